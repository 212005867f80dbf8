"""Batch sinks for key/value records."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class RecordSink:
    """Appends records with any batch writer.

    An option may contain ``{table}``; it is filled in with the name of the
    table being exported, escaped so that it is one path element.
    ``concurrent`` is how many tables may be written at a time. Leave it at 1
    where two appends to one place disturb each other, as they do when two
    file writers share a folder.
    """

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    concurrent: int = 1

    def write(self, records: DataFrame, table: str) -> None:
        place = quote(table, safe="")
        options = {
            key: value.replace("{table}", place) if isinstance(value, str) else value
            for key, value in self.options.items()
        }
        records.write.format(self.format).options(**options).mode("append").save()


def kafka_sink(servers: str, topic: str, concurrent: int = 8, **options: str) -> RecordSink:
    """One topic for every table. Needs the Spark Kafka connector on the classpath."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, **options}
    return RecordSink("kafka", settings, concurrent)


def file_sink(path: str, format: str = "parquet", concurrent: int = 8, **options: str) -> RecordSink:
    """A folder per table below ``path``, readable as one table partitioned by ``source``."""
    return RecordSink(format, {"path": path + "/source={table}", **options}, concurrent)
