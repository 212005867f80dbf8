"""Command line of the batch export, for ``spark-submit``.

    spark-submit --py-files ebbmark.zip ebbmark/job.py 0 --settings export.json

The settings file names the control table, the source tables and the sink::

    {"control": {"format": "kudu", "options": {"kudu.master": "m:7051"},
                 "name_option": "kudu.table", "name": "export_control", "versioned": false},
     "tables": {"format": "kudu", "options": {"kudu.master": "m:7051"},
                "name_option": "kudu.table"},
     "sink": {"format": "kafka", "concurrent": 8,
              "options": {"kafka.bootstrap.servers": "b:9092", "topic": "export"}},
     "export": {"key_columns": {"db.orders": "customer_id"}, "spread": null, "shift_hours": 8}}

The master and everything else about the cluster is left to ``spark-submit``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from ebbmark import ControlTable, RecordSink, TableResult, TableStore, export_batch


def run(spark: SparkSession, batch_id: str, settings: dict) -> list[TableResult]:
    control = dict(settings["control"])
    name, versioned = control.pop("name"), control.pop("versioned", True)
    return export_batch(
        spark,
        batch_id,
        ControlTable(TableStore(**control), name, versioned),
        TableStore(**settings["tables"]),
        RecordSink(**settings["sink"]),
        **settings.get("export", {}),
    )


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Export the new rows of one batch of tables.")
    parser.add_argument("batch_id", help="batch to export, an integer")
    parser.add_argument("--settings", type=Path, required=True, help="JSON settings file")
    arguments = parser.parse_args(argv)
    spark = SparkSession.builder.appName("ebbmark-export").getOrCreate()
    for result in run(spark, arguments.batch_id, json.loads(arguments.settings.read_text())):
        print(f"{result.table}: {result.row_count} rows, offset {result.offset} -> {result.max_offset}")


if __name__ == "__main__":
    main()
