"""What every file of a table holds of its check column, kept between runs."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbmark.operators.delta import Check, Stats, in_files
from ebbmark.sources.tables import TableStore

ZONES = (
    "tablename string, checkcolumn string, file string, least bigint, largest bigint, "
    "row_count bigint, exact boolean"
)


def listed_files(frame: DataFrame) -> list[str]:
    """Files of a table as its rows name them; the driver holds this list to plan any scan."""
    return [re.sub(r"^(\w+):///", r"\1:/", path) for path in frame.inputFiles()]


@dataclass(frozen=True)
class ZoneMap:
    """A log with one row per file and check column: least and largest value, rows that have one.

    A run reads only the files that the log does not know yet. A file is known
    by its path: tables whose files are written once and replaced under new
    names, as Spark writes them, stay right; rows of files that are gone are not
    looked at. Keep a zone map to itself (``name``) where other jobs write to it
    at the same time; a file recorded twice counts once.
    """

    store: TableStore
    name: str = "zone_map"

    def zones(self, spark: SparkSession, check: Check) -> DataFrame:
        """Zones of the table's present files; those not known yet are read and recorded first."""
        listed = listed_files(check.frame)
        present = spark.createDataFrame([(path,) for path in listed], "file string").distinct()
        known = self._known(spark, check)
        fresh = present if known is None else present.join(known, "file", "left_anti")
        names = [row.file for row in fresh.collect()]
        if names:
            self._record(spark, check, names)
            known = self._known(spark, check)
        if known is None:
            return spark.createDataFrame([], ZONES)
        return known.join(present, "file", "left_semi")

    def stats(self, spark: SparkSession, check: Check) -> Stats:
        """Like ``table_stats``, from the zones; rows are read only of new files and of those the offset falls into."""
        zones = self.zones(spark, check)
        if check.offset is None:
            past, split = ("row_count > 0" if check.from_start else "false"), "false"
        else:
            past = f"largest >= {int(check.offset)}"
            split = f"least < {int(check.offset)} AND {past}"
        row = zones.agg(
            F.max("largest").alias("largest"),
            F.coalesce(F.expr(f"sum(row_count) FILTER (WHERE {past} AND NOT ({split}))"), F.lit(0)).alias("whole"),
            F.expr(f"collect_list(file) FILTER (WHERE {past})").alias("files"),
            F.expr(f"collect_list(file) FILTER (WHERE {split})").alias("split"),
            F.coalesce(F.min("exact"), F.lit(True)).alias("exact"),
        ).first()
        count = row.whole
        if row.split:
            count += in_files(check.frame.filter(check.at_or_past), row.split).count()
        return Stats(check.table, row.largest, count, row.exact, row.files)

    def _known(self, spark: SparkSession, check: Check) -> DataFrame | None:
        log = self.store.read_if_there(spark, self.name)
        if log is None:
            return None
        mine = log.filter((F.col("tablename") == check.table) & (F.col("checkcolumn") == check.column))
        state = [c for c in log.columns if c not in ("tablename", "checkcolumn", "file")]
        return mine.groupBy("file").agg(*(F.max(c).alias(c) for c in state))

    def _record(self, spark: SparkSession, check: Check, files: Iterable[str]) -> None:
        rows = in_files(check.frame, files)
        least, largest = f"min({check.value})", f"max({check.value})"
        found = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.expr(f"{check.as_offset(least)} AS least"),
            F.expr(f"{check.as_offset(largest)} AS largest"),
            F.expr(f"count({check.value}) AS row_count"),
            F.expr(f"{check.exact(least)} AND {check.exact(largest)} AS exact"),
        )
        # A file without rows is recorded too, or every run would open it again.
        named = spark.createDataFrame([(path,) for path in files], "file string").join(found, "file", "left")
        self.store.append(
            named.select(
                F.lit(check.table).alias("tablename"),
                F.lit(check.column).alias("checkcolumn"),
                "file",
                "least",
                "largest",
                F.coalesce("row_count", F.lit(0)).alias("row_count"),
                F.coalesce("exact", F.lit(True)).alias("exact"),
            ).coalesce(1),
            self.name,
        )
