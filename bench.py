"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data (default ``/root/testdata/sf0.1``) and
``BENCH_CPUS`` the local cores (default 8). Every figure is the median of three
runs after a warm-up, in seconds. ``value`` is the sum over ``queries``.

The exports move six tables, about the upper half of each by key, to parquet
and advance a stored control table. ``comparison`` is not part of ``value``:
the same work as three jobs per table, one table after another.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbmark import ControlTable, TableStore, export_batch, file_sink
from ebbmark.operators.delta import Check, delta
from ebbmark.operators.records import to_records
from ebbmark.plans.export import DRIVER_ROW, advanced, driver_rows, wall_millis
from ebbmark.plans.queries import QUERIES, tables_in
from ebbmark.sources.control_log import LOG_SCHEMA, conform
from ebbmark.sources.scratch import scratch_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3

SOURCES = {
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
}
# The same for tables checked by a time, from the middle of each.
TIME_SOURCES = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
TIMED = [
    "batch_export",
    "watermark_stats",
    "watermark_stats_pruned",
    "watermark_timestamp",
    "delta_long",
    "delta_int",
    "delta_timestamp",
    "delta_bounded",
    "records_events",
    "records_lineitem",
    "records_documents",
    "control_latest",
    "control_select",
    "partition_horizon",
    "partition_range",
    "next_due_table",
    "batch_clock",
    "day_text",
    "yesterday_text",
    "names_to_snake",
    "names_to_camel",
    "qualified_names",
    "declared_schema",
]


def median_seconds(run) -> float:
    run()
    times = []
    for _ in range(REPEATS):
        began = time.perf_counter()
        run()
        times.append(time.perf_counter() - began)
    return round(statistics.median(times), 3)


def consume(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def middle_offsets(spark: SparkSession) -> DataFrame:
    """Control rows whose offsets are half of each table's largest key; batch 1 by times."""
    tops = [
        tables_in(SF_DIR).read(spark, table).agg(F.max(column)).first()[0]
        for table, column in SOURCES.items()
    ]
    rows = [(t, 0, c, 2, top // 2, None) for (t, c), top in zip(SOURCES.items(), tops)]
    for table, column in TIME_SOURCES.items():
        ends = tables_in(SF_DIR).read(spark, table).agg(F.min(column).alias("low"), F.max(column).alias("top")).first()
        rows.append((table, 1, column, 0, None, ends.low + (ends.top - ends.low) / 2))
    schema = (
        "tablename string, typeid int, checkcolumn string, columntypeid int, longoffset bigint, batchstart_ts timestamp"
    )
    frame = spark.createDataFrame(rows, schema).withColumn("seq", F.lit(0))
    missing = [f for f in LOG_SCHEMA if f.name not in frame.columns]
    return conform(frame.withColumns({f.name: F.lit(None) for f in missing}), LOG_SCHEMA)


def new_control(start: DataFrame) -> tuple[ControlTable, str]:
    folder = scratch_folder(start.sparkSession)
    control = ControlTable(TableStore(name_value=folder + "/{table}"), "control")
    control.append(start)
    return control, folder


def three_jobs_per_table(spark: SparkSession, control: ControlTable, folder: str, batch: int = 0) -> None:
    """Maximum, count and write as jobs of their own, then the control row, table by table."""
    tables = tables_in(SF_DIR)
    for row in driver_rows(control.current(spark, batch)).toArrow().to_pylist():
        frame, started = tables.read(spark, row["tablename"]), wall_millis()
        check = Check(row["tablename"], frame, row["checkcolumn"], row["columntypeid"], row["stored_offset"])
        top = frame.agg(F.expr(check.as_offset(f"max({check.value})"))).first()[0]
        count = delta(check).count()
        records = to_records(delta(check), check.table)
        records.write.mode("append").parquet(f"{folder}/records")
        found = {
            **{name: row.get(name) for name in DRIVER_ROW.names},
            "max_offset": top,
            "delta_count": count,
            "started_millis": started,
            "ended_millis": wall_millis(),
        }
        moved = spark.createDataFrame(DRIVER_ROW.empty_table().from_pylist([found], DRIVER_ROW))
        control.append(moved.select(*advanced()))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ebbmark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = middle_offsets(spark)

    def export(batch: int = 0, **options) -> float:
        # Control tables are made beforehand: setting one up is not the export.
        fresh = iter([new_control(start) for _ in range(REPEATS + 1)])

        def run() -> None:
            control, folder = next(fresh)
            sink = file_sink(f"{folder}/records")
            export_batch(spark, batch, control, tables_in(SF_DIR), sink, **options)

        return median_seconds(run)

    def old_shape(batch: int = 0) -> float:
        fresh = iter([new_control(start) for _ in range(REPEATS + 1)])
        return median_seconds(lambda: three_jobs_per_table(spark, *next(fresh), batch))

    seconds = {
        "export_each": export(),
        "export_together": export(single_write=True),
        "export_times": export(1, single_write=True),
    }
    comparison = {"three_jobs_per_table": old_shape(), "three_jobs_per_timed_table": old_shape(1)}
    for name in TIMED:
        seconds[name] = median_seconds(lambda: consume(QUERIES[name](spark, SF_DIR)))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "median query seconds, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "comparison": comparison,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
