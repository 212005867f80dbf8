"""Registered queries, each next to the SQL that gives the same rows.

Every query reads the given tables whole. Control logs, schedules and names
are derived from them, so their size follows the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.functions.clock import batch_clock, day_number, day_text, truncate_second, yesterday_text
from ebbmark.functions.naming import qualified_name, to_camel, to_snake
from ebbmark.operators.delta import (
    Check,
    collect_stats,
    delta,
    stored_offset,
    stride_counts,
    table_stats,
    union,
)
from ebbmark.operators.ranges import (
    count_rows,
    day_horizon,
    in_days,
    in_days_by_time,
    pick_range,
)
from ebbmark.operators.records import header, once, to_records
from ebbmark.operators.schedule import next_due_table
from ebbmark.operators.schemas import apply_schema, camel_columns, declared_schema, snake_columns
from ebbmark.plans.export import advanced, driver_rows, export_batch
from ebbmark.sources.claims import Claims
from ebbmark.sources.control_log import LOG_SCHEMA, ControlTable, conform, latest, select_batch
from ebbmark.sources.partitions import catalog_days, time_days
from ebbmark.sources.scratch import scratch_folder
from ebbmark.sources.sinks import file_sink
from ebbmark.sources.tables import TableStore, register_view
from ebbmark.sources.zone_map import ZoneMap

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-01-30"
EVENTS_FROM = "2024-01-15 00:00:00"
BATCH_MILLIS = 1_706_700_000_000


def registered(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, or another, with its SQL."""

    def register(query: Query) -> Query:
        QUERIES[name or query.__name__] = query
        ORACLES[name or query.__name__] = sql
        return query

    return register


def tables_in(sf_dir: str) -> TableStore:
    return TableStore("parquet", name_value=sf_dir.rstrip("/") + "/{table}.parquet")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tables_in(sf_dir).read(spark, table)


def local_times(frame: DataFrame) -> DataFrame:
    """Timestamps as local times, which have one reading everywhere."""
    return frame.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else f.name
            for f in frame.schema
        )
    )


# --- control rows -----------------------------------------------------------


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control log in which every order is one version of its customer's row."""
    status = F.col("o_orderstatus")
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("customer_"), "o_custkey").alias("tablename"),
        F.col("o_orderdate").cast("timestamp").alias("batchstart_ts"),
        (F.col("o_orderdate") + F.expr("INTERVAL '1' HOUR")).cast("timestamp").alias("batchend_ts"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("typeid"),
        F.col("o_orderpriority").alias("typename"),
        F.lit("o_orderkey").alias("checkcolumn"),
        F.col("o_custkey").cast("int").alias("intoffset"),
        F.col("o_orderkey").alias("longoffset"),
        F.when(status == "O", 0).when(status == "F", 1).otherwise(2).alias("columntypeid"),
        status.alias("cloumntypename"),
        F.floor("o_totalprice").alias("currentbatchcount"),
        (status == "O").alias("ordered"),
        F.col("o_orderkey").alias("seq"),
    )


ORDER_LOG_SQL = """
WITH log AS (
  SELECT 'customer_' || o_custkey AS tablename,
         o_orderdate AS batchstart_ts,
         o_orderdate + INTERVAL 1 HOUR AS batchend_ts,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS typeid,
         o_orderpriority AS typename,
         'o_orderkey' AS checkcolumn,
         CAST(o_custkey AS INTEGER) AS intoffset,
         o_orderkey AS longoffset,
         CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS columntypeid,
         o_orderstatus AS cloumntypename,
         CAST(floor(o_totalprice) AS BIGINT) AS currentbatchcount,
         o_orderstatus = 'O' AS ordered,
         o_orderkey AS seq
  FROM orders
), latest AS (
  SELECT * FROM log
  QUALIFY row_number() OVER (PARTITION BY typeid, tablename ORDER BY seq DESC) = 1
)
"""


@registered(ORDER_LOG_SQL + "SELECT * FROM log WHERE typeid = 0")
def control_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return local_times(select_batch(order_log(spark, sf_dir), "0"))


@registered(ORDER_LOG_SQL + "SELECT * FROM latest")
def control_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return local_times(latest(order_log(spark, sf_dir)))


@registered(
    ORDER_LOG_SQL
    + """
SELECT tablename, typeid, columntypeid,
       CASE columntypeid WHEN 0 THEN epoch_us(batchstart_ts)
                         WHEN 1 THEN CAST(intoffset AS BIGINT)
                         ELSE longoffset END AS stored_offset
FROM latest"""
)
def stored_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest(order_log(spark, sf_dir))
    return rows.select("tablename", "typeid", "columntypeid", stored_offset().alias("stored_offset"))


@registered(ORDER_LOG_SQL + "SELECT * FROM latest")
def control_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log appended to a stored control table, compacted, and read back."""
    folder = TableStore(name_value=scratch_folder(spark) + "/{table}")
    log, compacted = ControlTable(folder, "control"), ControlTable(folder, "compacted")
    log.append(order_log(spark, sf_dir))
    log.compact_into(spark, compacted)
    return local_times(compacted.current(spark))


# --- check columns ----------------------------------------------------------


def check(
    spark: SparkSession, sf_dir: str, table: str, column: str, type_id: int, offset: int
) -> Check:
    return Check(table, read(spark, sf_dir, table), column, type_id, offset)


def micros(local: str) -> int:
    """Microseconds since the epoch of a UTC time."""
    return int(datetime.fromisoformat(local + "+00:00").timestamp()) * 1_000_000


def number_checks(spark: SparkSession, sf_dir: str) -> list[Check]:
    return [
        check(spark, sf_dir, "events", "event_id", 2, 500),
        check(spark, sf_dir, "orders", "o_orderkey", 2, 700),
        check(spark, sf_dir, "part", "p_size", 1, 25),
        check(spark, sf_dir, "lineitem", "l_orderkey", 2, 700),
        check(spark, sf_dir, "lineitem", "l_linenumber", 1, 9),
        check(spark, sf_dir, "customer", "c_custkey", 2, 75),
        check(spark, sf_dir, "documents", "doc_id", 2, 0),
    ]


NUMBER_STATS_SQL = """
SELECT 'events' AS tablename, CAST(max(event_id) AS BIGINT) AS max_offset,
       count(*) FILTER (WHERE event_id >= 500) AS delta_count FROM events
UNION ALL SELECT 'orders', max(o_orderkey), count(*) FILTER (WHERE o_orderkey >= 700) FROM orders
UNION ALL SELECT 'part', max(p_size), count(*) FILTER (WHERE p_size >= 25) FROM part
UNION ALL SELECT 'lineitem', max(l_orderkey), count(*) FILTER (WHERE l_orderkey >= 700) FROM lineitem
UNION ALL SELECT 'lineitem', max(l_linenumber), count(*) FILTER (WHERE l_linenumber >= 9) FROM lineitem
UNION ALL SELECT 'customer', max(c_custkey), count(*) FILTER (WHERE c_custkey >= 75) FROM customer
UNION ALL SELECT 'documents', max(doc_id), count(*) FILTER (WHERE doc_id >= 0) FROM documents
"""


@registered(NUMBER_STATS_SQL)
def watermark_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union(table_stats(c) for c in number_checks(spark, sf_dir)).drop("exact")


@registered(NUMBER_STATS_SQL)
def watermark_stats_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures the way the export gets them: from the delta alone
    where there is one, here from the whole table for line numbers."""
    found = [tuple(stats[:3]) for stats in collect_stats(number_checks(spark, sf_dir))]
    return spark.createDataFrame(found, "tablename string, max_offset bigint, delta_count bigint")


@registered(
    """
SELECT 'events' AS tablename, epoch_us(max(ts)) AS max_offset,
       count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15 00:00:00') AS delta_count FROM events
UNION ALL SELECT 'orders', epoch_us(max(o_orderdate)),
       count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1996-07-01 00:00:00') FROM orders
UNION ALL SELECT 'lineitem', epoch_us(max(l_shipdate)),
       count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1998-12-01 00:00:00') FROM lineitem
"""
)
def watermark_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        check(spark, sf_dir, "events", "ts", 0, micros(EVENTS_FROM)),
        check(spark, sf_dir, "orders", "o_orderdate", 0, micros("1996-07-01 00:00:00")),
        check(spark, sf_dir, "lineitem", "l_shipdate", 0, micros("1998-12-01 00:00:00")),
    ]
    return union(table_stats(c) for c in checks).drop("exact")


@registered("SELECT * FROM orders WHERE o_orderkey >= 700")
def delta_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta(check(spark, sf_dir, "orders", "o_orderkey", 2, 700))


@registered("SELECT * FROM part WHERE p_size >= 25")
def delta_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta(check(spark, sf_dir, "part", "p_size", 1, 25))


@registered("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def delta_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta(check(spark, sf_dir, "events", "ts", 0, micros(EVENTS_FROM)))


@registered(
    "SELECT * FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'"
)
def delta_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delta with an upper bound, as a repeated batch would read it."""
    shipped = check(spark, sf_dir, "lineitem", "l_shipdate", 0, micros("1997-01-01 00:00:00"))
    return delta(shipped, upper=micros("1997-12-31 00:00:00"))


# --- records and the batch --------------------------------------------------

# Columns of the given tables, times marked with a star, arrays of floats with two.
COLUMNS = {
    "events": "event_id ts* user_id event_type value props",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate* o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate*",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "nation": "n_nationkey n_name n_regionkey",
    "region": "r_regionkey r_name",
    "documents": "doc_id text lang source n_chars",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
    "embeddings": "vec_id embedding** label",
}

# A float as JSON has it here: shortest digits, below a thousandth with an
# exponent. DuckDB's own JSON widens floats to doubles, so the text is built
# from its shortest form, plain (0.00012) or with an exponent (1.2e-05).
_SHORT = "CAST(x AS VARCHAR)"
_DIGITS = f"ltrim(replace(replace({_SHORT}, '-', ''), '.', ''), '0')"
_ZEROS = f"length(regexp_extract({_SHORT}, '^-?0[.](0*)', 1))"
FLOAT_SQL = f"""CASE WHEN x = 0 OR abs(x) >= 1e-3 THEN {_SHORT}
  WHEN {_SHORT} LIKE '%e-%' THEN
    split_part({_SHORT}, 'e-', 1) || CASE WHEN {_SHORT} LIKE '%.%' THEN '' ELSE '.0' END
      || 'E-' || CAST(CAST(split_part({_SHORT}, 'e-', 2) AS INTEGER) AS VARCHAR)
  ELSE CASE WHEN x < 0 THEN '-' ELSE '' END || left({_DIGITS}, 1) || '.'
      || CASE WHEN length({_DIGITS}) > 1 THEN substr({_DIGITS}, 2) ELSE '0' END
      || 'E-' || CAST({_ZEROS} + 1 AS VARCHAR) END"""


def record_sql(table: str) -> str:
    """SQL for the JSON of a row."""
    fields, lists = [], []
    for c in COLUMNS[table].split():
        name = c.rstrip("*")
        if c.endswith("**"):
            # Put in as text at the end: a number inside JSON would be spelled anew.
            fields.append(f"{name} := '@{name}@'")
            lists.append((name, f"'[' || array_to_string(list_transform({name}, lambda x: {FLOAT_SQL}), ',') || ']'"))
        elif c.endswith("*"):
            fields.append(f"{name} := epoch_us({name}) // 1000")
        else:
            fields.append(f"{name} := {name}")
    text = f"CAST(to_json(struct_pack({', '.join(fields)})) AS VARCHAR)"
    for name, value in lists:
        text = f"""replace({text}, '"@{name}@"', {value})"""
    return text


EVENT_RECORD, PART_RECORD, ORDER_RECORD = (record_sql(t) for t in ("events", "part", "orders"))


@registered(f"SELECT 'events' AS key, {EVENT_RECORD} AS value FROM events WHERE event_id >= 500")
def records_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_records(delta(check(spark, sf_dir, "events", "event_id", 2, 500)), "events")


@registered(f"SELECT 'part' AS key, {PART_RECORD} AS value FROM part WHERE p_size >= 25")
def records_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_records(delta(check(spark, sf_dir, "part", "p_size", 1, 25)), "part")


@registered(f"SELECT 'lineitem' AS key, {record_sql('lineitem')} AS value FROM lineitem")
def records_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_records(read(spark, sf_dir, "lineitem"), "lineitem")


@registered(f"SELECT CAST(c_nationkey AS VARCHAR) AS key, {record_sql('customer')} AS value FROM customer")
def records_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed by a column, which spreads a table over the partitions of a topic."""
    return to_records(read(spark, sf_dir, "customer"), "customer", key_column="c_nationkey")


@registered(f"SELECT 'embeddings' AS key, {record_sql('embeddings')} AS value FROM embeddings")
def records_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of floats, each in its shortest digits."""
    return to_records(read(spark, sf_dir, "embeddings"), "embeddings")


@registered(f"SELECT 'documents' AS key, {record_sql('documents')} AS value FROM documents")
def records_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_records(read(spark, sf_dir, "documents"), "documents")


@registered(f"SELECT 'pages' AS key, {record_sql('pages')} AS value FROM pages")
def records_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_records(read(spark, sf_dir, "pages"), "pages")


@registered(
    NUMBER_STATS_SQL
    + """
UNION ALL SELECT 'events_ts', epoch_us(max(ts)), count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15 00:00:00') FROM events
"""
)
def watermark_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stats of whole tables out of a zone map's second run, which reads no row of files that lie on one side of the offset."""
    zones = ZoneMap(TableStore(name_value=scratch_folder(spark) + "/{table}"))
    timed = check(spark, sf_dir, "events", "ts", 0, micros(EVENTS_FROM))
    checks = [*number_checks(spark, sf_dir), replace(timed, table="events_ts")]
    for c in checks:
        zones.zones(spark, c)
    found = [zones.stats(spark, c) for c in checks]
    rows = [(s.table, s.max_offset, s.delta_count) for s in found]
    return spark.createDataFrame(rows, "tablename string, max_offset bigint, delta_count bigint")


@registered(
    " UNION ALL ".join(
        f"SELECT '{table}' AS tablename, CAST(max({column}) AS BIGINT) AS max_offset, count({column}) AS delta_count FROM {table}"
        for table, column in (("events", "event_id"), ("orders", "o_orderkey"), ("part", "p_size"), ("lineitem", "l_linenumber"), ("pages", "page_id"))
    )
)
def watermark_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stats of tables taken from their start, out of the files' footers."""
    kinds = {"events": ("event_id", 2), "orders": ("o_orderkey", 2), "part": ("p_size", 1), "lineitem": ("l_linenumber", 1), "pages": ("page_id", 2)}
    checks = [Check(t, read(spark, sf_dir, t), c, kind, None, from_start=True) for t, (c, kind) in kinds.items()]
    rows = [(s.table, s.max_offset, s.delta_count) for s in collect_stats(checks)]
    return spark.createDataFrame(rows, "tablename string, max_offset bigint, delta_count bigint")


@registered(
    """
SELECT CAST((l_orderkey - 700) // greatest(1, CAST(ceil((max_key + 1 - 700) / 16.0) AS BIGINT)) AS INTEGER) AS part, count(*) AS row_count
FROM lineitem, (SELECT max(l_orderkey) AS max_key FROM lineitem) WHERE l_orderkey >= 700 GROUP BY 1"""
)
def delta_strides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a delta in each of the strides that a split read deals to its tasks."""
    c = check(spark, sf_dir, "lineitem", "l_orderkey", 2, 700)
    return stride_counts(c, collect_stats([c])[0].max_offset, 16)


BATCH_SQL = f"""
SELECT 'events' AS key, {EVENT_RECORD} AS value FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
UNION ALL SELECT 'part', {PART_RECORD} FROM part WHERE p_size >= 25
UNION ALL SELECT 'orders', {ORDER_RECORD} FROM orders WHERE o_orderkey >= 700
"""


def batch_zero(spark: SparkSession, sf_dir: str) -> list[Check]:
    return [
        check(spark, sf_dir, "events", "ts", 0, micros(EVENTS_FROM)),
        check(spark, sf_dir, "part", "p_size", 1, 25),
        check(spark, sf_dir, "orders", "o_orderkey", 2, 700),
    ]


@registered(BATCH_SQL)
def batch_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of a batch: stats of its tables first, then the bounded deltas."""
    checks = batch_zero(spark, sf_dir)
    return union(
        to_records(delta(c, stats.max_offset), c.table)
        for c, stats in zip(checks, collect_stats(checks))
    )


CONTROL_ROWS = (
    "tablename string, typeid int, checkcolumn string, columntypeid int, "
    "start string, intoffset int, longoffset bigint"
)
BATCH_ROWS = [
    ("events", 0, "ts", 0, EVENTS_FROM, 0, 0),
    ("part", 0, "p_size", 1, "2024-01-01 00:00:00", 25, 0),
    ("orders", 0, "o_orderkey", 2, "2024-01-01 00:00:00", 0, 700),
    ("customer", 1, "c_custkey", 2, "2024-01-01 00:00:00", 0, 0),
]


def control_rows(spark: SparkSession) -> DataFrame:
    """Control rows of two batches over the given tables."""
    rows = spark.createDataFrame(BATCH_ROWS, CONTROL_ROWS).select(
        "*",
        F.col("start").cast("timestamp").alias("batchstart_ts"),
        F.lit("2024-01-01 01:00:00").cast("timestamp").alias("batchend_ts"),
        F.lit("hourly").alias("typename"),
        F.element_at(
            F.array(F.lit("timestamp"), F.lit("int"), F.lit("long")), F.col("columntypeid") + 1
        ).alias("cloumntypename"),
        F.lit(0).alias("currentbatchcount"),
        F.lit(False).alias("ordered"),
        F.lit(0).alias("seq"),
    )
    return conform(rows, LOG_SCHEMA)


def run_batch(spark: SparkSession, sf_dir: str, runs: int, **options) -> tuple[ControlTable, str]:
    """Export batch 0 ``runs`` times; gives the control table and the last sink folder."""
    folder = scratch_folder(spark)
    control = ControlTable(TableStore(name_value=folder + "/{table}"), "control")
    control.append(control_rows(spark))
    for run in range(runs):
        sink = file_sink(f"{folder}/records-{run}")
        export_batch(
            spark, 0, control, tables_in(sf_dir), sink, clock=lambda: BATCH_MILLIS, **options
        )
    return control, f"{folder}/records-{runs - 1}"


@registered(BATCH_SQL)
def export_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job against a stored control table and a file sink."""
    _, records = run_batch(spark, sf_dir, 1)
    return spark.read.parquet(records).select("key", "value")


@registered(BATCH_SQL)
def export_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job with stats from a zone map, holding the batch by a claim."""
    folder = TableStore(name_value=scratch_folder(spark) + "/{table}")
    _, records = run_batch(spark, sf_dir, 1, zones=ZoneMap(folder), claims=Claims(folder))
    return spark.read.parquet(records).select("key", "value")


@registered(BATCH_SQL)
def export_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two runs, the second of which sends the boundary rows again, each left once by the headers."""
    folder = scratch_folder(spark)
    control = ControlTable(TableStore(name_value=folder + "/{table}"), "control")
    control.append(control_rows(spark))
    for run in ("first", "second"):
        export_batch(spark, 0, control, tables_in(sf_dir), file_sink(f"{folder}/records"), run_id=run, clock=lambda: BATCH_MILLIS)
    return once(spark.read.parquet(f"{folder}/records").drop("source")).select("key", "value")


@registered(
    f"""
SELECT 'lineitem' AS key, {record_sql('lineitem')} AS value, true AS in_order FROM lineitem
UNION ALL SELECT 'orders', {record_sql('orders')}, true FROM orders"""
)
def export_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables dealt by ranges of their check column; whether the ranges of a table lie apart."""
    rows = [("lineitem", 0, "l_orderkey", 2), ("orders", 0, "o_orderkey", 2)]
    sent = first_batch(spark, sf_dir, rows, ordered=8, run_id="run")
    offset = header("offset").cast("bigint")
    ranges = sent.groupBy("key", "partition").agg(F.min(offset).alias("low"), F.max(offset).alias("high"))
    before = ranges.select("key", (F.col("partition") + 1).alias("partition"), F.col("high").alias("below"))
    placed = ranges.join(before, ["key", "partition"], "left")
    apart = placed.select("key", "partition", F.expr("coalesce(below < low, true)").alias("in_order"))
    # A row per table and topic partition: the records stay where they are.
    return sent.join(F.broadcast(apart), ["key", "partition"]).select("key", "value", "in_order")


@registered(ORDER_LOG_SQL + "SELECT * FROM latest")
def control_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log compacted in place twice, with an append between and one after."""
    folder = TableStore(name_value=scratch_folder(spark) + "/{table}")
    control = ControlTable(folder, "control", manifest="pointers")
    log = order_log(spark, sf_dir)
    for part in range(3):
        if part:
            control.compact(spark)
        control.append(log.filter(F.col("seq") % 3 == part))
    return local_times(control.current(spark))


@registered(BATCH_SQL)
def export_single_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, records = run_batch(spark, sf_dir, 1, single_write=True)
    return spark.read.parquet(records).select("key", "value")


@registered(
    " UNION ALL ".join(f"SELECT '{t}' AS key, {record_sql(t)} AS value FROM {t}" for t in COLUMNS)
)
def export_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first batch over every table: without an offset yet, all rows are new."""
    # The first column of every table serves as its check column.
    checked = {table: columns.split()[0] for table, columns in COLUMNS.items()}
    kinds = {"nation": 1, "region": 1}
    return first_batch(spark, sf_dir, [(table, 0, key, kinds.get(table, 2)) for table, key in checked.items()])


def first_batch(spark: SparkSession, sf_dir: str, rows: list[tuple], **options) -> DataFrame:
    """Records of a batch of tables ``(tablename, typeid, checkcolumn, columntypeid)`` without offsets."""
    folder = scratch_folder(spark)
    control = ControlTable(TableStore(name_value=folder + "/{table}"), "control")
    schema = "tablename string, typeid int, checkcolumn string, columntypeid int"
    first = spark.createDataFrame(rows, schema)
    missing = {f.name: F.lit(None) for f in LOG_SCHEMA if f.name not in first.columns}
    control.append(conform(first.withColumns(missing), LOG_SCHEMA))
    sink = file_sink(f"{folder}/records")
    export_batch(spark, 0, control, tables_in(sf_dir), sink, from_start=True, **options)
    return spark.read.parquet(f"{folder}/records").drop("source")


TIMED = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}


@registered(" UNION ALL ".join(f"SELECT '{t}' AS key, {record_sql(t)} AS value FROM {t}" for t in TIMED))
def export_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables checked by a time, whose stats name the files to read."""
    return first_batch(spark, sf_dir, [(table, 0, column, 0) for table, column in TIMED.items()])


@registered(
    f"SELECT c_mktsegment AS key, {record_sql('customer')} AS value, true AS placed FROM customer "
    f"UNION ALL SELECT 'part', {PART_RECORD}, true FROM part"
)
def export_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlike tables in one batch, one keyed by a column, both dealt over eight topic partitions."""
    rows = [("customer", 0, "c_custkey", 2), ("part", 0, "p_partkey", 2)]
    sent = first_batch(spark, sf_dir, rows, key_columns={"customer": "c_mktsegment"}, spread=8)
    return sent.select("key", "value", F.col("partition").between(0, 7).alias("placed"))


@registered(
    f"""
SELECT 'events' AS key, {EVENT_RECORD} AS value FROM events WHERE ts = (SELECT max(ts) FROM events)
UNION ALL SELECT 'part', {PART_RECORD} FROM part WHERE p_size = (SELECT max(p_size) FROM part)
UNION ALL SELECT 'orders', {ORDER_RECORD} FROM orders
  WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)
"""
)
def export_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run on unchanged tables sends the boundary rows again, and only them."""
    _, records = run_batch(spark, sf_dir, 2)
    return spark.read.parquet(records).select("key", "value")


# The batch clock of the run, 2024-01-31 11:20:00, is eight hours on in the control rows.
ADVANCED_SQL = """
SELECT 'events' AS tablename, 0 AS typeid, max(ts) AS batchstart_ts,
       TIMESTAMP '2024-01-31 19:20:00' AS batchend_ts, 0 AS intoffset,
       CAST(0 AS BIGINT) AS longoffset,
       count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15 00:00:00') AS currentbatchcount,
       CAST(1 AS BIGINT) AS seq FROM events
UNION ALL SELECT 'part', 0, TIMESTAMP '2024-01-31 19:20:00', TIMESTAMP '2024-01-31 19:20:00',
       max(p_size), 0, count(*) FILTER (WHERE p_size >= 25), 1 FROM part
UNION ALL SELECT 'orders', 0, TIMESTAMP '2024-01-31 19:20:00', TIMESTAMP '2024-01-31 19:20:00',
       0, max(o_orderkey), count(*) FILTER (WHERE o_orderkey >= 700), 1 FROM orders
"""
ADVANCED_FIELDS = (
    "tablename", "typeid", "batchstart_ts", "batchend_ts",
    "intoffset", "longoffset", "currentbatchcount", "seq",
)


@registered(ADVANCED_SQL)
def control_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows moved to the watermarks of whole tables, without a job before."""
    rows = driver_rows(select_batch(control_rows(spark), 0))
    stats = union(table_stats(c) for c in batch_zero(spark, sf_dir))
    clock = F.lit(BATCH_MILLIS)
    found = rows.join(stats, "tablename").withColumns(
        {"started_millis": clock, "ended_millis": clock}
    )
    moved = found.select(*advanced())
    return local_times(moved.select(*ADVANCED_FIELDS))


@registered(
    ADVANCED_SQL
    + "UNION ALL SELECT 'customer', 1, TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 01:00:00', "
    "0, 0, 0, 0"
)
def export_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control state after a run: batch 0 has moved, batch 1 has not."""
    control, _ = run_batch(spark, sf_dir, 1)
    return local_times(control.current(spark).select(*ADVANCED_FIELDS))


@registered(f"SELECT 'part' AS key, {PART_RECORD} AS value FROM part WHERE p_size >= 25")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    file_sink(folder, "json").write(records_part(spark, sf_dir), "part")
    return spark.read.schema("key string, value string").json(folder).select("key", "value")


@registered("SELECT event_type, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY event_type")
def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = register_view(read(spark, sf_dir, "events"), "store::db.events")
    return spark.sql(
        f"SELECT event_type, count(*) AS n, max(ts) AS last_ts FROM {view} GROUP BY event_type"
    )


@registered("SELECT * FROM customer")
def source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer")


# --- day partitions ---------------------------------------------------------


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_days(read(spark, sf_dir, "events"), "ts")


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


@registered(
    """
WITH b AS (SELECT min(d) AS first, least(max(d), 20240129) AS final
           FROM (SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS d FROM events)),
     s AS (SELECT unnest([20231201, 20240110, 20240305]) AS start_day)
SELECT start_day,
       NOT (first <= start_day AND start_day <= final) AND NOT start_day < first AS incremental,
       CASE WHEN first <= start_day AND start_day <= final THEN start_day
            WHEN start_day < first THEN first ELSE final END AS low,
       final AS high
FROM b, s"""
)
def partition_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_horizon(event_days(spark, sf_dir), [20231201, 20240110, 20240305], as_of())


RANGE_SQL = "FROM events WHERE strftime(ts, '%Y%m%d') BETWEEN '20240110' AND '20240129'"


@registered(f"SELECT * {RANGE_SQL}")
def partition_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = pick_range(event_days(spark, sf_dir), 20240110, as_of())
    return in_days_by_time(read(spark, sf_dir, "events"), days, "ts")


@registered(f"SELECT count(*) AS row_count {RANGE_SQL}")
def partition_range_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(partition_range(spark, sf_dir))


@registered(
    "SELECT *, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day FROM events "
    "WHERE strftime(ts, '%Y%m%d') = '20240129'"
)
def partition_range_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day of a table stored by day; a start after the end reads that day alone.

    A day goes to few tasks and a task to few days, large days being split, so
    that files are neither many nor huge. The days come from the metastore.
    """
    table = f"by_day_{uuid.uuid4().hex}"
    events = read(spark, sf_dir, "events").withColumn("day", day_number(F.col("ts"))).hint("rebalance", F.col("day"))
    # A table at a path of its own: dropping it later leaves the files to this query's frame.
    events.write.partitionBy("day").option("path", scratch_folder(spark)).saveAsTable(table)
    days = pick_range(catalog_days(spark, table), 20240305, as_of())
    return in_days(spark.read.table(table), days)


@registered(
    """
WITH schedule AS (
  SELECT user_id AS seq, 'user_' || user_id AS tablename, CAST(max(ts) AS DATE) AS last_batch
  FROM events GROUP BY user_id)
SELECT coalesce((SELECT tablename FROM schedule
                 WHERE last_batch IS NULL OR last_batch = DATE '2024-01-29'
                 ORDER BY seq LIMIT 1), '') AS tablename""",
    "next_due_table",
)
def next_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule of one table per user, last run on the day of the user's last event."""
    schedule = (
        read(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("seq"))
        .agg(F.max("ts").cast("date").alias("last_batch"))
        .withColumn("tablename", F.concat(F.lit("user_"), "seq"))
    )
    return next_due_table(schedule, as_of())


# --- clocks and names -------------------------------------------------------


def event_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp")).alias("millis")
    return read(spark, sf_dir, "events").select("event_id", millis, "ts")


@registered("SELECT event_id, date_trunc('second', ts) + INTERVAL 8 HOUR AS clock FROM events", "batch_clock")
def batch_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_millis(spark, sf_dir)
    return local_times(rows.select("event_id", batch_clock(F.col("millis")).alias("clock")))


@registered("SELECT event_id, date_trunc('second', ts) AS clock FROM events", "truncate_second")
def truncated_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_millis(spark, sf_dir)
    return local_times(rows.select("event_id", truncate_second(F.col("millis")).alias("clock")))


@registered(
    """
SELECT l_orderkey, l_linenumber, l_partkey,
       coalesce(strftime(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_shipdate END, '%Y%m%d'), '0')
         AS day
FROM lineitem""",
    "day_text",
)
def day_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship days, with returned lines counting as not shipped."""
    shipped = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", day_text(shipped).alias("day")
    )


@registered(
    """SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
       strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS partition_before FROM orders""",
    "yesterday_text",
)
def yesterday_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = F.col("o_orderdate").cast("date")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        yesterday_text(ordered).alias("day_before"),
        yesterday_text(ordered, "yyyyMMdd").alias("partition_before"),
    )


@registered(
    r"""
WITH names AS (SELECT c_name AS name FROM customer
  UNION ALL SELECT c_mktsegment || c_name FROM customer
  UNION ALL SELECT o_orderpriority || o_orderstatus FROM orders
  UNION ALL SELECT url FROM pages
  UNION ALL SELECT p_type || '_' || p_brand || p_name FROM part)
SELECT name, lower(substr(name, 1, 1) ||
         regexp_replace(substr(name, 2), '([^\p{Ll}\p{Nd}_])', '_\1', 'g')) AS snake
FROM names"""
)
def names_to_snake(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {
        "customer": [F.col("c_name"), F.concat("c_mktsegment", "c_name")],
        "orders": [F.concat("o_orderpriority", "o_orderstatus")],
        "pages": [F.col("url")],
        "part": [F.concat("p_type", F.lit("_"), "p_brand", "p_name")],
    }
    rows = union(
        read(spark, sf_dir, table).select(name.alias("name"))
        for table, columns in names.items()
        for name in columns
    )
    return rows.select("name", to_snake(F.col("name")).alias("snake"))


@registered(
    """
WITH names AS (SELECT p_type || '__' || replace(p_name, ' ', '_') || '_' || p_brand AS name FROM part
  UNION ALL SELECT '_' || o_orderpriority || '_' || o_orderstatus || '_' FROM orders
  UNION ALL SELECT c_name FROM customer),
split AS (SELECT name, list_filter(string_split(name, '_'), lambda p: p <> '') AS pieces FROM names)
SELECT name,
  CASE WHEN contains(name, '_') THEN array_to_string(list_transform(pieces, lambda p, i:
         CASE WHEN i = 1 THEN lower(p) ELSE upper(p[1]) || lower(p[2:]) END), '')
       ELSE lower(name[1]) || name[2:] END AS camel,
  CASE WHEN contains(name, '_') THEN array_to_string(list_transform(pieces, lambda p:
         upper(p[1]) || lower(p[2:])), '')
       ELSE upper(name[1]) || name[2:] END AS pascal
FROM split"""
)
def names_to_camel(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, orders, customer = (read(spark, sf_dir, t) for t in ("part", "orders", "customer"))
    mark = F.lit("_")
    spaced = F.replace("p_name", F.lit(" "), mark)
    rows = union(
        [
            part.select(F.concat("p_type", F.lit("__"), spaced, mark, "p_brand").alias("name")),
            orders.select(F.concat(mark, "o_orderpriority", mark, "o_orderstatus", mark)),
            customer.select("c_name"),
        ]
    )
    name = F.col("name")
    return rows.select("name", to_camel(name).alias("camel"), to_camel(name, True).alias("pascal"))


@registered(
    """SELECT l_orderkey AS lOrderkey, l_partkey AS lPartkey, l_suppkey AS lSuppkey,
  l_linenumber AS lLinenumber, l_quantity AS lQuantity, l_extendedprice AS lExtendedprice,
  l_discount AS lDiscount, l_tax AS lTax, l_returnflag AS lReturnflag,
  l_linestatus AS lLinestatus, l_shipdate AS lShipdate FROM lineitem"""
)
def columns_to_camel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camel_columns(read(spark, sf_dir, "lineitem"))


@registered("SELECT * FROM lineitem")
def columns_to_snake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Camel-case columns and back: the names the table has."""
    return snake_columns(columns_to_camel(spark, sf_dir))


@registered(
    """
WITH names AS (SELECT source || '.' || lang AS name FROM documents
  UNION ALL SELECT lang FROM documents
  UNION ALL SELECT replace(replace(url, 'http://', ''), 'https://', '') FROM pages)
SELECT name, CASE WHEN contains(name, '.') THEN split_part(name, '.', 1) ELSE 'main' END AS "database",
       CASE WHEN contains(name, '.') THEN split_part(name, '.', 2) ELSE name END AS "table"
FROM names"""
)
def qualified_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, pages = read(spark, sf_dir, "documents"), read(spark, sf_dir, "pages")
    names = union(
        [
            documents.select(F.concat("source", F.lit("."), "lang").alias("name")),
            documents.select("lang"),
            pages.select(F.regexp_replace("url", "https?://", "")),
        ]
    )
    name = F.col("name")
    return names.select("name", qualified_name(name, "main").alias("q")).select("name", "q.*")


@registered(
    """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
       CAST(c_acctbal AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer""",
    "declared_schema",
)
def declared_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under declared types; the long key becomes a string."""
    schema = declared_schema(
        {
            "c_custkey": "long",
            "c_name": "string",
            "c_nationkey": "int",
            "c_acctbal": "double",
            "c_mktsegment": "string",
        }
    )
    return apply_schema(read(spark, sf_dir, "customer"), schema)
