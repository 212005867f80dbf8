from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ebbmark.operators.ranges import (
    DayRange,
    count_rows,
    day_horizon,
    in_days,
    in_days_by_time,
    pick_range,
)
from ebbmark.operators.records import to_records
from ebbmark.operators.schedule import next_due_table
from ebbmark.sources.partitions import catalog_days, time_days
from ebbmark.sources.sinks import file_sink


def as_of():
    return F.lit("2024-01-30").cast("date")


def days(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "day int")


@pytest.mark.parametrize(
    "partitions,start,expected",
    [
        ((20240105, 20240110, 20240120), 20240105, (False, 20240105, 20240120)),
        ((20240105, 20240110, 20240120), 20240107, (False, 20240107, 20240120)),
        ((20240105, 20240110, 20240120), 20240120, (False, 20240120, 20240120)),
        ((20240105, 20240110, 20240120), 20240104, (False, 20240105, 20240120)),
        ((20240105, 20240110, 20240120), 20240121, (True, 20240120, 20240120)),
        ((20240105, 20240129), 20240129, (False, 20240129, 20240129)),
        ((20240105, 20240131), 20240130, (True, 20240129, 20240129)),
        ((20240105, 20240131), 20240129, (False, 20240129, 20240129)),
        # Every partition in the future: low is past high, so nothing is read.
        ((20240201, 20240202), 20240101, (False, 20240201, 20240129)),
        ((20240201, 20240202), 20240201, (True, 20240129, 20240129)),
        ((20240110,), 20240110, (False, 20240110, 20240110)),
    ],
)
def test_rules(spark, partitions, start, expected):
    assert pick_range(days(spark, *partitions), start, as_of()) == expected


def test_no_partitions_no_range(spark):
    assert pick_range(days(spark), 20240101, as_of()) is None
    assert day_horizon(days(spark, None), [20240101], as_of()).count() == 0


def test_many_starts_take_one_pass(spark):
    found = day_horizon(days(spark, 20240105, 20240105, 20240120), [20240101, 20240301], as_of())
    assert [tuple(r) for r in found.orderBy("start_day").collect()] == [
        (20240101, False, 20240105, 20240120),
        (20240301, True, 20240120, 20240120),
    ]


def test_default_day_is_today(spark):
    found = pick_range(days(spark, 20000101, 99991231), 20000101)
    yesterday = spark.sql("SELECT date_format(current_date() - 1, 'yyyyMMdd')").first()[0]
    assert found == (False, 20000101, int(yesterday))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("days") / "t")
    rows = spark.range(40).selectExpr(
        "id", "CAST(date_format(DATE '2024-01-01' + CAST(id % 4 AS int), 'yyyyMMdd') AS int) AS day"
    )
    rows.write.partitionBy("day").parquet(place)
    return place


def scanned_files(frame):
    frame.collect()
    node = frame._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().get("numFiles").get().value()


def test_range_prunes_partitions(spark, stored):
    table = spark.read.parquet(stored)
    some = in_days(table, DayRange(False, 20240102, 20240103))
    assert some.count() == 20 and count_rows(some).first().row_count == 20
    assert scanned_files(some) == scanned_files(table) // 2
    one = in_days(table, DayRange(True, 20240104, 20240104))
    assert {r.day for r in one.collect()} == {20240104} and one.count() == 10
    assert in_days(table, DayRange(False, 20240201, 20240129)).count() == 0


def test_text_partitions(spark, stored):
    table = spark.read.schema("id bigint, day string").parquet(stored)
    assert in_days(table, DayRange(False, 20240102, 20240103)).count() == 20


def test_catalog_partitions(spark):
    spark.sql("CREATE TABLE by_day (id BIGINT, day INT, hour INT) USING parquet PARTITIONED BY (day, hour)")
    try:
        for day in (20240103, 20240101):
            rows = spark.range(3).selectExpr("id", f"{day} AS day", "CAST(id AS int) AS hour")
            rows.write.insertInto("by_day")
        listed = catalog_days(spark, "by_day")
        assert sorted({r.day for r in listed.collect()}) == [20240101, 20240103]
        found = pick_range(listed, 20240102, as_of())
        assert found == (False, 20240102, 20240103)
        assert in_days(spark.table("by_day"), found).count() == 3
    finally:
        spark.sql("DROP TABLE by_day")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_time_ranges_match_days(spark, kind):
    times = [
        "2024-01-01 23:59:59.999999", "2024-01-02 00:00:00", "2024-01-03 12:00:00",
        "2024-01-03 23:59:59.999999", "2024-01-04 00:00:00", None,
    ]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast(kind).alias("t"))
    assert in_days_by_time(rows, DayRange(False, 20240102, 20240103), "t").count() == 3
    assert in_days_by_time(rows, DayRange(True, 20240104, 20240104), "t").count() == 1
    assert sorted(r.day for r in time_days(rows, "t").collect()) == [20240101, 20240104]


def test_time_days_of_an_empty_table(spark):
    rows = spark.sql("SELECT TIMESTAMP '2024-01-01' AS t WHERE false")
    assert pick_range(time_days(rows, "t"), 20240101, as_of()) is None


def due(spark, *rows):
    schedule = spark.createDataFrame([*rows], "seq int, tablename string, last_batch date")
    found = next_due_table(schedule, as_of()).collect()
    assert len(found) == 1
    return found[0].tablename


def test_next_due_table(spark):
    older, yesterday, today = date(2024, 1, 28), date(2024, 1, 29), date(2024, 1, 30)
    assert due(spark, (2, "b", yesterday), (1, "a", older), (3, "c", None)) == "b"
    assert due(spark, (2, "b", yesterday), (1, "a", None)) == "a"
    assert due(spark, (1, "a", older), (2, "b", today)) == ""
    assert due(spark) == ""


def test_next_due_table_takes_timestamps(spark):
    schedule = spark.createDataFrame(
        [(1, "a", datetime(2024, 1, 29, 23, 59))], "seq int, tablename string, last_batch timestamp"
    )
    assert next_due_table(schedule, as_of()).first().tablename == "a"


def test_day_export(spark, stored, tmp_path):
    """The next due table, its range, its rows as records in a sink."""
    schedule = spark.createDataFrame(
        [(1, "old", date(2024, 1, 5)), (2, "t", None)], "seq int, tablename string, last_batch date"
    )
    name = next_due_table(schedule, as_of()).first().tablename
    table = spark.read.parquet(stored)
    rows = in_days(table, pick_range(table, 20240103, as_of()))
    sink = file_sink(f"{tmp_path}/out")
    sink.write(to_records(rows, name), name)
    sent = spark.read.parquet(f"{tmp_path}/out")
    assert {r.key for r in sent.collect()} == {"t"}
    assert sent.count() == count_rows(rows).first().row_count == 20
