import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ebbmark.operators.delta import (
    Check,
    collect_stats,
    delta,
    delta_stats,
    footer_frame,
    in_files,
    stored_offset,
    table_stats,
)


def micros(year, month, day, hour=0, minute=0):
    moment = datetime(year, month, day, hour, minute, tzinfo=timezone.utc)
    return int(moment.timestamp()) * 1_000_000


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (1, 10, "2024-01-01 00:00:00"),
            (2, 20, "2024-01-02 10:00:00"),
            (3, None, None),
            (None, 30, "2024-01-03 00:00:00"),
        ],
        "small int, big bigint, text string",
    ).select(
        "*",
        F.col("text").cast("timestamp").alias("instant"),
        F.col("text").cast("timestamp_ntz").alias("local"),
        F.col("text").cast("date").alias("day"),
    )


@pytest.mark.parametrize(
    "column,type_id,offset,expected",
    [
        ("small", 1, 2, [2, 3]),
        ("big", 2, 20, [20, 30]),
        ("big", 7, 30, [30]),
        ("instant", 0, micros(2024, 1, 2, 10), None),
        ("local", 0, micros(2024, 1, 2, 10), None),
    ],
)
def test_bound_is_inclusive_and_nulls_never_match(rows, column, type_id, offset, expected):
    found = [r[column] for r in delta(Check("t", rows, column, type_id, offset)).collect()]
    if expected is None:
        expected = [datetime(2024, 1, 2, 10), datetime(2024, 1, 3)]
    assert sorted(found) == expected


@pytest.mark.parametrize(
    "column,type_id",
    [("small", 2), ("big", 1), ("day", 0), ("text", 0), ("text", 2), ("instant", 2), ("small", 0)],
)
def test_type_mismatch_is_refused(rows, column, type_id):
    with pytest.raises(TypeError, match=column):
        Check("t", rows, column, type_id, 0)


def test_null_offset_selects_nothing_unless_from_start(rows):
    assert delta(Check("t", rows, "big", 2, None)).count() == 0
    everything = Check("t", rows, "big", 2, None, from_start=True)
    assert delta(everything).count() == 3
    assert collect_stats([everything])[0][:4] == ("t", 30, 3, True)
    # A stored offset still counts when starting from scratch is allowed.
    assert delta(Check("t", rows, "big", 2, 20, from_start=True)).count() == 2


def test_nested_check_column(rows):
    nested = rows.select(F.struct("big").alias("s"))
    assert delta(Check("t", nested, "s.big", 2, 20)).count() == 2
    dotted = rows.select(F.col("big").alias("a.b"))
    assert delta(Check("t", dotted, "a.b", 2, 20)).count() == 2
    assert delta(Check("t", rows, "BIG", 2, 20)).count() == 2
    odd = rows.select(F.struct(F.col("big").alias("a b")).alias("s t"), F.col("big").alias("x) OR (1"))
    assert delta(Check("t", odd, "s t.a b", 2, 20)).count() == 2
    assert delta(Check("t", odd, "x) OR (1", 2, 20)).count() == 2
    for name in ("1", "big) OR (true", "big + 1", "nothing"):
        with pytest.raises(Exception, match="UNRESOLVED_COLUMN|INVALID_ATTRIBUTE"):
            Check("t", rows, name, 2, 20)


def test_upper_bound(rows):
    assert [r.big for r in delta(Check("t", rows, "big", 2, 10), upper=20).collect()] == [10, 20]


def test_stats_of_edge_tables(spark, rows):
    checks = [
        Check("empty", rows.filter("false"), "big", 2, 5),
        Check("nulls", rows.filter("big IS NULL"), "big", 2, 5),
        Check("cut back", rows, "big", 2, 99),
        Check("no offset", rows, "big", 2, None),
        Check("usual", rows, "big", 2, 20),
    ]
    found = [(s.table, s.max_offset, s.delta_count) for s in collect_stats(checks)]
    assert found == [
        ("empty", None, 0),
        ("nulls", None, 0),
        ("cut back", 30, 0),
        ("no offset", 30, 0),
        ("usual", 30, 2),
    ]


def test_stats_match_brute_force(spark):
    source = random.Random(7)
    values = [source.choice([None, *range(-50, 50)]) for _ in range(2000)]
    frame = spark.createDataFrame([(v,) for v in values], "v bigint")
    offsets = [-60, -50, -1, 0, 17, 49, 50]
    checks = [Check(str(o), frame, "v", 2, o) for o in offsets]
    known = [v for v in values if v is not None]
    expected = [(max(known), sum(v >= o for v in known)) for o in offsets]
    assert [(r.max_offset, r.delta_count) for r in collect_stats(checks)] == expected
    whole = [table_stats(c).first() for c in checks]
    assert [(r.max_offset, r.delta_count) for r in whole] == expected


def test_microseconds_survive(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05.678901' AS ts")
    check = Check("t", frame, "ts", 0, micros(2024, 1, 1))
    top = collect_stats([check])[0].max_offset
    assert top % 1_000_000 == 678901
    assert delta(Check("t", frame, "ts", 0, top)).count() == 1
    assert delta(Check("t", frame, "ts", 0, top + 1)).count() == 0


def test_local_time_the_zone_skips_is_reported(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00' AS ts")
    check = Check("t", frame, "ts", 0, 0)
    assert collect_stats([check])[0].exact
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert not collect_stats([check])[0].exact
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stored_offset_follows_the_column_type(spark):
    rows = spark.sql(
        "SELECT kind AS columntypeid, TIMESTAMP '1970-01-01 00:00:01' AS batchstart_ts, "
        "2 AS intoffset, 3L AS longoffset FROM VALUES (0), (1), (2), (9) AS t(kind)"
    )
    assert [r[0] for r in rows.select(stored_offset()).collect()] == [1_000_000, 2, 3, 3]


def scan_metric(frame, name):
    rows = frame.collect()
    node = frame._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return len(rows), node.metrics().get(name).get().value()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_deltas_open_only_their_files(spark, tmp_path, kind):
    place = f"{tmp_path}/a b%20c"  # a path that needs escaping
    rows = spark.range(0, 800, 1, 8).selectExpr("id", f"CAST(timestamp_seconds(id) AS {kind}) AS ts")
    rows.write.parquet(place)
    rows.write.mode("append").parquet(place)
    check = Check("t", spark.read.parquet(place), "ts", 0, 650_000_000)
    found = delta(check, 720_000_000)
    assert scan_metric(found, "numFiles") == (142, 16)
    (stats,) = collect_stats([check])
    narrow = in_files(found, stats.files)
    assert scan_metric(narrow, "numFiles") == (142, 4)
    assert sorted(narrow.collect()) == sorted(found.collect())
    # Partition columns, nothing found.
    by_day = f"{tmp_path}/days"
    rows.withColumn("day", F.col("id") % 2).write.partitionBy("day").parquet(by_day)
    checked = Check("t", spark.read.parquet(by_day), "ts", 0, 795_000_000)
    days, (stats,) = delta(checked), collect_stats([checked])
    assert sorted(in_files(days, stats.files).collect()) == sorted(days.collect()) and days.count() == 5
    (empty,) = collect_stats([Check("t", check.frame, "ts", 0, 10**12)])
    assert in_files(check.frame, empty.files or []).count() == 0


def test_any_number_of_files_is_named(spark, tmp_path):
    place = f"{tmp_path}/it's"
    rows = spark.range(0, 1200, 1, 1200).selectExpr("id", "CAST(timestamp_seconds(id) AS timestamp_ntz) AS ts")
    rows.write.parquet(place)
    check = Check("t", spark.read.parquet(place), "ts", 0, 150_000_000)
    (stats,) = collect_stats([check])
    assert (stats.delta_count, len(stats.files)) == (1050, 1050)
    assert scan_metric(in_files(delta(check, stats.max_offset), stats.files), "numFiles") == (1050, 1050)


def test_tables_without_files_are_read_as_they_are(spark):
    frame = spark.range(5).selectExpr("timestamp_seconds(id) AS ts").repartition(2)
    check = Check("t", frame, "ts", 0, 3_000_000)
    (stats,) = collect_stats([check])
    assert stats.files is None and in_files(delta(check), stats.files).count() == 2


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_delta_stats_push_the_offset_and_read_one_column(spark, tmp_path):
    spark.range(1000).selectExpr("id AS k", "CAST(id AS string) AS wide").write.parquet(f"{tmp_path}/t")
    check = Check("t", spark.read.parquet(f"{tmp_path}/t"), "k", 2, 900)
    text = plan(delta_stats(check))
    assert "GreaterThanOrEqual(k,900)" in text
    assert "ReadSchema: struct<k:bigint>" in text
    assert "hashpartitioning" not in text
    bounded = plan(delta(check, 950))
    assert "GreaterThanOrEqual(k,900), LessThanOrEqual(k,950)" in bounded
    assert "Exchange" not in bounded


def test_row_groups_below_the_offset_are_skipped(spark, tmp_path):
    place = f"{tmp_path}/grouped"
    sorted_rows = spark.range(0, 200_000, 1, 1).selectExpr("id AS k")
    sorted_rows.write.option("parquet.block.size", 65536).parquet(place)
    frame = delta(Check("t", spark.read.parquet(place), "k", 2, 199_000))
    rows, read = scan_metric(frame, "numOutputRows")
    assert rows == 1000 and read < 100_000


def test_footers_tell_what_the_whole_table_tells(spark, tmp_path):
    place = f"{tmp_path}/a b%20é"
    rows = spark.range(100).selectExpr("id", "IF(id % 3 = 0, NULL, CAST(id AS INT)) AS size", "id % 2 AS p", "TIMESTAMP '2024-01-01' AS ts", "struct(id) AS s")
    rows.repartition(3).write.partitionBy("p").parquet(place)
    frame = spark.read.parquet(place)
    for column, kind, largest, n in (("id", 2, 99, 100), ("size", 1, 98, 66)):
        check = Check("t", frame, column, kind, None, from_start=True)
        footers = footer_frame(check)
        plan = footers._jdf.queryExecution().executedPlan().toString()
        assert f"MAX({column})" in plan and f"COUNT({column})" in plan
        assert tuple(footers.first()) == (largest, n)
        found = collect_stats([check, Check("u", frame, column, kind, 5000)])
        assert [(s.max_offset, s.delta_count) for s in found] == [(largest, n), (largest, 0)]
        whole = table_stats(check).first()
        assert (whole.max_offset, whole.delta_count) == (largest, n)
    assert footer_frame(Check("t", frame, "ts", 0, None)) is None
    assert footer_frame(Check("t", frame, "s.id", 2, None)) is None
    assert footer_frame(Check("t", spark.range(3), "id", 2, None)) is None
    # A partition column is in no footer.
    assert footer_frame(Check("t", frame, "p", 1, None)) is None
    # Files that come after the table was opened do not count.
    spark.range(500, 600).selectExpr("id", "CAST(id AS INT) AS size", "0 AS p", "TIMESTAMP '2024-01-01' AS ts", "struct(id) AS s").write.mode("append").partitionBy("p").parquet(place)
    assert collect_stats([Check("t", frame, "id", 2, None, from_start=True)])[0].max_offset == 99


def test_a_first_batch_of_an_empty_table(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/t")
    found = collect_stats([Check("t", spark.read.parquet(f"{tmp_path}/t"), "id", 2, None, from_start=True)])
    assert (found[0].max_offset, found[0].delta_count) == (None, 0)
