"""Zone maps: stats of whole tables from what each file holds."""

import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ebbmark import TableStore, ZoneMap
from ebbmark.operators.delta import Check, table_stats
from ebbmark.sources.zone_map import listed_files


@pytest.fixture
def place(tmp_path):
    return TableStore(name_value=f"{tmp_path}/a b%20é/{{table}}")


def check_of(spark, store, column, kind, offset, **options):
    return Check("t", store.read(spark, "t"), column, kind, offset, **options)


def agree(spark, zones, check):
    found = zones.stats(spark, check)
    row = table_stats(check).first()
    assert (found.max_offset, found.delta_count, found.exact) == (row.max_offset, row.delta_count, row.exact)
    past = check.frame.filter(check.at_or_past).select("_metadata.file_path").distinct().collect()
    assert {r.file_path for r in past} <= set(found.files)
    return found


@pytest.mark.parametrize("offset", [None, -5, 0, 37, 40, 99, 100, 500])
def test_stats_are_those_of_the_whole_table(spark, place, offset):
    rows = spark.range(100).select("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("int")).alias("size"))
    place.append(rows.repartitionByRange(5, "id"), "t")
    zones = ZoneMap(place)
    for column, kind in (("id", 2), ("size", 1)):
        agree(spark, zones, check_of(spark, place, column, kind, offset))
        agree(spark, zones, check_of(spark, place, column, kind, offset, from_start=True))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_timestamps(spark, place, kind):
    rows = spark.range(50).select((F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("id"))).cast(kind).alias("ts"))
    place.append(rows.repartitionByRange(4, "ts"), "t")
    offset = int(datetime.fromisoformat("2024-01-02 00:00:00+00:00").timestamp()) * 1_000_000
    assert agree(spark, ZoneMap(place), check_of(spark, place, "ts", 0, offset)).delta_count == 26


def test_a_second_run_opens_only_new_files(spark, place):
    place.append(spark.range(0, 100).repartitionByRange(4, "id"), "t")
    zones = ZoneMap(place)
    assert zones.stats(spark, check_of(spark, place, "id", 2, 100)).delta_count == 0
    old = glob.glob(place.name_value.format(table="t") + "/*.parquet")
    # Old files that cannot be read any more: all a run needs of them is recorded.
    place.append(spark.range(100, 130).coalesce(1), "t")
    frame = place.read(spark, "t")
    for path in old:
        with open(path, "r+b") as file:
            file.truncate(3)
    found = zones.stats(spark, Check("t", frame, "id", 2, 110))
    assert (found.max_offset, found.delta_count) == (129, 20)
    assert len(old) == 4 and len(found.files) == 1


def test_files_that_go_and_files_without_rows(spark, place):
    place.append(spark.range(10).coalesce(1), "t")
    place.append(spark.range(0).coalesce(1), "t")
    zones = ZoneMap(place)
    agree(spark, zones, check_of(spark, place, "id", 2, 3))
    recorded = place.read(spark, "zone_map").count()
    assert recorded == len(listed_files(place.read(spark, "t")))
    place.read(spark, "t").limit(4).write.mode("overwrite").parquet(place.name_value.format(table="other"))
    place.read(spark, "other").write.mode("overwrite").parquet(place.name_value.format(table="t"))
    assert agree(spark, zones, check_of(spark, place, "id", 2, 0)).delta_count == 4


def test_a_file_recorded_twice_counts_once(spark, place):
    place.append(spark.range(10).coalesce(2), "t")
    zones = ZoneMap(place)
    check = check_of(spark, place, "id", 2, 3)
    zones.zones(spark, check)
    zones._record(spark, check, listed_files(check.frame))
    agree(spark, zones, check)


def test_an_empty_table(spark, place):
    place.append(spark.range(0), "t")
    found = ZoneMap(place).stats(spark, check_of(spark, place, "id", 2, 0))
    assert (found.max_offset, found.delta_count) == (None, 0)
