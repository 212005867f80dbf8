import shutil
from pathlib import Path

import pytest

from ebbmark.sources.scratch import scratch_folder
from ebbmark.sources.sinks import RecordSink, file_sink, kafka_sink
from ebbmark.sources.tables import TableStore, register_view, view_name


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_file_formats(spark, tmp_path, format):
    options = {"header": "true", "inferSchema": "true"} if format == "csv" else {}
    store = TableStore(format, options, name_value=f"{tmp_path}/{{table}}")
    rows = spark.range(5).selectExpr("id", "concat('n', id) AS name")
    store.append(rows, "t")
    store.append(rows, "t")
    found = store.read(spark, "t").select("id", "name").collect()
    assert sorted((int(r.id), r.name) for r in found) == sorted(2 * [(i, f"n{i}") for i in range(5)])
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        store.create(rows, "t")


def test_catalog_tables(spark):
    store = TableStore("table")
    store.create(spark.range(3), "store_rows")
    try:
        store.append(spark.range(2), "store_rows")
        assert store.read(spark, "store_rows").count() == 5
    finally:
        spark.sql("DROP TABLE store_rows")


def test_catalog_tables_show_files_added_by_others(spark, tmp_path):
    place = f"{tmp_path}/outside"
    spark.range(3).write.parquet(place)
    spark.sql(f"CREATE TABLE outside (id BIGINT) USING parquet LOCATION '{place}'")
    try:
        store = TableStore("table")
        assert store.read(spark, "outside").count() == 3
        more = f"{tmp_path}/more"
        spark.range(3, 5).coalesce(1).write.parquet(more)
        for part in Path(more).glob("*.parquet"):
            shutil.copy(part, place)
        assert store.read(spark, "outside").count() == 5
    finally:
        spark.sql("DROP TABLE outside")


def test_view_names(spark):
    tables = ["db.t", "db_t", "db__t", "store::db.t-1", "中a", "2024", "T", "t", "", "a_2e_b", "a.b", "1a", "_1a", "t\u2024", "x\x1a"]
    assert len({view_name(t).lower() for t in tables}) == len(tables)
    assert view_name("db.t") == "db_2e_t" and view_name("plain1") == "plain1"
    register_view(spark.range(1), "a.b")
    register_view(spark.range(5), "a_b")
    both = spark.sql(f"SELECT (SELECT count(*) FROM {view_name('a.b')}), (SELECT count(*) FROM {view_name('a_b')})")
    assert tuple(both.first()) == (1, 5)
    view = register_view(spark.range(4), "store::db.t-1")
    assert spark.sql(f"SELECT max(id) FROM {view}").first()[0] == 3


def test_file_sink_keeps_tables_apart(spark, tmp_path):
    records = spark.sql("SELECT 'k' AS key, 'v' AS value")
    sink = file_sink(f"{tmp_path}/out")
    for table in ("a/b", "a b", "c=d", "a/b"):
        sink.write(records, table)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4
    assert len([p for p in (tmp_path / "out").iterdir()]) == 3


def test_plain_sink_appends_to_one_place(spark, tmp_path):
    records = spark.sql("SELECT 'k' AS key, 'v' AS value")
    sink = RecordSink("json", {"path": f"{tmp_path}/out"})
    sink.write(records, "a")
    sink.write(records, "b")
    assert sink.concurrent == 1 and spark.read.json(f"{tmp_path}/out").count() == 2


def test_kafka_settings():
    sink = kafka_sink("h:1", "topic", **{"kafka.acks": "all"})
    assert sink.format == "kafka"
    assert sink.options == {"kafka.bootstrap.servers": "h:1", "topic": "topic", "kafka.acks": "all"}


def test_scratch_folders_are_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark), scratch_folder(spark)
    assert first.startswith(shared) and first != second
