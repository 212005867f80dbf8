import pytest
from pyspark.sql import functions as F

from ebbmark.sources.control_log import (
    CONTROL_SCHEMA,
    LOG_SCHEMA,
    ControlTable,
    batch_number,
    conform,
    latest,
    select_batch,
)
from ebbmark.sources.tables import TableStore


def log(spark, rows):
    frame = spark.createDataFrame(rows, "typeid int, tablename string, longoffset bigint, seq bigint")
    missing = [f for f in LOG_SCHEMA if f.name not in frame.columns]
    return conform(frame.withColumns({f.name: F.lit(None) for f in missing}), LOG_SCHEMA)


def test_batch_id_is_an_integer_only(spark):
    assert batch_number(" 3 ") == 3 and batch_number(-1) == -1
    for bad in ("0 or true", "1_0", "", "1.0", 1.0, None):
        with pytest.raises((ValueError, TypeError)):
            batch_number(bad)
    rows = log(spark, [(0, "a", 1, 0), (1, "b", 1, 0), (None, "c", 1, 0)])
    assert [r.tablename for r in select_batch(rows, "1").collect()] == ["b"]


def test_latest_is_per_table_and_batch(spark):
    versions = [(0, "a", 5, 1), (0, "a", 9, 2), (0, "a", 7, 0), (1, "a", 3, 0), (0, "b", None, 4)]
    rows = log(spark, versions)
    state = latest(rows)
    assert state.schema == rows.schema
    assert {(r.typeid, r.tablename, r.longoffset) for r in state.collect()} == {
        (0, "a", 9),
        (1, "a", 3),
        (0, "b", None),
    }


def test_latest_without_seq(spark):
    rows = log(spark, [(0, "a", 5, None), (0, "b", 1, None), (0, "b", 2, 0)])
    assert {r.tablename: r.longoffset for r in latest(rows).collect()} == {"a": 5, "b": 2}


def test_latest_with_one_key_holding_a_third_of_the_log(spark):
    versions = spark.range(30_000).select(
        F.lit(0).alias("typeid"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 100)).alias("tablename"),
        (F.col("id") * 7 % 30_000).alias("longoffset"),
        (F.col("id") * 7 % 30_000).alias("seq"),
    )
    missing = [f for f in LOG_SCHEMA if f.name not in versions.columns]
    state = latest(conform(versions.withColumns({f.name: F.lit(None) for f in missing}), LOG_SCHEMA))
    expected = {}
    for i in range(30_000):
        name = "hot" if i % 3 == 0 else f"t{i % 100}"
        expected[name] = max(expected.get(name, -1), i * 7 % 30_000)
    assert {r.tablename: r.longoffset for r in state.collect()} == expected


def test_latest_combines_before_the_shuffle_and_prunes_by_batch(spark, tmp_path):
    log(spark, [(0, "a", 1, 0), (1, "a", 1, 0)]).write.parquet(f"{tmp_path}/log")
    rows = latest(spark.read.parquet(f"{tmp_path}/log")).filter("typeid = 1")
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_max_by") > text.index("Exchange hashpartitioning")
    assert "EqualTo(typeid,1)" in text


def test_append_current_and_compaction(spark, tmp_path):
    store = TableStore(name_value=f"{tmp_path}/{{table}}")
    control, compacted = ControlTable(store, "log"), ControlTable(store, "compacted")
    control.append(log(spark, [(0, "a", 5, 0), (1, "b", 1, 0)]))
    control.append(log(spark, [(0, "a", 8, 1)]))
    assert control.read(spark).count() == 3
    control.compact_into(spark, compacted)
    assert compacted.read(spark).count() == 2
    assert sorted(control.current(spark).collect()) == sorted(compacted.current(spark).collect())
    assert [r.longoffset for r in compacted.current(spark, 0).collect()] == [8]
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        control.compact_into(spark, compacted)


def test_store_that_replaces_by_key_has_no_versions(spark, tmp_path):
    control = ControlTable(TableStore(name_value=f"{tmp_path}/{{table}}"), "keyed", versioned=False)
    control.append(log(spark, [(0, "a", 5, 0)]))
    assert control.read(spark).columns == CONTROL_SCHEMA.names
    assert control.current(spark, 0).count() == 1


def test_reads_by_name_and_casts(spark, tmp_path):
    fields = [f.name for f in LOG_SCHEMA]
    rows = log(spark, [(0, "a", 5, 0)]).select(*(F.col(n).cast("string") for n in reversed(fields)))
    rows.write.option("ignoreNullFields", "false").json(f"{tmp_path}/text")
    control = ControlTable(TableStore("json", name_value=f"{tmp_path}/{{table}}"), "text")
    state = control.read(spark)
    assert state.schema == LOG_SCHEMA
    assert state.first().longoffset == 5
    with pytest.raises(Exception, match="longoffset"):
        conform(state.drop("longoffset"), LOG_SCHEMA)


def test_reads_before_while_and_after_a_compaction_give_one_state(spark, tmp_path):
    control = ControlTable(TableStore(name_value=f"{tmp_path}/{{table}}"), "control", manifest="pointers")

    def version(table, seq, offset):
        row = spark.createDataFrame([(table, 0, offset, seq)], "tablename string, typeid int, longoffset long, seq long")
        missing = {f.name: F.lit(None) for f in LOG_SCHEMA if f.name not in row.columns}
        return conform(row.withColumns(missing), LOG_SCHEMA)

    def state():
        return {r.tablename: (r.seq, r.longoffset) for r in control.current(spark).collect()}

    control.append(version("a", 0, 1))
    control.append(version("a", 1, 2))
    control.append(version("b", 0, 5))
    before = state()
    # A run that looked the log up before the compaction and appends after it.
    _, (old,), _ = control._logs(spark)
    control.compact(spark)
    assert state() == before == {"a": (1, 2), "b": (0, 5)}
    control.store.append(version("b", 1, 6), old)
    control.append(version("a", 2, 3))
    assert state() == {"a": (2, 3), "b": (1, 6)}
    control.compact(spark)
    assert state() == {"a": (2, 3), "b": (1, 6)}
    _, (newest,), _ = control._logs(spark)
    assert control.store.read(spark, newest).count() == 2
    # Two compactions at one time: both logs count.
    generation, (name,), _ = control._logs(spark)
    rows = [(generation + 1, "one", name), (generation + 1, "two", name)]
    for log in ("one", "two"):
        control.store.create(control.current(spark), log)
    control.store.append(spark.createDataFrame(rows, "generation bigint, log string, previous string"), "pointers")
    control.store.append(version("c", 0, 7), "two")
    assert state() == {"a": (2, 3), "b": (1, 6), "c": (0, 7)}
    with pytest.raises(ValueError):
        ControlTable(control.store, "control").compact(spark)
