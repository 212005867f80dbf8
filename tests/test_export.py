import glob
import json
import random
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ebbmark import (
    BatchClaimed,
    BatchFailed,
    Claims,
    ControlTable,
    RecordSink,
    Split,
    TableStore,
    ZoneMap,
    export_batch,
    file_sink,
)
from ebbmark.operators.records import header, to_records
from ebbmark.plans import export
from ebbmark.sources.control_log import LOG_SCHEMA, conform

CLOCK = 1_706_700_000_999  # 2024-01-31 11:20:00.999


def control_row(table, column, kind, offset, batch=0):
    return {
        "tablename": table,
        "typeid": batch,
        "checkcolumn": column,
        "columntypeid": kind,
        "intoffset": offset if kind == 1 else None,
        "longoffset": offset if kind not in (0, 1) else None,
        "batchstart_ts": offset if kind == 0 else None,
        "typename": "hourly",
        "ordered": True,
        "seq": 0,
    }


class Setting:
    """Tables, a control table and a sink below one folder."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.tables = TableStore(name_value=f"{folder}/tables/{{table}}")
        self.control = ControlTable(TableStore(name_value=f"{folder}/{{table}}"), "control")
        self.runs = 0

    def put(self, table, frame):
        self.tables.append(frame.coalesce(1), table)

    def register(self, *rows):
        schema = (
            "tablename string, typeid int, checkcolumn string, columntypeid int, intoffset int, "
            "longoffset bigint, batchstart_ts string, typename string, ordered boolean, seq bigint"
        )
        names = [field.split()[0] for field in schema.split(", ")]
        frame = self.spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
        missing = [f for f in LOG_SCHEMA if f.name not in frame.columns]
        self.control.append(conform(frame.withColumns({f.name: F.lit(None) for f in missing}), LOG_SCHEMA))

    def run(self, batch=0, sink=None, **options):
        self.runs += 1
        self.out = f"{self.folder}/out-{self.runs}"
        sink = sink or file_sink(self.out)
        return export_batch(
            self.spark, batch, self.control, self.tables, sink, clock=lambda: CLOCK, **options
        )

    def sent(self):
        try:
            rows = self.spark.read.parquet(self.out).collect()
        except Exception as error:
            assert "PATH_NOT_FOUND" in str(error)
            return {}
        found = {}
        for row in rows:
            found.setdefault(row.key, []).append(json.loads(row.value))
        return found

    def state(self, table):
        return self.control.current(self.spark).filter(F.col("tablename") == table).first()


@pytest.fixture
def setting(spark, tmp_path):
    setting = Setting(spark, str(tmp_path))
    setting.put("longs", spark.range(10).selectExpr("id", "id * 2 AS twice"))
    setting.put("ints", spark.range(10).selectExpr("CAST(id % 5 AS int) AS size"))
    setting.put(
        "times", spark.range(10).selectExpr("TIMESTAMP_NTZ '2024-01-01' + make_interval(0,0,0,int(id)) AS ts")
    )
    return setting


def ids(setting, table="longs", field="id"):
    return sorted(r[field] for r in setting.sent().get(table, []))


def test_runs_send_the_delta_then_the_boundary_then_the_new_rows(spark, setting):
    setting.register(
        control_row("longs", "id", 2, 6),
        control_row("ints", "size", 1, 3),
        control_row("times", "ts", 0, "2024-01-08 00:00:00"),
        control_row("longs", "id", 2, 0, batch=1),
    )
    results = setting.run()
    assert {(r.table, r.offset, r.max_offset, r.row_count) for r in results if r.table != "times"} == {
        ("longs", 6, 9, 4),
        ("ints", 3, 4, 4),
    }
    assert ids(setting) == [6, 7, 8, 9]
    assert ids(setting, "ints", "size") == [3, 3, 4, 4]
    assert len(setting.sent()["times"]) == 3
    assert setting.control.current(spark, 1).first().longoffset == 0

    setting.run()
    assert ids(setting) == [9]
    assert ids(setting, "ints", "size") == [4, 4]
    assert len(setting.sent()["times"]) == 1

    setting.put("longs", spark.range(8, 12).selectExpr("id", "id * 2 AS twice"))
    setting.run()
    # The late row 8 is below the offset and is never sent; both nines are at it.
    assert ids(setting) == [9, 9, 10, 11]


def test_control_row_after_a_run(spark, setting):
    setting.register(control_row("longs", "id", 2, 6), control_row("times", "ts", 0, "2024-01-08 00:00:00"))
    setting.run()
    row = setting.state("longs")
    text = lambda name, table="longs": str(setting.state(table)[name])
    assert (row.longoffset, row.currentbatchcount, row.seq) == (9, 4, 1)
    assert (row.typename, row.ordered, row.intoffset) == ("hourly", True, None)
    assert text("batchstart_ts") == text("batchend_ts") == "2024-01-31 19:20:00"
    assert text("batchstart_ts", "times") == "2024-01-10 00:00:00"
    assert text("batchend_ts", "times") == "2024-01-31 19:20:00"
    setting.run(shift_hours=0)
    assert text("batchend_ts") == "2024-01-31 11:20:00"
    assert setting.state("longs").seq == 2


def test_empty_and_cut_back_tables(spark, setting):
    setting.put("empty", spark.range(0).toDF("id"))
    setting.register(control_row("empty", "id", 2, 5), control_row("longs", "id", 2, 100))
    setting.run()
    assert setting.sent() == {}
    assert setting.state("empty").longoffset == 5
    assert setting.state("longs").longoffset == 9
    assert setting.state("longs").currentbatchcount == 0


def test_null_offset(spark, setting):
    setting.register(
        control_row("longs", "id", 2, None), control_row("ints", "size", 1, 3), control_row("times", "ts", 0, None, batch=1)
    )
    with pytest.raises(BatchFailed, match="longs: no offset"):
        setting.run()
    assert set(setting.sent()) == {"ints"} and setting.state("longs").longoffset is None and setting.state("longs").seq == 0
    setting.run(batch=1, from_start=True)
    assert len(setting.sent()["times"]) == 10


@pytest.mark.parametrize("single_write", [False, True])
def test_bad_tables_are_reported_and_the_others_go_on(spark, setting, single_write):
    setting.register(
        control_row("longs", "id", 2, 6),
        control_row("missing", "id", 2, 6),
        control_row("ints", "size", 2, 3),
        control_row("times", "nothing", 0, "2024-01-08 00:00:00"),
    )
    with pytest.raises(BatchFailed) as failure:
        setting.run(single_write=single_write)
    errors = {r.table: r.error for r in failure.value.results}
    assert errors.pop("longs") is None
    assert isinstance(errors["ints"], TypeError)
    assert set(errors) == {"missing", "ints", "times"} and all(errors.values())
    assert ids(setting) == [6, 7, 8, 9]
    assert [setting.state(t).seq for t in ("longs", "missing", "ints", "times")] == [1, 0, 0, 0]


def test_stats_that_fail_hold_back_their_table_only(spark, setting):
    setting.register(control_row("broken", "id", 2, 0), control_row("longs", "id", 2, 6))
    real = TableStore.read

    class Broken(TableStore):
        def read(self, session, table):
            if table == "broken":
                return session.range(5).selectExpr("CAST(raise_error('bad block') AS bigint) AS id")
            return real(self, session, table)

    setting.tables = Broken(name_value=setting.tables.name_value)
    with pytest.raises(BatchFailed, match="broken: .*bad block"):
        setting.run()
    assert ids(setting) == [6, 7, 8, 9]
    assert setting.state("broken").seq == 0


class FailingSink(RecordSink):
    def write(self, records, table):
        if table in ("ints", "all"):
            raise OSError("sink is down")
        super().write(records, table)


def failing_sink(path):
    return FailingSink("parquet", {"path": path + "/source={table}"}, concurrent=3)


def test_sink_failure_leaves_the_control_row(spark, setting):
    setting.register(control_row("longs", "id", 2, 6), control_row("ints", "size", 1, 3))
    with pytest.raises(BatchFailed, match="ints: sink is down"):
        setting.run(sink=failing_sink(f"{setting.folder}/out-1"))
    assert setting.state("ints").intoffset == 3 and setting.state("ints").seq == 0
    assert setting.state("longs").longoffset == 9
    setting.run()
    assert ids(setting, "ints", "size") == [3, 3, 4, 4] and ids(setting) == [9]


def test_single_write_failure_holds_back_all(spark, setting):
    setting.register(control_row("longs", "id", 2, 6), control_row("ints", "size", 1, 3))
    with pytest.raises(BatchFailed):
        setting.run(sink=failing_sink(f"{setting.folder}/out-1"), single_write=True)
    assert {setting.state(t).seq for t in ("longs", "ints")} == {0}
    setting.run(single_write=True)
    assert ids(setting) == [6, 7, 8, 9] and ids(setting, "ints", "size") == [3, 3, 4, 4]
    assert {setting.state(t).seq for t in ("longs", "ints")} == {1}


def test_a_run_lost_before_the_advance_is_sent_again(spark, setting, monkeypatch):
    setting.register(control_row("longs", "id", 2, 6))

    def lost(self, rows):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ControlTable, "append", lost)
        with pytest.raises(BatchFailed, match="driver lost"):
            setting.run()
    assert ids(setting) == [6, 7, 8, 9] and setting.state("longs").seq == 0
    setting.run()
    assert ids(setting) == [6, 7, 8, 9]


def test_rows_that_come_after_the_stats_wait_for_the_next_run(spark, setting, monkeypatch):
    """The upper bound keeps what is sent equal to what was counted."""
    setting.register(control_row("longs", "id", 2, 6))
    view = {"rows": spark.range(10)}

    class Live(TableStore):
        def read(self, session, table):
            return view["rows"]

    setting.tables = Live()
    real = export.collect_stats

    def counted_first(checks):
        found = real(checks)
        # What a live source shows the second scan.
        object.__setattr__(checks[0], "frame", spark.range(15))
        return found

    monkeypatch.setattr(export, "collect_stats", counted_first)
    assert setting.run()[0].row_count == 4
    assert ids(setting) == [6, 7, 8, 9]


@pytest.mark.parametrize("single_write", [False, True])
def test_more_tables_than_one_chunk(spark, setting, monkeypatch, single_write):
    monkeypatch.setattr(export, "STATS_CHUNK", 3)
    names = [f"t{i}" for i in range(8)]
    for i, name in enumerate(names):
        setting.put(name, spark.range(i + 1))
    setting.register(*(control_row(name, "id", 2, 0) for name in names))
    results = setting.run(single_write=single_write, write_group=2)
    assert {r.table: r.row_count for r in results} == {f"t{i}": i + 1 for i in range(8)}
    assert {k: len(v) for k, v in setting.sent().items()} == {f"t{i}": i + 1 for i in range(8)}
    assert {setting.state(n).seq for n in names} == {1}


def test_one_folder_sink_is_written_one_table_at_a_time(spark, setting):
    setting.register(control_row("longs", "id", 2, 0), control_row("ints", "size", 1, 0))
    busy, most = threading.Semaphore(0), []

    class Counting(RecordSink):
        def write(self, records, table):
            busy.release()
            most.append(busy._value)
            super().write(records, table)
            busy.acquire()

    setting.run(sink=Counting("parquet", {"path": f"{setting.folder}/out-1"}))
    assert most == [1, 1]
    assert {k: len(v) for k, v in setting.sent().items()} == {"longs": 10, "ints": 10}


def test_key_column_and_odd_table_names(spark, setting):
    setting.put("a b%c", spark.range(3))
    setting.register(control_row("a b%c", "id", 2, 1))
    setting.run(key_columns={"a b%c": "id"})
    assert set(setting.sent()) == {"1", "2"}


def test_unlike_tables_with_a_key_each(spark, setting):
    setting.put("x", spark.range(3).toDF("a"))
    setting.put("y", spark.range(3).toDF("b"))
    setting.register(control_row("x", "a", 2, 0), control_row("y", "b", 2, 0))
    setting.run(key_columns={"x": "a"}, spread=4)
    assert set(setting.sent()) == {"0", "1", "2", "y"}
    placed = spark.read.parquet(setting.out).select("partition").distinct().collect()
    assert {r.partition for r in placed} <= set(range(4))


def test_a_broken_table_holds_back_no_other_of_its_chunk(spark, setting):
    names = [f"t{i}" for i in range(6)]
    for name in names:
        setting.put(name, spark.range(4))
    setting.register(control_row("broken", "id", 2, 0), *(control_row(name, "id", 2, 2) for name in names))
    real = TableStore.read

    class Broken(TableStore):
        def read(self, session, table):
            if table == "broken":
                return session.range(5).selectExpr("CAST(raise_error('bad block') AS bigint) AS id")
            return real(self, session, table)

    setting.tables = Broken(name_value=setting.tables.name_value)
    with pytest.raises(BatchFailed) as failure:
        setting.run(single_write=True, write_group=4)
    assert [r.table for r in failure.value.results if r.error] == ["broken"]
    assert all(setting.state(name).seq == 1 for name in names)


def jobs_of(spark, action):
    group = f"counted-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_times_take_as_many_jobs_as_longs(spark, setting):
    counts = {}
    for batch, (kind, column) in enumerate([(2, "id"), (0, "ts")]):
        names = [f"{column}{i}" for i in range(12)]
        for name in names:
            setting.put(name, spark.range(3).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' + make_interval(0,0,0,int(id)) AS ts"))
        offset = 0 if kind else "2024-01-01 00:00:00"
        setting.register(*(control_row(name, column, kind, offset, batch) for name in names))
        counts[column] = jobs_of(spark, lambda: setting.run(batch=batch, single_write=True))
    assert abs(counts["ts"] - counts["id"]) <= 2, counts


def test_store_that_replaces_rows_by_key(spark, setting):
    """With such a store the control table has no versions; here each run reads its own copy."""
    setting.register(control_row("longs", "id", 2, 6))
    keyed = ControlTable(setting.control.store, "keyed", versioned=False)
    keyed.append(setting.control.read(spark))
    setting.control = keyed
    setting.run()
    offsets = sorted(r.longoffset for r in keyed.read(spark).collect())
    assert offsets == [6, 9]


def test_control_rows_brought_in_without_seq(spark, setting):
    setting.register({**control_row("longs", "id", 2, 6), "seq": None})
    setting.run()
    assert (setting.state("longs").seq, setting.state("longs").longoffset) == (0, 9)
    setting.run()
    assert ids(setting) == [9]


def test_unknown_batch_is_empty_and_text_batch_refused(spark, setting):
    setting.register(control_row("longs", "id", 2, 6))
    assert setting.run(batch=5) == []
    with pytest.raises(ValueError):
        setting.run(batch="0 or true")


def test_zone_other_than_utc(spark, setting):
    """Stored clocks are instants; local check values are compared in the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        instants = spark.range(10).selectExpr("TIMESTAMP '2024-01-01' + make_interval(0,0,0,int(id)) AS ts")
        setting.put("instants", instants)
        setting.register(
            control_row("times", "ts", 0, "2024-01-08 00:00:00"),
            control_row("instants", "ts", 0, "2024-01-08 00:00:00"),
        )
        assert [r.row_count for r in setting.run()] == [3, 3]
        sent = setting.sent()
        first = 1704643200000  # 2024-01-08 in Shanghai
        for table in ("times", "instants"):
            assert sorted(r["ts"] for r in sent[table]) == [first + d * 86_400_000 for d in range(3)]
            shown = setting.control.current(spark).filter(F.col("tablename") == table)
            assert shown.select(F.col("batchstart_ts").cast("string")).first()[0] == "2024-01-10 00:00:00"
        assert [r.row_count for r in setting.run()] == [1, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_random_history_matches_brute_force(spark, setting):
    source = random.Random(11)
    held = {name: [] for name in ("p", "q")}
    offset = {name: 0 for name in held}
    setting.register(*(control_row(name, "v", 2, 0) for name in held))
    for step in range(4):
        for name, values in held.items():
            top = max(values, default=0)
            new = [source.choice([None, *range(max(0, top - 3), top + 6)]) for _ in range(20)]
            values += [v for v in new if v is not None]
            setting.put(name, spark.createDataFrame([(v,) for v in new], "v bigint"))
        results = {r.table: r for r in setting.run(single_write=step % 2 == 1)}
        for name, values in held.items():
            expected = sorted(v for v in values if v >= offset[name])
            assert ids(setting, name, "v") == expected
            assert results[name].row_count == len(expected)
            offset[name] = max(values)
            assert setting.state(name).longoffset == offset[name]
            assert setting.state(name).currentbatchcount == len(expected)


class Overlapping:
    """A sink in the middle of whose first write another run of the same batch starts."""

    concurrent = 1

    def __init__(self, inner, other):
        self.inner, self.other = inner, other

    def write(self, records, table):
        if self.other:
            self.other, other = None, self.other
            with pytest.raises(BatchClaimed):
                other()
        self.inner.write(records, table)


def test_of_overlapping_runs_one_advances(setting):
    setting.register(control_row("longs", "id", 2, 4), control_row("ints", "size", 1, 3))
    claims = Claims(setting.control.store)
    first, second = file_sink(f"{setting.folder}/first"), file_sink(f"{setting.folder}/second")
    setting.run(sink=Overlapping(first, lambda: setting.run(sink=second, claims=claims)), claims=claims)
    assert setting.state("longs").seq == setting.state("ints").seq == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        setting.spark.read.parquet(f"{setting.folder}/second")
    setting.run(sink=second, claims=claims)
    assert setting.state("longs").seq == 2


def test_a_run_past_its_lease_advances_nothing(setting):
    setting.register(control_row("longs", "id", 2, 4))
    with pytest.raises(BatchFailed, match="lease"):
        setting.run(claims=Claims(setting.control.store, lease_seconds=0))
    assert setting.state("longs").seq == 0


def test_zones_export_the_same(setting):
    setting.register(control_row("longs", "id", 2, 4), control_row("ints", "size", 1, 3))
    zones = ZoneMap(setting.control.store)
    setting.run(zones=zones)
    assert sorted(r["id"] for r in setting.sent()["longs"]) == [4, 5, 6, 7, 8, 9]
    assert setting.state("longs").longoffset == 9 and setting.state("ints").currentbatchcount == 4
    setting.put("longs", setting.spark.range(8, 14).selectExpr("id", "id AS twice"))
    setting.run(zones=zones)
    assert sorted(r["id"] for r in setting.sent()["longs"]) == [9, 9, 10, 11, 12, 13]
    assert setting.state("longs").currentbatchcount == 6


class Growing(TableStore):
    """A store in which rows at the watermark arrive between the count and the write."""

    def read_split(self, spark, table, column, lower, upper):
        frame = self.read(spark, table)
        return frame.unionByName(frame.filter(f"{column} = {int(upper) - 1}"))


def test_the_count_is_what_was_sent(setting):
    setting.register(control_row("longs", "id", 2, 4))
    setting.tables = Growing(name_value=setting.tables.name_value, split=Split(2))
    results = setting.run()
    assert len(setting.sent()["longs"]) == results[0].row_count == setting.state("longs").currentbatchcount == 7


@pytest.mark.parametrize("single", [False, True])
def test_counts_of_several_tables(setting, single):
    setting.register(control_row("longs", "id", 2, 4), control_row("ints", "size", 1, 3))
    results = setting.run(single_write=single, **({"sink": file_sink(f"{setting.folder}/s")} if single else {}))
    assert {r.table: r.row_count for r in results} == {"longs": 6, "ints": 4}


def test_ordered_records_ascend_in_every_partition(setting):
    setting.put("many", setting.spark.range(500).select((F.col("id") * 7919 % 500).alias("id")).repartition(4))
    setting.register(control_row("many", "id", 2, 100))
    setting.run(ordered=4, run_id="r")
    rows = setting.spark.read.parquet(setting.out)
    ranges = sorted((min(v), max(v)) for v in rows.groupBy("partition").agg(F.collect_list(header("offset").cast("int")).alias("v")).rdd.map(lambda r: r.v).collect())
    assert ranges[0][0] == 100 and ranges[-1][1] == 499 and len(ranges) == 4
    assert all(high < low for (_, high), (low, _) in zip(ranges, ranges[1:]))
    for path in glob.glob(f"{setting.out}/*/*.parquet"):
        ids = [json.loads(r.value)["id"] for r in setting.spark.read.parquet(path).collect()]
        assert ids == sorted(ids)


def test_forms_that_are_refused(setting):
    setting.register(control_row("longs", "id", 2, 4))
    with pytest.raises(ValueError, match="run id"):
        setting.run(run_id="it's")
    with pytest.raises(ValueError, match="not by both"):
        setting.run(ordered=2, spread=2)


@pytest.mark.parametrize("single_write", [False, True])
def test_large_ordered_tables_go_in_steps(setting, monkeypatch, single_write):
    monkeypatch.setattr("ebbmark.plans.export.SORT_ROWS", 30)
    spark = setting.spark
    ids = spark.range(500).select((F.col("id") * 7919 % 500 - 50).alias("id"))
    # A value that many rows share stays in one partition; odd column names and nested values arrive as they are.
    many = ids.unionAll(spark.range(40).select(F.lit(77).cast("bigint").alias("id")))
    many = many.withColumns({"Row `x.y`": F.col("id").cast("string"), "at": F.struct(F.timestamp_micros("id").alias("ts")), "none": F.lit(None).cast("int")})
    setting.put("many", many.repartition(4))
    setting.register(control_row("many", "id", 2, -40), control_row("longs", "id", 2, 6))
    writes = []

    class Kept:
        concurrent = 1

        def write(self, records, table):
            # Rows as each task has them, one after the other.
            rows = records.withColumn("task", F.spark_partition_id()).collect()
            writes.append([r for r in rows if r.key == "many"])

    results = setting.run(sink=Kept(), ordered=4, run_id="r", single_write=single_write)
    assert {r.table: r.row_count for r in results} == {"many": 530, "longs": 4}
    sent = [[(r.partition, int(r.headers[1]["value"])) for r in rows] for rows in writes if rows]
    # Five steps; a task of a step has its share of rows, and those of one value together.
    assert len(sent) == 5
    assert max(n for rows in writes for n in Counter(r.task for r in rows).values()) <= 30 + 40
    found = {}
    for rows in sent:
        for partition, offset in rows:
            found.setdefault(partition, []).append(offset)
    assert all(offsets == sorted(offsets) for offsets in found.values())
    ranges = [(found[p][0], found[p][-1]) for p in sorted(found)]
    assert all(high < low for (_, high), (low, _) in zip(ranges, ranges[1:]))
    assert sorted(sum(found.values(), [])) == sorted([*range(-40, 450), *[77] * 40])
    values = sorted(r.value for rows in writes for r in rows)
    assert values == sorted(r.value for r in to_records(many.filter("id >= -40"), "many").collect())
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/*/step=*")
