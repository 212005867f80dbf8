import base64
import json
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ebbmark.operators.records import header, once, to_records


def values(frame, **options):
    return [json.loads(r.value) for r in to_records(frame, "t", **options).collect()]


def test_value_rules(spark):
    frame = spark.createDataFrame(
        [
            (1, None, datetime(2024, 1, 2, 3, 4, 5, 678901), date(1970, 1, 2), b"\x00\xff", Decimal("1.50"), True),
            (None, "é\"\n中", datetime(1969, 12, 31, 23, 59, 59, 999999), None, None, None, None),
        ],
        "i bigint, s string, ts timestamp, d date, b binary, dec decimal(10,2), f boolean",
    )
    first, second = values(frame)
    assert first == {
        "i": 1,
        "ts": 1704164645678,
        "d": 86_400_000,
        "b": base64.b64encode(b"\x00\xff").decode(),
        "dec": 1.5,
        "f": True,
    }
    assert second == {"s": 'é"\n中', "ts": -1}
    assert '"dec":1.50' in to_records(frame, "t").first().value


def test_local_timestamps_are_milliseconds_too(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '1970-01-01 00:00:01.5' AS ts")
    assert values(frame) == [{"ts": 1500}]


def test_numbers_json_cannot_hold_are_left_out(spark):
    frame = spark.sql(
        "SELECT CAST(x AS double) AS d, CAST(x AS float) AS f "
        "FROM VALUES ('NaN'), ('Infinity'), ('-Infinity'), ('0'), ('-2.5'), ('1e308') AS t(x) "
        "WHERE x <> '1e308' UNION ALL SELECT 1e308D, CAST(3e38 AS float)"
    )
    assert values(frame) == [
        {}, {}, {}, {"d": 0.0, "f": 0.0}, {"d": -2.5, "f": -2.5}, {"d": 1e308, "f": 3e38},
    ]


def test_fields_keep_schema_order_and_odd_names(spark):
    frame = spark.sql("SELECT 1 AS z, 2 AS `a.b`, 3 AS `c``d`, 4 AS `it's`, 5.5D AS `f g`")
    assert list(values(frame)[0].items()) == [("z", 1), ("a.b", 2), ("c`d", 3), ("it's", 4), ("f g", 5.5)]


def test_nested_values_pass_through(spark):
    frame = spark.sql("SELECT array(1, 2) AS a, named_struct('x', 'y') AS s, map('k', 1) AS m")
    assert values(frame) == [{"a": [1, 2], "s": {"x": "y"}, "m": {"k": 1}}]


def test_key_is_the_table_name_or_a_column(spark):
    frame = spark.range(3).withColumn("user", F.concat(F.lit("u"), "id"))
    assert {r.key for r in to_records(frame, "db.t").collect()} == {"db.t"}
    assert [r.key for r in to_records(frame, "t", key_column="id").collect()] == ["0", "1", "2"]
    assert to_records(frame, "t").dtypes == [("key", "string"), ("value", "string")]


def test_all_null_row_is_an_empty_object(spark):
    assert values(spark.sql("SELECT CAST(NULL AS int) AS a")) == [{}]


def test_nested_values_follow_the_same_rules(spark):
    frame = spark.sql(
        """SELECT 1 AS id, array(double('NaN'), 1.5D, null) AS numbers,
           named_struct('at', TIMESTAMP '2024-01-01', 'd', DATE '2024-01-02', 'f', float('Infinity')) AS s,
           map('k', TIMESTAMP_NTZ '2024-01-01 00:00:01', 'n', null) AS m,
           array(named_struct('a`b', array(DATE '1970-01-02')), null) AS deep,
           CAST(null AS struct<at: timestamp>) AS none, array(1, 2) AS plain"""
    )
    value = json.loads(to_records(frame, "t").first().value)
    assert value == {
        "id": 1,
        "numbers": [None, 1.5, None],
        "s": {"at": 1704067200000, "d": 1704153600000},
        "m": {"k": 1704067201000, "n": None},
        "deep": [{"a`b": [86400000]}, None],
        "plain": [1, 2],
    }


def test_flat_tables_and_plain_arrays_keep_a_plain_projection(spark):
    frame = spark.range(1).selectExpr("id", "array(id) AS a", "named_struct('x', id) AS s")
    plan = to_records(frame, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "transform" not in plan


def test_spread_adds_no_exchange(spark):
    records = to_records(spark.range(100), "t", spread=8)
    assert "Exchange" not in records._jdf.queryExecution().executedPlan().toString()
    assert records.select("partition").distinct().count() == 8
    assert records.select("key").distinct().collect()[0][0] == "t"


def test_headers_leave_each_record_once(spark):
    rows = spark.sql("SELECT 1 AS id, 7L AS at UNION ALL SELECT 1, 7L UNION ALL SELECT 2, 8L")
    sent = [to_records(part, "t", headers={"run": f"'{run}'", "offset": "at"}) for run, part in (("r1", rows), ("r2", rows), ("r3", rows.filter("id = 2")))]
    assert sent[0].schema["headers"].dataType.simpleString() == "array<struct<key:string,value:binary>>"
    every = sent[0].unionAll(sent[1]).unionAll(sent[2])
    left = once(every)
    assert left.columns == every.columns
    values = [(r.value, r.run, r.at) for r in left.select("value", header("run").alias("run"), header("offset").alias("at")).collect()]
    assert sorted(values) == [('{"id":1,"at":7}', "r1", "7")] * 2 + [('{"id":2,"at":8}', "r1", "8")]
