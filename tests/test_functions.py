from dataclasses import dataclass
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbmark.functions.clock import batch_clock, day_text, truncate_second, yesterday_text
from ebbmark.functions.naming import qualified_name, to_camel, to_snake
from ebbmark.operators.schemas import apply_schema, camel_columns, declared_schema, snake_columns


def apply(spark, function, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(1)
    return [r[0] for r in frame.orderBy("i").select(function(F.col("v"))).collect()]


def snake_by_hand(name):
    out = ""
    for i, c in enumerate(name or ""):
        apart = i > 0 and c == c.upper() and not c.isdecimal() and c != "_"
        out += ("_" if apart else "") + c.upper()
    return out.lower()


def camel_by_hand(name, first_upper):
    if not name:
        return ""
    capital = str.upper if first_upper else str.lower
    if "_" not in name:
        return capital(name[0]) + name[1:]
    pieces = [p for p in name.split("_") if p]
    out = [p[0].upper() + p[1:].lower() for p in pieces]
    if pieces and not first_upper:
        out[0] = pieces[0].lower()
    return "".join(out)


def test_snake_samples(spark):
    samples = {
        "helloWorld": "hello_world",
        "ABTest": "a_b_test",
        "a_B": "a__b",
        "": "",
        None: "",
        "x2Y": "x2_y",
        "straßeÜber": "strasse_über",
        "a-b": "a_-b",
        "中a": "中a",
        "a中": "a_中",
        "_aB": "_a_b",
        "l_orderkey": "l_orderkey",
        "A": "a",
        "aⅷ": "aⅷ",
    }
    assert apply(spark, to_snake, samples) == list(samples.values())


def test_camel_samples(spark):
    samples = {
        "hello_world": ("helloWorld", "HelloWorld"),
        "_hello_world": ("helloWorld", "HelloWorld"),
        "a__b": ("aB", "AB"),
        "A_b_": ("aB", "AB"),
        "_": ("", ""),
        "": ("", ""),
        None: ("", ""),
        "HelloWorld": ("helloWorld", "HelloWorld"),
        "l_orderkey": ("lOrderkey", "LOrderkey"),
        "HELLO_WORLD": ("helloWorld", "HelloWorld"),
    }
    assert apply(spark, to_camel, samples) == [v[0] for v in samples.values()]
    assert apply(spark, lambda n: to_camel(n, True), samples) == [v[1] for v in samples.values()]


NAMES = st.text(st.sampled_from("aAbBzZ019_-. éÉ中"), max_size=12)


@settings(max_examples=5, deadline=None)
@given(st.lists(NAMES, min_size=60, max_size=60))
def test_names_match_rules_by_hand(spark, names):
    assert apply(spark, to_snake, names) == [snake_by_hand(n) for n in names]
    for upper in (False, True):
        found = apply(spark, lambda n: to_camel(n, upper), names)
        assert found == [camel_by_hand(n, upper) for n in names]


def test_qualified_names(spark):
    found = apply(spark, lambda n: qualified_name(n, "main"), ["db.t", "t", "store::db.t", "a.b.c", None])
    assert [tuple(r) for r in found] == [
        ("db", "t"), ("main", "t"), ("store::db", "t"), ("a", "b"), ("main", None),
    ]


def test_column_renames(spark):
    frame = spark.sql("SELECT 1 AS orderKey, 2 AS l_x, 3 AS `Big Name`")
    assert snake_columns(frame).columns == ["order_key", "l_x", "big_ _name"]
    assert camel_columns(frame.select("orderKey", "l_x")).columns == ["orderKey", "lX"]
    assert camel_columns(frame.select("l_x"), first_upper=True).columns == ["LX"]
    assert snake_columns(frame).first() == (1, 2, 3)
    with pytest.raises(ValueError, match="a_b"):
        camel_columns(spark.sql("SELECT 1 AS a_b, 2 AS a__b"))


def clock(spark, millis, function):
    frame = spark.createDataFrame([(millis,)], "ms bigint").select(function(F.col("ms")).cast("string"))
    return frame.first()[0]


def test_clocks(spark):
    assert clock(spark, 1_706_700_000_999, truncate_second) == "2024-01-31 11:20:00"
    assert clock(spark, 1_706_700_000_999, batch_clock) == "2024-01-31 19:20:00"
    assert clock(spark, 1_706_700_000_000, lambda m: batch_clock(m, -12)) == "2024-01-30 23:20:00"
    assert clock(spark, -1, truncate_second) == "1969-12-31 23:59:59"
    assert clock(spark, None, batch_clock) is None


def test_day_texts(spark):
    rows = spark.createDataFrame([(date(2024, 3, 1),), (None,)], "d date")
    assert [r[0] for r in rows.select(day_text(F.col("d"))).collect()] == ["20240301", "0"]
    found = rows.select(yesterday_text(F.col("d")), yesterday_text(F.col("d"), "yyyyMMdd")).first()
    assert tuple(found) == ("2024-02-29", "20240229")
    before_today = F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd")
    today = rows.select(yesterday_text(), before_today).first()
    assert today[0] == today[1]


@dataclass
class Declared:
    name: str
    price: float
    size: int
    flag: bool
    at: datetime


def test_declared_schema():
    schema = declared_schema(Declared)
    assert schema.simpleString() == "struct<name:string,price:double,size:int,flag:string,at:string>"
    assert not any(f.nullable for f in schema)
    named = declared_schema({"a": "long", "b": "int", "c": "boolean", "d": "double", "e": "string"})
    assert named.simpleString() == "struct<a:string,b:int,c:string,d:double,e:string>"


def test_apply_schema(spark):
    frame = spark.sql("SELECT 'x' AS name, 7L AS size, 1 AS price, true AS flag, 'now' AS at, 0 AS other")
    cast = apply_schema(frame, declared_schema(Declared))
    assert cast.schema == declared_schema(Declared)
    assert cast.first() == ("x", 1.0, 7, "true", "now")
    holed = frame.withColumn("size", F.lit(None).cast("int"))
    with pytest.raises(Exception, match="null in non-nullable column size"):
        apply_schema(holed, declared_schema(Declared)).collect()
