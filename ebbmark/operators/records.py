"""Rows as key/value records, the value being the row in JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _json_value(value: str, kind: T.DataType, depth: int = 0) -> str:
    """SQL for a value as it goes into JSON; the value itself where its type needs no change."""
    inner = f"x{depth}"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return f"unix_millis(CAST({value} AS TIMESTAMP))"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # JSON has no NaN and no infinities; they leave as missing values.
        # Only a finite x gives x - x = 0.
        return f"CASE WHEN {value} - {value} = 0 THEN {value} END"
    if isinstance(kind, T.ArrayType):
        changed = _json_value(inner, kind.elementType, depth + 1)
        return value if changed == inner else f"transform({value}, {inner} -> {changed})"
    if isinstance(kind, T.MapType):
        # Keys are written as text either way.
        changed = _json_value(inner, kind.valueType, depth + 1)
        return value if changed == inner else f"transform_values({value}, (k{depth}, {inner}) -> {changed})"
    if isinstance(kind, T.StructType):
        fields = [(f.name, f"{value}.{_quoted(f.name)}", f.dataType) for f in kind]
        changed = [_json_value(field, data_type, depth) for _, field, data_type in fields]
        if all(new == field for new, (_, field, _) in zip(changed, fields)):
            return value
        parts = ", ".join(f"{new} AS {_quoted(name)}" for new, (name, _, _) in zip(changed, fields))
        return f"CASE WHEN {value} IS NOT NULL THEN struct({parts}) END"
    return value


def _json_field(field: T.StructField) -> str:
    name = _quoted(field.name)
    value = _json_value(name, field.dataType)
    return name if value == name else f"{value} AS {name}"


def to_records(
    rows: DataFrame,
    table: str,
    key_column: str | None = None,
    spread: int | None = None,
    headers: Mapping[str, str] | None = None,
) -> DataFrame:
    """``(key, value)`` strings. The key is the table name, the same for all
    rows, unless a key column is named. ``spread`` adds ``partition``, an int
    below it by a hash of the value, which a Kafka sink takes as the topic
    partition: so the key can stay the table's name on many partitions.

    ``headers``, names and SQL texts over the row, add ``headers`` as a Kafka sink
    takes them, an array of names and binary values.

    In the value, null fields are left out, timestamps and dates are epoch
    milliseconds, NaN and infinities are missing (in an array: null) and binary
    is base64, also within structs, arrays and maps. Fields keep the order of
    the schema.
    """
    key = F.lit(table) if key_column is None else F.col(key_column).cast("string")
    # One SQL text for all fields: a batch plans thousands of columns on the driver.
    fields = ", ".join(_json_field(f) for f in rows.schema)
    value = F.expr(f"to_json(struct({fields}), map('ignoreNullFields', 'true'))")
    more = []
    if headers:
        pairs = (f"struct('{name}' AS key, CAST(CAST({text} AS STRING) AS BINARY) AS value)" for name, text in headers.items())
        more = [F.expr(f"array({', '.join(pairs)})").alias("headers")]
    records = rows.select(key.alias("key"), value.alias("value"), *more)
    if spread is None:
        return records
    return records.withColumn("partition", F.pmod(F.xxhash64("value"), F.lit(spread)).cast("int"))


def header(name: str) -> Column:
    """The value of a header as text."""
    return F.filter("headers", lambda h: h["key"] == name)[0]["value"].cast("string")


def once(records: DataFrame) -> DataFrame:
    """Records of several runs, each left once, by their headers ``run`` and ``offset``.

    Delivery is at-least-once: a run may send again what one before it sent. A
    record is the same if key, value and offset are; rows that a table holds
    twice stay two, as a run sends both.
    """
    same = ["key", "value", "_offset"]
    rest = F.struct(*(c for c in records.columns if c not in ("key", "value")))
    told = records.withColumns({"_run": header("run"), "_offset": header("offset"), "_rest": rest})
    by_run = told.groupBy(*same, "_run").agg(F.count("*").alias("_n"), F.first("_rest").alias("_rest"))
    sent = by_run.groupBy(*same).agg(F.min_by("_rest", "_run").alias("_rest"), F.max("_n").alias("_n"))
    left = sent.select("key", "value", F.explode(F.expr("array_repeat(_rest, CAST(_n AS INT))")).alias("_rest"))
    return left.select("key", "value", "_rest.*").select(*records.columns)
