"""Declared schemas and renamed columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import get_type_hints

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.functions.naming import to_camel, to_snake

# Only these declared types keep a type of their own.
DECLARED_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
}
PYTHON_NAMES = {str: "string", float: "double", int: "int"}
FILLER = {T.StringType(): "", T.DoubleType(): 0.0, T.IntegerType(): 0}


def declared_schema(fields: Mapping[str, str] | type) -> T.StructType:
    """Schema of declared types, no field nullable.

    ``fields`` maps names to type names, or is a class with annotations. Every
    type but string, double and int (long, boolean and dates too) becomes string.
    """
    if isinstance(fields, type):
        fields = {n: PYTHON_NAMES.get(t, "other") for n, t in get_type_hints(fields).items()}
    return T.StructType(
        [T.StructField(n, DECLARED_TYPES.get(t, T.StringType()), False) for n, t in fields.items()]
    )


def apply_schema(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name and cast; a null fails the job that meets it."""

    def required(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`").cast(field.dataType)
        error = F.raise_error(F.lit(f"null in non-nullable column {field.name}"))
        checked = F.when(value.isNull(), error).otherwise(value)
        # The filler is never reached; with it Spark knows the column holds no nulls.
        return F.coalesce(checked, F.lit(FILLER[field.dataType])).alias(field.name)

    return frame.select(*(required(f) for f in schema))


def rename_all(frame: DataFrame, convert: Callable[[Column], Column]) -> DataFrame:
    """Rename every column by a name function; two columns with one new name are refused."""
    one_row = frame.sparkSession.sql("VALUES (1)")
    names = one_row.select(F.transform(F.lit(frame.columns), convert)).first()[0]
    seen: dict[str, str] = {}
    for old, new in zip(frame.columns, names):
        if new.lower() in seen:
            other = seen[new.lower()]
            raise ValueError(f"columns {other!r} and {old!r} would both be named {new!r}")
        seen[new.lower()] = old
    return frame.toDF(*names)


def snake_columns(frame: DataFrame) -> DataFrame:
    return rename_all(frame, to_snake)


def camel_columns(frame: DataFrame, first_upper: bool = False) -> DataFrame:
    return rename_all(frame, lambda name: to_camel(name, first_upper))
