"""Days a table has data for, as an int column ``day``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbmark.functions.clock import day_number


def catalog_days(spark: SparkSession, table: str, day_col: str = "day") -> DataFrame:
    """``day`` of every partition of a metastore table; reads no data.

    A day repeats where the table has partition columns besides ``day``.
    """
    key = rf"(?:^|/){day_col}=([0-9]{{8}})(?:/|$)"
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    return listed.select(F.regexp_extract("partition", key, 1).try_cast("int").alias("day"))


def time_days(frame: DataFrame, time_col: str) -> DataFrame:
    """First and last day of a table that has only a time column.

    Bounds are taken over the times, so that days are worked out twice and not
    once per row.
    """
    bounds = frame.agg(F.array(F.min(time_col), F.max(time_col)).alias("bounds"))
    return bounds.select(F.explode("bounds").alias("day")).select(day_number(F.col("day")).alias("day"))
