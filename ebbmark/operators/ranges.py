"""Day partitions: which range to read, and reading it."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbmark.functions.clock import DAY_FORMAT, day_number, yesterday


class DayRange(NamedTuple):
    incremental: bool
    low: int
    high: int


def day_horizon(
    days: DataFrame,
    start_days: int | Sequence[int],
    as_of: Column | None = None,
    day_col: str = "day",
) -> DataFrame:
    """The range to read for each start day: ``(start_day, incremental, low, high)``.

    The end is the last partition, but not after yesterday. A start within the
    partitions gives ``start..end``; one before them ``first..end``; one after
    the end reads the end day alone and is marked incremental. No partitions,
    no rows. Days may repeat in ``days``.
    """
    starts = [start_days] if isinstance(start_days, int) else list(start_days)
    start, first, end = F.col("start_day"), F.col("first"), F.col("end")
    bounds = days.agg(
        F.min(day_col).cast("int").alias("first"), F.max(day_col).cast("int").alias("last")
    ).filter(F.col("first").isNotNull())
    return (
        bounds.withColumn("end", F.least("last", day_number(yesterday(as_of))))
        .withColumn("start_day", F.explode(F.array(*(F.lit(s) for s in starts))))
        .select(
            "start_day",
            ((start >= first) & (start > end)).alias("incremental"),
            F.when(start < first, first).when(start <= end, start).otherwise(end).alias("low"),
            end.alias("high"),
        )
    )


def pick_range(
    days: DataFrame, start_day: int, as_of: Column | None = None, day_col: str = "day"
) -> DayRange | None:
    """The range for one start day as plain values, for a filter that prunes partitions."""
    found = day_horizon(days, start_day, as_of, day_col).first()
    return None if found is None else DayRange(found.incremental, found.low, found.high)


def in_days(frame: DataFrame, days: DayRange, day_col: str = "day") -> DataFrame:
    """Rows of a table partitioned by day; the range prunes partitions."""
    day_type = frame.schema[day_col].dataType
    day = F.col(day_col)
    low, high = (F.lit(str(d)).cast(day_type) for d in (days.low, days.high))
    return frame.filter(day == low) if days.incremental else frame.filter(day.between(low, high))


def in_days_by_time(frame: DataFrame, days: DayRange, time_col: str) -> DataFrame:
    """The same rows from a table that has only a time column.

    Compares the column itself with the first instant of the range and of the
    day after it, which a scan can use; a day worked out per row it cannot.
    """
    time_type = frame.schema[time_col].dataType
    last = days.low if days.incremental else days.high
    begin = F.to_date(F.lit(str(days.low)), DAY_FORMAT)
    after = F.date_add(F.to_date(F.lit(str(last)), DAY_FORMAT), 1)
    time = F.col(time_col)
    return frame.filter((time >= begin.cast(time_type)) & (time < after.cast(time_type)))


def count_rows(rows: DataFrame) -> DataFrame:
    """The row count of a range as a one-row frame."""
    return rows.agg(F.count("*").alias("row_count"))
