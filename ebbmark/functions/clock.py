"""Batch clocks and day text as column expressions.

All of them follow ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and the clock shift the exported control rows rely on.
DAY_FORMAT = "yyyyMMdd"
DATE_FORMAT = "yyyy-MM-dd"
CLOCK_SHIFT_HOURS = 8
NO_DAY = "0"


def truncate_second(epoch_millis: Column) -> Column:
    """Timestamp of an epoch-millisecond column, cut to the whole second."""
    return F.date_trunc("SECOND", F.timestamp_millis(epoch_millis))


def batch_clock(epoch_millis: Column, shift_hours: int = CLOCK_SHIFT_HOURS) -> Column:
    """Whole-second timestamp moved by ``shift_hours``, as control rows hold it."""
    return truncate_second(epoch_millis) + F.make_dt_interval(hours=F.lit(shift_hours))


def day_text(date: Column, fmt: str = DAY_FORMAT) -> Column:
    """Formatted date; a null date gives ``"0"``."""
    return F.coalesce(F.date_format(date, fmt), F.lit(NO_DAY))


def yesterday(as_of: Column | None = None) -> Column:
    """The date before ``as_of`` (default: the current date)."""
    return F.date_sub(F.current_date() if as_of is None else as_of, 1)


def yesterday_text(as_of: Column | None = None, fmt: str = DATE_FORMAT) -> Column:
    """The day before ``as_of`` as text."""
    return F.date_format(yesterday(as_of), fmt)


def day_number(date: Column) -> Column:
    """Date as an int ``yyyyMMdd``, the form ``day`` partitions use."""
    return F.date_format(date, DAY_FORMAT).cast("int")
