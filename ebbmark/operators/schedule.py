"""Which table is due next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbmark.functions.clock import yesterday


def next_due_table(schedule: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row: the first table by ``seq`` never run or last run yesterday, else ``""``.

    ``schedule`` holds ``seq``, ``tablename`` and ``last_batch``.
    """
    last = F.to_date("last_batch")
    due = schedule.filter(last.isNull() | (last == yesterday(as_of)))
    first = F.min_by("tablename", "seq")
    return due.agg(F.coalesce(first, F.lit("")).alias("tablename"))
