"""Small column helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def others(frame: DataFrame, taken: Iterable[str]) -> list[Column]:
    """The columns of ``frame`` that are not named like one of ``taken``, in any case."""
    names = {name.lower() for name in taken}
    return [F.col(f"`{c}`") for c in frame.columns if c.lower() not in names]


def unused(frame: DataFrame, name: str) -> str:
    """``name``, or with as many underscores before it as no column of ``frame`` has."""
    there = {c.lower() for c in frame.columns}
    while name.lower() in there:
        name = f"_{name}"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
