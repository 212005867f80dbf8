"""Matches of patterns with their places in a text, as DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbmark.llm.columns import let

# Matches that share one running end; bounds what an appended match copies.
BATCH = 64
# Code points of the text before and after a match that count as near it.
BEFORE, AFTER = 48, 24

SPAN = "struct<start:int,end:int,value:string,before:string,after:string>"


def matches(text: Column, pattern: str, group: int = 0, near: bool = False) -> Column:
    """Leftmost non-overlapping matches in order: ``start``, ``end`` (exclusive), ``value``.

    Places are code points. ``value`` is what ``group`` holds. With ``near`` the
    text just before and after stands in ``before`` and ``after``, no further than
    to the next match; without, both are null. The lengths of what lies between
    the matches give the places. Running ends are kept for a batch of matches at
    a time, so that the work grows in proportion to the text.
    """
    none = F.array().cast(f"array<{SPAN}>")
    nothing = F.lit(None).cast("string")

    def pieces(between: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
        after = F.slice(between, F.lit(2), F.size(between)) if near else F.array().cast("array<string>")
        joined = F.arrays_zip(found.alias("f"), values.alias("v"), F.slice(between, F.lit(1), F.size(between) - 1).alias("b"), after.alias("a"))
        return F.transform(
            joined,
            lambda x: F.struct(
                F.char_length(x["b"]).alias("gap"),
                F.char_length(x["f"]).alias("run"),
                x["v"].alias("value"),
                (F.right(x["b"], F.lit(BEFORE)) if near else nothing).alias("before"),
                (F.left(x["a"], F.lit(AFTER)) if near else nothing).alias("after"),
            ),
        )

    def batched(every: Column) -> Column:
        last = F.floor((F.size(every) - 1) / BATCH).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(every, k * BATCH + 1, F.lit(BATCH)))

    def placed(batches: Column) -> Column:
        lengths = F.transform(batches, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x["gap"] + x["run"]))
        starts = F.aggregate(
            F.slice(lengths, F.lit(1), F.size(lengths) - 1),
            F.array(F.lit(0)),
            lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)),
        )
        return F.flatten(F.zip_with(batches, starts, one_batch))

    def one_batch(batch: Column, start: Column) -> Column:
        return F.aggregate(
            batch,
            F.struct(start.alias("at"), none.alias("done")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["run"]).alias("at"),
                F.concat(
                    acc["done"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            (acc["at"] + x["gap"] + x["run"]).alias("end"),
                            x["value"].alias("value"),
                            x["before"].alias("before"),
                            x["after"].alias("after"),
                        )
                    ),
                ).alias("done"),
            ),
            lambda acc: acc["done"],
        )

    there = let(F.split(text, pattern, -1), lambda between: let(let(pieces(between), batched), placed))
    return F.when(text.rlike(pattern), there).otherwise(none)


def listed(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of spans with a ``place`` in ``kinds``, comma-joined."""
    names = F.array(*(F.lit(kind) for kind in kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["place"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
