"""Document fingerprints by invertible Bloom lookup sketches.

A text is the set of digests of its paragraphs (sentences, cut at 200
characters). Its sketch is an array of cells; every digest is XORed into one cell
of each of four groups. The XOR of two sketches is the sketch of the paragraphs
in which two versions differ: a cell with one digest left is known by the check
bits inside it, is taken out of its other cells, and so on until all cells are
empty (peeling). Where peeling gets stuck a larger sketch is tried.

The fingerprint of a text holds its sketch of ``CELLS`` cells. Two fingerprints are
compared by subtracting and peeling these. Only where that gets stuck, as more
paragraphs differ than the cells can tell, larger sketches are made, shard by
shard: digests are dealt to shards by their own bits, every shard has a sketch of
its own, so that the work grows with the number of paragraphs.

DataFrame functions only, nothing leaves the JVM.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUPS = 4
GROUP_CELLS = 6
CELLS = GROUPS * GROUP_CELLS
# A digest is a 40-bit hash and 24 check bits made from it.
CHECK_BITS = 24
# Sizes of a group of cells that are tried one after the other.
TRIES = (GROUP_CELLS, 4 * GROUP_CELLS, 16 * GROUP_CELLS)
# Digests of two texts that share a shard on average, before equal ones cancel.
SHARD_LOAD = 8
PARAGRAPH = r"[^.!?\n]{1,200}[.!?]*"
# Ranges of ids per shuffle partition, which even out what a partition gets.
RANGES = 4


def digests(text: str) -> str:
    """SQL for the distinct paragraph digests of a text column, never 0."""
    units = f"filter(transform(regexp_extract_all({text}, '{_quoted(PARAGRAPH)}', 0), u -> trim(u)), u -> u <> '')"
    key = "shiftleft(xxhash64(u) & 1099511627775L, 24)"
    return f"array_distinct(transform({units}, u -> {_checked(key)}))"


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _checked(key: str) -> str:
    """A key of 40 bits, shifted up, with its check bits."""
    mask = (1 << CHECK_BITS) - 1
    return f"({key} | (xxhash64(shiftrightunsigned({key}, {CHECK_BITS})) & {mask}L))"


def _place(digest: str, group: int, size: int) -> str:
    """The cell of a digest in a group."""
    return f"CAST({group * size} + pmod(xxhash64({digest}, {group}), {size}) AS INT)"


def sketch(array: str, size: int) -> str:
    """SQL for the cells of an array of digests: the XOR of what falls in each."""
    by_group = []
    for group in range(GROUPS):
        # The place of a digest in the group is worked out once, not once per cell.
        placed = f"transform({array}, _d -> named_struct('d', _d, 'v', pmod(xxhash64(_d, {group}), {size})))"
        cells = f"transform(sequence(0, {size - 1}), v -> aggregate(_placed, 0L, (_x, _e) -> IF(_e.v = v, _x ^ _e.d, _x)))"
        by_group.append(f"get(transform(array({placed}), _placed -> {cells}), 0)")
    return f"concat({', '.join(by_group)})"


def peeled(cells: str, size: int) -> str:
    """SQL for the number of digests peeled out of cells; null where peeling gets stuck."""
    mask = (1 << CHECK_BITS) - 1
    pure = f"c -> c <> 0 AND (xxhash64(shiftrightunsigned(c, {CHECK_BITS})) & {mask}L) = (c & {mask}L)"
    # The places of the digest taken out are worked out once, not once per cell.
    places = ", ".join(f"'v{group}', {_place('p', group, size)}" for group in range(GROUPS))
    hit = " OR ".join(f"i = q.v{group}" for group in range(GROUPS))
    found = f"transform(slice(filter(s.cells, {pure}), 1, 1), p -> named_struct('d', p, {places}))"
    # Once no cell is pure nothing more happens, so the steps left are skipped.
    step = (
        f"IF(s.go, coalesce(get(transform({found}, q -> named_struct("
        f"'cells', transform(s.cells, (c, i) -> IF({hit}, c ^ q.d, c)), 'n', s.n + 1, 'go', true)), 0), "
        "named_struct('cells', s.cells, 'n', s.n, 'go', false)), s)"
    )
    # No more digests come out than there are cells.
    return (
        f"aggregate(sequence(1, {GROUPS * size}), named_struct('cells', {cells}, 'n', 0, 'go', true), (s, k) -> {step}, "
        "s -> IF(forall(s.cells, c -> c = 0), s.n, CAST(NULL AS INT)))"
    )


def differing(array: str) -> str:
    """SQL for how many digests an array holds an odd number of times, by sketches of growing size.

    Where even the largest is stuck (digests that share all their cells), they are counted one by one.
    """
    tries = [peeled(sketch(array, size), size) for size in TRIES]
    plain = f"size(filter(array_distinct({array}), _d -> size(filter({array}, _e -> _e = _d)) % 2 = 1))"
    return f"coalesce({', '.join(tries)}, {plain})"


def fingerprint(text_hash: str, array: str, cells: str) -> str:
    """SQL for a fingerprint: the whole text's hash, the number of paragraphs, the cells of their sketch."""
    return f"concat_ws('-', hex({text_hash}), CAST(size({array}) AS STRING), array_join(transform({cells}, c -> hex(c)), '.'))"


def told_apart(left: str, right: str, n_left: str, n_right: str) -> str:
    """SQL for how many digests differ between two sketches of ``CELLS`` cells; null where they are stuck.

    Sets whose sizes differ by more than the cells are not tried.
    """
    apart = peeled(f"zip_with({left}, {right}, (x, y) -> x ^ y)", GROUP_CELLS)
    return f"IF(abs({n_left} - {n_right}) > {CELLS}, CAST(NULL AS INT), {apart})"


def with_next(docs: DataFrame) -> DataFrame:
    """``(range, place, doc_id, text, next_text)``: every text with the one of the next id.

    Ids are cut into ranges at ids of the table, so that a range's last text
    meets the next range's first one: a row whose id begins a range goes to the
    range before as well. The last id is followed by the first. Rows of one id
    are ordered by text. A null id has no next text.
    """
    spark = docs.sparkSession
    parts = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(
        F.percentile_approx("doc_id", [k / parts for k in range(parts)], 100 * parts).alias("cuts")
    ).first()
    cuts = sorted(set(found.cuts or []))
    coarse = cuts[:: max(1, int(len(cuts) ** 0.5))]
    # Two short lists, so that a row is not held against every cut.
    fine = [cuts[bisect_right(cuts, a) - 1 : bisect_right(cuts, b) - 1 if b is not None else None] for a, b in zip(coarse, [*coarse[1:], None])]
    starts = [cuts.index(a) for a in coarse]

    def longs(values: list[int]) -> str:
        return "array(" + ", ".join(f"{v}L" for v in values) + ")"

    if cuts:
        block = f"size(filter({longs(coarse)}, c -> c <= doc_id)) - 1"
        blocks = f"array({', '.join(longs(f) for f in fine)})"
        inside = f"get(array({', '.join(map(str, starts))}), _block) + size(filter(get({blocks}, _block), c -> c <= doc_id)) - 1"
        begins = f"array_contains(get({blocks}, _block), doc_id)"
    else:
        block, inside, begins = "0", "0", "false"
    spread = f"-1 - CAST(pmod(xxhash64(text), {parts}) AS INT)"
    rows = docs.withColumn("_block", F.expr(block))
    rows = rows.withColumn("_range", F.expr(f"CAST(IF(doc_id IS NULL, {spread}, {inside}) AS INT)"))
    before = f"pmod(_range - 1, {max(len(cuts), 1)})"
    own, guest = "named_struct('range', _range, 'guest', false)", f"named_struct('range', CAST({before} AS INT), 'guest', true)"
    homes = F.expr(f"IF(doc_id IS NOT NULL AND {begins}, array({own}, {guest}), array({own}))")
    rows = rows.withColumn("_home", F.explode(homes)).select("*", "_home.range", "_home.guest").drop("_block", "_range", "_home")
    # Never so; said here, as a left join would ask it of one of the two uses of the shuffle alone.
    rows = rows.filter("range IS NOT NULL")
    order = Window.partitionBy("range").orderBy("guest", "doc_id", "text")
    rows = rows.withColumns(
        {
            "place": F.row_number().over(order),
            "next_text": F.when(F.col("doc_id").isNotNull(), F.lead("text").over(order)),
            "next_digests": F.when(F.col("doc_id").isNotNull(), F.lead("digests").over(order)),
            "next_cells": F.when(F.col("doc_id").isNotNull(), F.lead("cells").over(order)),
        }
    )
    return rows.filter("NOT guest").drop("guest")


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    The edited form has its last quarter (of code points, rounded down)
    replaced by as much of the beginning of the next text. ``near_edited`` and
    ``near_next`` are the Jaccard likeness of the paragraph sets, worked out
    from how many digests differ: 1 for equal sets, two empty ones included.
    ``by_fingerprint`` says for how many of the two the fingerprints were enough.

    Null texts are empty. A null id is followed by an empty text; rows of one
    id are ordered by text, repeated rows have rows of their own; columns
    besides ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("digests", F.expr(digests("text")))
    texts = texts.withColumn("cells", F.expr(sketch("digests", GROUP_CELLS)))
    none = F.array().cast("array<bigint>")
    rows = with_next(texts).withColumns(
        {
            "n_chars": F.char_length("text"),
            "next_text": F.coalesce("next_text", F.lit("")),
            "next_digests": F.coalesce("next_digests", none),
            "next_cells": F.coalesce("next_cells", F.array_repeat(F.lit(0).cast("bigint"), CELLS)),
        }
    )
    rows = rows.withColumn(
        "edited", F.expr("concat(substring(text, 1, n_chars - n_chars div 4), substring(next_text, 1, CAST(n_chars div 4 AS INT)))")
    ).withColumn("edited_digests", F.expr(digests("edited")))
    rows = rows.withColumn("edited_cells", F.expr(sketch("edited_digests", GROUP_CELLS)))
    rows = rows.withColumns(
        {
            f"{other}_apart": F.expr(told_apart("cells", f"{other}_cells", "size(digests)", f"size({other}_digests)"))
            for other in ("edited", "next")
        }
    )
    printed = rows.select(
        "range",
        "place",
        "doc_id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.expr(fingerprint("xxhash64(text)", "digests", "cells")).alias("fingerprint"),
        F.expr(fingerprint("xxhash64(edited)", "edited_digests", "edited_cells")).alias("edited_fingerprint"),
        F.expr("size(digests) + size(edited_digests)").alias("edited_n"),
        F.expr("size(digests) + size(next_digests)").alias("next_n"),
        "edited_apart",
        "next_apart",
    )
    both = printed.join(_apart_by_shards(rows), ["range", "place"], "left")
    nears = []
    for other in ("edited", "next"):
        n, apart = f"{other}_n", f"coalesce({other}_apart, {other}_sharded)"
        nears.append(F.expr(f"IF({n} = 0, 1.0D, ({n} - {apart}) / CAST({n} + {apart} AS DOUBLE))").alias(f"near_{other}"))
    known = F.expr("CAST(edited_apart IS NOT NULL AS INT) + CAST(next_apart IS NOT NULL AS INT)").alias("by_fingerprint")
    return both.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *nears, known)


def _apart_by_shards(rows: DataFrame) -> DataFrame:
    """``(range, place, edited_sharded, next_sharded)`` where fingerprints were stuck.

    All groupings lie within a range, which is one partition.
    """
    stuck = [
        f"IF({other}_apart IS NULL, array(named_struct('pair', {pair}, 'both', concat(digests, {other}_digests))), array())"
        for pair, other in enumerate(("edited", "next"))
    ]
    pairs = rows.select("range", "place", F.explode(F.expr(f"concat({', '.join(stuck)})")).alias("p"))
    shards = f"greatest(1, CAST(ceil(size(p.both) / {float(SHARD_LOAD)}) AS INT))"
    dealt = pairs.select("range", "place", "p.pair", F.expr(shards).alias("shards"), F.explode("p.both").alias("d"))
    dealt = dealt.withColumn("shard", F.expr("pmod(xxhash64(d, 99), shards)"))
    # A shard holds about SHARD_LOAD digests, whatever the length of the text.
    sharded = dealt.groupBy("range", "place", "pair", "shard").agg(F.collect_list("d").alias("held"))
    counted = sharded.withColumn("differ", F.expr(differing("held")))
    return counted.groupBy("range", "place").agg(
        F.sum(F.when(F.col("pair") == 0, F.col("differ"))).alias("edited_sharded"),
        F.sum(F.when(F.col("pair") == 1, F.col("differ"))).alias("next_sharded"),
    )


def recovered(left: str, right: str) -> str:
    """SQL for how many paragraphs differ between two fingerprint columns, from their sketches alone.

    Null if more differ than sketches of that size can tell.
    """
    cells = [f"transform(split(element_at(split({side}, '-'), -1), '[.]'), c -> CAST(conv(c, 16, -10) AS BIGINT))" for side in (left, right)]
    return peeled(f"zip_with({cells[0]}, {cells[1]}, (x, y) -> x ^ y)", GROUP_CELLS)
