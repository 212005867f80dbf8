"""Near-duplicate groups of documents by HyperMinHash.

A document is the set of its distinct word shingles. Sets are hashed into
``BUCKETS`` buckets; a bucket keeps the smallest hash it saw as a compressed
register, the count of leading zeros and ``MANTISSA`` bits after the first
one. Empty buckets borrow a register for banding; ``BANDS`` bands of consecutive
registers, hashed, bring documents together;
the Jaccard estimate of two register arrays, corrected for registers that are
equal by chance, screens the pairs, and the full sets decide.

At a similarity of 0.8 a band of six registers agrees with probability 0.26, so
64 bands all miss with probability 4e-9. The screen keeps every pair within six
standard deviations of the threshold.

No group is expanded into its pairs. Equal sets are one class. A band's members
are held against the one that meets most others, the three most alike per member
are verified and their components found. Links may be left between members of one
band that lie in different components. These members are not paired band by band:
with the shingles of each ordered from the rarest on, two that reach the threshold
share one among the first of both, at places their sizes bound. Members meet at
such shingles only, so that texts which have too many shingles of their own meet
nothing, and a group of n copies costs about n pairs. No link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.llm.arrays import Words, distinct_pairs, giving_back, may_hold, membership, mix, shingles, slices, stored, stored_alone, texts_of
from ebbmark.llm.components import components

BANDS = 64
BAND_WIDTH = 6
BUCKETS = BANDS * BAND_WIDTH
MANTISSA = 9
# Words of 64 register bits that travel with band members for a first look.
LANES = 4
# Sizes of sets within such a factor are of one class.
SIZE_STEP = 1.05
# Best-looking partners of a document that are verified before its component is known.
FIRST_TRIES = 3

_SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_a", T.LongType()),
        T.StructField("set_b", T.LongType()),
        T.StructField("registers", T.BinaryType()),
    ]
)
_BANDED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("lanes", T.ArrayType(T.LongType())),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)
_SETS = T.StructType([T.StructField("id", T.LongType()), T.StructField("members", T.BinaryType())])
_SHINGLES = T.StructType([T.StructField("id", T.LongType()), T.StructField("shingle", T.LongType())])
_LIKE = T.StructType(
    [
        T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()),
        T.StructField("likeness", T.DoubleType()),
    ]
)
_EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def shingle_sets(texts: pa.StringArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ordered by row and hash."""
    words = Words(texts)
    keys, rows, _ = shingles(words, words.hashes(lower=True), size)
    return distinct_pairs(keys, rows)


def registers_of(keys: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Compressed registers, one line per row; 0 is an empty bucket.

    ``keys`` are ordered within a row, and the bucket is taken from their
    leading bits, so the first of a bucket is its smallest.
    """
    low = np.uint64(0xFFFFFFFF)
    spread = (keys >> np.uint64(32)) * np.uint64(BUCKETS) + (((keys & low) * np.uint64(BUCKETS)) >> np.uint64(32))
    bucket = (spread >> np.uint64(32)).astype(np.int64)
    rest = spread & low
    place = rows * BUCKETS + bucket
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]
    rest = rest[first].astype(np.int64) | 1
    zeros = 31 - np.floor(np.log2(rest)).astype(np.int64)
    below = (rest << (zeros + 1)) & 0xFFFFFFFF
    value = (np.minimum(zeros, 31) << MANTISSA) | (below >> (32 - MANTISSA))
    flat = np.zeros(n_rows * BUCKETS, np.uint16)
    flat[place[first]] = value + 1
    return flat.reshape(n_rows, BUCKETS)


def chance_of_equal(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that registers of two unrelated sets of these sizes are equal.

    A bucket's minimum is exponential with rate n / BUCKETS. Registers with l
    leading zeros are cells of width 2^-(l + 1 + MANTISSA).
    """
    a, b = n_a[:, None] / BUCKETS, n_b[:, None] / BUCKETS
    level = np.arange(32)[None, :]
    inside = np.exp(-(a + b) * 2.0 ** -(level + 1)) - np.exp(-(a + b) * 2.0**-level)
    return (2.0 ** -(level + 1 + MANTISSA) * inside).sum(1) * (a * b / (a + b))[:, 0]


def estimate(left: np.ndarray, right: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates, and how many buckets each rests on."""
    both = (left > 0) & (right > 0)
    used = np.maximum(((left > 0) | (right > 0)).sum(1), 1)
    equal = (both & (left == right)).sum(1)
    chance = chance_of_equal(n_a.astype(float), n_b.astype(float))
    corrected = (equal - both.sum(1) * chance) / (1 - chance)
    return np.clip(corrected / used, 0, 1), used


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Set size, a 128-bit hash of the set and the registers of each document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for first, last in slices(texts):
                n = last - first
                keys, rows = shingle_sets(texts.slice(first, n), size)
                counts = np.bincount(rows, minlength=n).astype(np.int64)
                bounds = np.concatenate(([0], np.cumsum(counts)))
                parts = []
                for salt in (1, 2):
                    total = np.zeros(len(keys) + 1, np.uint64)
                    np.cumsum(mix(keys, salt), out=total[1:])
                    parts.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
                lines = registers_of(keys, rows, n)
                registers = [lines[i].tobytes() if counts[i] else None for i in range(n)]
                ids = batch.column(0).slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(counts), pa.array(parts[0]), pa.array(parts[1]), pa.array(registers, pa.binary())],
                    names=_SIGNED.names,
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(giving_back(sign), _SIGNED)


@cache
def _priorities() -> np.ndarray:
    """For every bucket a random order of all buckets, the same in every task."""
    places = np.arange(BUCKETS * BUCKETS, dtype=np.uint64)
    return mix(places, 3).reshape(BUCKETS, BUCKETS).astype(np.float32)


def filled(lines: np.ndarray) -> np.ndarray:
    """Registers whose empty buckets borrow from the first filled one in their own order.

    Small sets leave most buckets empty; bands of those would agree on a single
    common shingle. Borrowed registers of two sets agree as often as their own.
    """
    lines = lines.copy()
    order = _priorities()
    for i in np.flatnonzero((lines == 0).any(1)):
        held = np.flatnonzero(lines[i])
        if len(held):
            empty = np.flatnonzero(lines[i] == 0)
            lines[i, empty] = lines[i, held[order[np.ix_(empty, held)].argmin(1)]]
    return lines


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashed bands, and lanes: the lowest bits of the first registers, 64 to a lane."""
    for batch in batches:
        for first in range(0, batch.num_rows, 1000):
            part = batch.slice(first, 1000)
            lines = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16).reshape(-1, BUCKETS)
            lines = filled(lines)
            bits = np.packbits((lines[:, : 64 * LANES] & 1).astype(bool), axis=1).view(np.int64)
            by_band = lines.reshape(-1, BANDS, BAND_WIDTH).astype(np.uint64)
            keys = np.zeros(by_band.shape[:2], np.uint64)
            for k in range(BAND_WIDTH):
                keys += mix(by_band[:, :, k], k)
            keys = mix(mix(keys) + np.arange(BANDS, dtype=np.uint64)[None, :]).view(np.int64)
            arrays = [
                pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), v.shape[1]).cast(pa.list_(pa.int64())) for v in (bits, keys)
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *arrays], names=_BANDED.names)


def _lanes_allow(a: str, b: str, threshold: float) -> str:
    """SQL for whether sizes and lanes of two sets allow the threshold, six standard deviations off.

    Low bits of equal registers agree, those of others every other time. A set
    smaller than the lanes has only as many independent ones.
    """
    bits = 64 * LANES
    unlike = " + ".join(f"bit_count({a}.lanes[{k}] ^ {b}.lanes[{k}])" for k in range(LANES))
    share = (1 - threshold) / 2
    spread = f"sqrt({share * (1 - share)} / least({bits}, {a}.n_shingles, {b}.n_shingles))"
    sizes = f"least({a}.n_shingles, {b}.n_shingles) >= {threshold} * greatest({a}.n_shingles, {b}.n_shingles) - 1e-9"
    return f"({sizes} AND {unlike} <= {bits} * ({share} + 6 * {spread}))"


def _screen(threshold: float):
    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                left, right = (
                    np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS)
                    for c in ("registers_a", "registers_b")
                )
                n_a, n_b = (part.column(c).to_numpy() for c in ("n_a", "n_b"))
                like, used = estimate(left, right, n_a, n_b)
                near = like + 6 * np.sqrt(threshold * (1 - threshold) / used) + 1 / used >= threshold
                near &= np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) - 1e-9
                yield pa.RecordBatch.from_arrays(
                    [part.column("a").filter(pa.array(near)), part.column("b").filter(pa.array(near)), pa.array(like[near])],
                    names=_LIKE.names,
                )

    return screen


def _screened(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` whose registers allow the threshold, with their estimate."""
    side = classes.select(F.col("rep").alias("id"), "n_shingles", "registers")
    a = side.select(F.col("id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("registers").alias("registers_a"))
    b = side.select(F.col("id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("registers").alias("registers_b"))
    joined = pairs.join(a, "a").join(b, "b")
    return joined.select("a", "b", "n_a", "n_b", "registers_a", "registers_b").mapInArrow(giving_back(_screen(threshold)), _LIKE)


def _member_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``(id, members)``, the full shingle sets of all documents in ``ids``, and of few others.

    A membership filter keeps the texts of the others from being cut up and shuffled.
    """
    bitmap = membership(ids, "id")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(words, batch.column(2).to_numpy())))
            texts = texts_of(batch.column(1))
            for first, last in slices(texts):
                keys, rows = shingle_sets(texts.slice(first, last - first), size)
                cuts = np.searchsorted(rows, np.arange(last - first + 1))
                sets = [keys[cuts[i] : cuts[i + 1]].tobytes() for i in range(last - first)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(sets, pa.binary())], names=_SETS.names
                )

    wanted = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    return wanted.filter("id IS NOT NULL").withColumn("hash", F.xxhash64("id")).mapInArrow(giving_back(members), _SETS)


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("members_a"), batch.column("members_b")):
                left, right = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(left, right, assume_unique=True))
                linked.append(both > 0 and 100 * both >= percent * (len(left) + len(right) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=_EDGE.names)

    return verify


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    sets = _member_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")), size)
    a = sets.select(F.col("id").alias("a"), F.col("members").alias("members_a"))
    b = sets.select(F.col("id").alias("b"), F.col("members").alias("members_b"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b")
    return both.select("a", "b", "members_a", "members_b").mapInArrow(giving_back(_verify(percent)), _EDGE)


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets as rows, a slice of about a million shingles at a time."""
    for batch in batches:
        for first, last in slices(batch.column(1), 8 << 20):
            sets = [np.frombuffer(s.as_buffer(), np.int64) for s in batch.column(1).slice(first, last - first)]
            ids = np.repeat(batch.column(0).slice(first, last - first).to_numpy(), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets))], names=_SHINGLES.names)


def _size_class(size: str) -> str:
    return f"CAST(floor(ln({size}) / ln({SIZE_STEP}D)) AS INT)"


def places(shingled: DataFrame, members: DataFrame) -> DataFrame:
    """``(id, component, n_shingles, shingle, place)`` of every shingle that members share.

    ``shingled`` has ``(id, shingle)`` rows, each once, of ``members(id,
    component, n_shingles)``. Shingles are ordered by how many members have them;
    a shingle that one member has alone meets nothing, but takes a place.
    """
    counts = shingled.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1")
    held = shingled.join(counts, "shingle").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("common"))
    placed = held.join(members, "id").select(
        "id", "component", "n_shingles", (F.col("n_shingles") - F.size("common")).alias("alone"), F.posexplode("common").alias("k", "c")
    )
    return placed.select("id", "component", "n_shingles", F.col("c.shingle").alias("shingle"), (F.col("alone") + F.col("k")).alias("place"))


def meetings(shingled: DataFrame, members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Where members can meet, see ``places`` and ``sides``."""
    return sides(places(shingled, members), percent)


def sides(placed: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Where members can meet: ``(shingle, class, id, component, n_shingles)``, as the smaller set and as the larger.

    Sets of n <= m shingles reach the threshold with an intersection of at least
    p (n + m) / (100 + p); none of n - i or less can follow the place i of the
    first common shingle. So the smaller set needs to be met only within its
    first n - 2 p n / (100 + p) places, and the larger at place j only by sets of
    n <= (m - j) (100 + p) / p - m shingles.
    """
    p, n = percent, "n_shingles"
    smaller = placed.filter(f"place <= {n} - ceil(2 * {p} * {n} / {100 + p}.0)").withColumn("class", F.expr(_size_class(n)))
    least, most = f"ceil({p} * {n} / 100.0)", f"least({n}, floor(({n} - place) * {100 + p} / {p}.0 - {n} + 1e-6))"
    larger = placed.withColumn("least", F.expr(least)).withColumn("most", F.expr(most)).filter("most >= least AND least > 0")
    larger = larger.withColumn("class", F.explode(F.expr(f"sequence({_size_class('least')}, {_size_class('most')})")))
    columns = ["shingle", "class", "id", "component", "n_shingles"]
    return smaller.select(*columns), larger.select(*columns, "least", "most")


def _across(docs: DataFrame, members: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of members of different components that may reach the threshold; all that do are among them."""
    spark = docs.sparkSession

    def shared() -> list[DataFrame]:
        sets = _member_sets(docs, members.select("id"), size)
        shingled = sets.mapInArrow(giving_back(_shingles), _SHINGLES).join(members.select("id"), "id", "left_semi").distinct()
        return [places(stored(shingled, spark, "shingles"), members)]

    [placed] = stored_alone(shared, spark, "places")
    smaller, larger = (stored(side, spark, "meetings") for side in sides(placed, percent))
    key = ["shingle", "class"]
    # Of each place one component has most members; pairs need an end outside it.
    per_component = smaller.select(*key, "component").unionAll(larger.select(*key, "component")).groupBy(*key, "component").agg(F.count("*").alias("n"))
    top = per_component.groupBy(*key).agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("n_components"))
    top = top.filter("n_components > 1").select(*key, F.col("top.component").alias("top"))
    x, y = (side.join(top, key) for side in (smaller, larger))

    def met(one: DataFrame, other: DataFrame) -> DataFrame:
        one = one.select(*key, *(F.col(c).alias(f"x_{c}") for c in ("id", "component", "n_shingles")))
        other = other.select(*key, *(F.col(c).alias(f"y_{c}") for c in ("id", "component", "n_shingles")), "least", "most")
        fits = "x_n_shingles BETWEEN least AND most AND x_component <> y_component"
        return one.join(other, key).filter(fits).select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b"))

    outside = "component <> top"
    return met(x.filter(outside), y).unionAll(met(x.filter("component = top"), y.filter(outside))).distinct()


def near_duplicates(docs: DataFrame, spark: SparkSession, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. Two documents are
    linked if 100 * intersection >= ``percent`` * union of their shingle sets;
    ``component_id`` is the smallest ``doc_id`` reachable over links.

    Null and empty texts have no shingles, are linked with nothing and kept. A
    text shorter than a shingle is one shingle of its own. Equal texts fall in
    one group whose smallest id stays; repeated rows of one id are one document
    of the graph. A null id never names a group: such a row takes the group of
    its copies, and is kept only where none has an id. Columns besides
    ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    """
    # Whoever calls keeps no more than these rows; each step's tables go as soon as its result is written.
    [groups] = stored_alone(lambda: [_groups(docs, spark, shingle, percent)], spark, "groups")
    return groups


def _groups(docs: DataFrame, spark: SparkSession, shingle: int, percent: int) -> DataFrame:
    signed, classes = stored_alone(lambda: _classes(docs, spark, shingle), spark, "sets", "classes")
    nodes = classes.filter("n_shingles > 0 AND rep IS NOT NULL")
    edges, found, apart = stored_alone(lambda: _first_links(docs, nodes, spark, shingle, percent), spark, "edges", "found", "apart")
    [across] = stored_alone(lambda: [_screened(_across(docs, apart, shingle, percent), nodes, percent / 100)], spark, "across")
    [more] = stored_alone(lambda: [_confirmed(across, docs, shingle, percent)], spark, "more")
    if not more.isEmpty():
        [found] = stored_alone(lambda: [components(edges.unionAll(more), spark)], spark, "all")

    labelled = classes.select("set_a", "set_b", "n_shingles", "rep").join(
        found.select(F.col("id").alias("rep"), "component"), "rep", "left"
    )
    labelled = labelled.select("set_a", "set_b", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    return signed.join(labelled, ["set_a", "set_b", "n_shingles"], "left").select(
        "doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept")
    )


def _classes(docs: DataFrame, spark: SparkSession, size: int) -> list[DataFrame]:
    """The set of each document, and the classes of equal sets with their registers."""
    signed = stored(signatures(docs, size), spark, "signed")
    # A document without shingles is a class of its own, so that such rows do not meet in one task.
    signed = signed.withColumn("set_b", F.expr("if(n_shingles = 0, doc_id, set_b)"))
    classes = signed.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("registers").alias("registers"))
    return [signed.select("doc_id", "set_a", "set_b", "n_shingles"), classes]


def _first_links(docs: DataFrame, nodes: DataFrame, spark: SparkSession, shingle: int, percent: int) -> list[DataFrame]:
    """Links of members with those that lead their bands, their components, and members of bands that lie in several."""
    banded = nodes.select(F.col("rep").alias("id"), "n_shingles", "registers").mapInArrow(giving_back(_banded), _BANDED)
    banded = stored(banded, spark, "banded")
    rows = banded.select("id", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(rows.join(shared, "band"), spark, "members")

    # The member that meets most others leads its band: a text and its edited copies gather at the text.
    weights = members.groupBy("id").agg(F.sum("n").alias("met"))
    looks = banded.select("id", "n_shingles", "lanes").join(weights, "id")
    weighed = members.select("band", "id").join(weights, "id")
    leaders = weighed.groupBy("band").agg(F.max(F.struct("met", (-F.col("id")).alias("id"))).alias("top"))
    led = members.select("band", "id").join(leaders.select("band", (-F.col("top.id")).alias("leader")), "band")
    led = led.filter("id <> leader").select("leader", "id").distinct()
    a, b = (looks.select(F.struct("id", "n_shingles", "lanes").alias(x), F.col("id").alias(k)) for x, k in (("x", "leader"), ("y", "id")))
    looked = led.join(a, "leader").join(b, "id").filter(_lanes_allow("x", "y", percent / 100))
    unlike = F.expr(" + ".join(f"bit_count(x.lanes[{k}] ^ y.lanes[{k}])" for k in range(LANES)))
    # At most one leader per band and document.
    best = looked.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(unlike.alias("unlike"), "leader"))).alias("best"))
    tried = best.select(F.explode(F.slice("best", 1, FIRST_TRIES)).alias("pair"), F.col("id").alias("b"))
    tried = _screened(tried.select(F.col("pair.leader").alias("a"), "b"), nodes, percent / 100)
    edges = stored(_confirmed(stored(tried, spark, "tried"), docs, shingle, percent), spark, "edges")
    found = stored(components(edges, spark), spark, "found")

    # Links between different components: both ends share a band.
    placed = members.select("band", "id").join(banded.select("id", "n_shingles"), "id").join(found, "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    apart = placed.join(mixed.select("band"), "band", "left_semi").select("id", "component", "n_shingles").distinct()
    return [edges, found, apart]
