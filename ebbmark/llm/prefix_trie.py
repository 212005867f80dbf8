"""The trie of the prefixes that conversations share.

A turn is two 64-bit hashes of its role and text; texts are not moved.
Conversations are cut into blocks of ``WIDTH`` turns. The blocks of one level,
each headed by a hash of all turns before it, are dealt by range into shards. A
shard lays its blocks out as a padded matrix of turn ids, sorts it with
``lexsort`` and ORs the masks of changed columns from left to right: a mark is
the first row of a node. ``reduceat`` over the marks of every depth gives the
counts, from the deepest up. Only the nodes of a shard's first and last row can
go on in another shard; their parts, at most two per depth and shard, are
combined apart. Levels follow one another from the deepest that conversations
share, so that what lies below a block's end is known; blocks that a single
conversation reaches need no level.

No step holds a conversation whole: turns are numbered within range shards,
which are then linked by the counts of the conversations that cross them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbmark.llm.arrays import mix, stored

# Turns of a block, rows of a shard, fewest rows where there are many shards anyway.
WIDTH = 32
SHARD_ROWS, FEWEST_ROWS = 20_000, 500
# Conversation ids in one piece of a list of ends.
PIECE = 512
HEAD = 8
NO_ENDS = hashlib.sha256(b"").hexdigest()
# Sorts before every id: the first hash of an id is odd.
PAD = np.iinfo(np.int64).min

_KEY = ["p1", "p2", "depth", "k1", "k2"]
_PART = (
    "kind int, shard int, side int, depth int, p1 long, p2 long, k1 long, k2 long, up1 long, up2 long, parent_side int, "
    "parent_conv_id long, conv_id long, n_convs long, bytes long, n_children long, n_leaves long, saved long, "
    "below_children long, below_leaves long, below_saved long, ends string, path array<struct<depth:int,k1:long,k2:long>>"
)
NODE, EDGE, ENDS = 0, 1, 2


def _shards(frame: DataFrame, rows: int) -> int:
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // SHARD_ROWS), min(partitions, -(-rows // FEWEST_ROWS)))


def turn_ids(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, a, b, n`` of every row with a conversation: two hashes of role and text, bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).bitwiseOR(F.lit(1)).alias("a"),
        F.xxhash64(F.lit("second"), text, role).alias("b"),
        F.octet_length(text).cast("bigint").alias("n"),
    )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of rows within their conversation and shard; rows come sorted."""
    shard, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids = batch.column("conv_id").to_numpy()
        if not len(ids):
            continue
        fresh = np.ones(len(ids), bool)
        fresh[1:] = ids[1:] != ids[:-1]
        starts = np.flatnonzero(fresh)
        place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids)))) + 1
        if ids[0] == last:
            end = starts[1] if len(starts) > 1 else len(ids)
            place[:end] += count
        last, count = ids[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), shard, np.int32)), *(batch.column(c) for c in ("conv_id", "a", "b", "n")), pa.array(place.astype(np.int64))],
            ["shard", "conv_id", "a", "b", "n", "place"],
        )


def in_order(turns: DataFrame) -> DataFrame:
    """``conv_id, place, a, b, n``: places from 1 by turn (null first), then by the hashes.

    However many rows one conversation has, they are spread over shards.
    """
    spark = turns.sparkSession
    turns = stored(turns, spark, "turns").withColumn("row", F.monotonically_increasing_id())
    shards = _shards(turns, turns.count())
    order = ["conv_id", F.asc_nulls_first("turn"), "a", "b", "row"]
    dealt = turns.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    local = stored(dealt.mapInArrow(_numbered, "shard int, conv_id long, a long, b long, n long, place long"), spark, "places")
    # At most the first and the last conversation of a shard cross its bounds.
    ends = local.groupBy("conv_id", "shard").agg(F.max("place").alias("n_there"))
    crossing = ends.groupBy("conv_id").agg(F.count("*").alias("n_shards"), F.collect_list(F.struct("shard", "n_there")).alias("parts"))
    crossing = crossing.filter("n_shards > 1").select("conv_id", F.explode("parts").alias("part")).select("conv_id", "part.*")
    before = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = crossing.select("conv_id", "shard", F.coalesce(F.sum("n_there").over(before), F.lit(0)).alias("before"))
    # Two rows per shard at most.
    placed = local.join(F.broadcast(offsets), ["conv_id", "shard"], "left")
    return placed.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "a", "b", "n")


def rebuild(ordered: DataFrame) -> DataFrame:
    """Every conversation with the head of another in place of its own.

    The first h turns come from the largest multiple of 5 up to c, h being the unsigned
    crc32 of c's decimal text modulo 9; c's own turns after its first h follow.
    Blocks of at most ``WIDTH`` turns: ``conv_id, block, turns``; a conversation
    without turns has one block without any.
    """
    head = F.sort_array(F.collect_list(F.struct("place", "a", "b", "n")))
    heads = ordered.filter(F.col("place") <= HEAD).groupBy("conv_id").agg(head.alias("head"))
    wanted = heads.select("conv_id", F.expr("conv_id - pmod(conv_id, 5)").alias("other"), (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int").alias("h"))
    others = heads.select(F.col("conv_id").alias("other"), "head")
    none = F.array().cast("array<struct<place:bigint,a:bigint,b:bigint,n:bigint>>")
    taken = wanted.join(others, "other", "left").select("conv_id", "h", F.slice(F.coalesce("head", none), F.lit(1), F.col("h")).alias("head"))
    lent = taken.select("conv_id", F.explode_outer("head").alias("t")).select("conv_id", "t.place", "t.a", "t.b", "t.n")
    own = (
        ordered.join(taken.select("conv_id", "h", F.size("head").alias("n_lent")), "conv_id")
        .filter("place > h")
        .select("conv_id", (F.col("place") - F.col("h") + F.col("n_lent")).alias("place"), "a", "b", "n")
    )
    turn = F.when(F.col("place").isNotNull(), F.struct("place", "a", "b", "n"))
    block = F.coalesce(F.expr(f"(place - 1) div {WIDTH}"), F.lit(0)).alias("block")
    return lent.unionByName(own).groupBy("conv_id", block).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def _hash_of(turns: Column, salt: int) -> Column:
    return F.aggregate(turns, F.lit(0).cast("bigint"), lambda acc, t: acc.bitwiseXOR(F.xxhash64(F.lit(salt), t["place"], t["a"], t["b"])))


def _prefixed(blocks: DataFrame) -> DataFrame:
    """Blocks with hashes of all turns before them (``p1, p2``) and up to their end (``q1, q2``), and whether ``more`` follow."""
    own = blocks.withColumn("x1", _hash_of(F.col("turns"), 1)).withColumn("x2", _hash_of(F.col("turns"), 2))
    along = Window.partitionBy("conv_id").orderBy("block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    prefixed = own.withColumn("p1", F.coalesce(F.bit_xor("x1").over(before), F.lit(0))).withColumn("p2", F.coalesce(F.bit_xor("x2").over(before), F.lit(0)))
    for q, p, x in (("q1", "p1", "x1"), ("q2", "p2", "x2")):
        prefixed = prefixed.withColumn(q, F.col(p).bitwiseXOR(F.col(x)))
    return prefixed.withColumn("more", F.lead("block").over(along).isNotNull()).drop("x1", "x2")


def _matrix(lengths: np.ndarray, values: np.ndarray, width: int, pad: int) -> np.ndarray:
    matrix = np.full((len(lengths), width), pad, np.int64)
    matrix[np.arange(width)[None, :] < lengths[:, None]] = values
    return matrix


def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the prefixes of one row: lengths 0 to all, two lanes."""
    a, b, at = a.astype(np.uint64), b.astype(np.uint64), np.arange(1, len(a) + 1, dtype=np.uint64)
    keys = np.zeros((len(a) + 1, 2), np.uint64)
    keys[1:, 0] = np.bitwise_xor.accumulate(mix(a ^ mix(b ^ mix(at, 1), 2), 3))
    keys[1:, 1] = np.bitwise_xor.accumulate(mix(b ^ mix(a ^ mix(at, 4), 5), 6))
    return keys.astype(np.int64)


class _Rows:
    """Result rows of a shard, column by column."""

    NAMES = [c.split(" ")[0] for c in _PART.split(", ")[:-1]] + ["path"]

    def __init__(self, shard: int):
        self.shard, self.parts = shard, []

    def add(self, n: int, **columns) -> None:
        columns |= {"shard": self.shard}
        arrays = []
        for field in _ARROW:
            value = columns.get(field.name)
            if isinstance(value, (np.ndarray, list)):
                arrays.append(pa.array(value, field.type))
            else:
                arrays.append(pa.array([value], field.type).take(pa.array(np.zeros(n, np.int32))))
        self.parts.append(pa.RecordBatch.from_arrays(arrays, schema=_ARROW))


_ARROW = pa.schema(
    [(c.split(" ")[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split(" ")[1]]) for c in _PART.split(", ")[:-1]]
    + [("path", pa.list_(pa.struct([("depth", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64())])))]
)


def _shard_nodes(table: pa.Table, shard: int) -> list[pa.RecordBatch]:
    """Whole nodes of a shard, the parts of those at its edges, and pieces of the latter's ends."""
    conv, p1, p2 = (table[c].to_numpy() for c in ("conv_id", "p1", "p2"))
    more = table["more"].to_numpy(zero_copy_only=False)
    below = {c: table[c].to_numpy() for c in ("below_children", "below_leaves", "below_saved")}
    turns = table["turns"].combine_chunks()
    lengths = np.diff(turns.offsets.to_numpy())
    flat = turns.flatten()
    width, n_rows = int(lengths.max(initial=0)), len(conv)
    lanes = {c: _matrix(lengths, flat.field(c).to_numpy(zero_copy_only=False), width, pad) for c, pad in (("a", PAD), ("b", PAD), ("n", 0))}
    columns = [x for d in range(width) for x in (lanes["a"][:, d], lanes["b"][:, d])]
    order = np.lexsort([conv, *reversed([p1, p2, *columns])])
    conv, p1, p2, more, lengths = conv[order], p1[order], p2[order], more[order], lengths[order]
    below = {c: v[order] for c, v in below.items()}
    a, b, n_bytes = (lanes[c][order] for c in "abn")

    changed = np.ones((n_rows, width + 1), bool)
    changed[1:, 0] = (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])
    changed[1:, 1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    starts = np.logical_or.accumulate(changed, axis=1)
    rows = _Rows(shard)
    leaf_sums, saved_sums = np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64)
    at = [np.flatnonzero(starts[:, d]) for d in range(width + 1)]
    keys = {1: _keys(a[0, : lengths[0]], b[0, : lengths[0]]), 2: _keys(a[-1, : lengths[-1]], b[-1, : lengths[-1]])}
    smallest = [np.minimum.reduceat(conv, at[d]) for d in range(width + 1)]

    for d in range(width, -1, -1):
        idx = at[d]
        there = lengths[idx] >= d
        n = np.diff(np.append(idx, n_rows))
        edge = np.zeros(len(idx), bool)
        edge[[0, -1]] = True
        whole = there & ~edge
        children = np.zeros(len(idx), np.int64)
        if d < width:
            children = np.add.reduceat((starts[:, d + 1] & (lengths > d)).astype(np.int64), idx)
            # Children at the shard's edges are counted when their parts are combined.
            if lengths[0] > d:
                children[0] -= 1
            if lengths[-1] > d and len(at[d + 1]) > 1:
                children[-1] -= 1
        # What lies below the end of a block, where conversations go on: alike in all rows of the node.
        beneath = {c: np.maximum.reduceat(np.where(more & (lengths == d), v, 0), idx) for c, v in below.items()}
        children[whole] += beneath["below_children"][whole]
        size = n_bytes[idx, d - 1] if d else np.zeros(len(idx), np.int64)
        leaf_sums[idx] += np.where(whole, beneath["below_leaves"] + (children == 0), 0)
        saved_sums[idx] += np.where(whole, beneath["below_saved"] + (n - 1) * size, 0)
        leaves, saved = np.add.reduceat(leaf_sums, idx), np.add.reduceat(saved_sums, idx)

        ending = (lengths == d) & ~more
        n_ends = np.add.reduceat(ending.astype(np.int64), idx)
        if whole.any():
            chosen = np.flatnonzero(whole)
            texts = np.full(len(chosen), NO_ENDS, object)
            for k in np.flatnonzero(n_ends[chosen]):
                first, last = idx[chosen[k]], idx[chosen[k]] + n[chosen[k]]
                ids = conv[first:last][ending[first:last]]
                texts[k] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
            if d:
                parent = np.searchsorted(at[d - 1], idx[chosen], "right") - 1
                side = np.where(parent == 0, 1, np.where(parent == len(at[d - 1]) - 1, 2, 0))
                parent_conv = smallest[d - 1][parent]
            else:
                side, parent_conv = np.zeros(len(chosen), np.int32), np.zeros(len(chosen), np.int64)
            rows.add(
                len(chosen), kind=NODE, depth=d, p1=p1[idx[chosen]], p2=p2[idx[chosen]], parent_side=side.astype(np.int32),
                parent_conv_id=parent_conv, conv_id=smallest[d][chosen], n_convs=n[chosen], n_children=children[chosen],
                n_leaves=leaves[chosen], saved=saved[chosen], ends=list(texts),
            )
        for side, g in ((1, 0), (2, len(idx) - 1)):
            if not there[g] or (side == 2 and g == 0):
                continue
            key, path = keys[side][d], [{"depth": i, "k1": int(x), "k2": int(y)} for i, (x, y) in enumerate(keys[side][: d + 1])]
            up = keys[side][d - 1] if d else (None, None)
            name = dict(depth=d, side=side, p1=int(p1[idx[g]]), p2=int(p2[idx[g]]), k1=int(key[0]), k2=int(key[1]))
            rows.add(
                1, kind=EDGE, **name, up1=None if up[0] is None else int(up[0]), up2=None if up[1] is None else int(up[1]),
                conv_id=int(smallest[d][g]), n_convs=int(n[g]), bytes=int(size[g]), n_children=int(children[g]), n_leaves=int(leaves[g]),
                saved=int(saved[g]), **{c: int(v[g]) for c, v in beneath.items()}, path=[path],
            )
            ids = conv[idx[g] : idx[g] + n[g]][ending[idx[g] : idx[g] + n[g]]].tolist()
            for k in range(0, len(ids), PIECE):
                rows.add(1, kind=ENDS, **name, conv_id=ids[k], ends=",".join(map(str, ids[k : k + PIECE])))
    return rows.parts


def _nodes_of_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [batch for batch in batches if batch.num_rows]
    if parts:
        yield from _shard_nodes(pa.Table.from_batches(parts), TaskContext.get().partitionId())


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of every node, which come sorted; one running digest at a time."""
    now, digest, done = None, None, []

    def out(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [*_KEY, "digest"])

    for batch in batches:
        for *key, piece in zip(*(batch.column(c).to_pylist() for c in [*_KEY, "ends"]), strict=True):
            if key != now:
                if digest:
                    done.append((*now, digest.hexdigest()))
                now, digest = key, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if done:
            yield out(done)
            done = []
    if digest:
        yield out([(*now, digest.hexdigest())])


def _level(blocks: DataFrame) -> DataFrame:
    """All nodes of the blocks of one level, those at depth 0 (the blocks' heads) too.

    Gives ``p1, p2, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved, ends``, the depth counted from the head.
    """
    spark = blocks.sparkSession
    blocks = stored(blocks, spark, "level")
    shards = _shards(blocks, blocks.count())
    # Equal conversations are dealt on by their ids.
    dealt = blocks.repartitionByRange(shards, "p1", "p2", F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"))), "conv_id")
    parts = stored(dealt.mapInArrow(_nodes_of_shards, _PART), spark, "nodes")

    edges = parts.filter(F.col("kind") == EDGE)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    same = [F.max(c).alias(c) for c in ("bytes", "below_children", "below_leaves", "below_saved", "up1", "up2")]
    joined = edges.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), *sums, *same, F.first("path").alias("path"))
    joined = stored(joined, spark, "edges")
    up = ["p1", "p2", (F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2")]
    kids = joined.filter("depth > 0").groupBy(*up).agg(F.count("*").alias("kids"))
    counted = joined.join(kids, _KEY, "left").withColumn("n_children", F.expr("n_children + coalesce(kids, 0) + below_children"))
    own = counted.select(
        "p1",
        "p2",
        F.explode("path").alias("over"),
        F.expr("below_leaves + CAST(n_children = 0 AS BIGINT)").alias("own_leaves"),
        F.expr("below_saved + (n_convs - 1) * bytes").alias("own_saved"),
    ).select("p1", "p2", "over.*", "own_leaves", "own_saved")
    beneath = own.groupBy(*_KEY).agg(F.sum("own_leaves").alias("more_leaves"), F.sum("own_saved").alias("more_saved"))
    pieces = parts.filter(F.col("kind") == ENDS).select(*_KEY, "conv_id", "ends")
    sorted_pieces = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "conv_id").drop("conv_id")
    digests = sorted_pieces.mapInArrow(_digests, "p1 long, p2 long, depth int, k1 long, k2 long, digest string")
    parents = joined.select("p1", "p2", (F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    at_edges = (
        counted.join(beneath, _KEY)
        .join(digests, _KEY, "left")
        .join(parents, ["p1", "p2", "depth", "up1", "up2"], "left")
        .select(
            "p1", "p2", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children",
            F.expr("n_leaves + more_leaves").alias("n_leaves"), F.expr("saved + more_saved").alias("saved"),
            F.coalesce("digest", F.lit(NO_ENDS)).alias("ends"),
        )
    )
    # The parent of a whole node may lie at its shard's edge; one row per shard, side and depth.
    edge_convs = edges.select(*_KEY, "shard", "side").join(joined.select(*_KEY, F.col("conv_id").alias("edge_conv_id")), _KEY)
    edge_convs = edge_convs.select("shard", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), "edge_conv_id")
    inside = parts.filter(F.col("kind") == NODE).join(edge_convs, ["shard", "parent_side", "depth"], "left")
    inside = inside.select(
        "p1", "p2", "depth", "conv_id", F.coalesce("edge_conv_id", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved", "ends"
    )
    return inside.unionByName(at_edges)


def _result(nodes: DataFrame, level: int) -> DataFrame:
    return nodes.select(
        "conv_id",
        (F.col("depth") + level * WIDTH).cast("bigint").alias("depth"),
        F.expr("CASE WHEN depth > 0 THEN parent_conv_id END").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def _with_below(blocks: DataFrame, heads: DataFrame | None) -> DataFrame:
    """Blocks with what lies below their ends; a block that one conversation alone goes on from has one leaf there."""
    more = F.col("more")
    if heads is None:
        one = more.cast("bigint")
        below = [one.alias("below_children"), one.alias("below_leaves"), F.lit(0).cast("bigint").alias("below_saved")]
        return blocks.select("conv_id", "p1", "p2", "turns", "more", *below)
    heads = heads.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), "n_children", "n_leaves", "saved")
    joined = blocks.join(heads, ["q1", "q2"], "left")
    alone = F.when(more, 1).otherwise(0).cast("bigint")
    below = [
        F.coalesce("n_children", alone).alias("below_children"),
        F.coalesce("n_leaves", alone).alias("below_leaves"),
        F.coalesce("saved", F.lit(0)).alias("below_saved"),
    ]
    return joined.select("conv_id", "p1", "p2", "turns", "more", *below)


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (``rebuild``).

    ``conversations`` has ``conv_id, turn, role, text``. A node is a distinct
    sequence of a conversation's first ``depth`` turns; its members are the
    conversations that start with it. Gives ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``, as longs and a text.

    Rows without a conv_id are left out; a null role or text is an empty one, a
    null turn comes first; turns of one number are ordered by hashes of role and
    text; repeated rows are turns of their own; other columns are not read; an
    empty table gives no rows, not even a root.
    """
    spark = conversations.sparkSession
    blocks = stored(rebuild(in_order(turn_ids(conversations))), spark, "blocks")
    deepest = blocks.agg(F.max("block")).first()[0]
    if not deepest:
        zero = F.lit(0).cast("bigint")
        blocks = blocks.select("conv_id", "turns", zero.alias("p1"), zero.alias("p2"), F.lit(False).alias("more"))
        return _result(_level(_with_below(blocks, None)), 0)

    blocks = stored(_prefixed(blocks), spark, "prefixed")
    sharing = blocks.filter("block > 0").groupBy("block", "p1", "p2").agg(F.count("*").alias("n_there")).filter("n_there > 1")
    sharing = stored(sharing.drop("n_there"), spark, "sharing")
    levels = sharing.agg(F.max("block")).first()[0] or 0
    # The node at the end of a full block has those as members too that end there.
    full = blocks.filter(F.size("turns") == WIDTH)
    parents = full.groupBy((F.col("block") + 1).alias("block"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.min("conv_id").alias("head_conv_id"))
    parents = stored(parents, spark, "parents")
    heads, results = None, []
    for level in range(levels, -1, -1):
        rows = blocks.filter(F.col("block") == level)
        if level:
            rows = rows.join(sharing, ["block", "p1", "p2"], "left_semi")
        nodes = stored(_level(_with_below(rows, heads)), spark, "trie")
        if level:
            heads = nodes.filter("depth = 0")
            first = parents.filter(F.col("block") == level).select("p1", "p2", F.lit(1).alias("depth"), "head_conv_id")
            nodes = nodes.filter("depth > 0").join(first, ["p1", "p2", "depth"], "left")
            nodes = nodes.withColumn("parent_conv_id", F.coalesce("head_conv_id", "parent_conv_id"))
        results.append(_result(nodes, level))
    # Turns that a single conversation has: one member, one leaf, nothing saved.
    alone = blocks.filter("block > 0").join(sharing, ["block", "p1", "p2"], "left_anti")
    alone = alone.join(parents, ["block", "p1", "p2"])
    last = F.expr(f"NOT more AND t.place = {WIDTH} * block + size(turns)")
    one = F.lit(1).cast("bigint")
    single = alone.select("conv_id", "head_conv_id", "more", "block", "turns", F.explode("turns").alias("t")).select(
        "conv_id",
        F.col("t.place").alias("depth"),
        F.expr(f"CASE WHEN t.place = {WIDTH} * block + 1 THEN head_conv_id ELSE conv_id END").alias("parent_conv_id"),
        one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"),
        one.alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(NO_ENDS).alias("ends_sha256"),
    )
    for nodes in results:
        single = single.unionByName(nodes)
    return single
