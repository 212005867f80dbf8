import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ebbmark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, extra string, Conv string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(own):
    """Nodes of the trie of ``own``, a dict of conversation to its turns in order."""
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(rebuilt) + 1):
            members.setdefault(rebuilt[:d], []).append((c, d == len(rebuilt)))
    result = []
    for prefix, there in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        inner = {p[:-1] for p in members if p}
        ends = ",".join(str(c) for c in sorted(c for c, end in there if end))
        result.append(
            (
                min(c for c, _ in there),
                len(prefix),
                min(c for c, _ in members[prefix[:-1]]) if prefix else None,
                len(there),
                sum(len(p) == len(prefix) + 1 for p in below),
                sum(p not in inner for p in below),
                sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(result, key=str)


def nodes(frame):
    return sorted((tuple(row[n] for n in NAMES) for row in prefix_trie.trie(frame).collect()), key=str)


def table(spark, own):
    rows = [(c, t, *turn, "x", "y") for c, turns in own.items() for t, turn in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def small(monkeypatch):
    """Many shards and short blocks on a few rows."""
    monkeypatch.setattr(prefix_trie, "WIDTH", 3)
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", 20)
    monkeypatch.setattr(prefix_trie, "FEWEST_ROWS", 10)


def made(seed, n, longest):
    pick = random.Random(seed)
    texts = [("user", "é"), ("user", "a"), ("bot", "a"), ("", "long text")]
    return {
        c: [pick.choice(texts[: 1 + pick.randrange(4)]) for _ in range(pick.randrange(1, longest))]
        for c in pick.sample(range(-20, 4 * n), n)
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_of_many_shards_and_blocks(spark, small, seed):
    own = made(seed, 50, 16)
    assert nodes(table(spark, own)) == brute(own)


def test_nodes_of_one_shard(spark):
    own = made(3, 40, 12)
    assert nodes(table(spark, own)) == brute(own)


def test_a_common_conversation_and_a_long_one(spark, small):
    own = {c: [("u", "a"), ("b", "b")] for c in range(0, 200, 5)}
    own |= {c: [("u", "a"), ("b", "b"), ("u", "c")] for c in range(1, 60, 5)}
    own |= {1000 + c: [("u", f"{k % 3}") for k in range(40)] for c in (0, 5)}
    own[2000] = [("u", f"{k}") for k in range(60)]
    assert nodes(table(spark, own)) == brute(own)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (5, None, "u", "first", "", ""),
        (5, 2, None, None, "", ""),
        (5, 1, "u", "same", "", ""),
        (5, 1, "u", "same", "", ""),
        (None, 1, "u", "of nobody", "", ""),
        (8, 0, "u", "", None, None),
    ]
    own = {5: [("u", "first"), ("u", "same"), ("u", "same"), ("", "")], 8: [("u", "")]}
    assert nodes(spark.createDataFrame(rows, SCHEMA)) == brute(own)
    # Turns of one number: one order, whatever the order of the rows.
    tied = [(10, 1, "u", t, "", "") for t in "abcdef"]
    assert nodes(spark.createDataFrame(tied, SCHEMA)) == nodes(spark.createDataFrame(tied[::-1], SCHEMA))


def test_no_rows(spark):
    assert nodes(spark.createDataFrame([], SCHEMA)) == []
    assert nodes(spark.createDataFrame([(None, 1, "u", "a", "", "")], SCHEMA)) == []


def test_order_over_shards(spark, small):
    turns = spark.range(100).select(F.lit(1).alias("conv_id"), (99 - F.col("id")).alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    ids = {r.a: r.turn for r in prefix_trie.turn_ids(turns).collect()}
    placed = prefix_trie.in_order(prefix_trie.turn_ids(turns)).collect()
    assert sorted((r.place, ids[r.a]) for r in placed) == [(k + 1, k) for k in range(100)]
