"""Near-duplicate groups against brute force on full shingle sets."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbmark.llm import near_dedup
from ebbmark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingle_set(text, size):
    words = WORD.findall(lowered(text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def roots(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def brute(rows, size, percent):
    sets = {k: shingle_set(t, size) for k, t in rows}
    holders, shared = defaultdict(list), Counter()
    for k, own in sets.items():
        for s in own:
            for other in holders[s]:
                shared[other, k] += 1
            holders[s].append(k)
    edges = [(a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    found = roots(edges, sets)
    return {k: (len(sets[k]), found[k], found[k] == k) for k in sets}


def planted(seed=1):
    """Base texts, stars and chains of near copies, texts that share a passage, short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    rows, k = [], 0

    def add(words):
        nonlocal k
        rows.append((k, " ".join(words)))
        k += 1

    for n in (5, 8, 30, 120, 400):
        base = rng.choices(vocabulary, k=n)
        add(base)
        for edits in (0, 0, 1, 1, 2, 3, 5):
            words = [*base]
            for _ in range(edits):
                words[rng.randrange(n)] = rng.choice(vocabulary)
            add(words)
    chain = rng.choices(vocabulary, k=200)
    for _ in range(12):
        chain[rng.randrange(200)] = rng.choice(vocabulary)
        add(chain)
    for _ in range(40):
        add(rng.choices(vocabulary, k=20) + passage.split() + rng.choices(vocabulary, k=rng.choice((5, 60))))
    for _ in range(30):
        add(rng.choices(vocabulary[:3], k=rng.randrange(1, 6)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "percent"), [(4, 80), (5, 80)])
def test_planted_groups_match_brute_force(spark, size, percent):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_dedup.near_duplicates(docs, spark, size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, size, percent)


def test_documents_match_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = near_dedup.near_duplicates(documents, spark, 4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(rows, 4, 80)


def test_odd_rows(spark, odd, nothing):
    extra = odd.selectExpr("*", "1 AS n_shingles", "2 AS component_id", "3 AS band", "4 AS rep")
    found = near_dedup.near_duplicates(extra, spark).collect()
    assert len(found) == 9
    by_id = defaultdict(list)
    for r in found:
        by_id[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert by_id[5] == [(0, 5, True)] and by_id[3] == [(0, 3, True)] and by_id[7] == [(0, 7, True)]
    assert by_id[2] == [(1, 2, True)] * 2 and len(by_id[9]) == 2
    assert by_id[None] == [(7, None, True)]
    assert near_dedup.near_duplicates(nothing, spark).count() == 0


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=25))
@settings(max_examples=4, deadline=None)
def test_components_of_random_graphs(spark, edges):
    frame = spark.createDataFrame(edges or [(1, 1)], "a bigint, b bigint")
    found = {r.id: r.component for r in components(frame, spark).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert found == roots([(a, b) for a, b in edges if a != b], nodes)


def test_components_of_a_long_path(spark):
    order = list(range(60))
    random.Random(3).shuffle(order)
    frame = spark.createDataFrame([*zip(order, order[1:])], "a bigint, b bigint")
    assert {r.component for r in components(frame, spark).collect()} == {0}


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(0)
    errors = []
    for overlap in (0.2, 0.5, 0.8, 0.95):
        for n in (50, 400, 5000):
            both = int(n * overlap)
            keys = rng.integers(0, 2**64, 2 * n - both, dtype=np.uint64)
            sets = [np.unique(keys[:n]), np.unique(keys[n - both :])]
            lines = [near_dedup.registers_of(s, np.zeros(len(s), int), 1) for s in sets]
            sizes = [np.array([len(s)]) for s in sets]
            like, used = near_dedup.estimate(*lines, *sizes)
            truth = both / (2 * n - both)
            errors.append(abs(like[0] - truth) / np.sqrt(0.25 / used[0]))
    assert max(errors) < 4


def test_unrelated_registers_meet_as_often_as_predicted():
    rng = np.random.default_rng(1)
    n = 2000
    lines = [
        near_dedup.registers_of(np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)), np.zeros(n, int), 1)[0]
        for _ in range(60)
    ]
    met = np.mean([(a == b).mean() for i, a in enumerate(lines) for b in lines[:i]])
    assert met == pytest.approx(near_dedup.chance_of_equal(np.array([n]), np.array([n]))[0], rel=0.25)


def test_borrowed_registers_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(2)
    agreed = []
    for _ in range(200):
        keys = rng.integers(0, 2**64, 10, dtype=np.uint64)
        left, right = (
            near_dedup.filled(near_dedup.registers_of(np.sort(k), np.zeros(len(k), int), 1)) for k in (keys[:9], keys[1:])
        )
        agreed.append((left == right).mean())
    assert np.mean(agreed) == pytest.approx(0.8, abs=0.03)


def test_words_end_at_the_white_space_named():
    texts = pa.array(["a\x0bb c A", "a b c\na"])
    keys, rows = near_dedup.shingle_sets(texts, 2)
    assert set(keys[rows == 0]) == set(keys[rows == 1]) and len(keys) == 4


def test_members_that_stay_apart_meet_nowhere(spark):
    """Copies with too many shingles of their own to be linked, a few that are, sets of unlike sizes."""
    rng = random.Random(5)
    body = list(range(400))
    sets = {k: [*body[:340], *range(10_000 + 100 * k, 10_060 + 100 * k)] for k in range(120)}
    sets |= {1000 + k: rng.sample(body, 390) for k in range(6)}
    sets |= {2000 + k: body[: 250 + 20 * k] for k in range(8)}
    sets |= {3000 + k: [50_000 + j for j in range(k + 1)] for k in range(12)}
    members = spark.createDataFrame([(k, k % 3 if k >= 1000 else k, len(s)) for k, s in sets.items()], "id long, component long, n_shingles long")
    shingled = spark.createDataFrame([(k, x) for k, s in sets.items() for x in s], "id long, shingle long")
    smaller, larger = near_dedup.meetings(shingled, members, 80)
    held = smaller.select("shingle", "class", "id").withColumnRenamed("id", "a")
    met = held.join(larger.select("shingle", "class", "id", "least", "most"), ["shingle", "class"])
    found = {tuple(sorted((r.a, r.id))) for r in met.select("a", "id").distinct().collect() if r.a != r.id}
    wanted = set()
    for a, x in sets.items():
        for b, y in sets.items():
            both = len({*x} & {*y})
            if a < b and 100 * both >= 80 * (len(x) + len(y) - both):
                wanted.add((a, b))
    assert wanted and wanted <= found and len(found) < 4 * len(wanted)


def test_groups_leave_no_more_than_their_rows(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("ebbmark-*"))
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (2, text), (3, f"{text} more"), (4, "something else"), (None, text), (5, None)]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), spark)
    left = set(shared.glob("ebbmark-*")) - before
    assert len(left) == 1 and "-groups-" in left.pop().name
    groups = {r.doc_id: r.component_id for r in found.collect()}
    assert groups == {1: 1, 2: 1, 3: 1, 4: 4, None: 1, 5: 5}
