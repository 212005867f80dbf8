"""Fingerprints and likeness against plain Python."""

import hashlib
import random
import re

import pytest

from ebbmark.llm import fingerprints

PARAGRAPH = re.compile(fingerprints.PARAGRAPH)


def paragraphs(text):
    return {p.strip(" ") for p in PARAGRAPH.findall(text)} - {""}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    ordered = sorted((i, t or "") for i, t in rows if i is not None)
    for k, (doc_id, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        m = len(text) // 4
        edited = text[: len(text) - m] + after[:m]
        yield doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(text, edited), likeness(text, after)


def check(rows, found):
    wanted = sorted(expected(rows))
    got = sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in found if r.doc_id is not None)
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    for g, w in zip(got, wanted):
        assert g[3:] == pytest.approx(w[3:]), g[0]


def test_documents_match_plain_python(spark, documents):
    check([(r.doc_id, r.text) for r in documents.collect()], fingerprints.compare(documents).collect())


def test_long_texts_ties_and_gaps(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(-(10**12), 10**12), " ".join(f"s{rng.randrange(500)} x{k}." for k in range(n))) for n in (0, 1, 3, 40, 2500)]
    rows += [(7, "same. "), (7, "same. "), (7, "other one."), (8, None), (9, "é" * 450), (10, "é" * 450)]
    found = fingerprints.compare(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    check(rows, found)
    prints = {}
    for r, text in ((r, r.fingerprint) for r in found):
        prints.setdefault(text, set()).add(r.doc_id)
    assert {9, 10} in prints.values()


def test_one_document_is_its_own_next(spark):
    rows = [(4, "One. Two. Three. Four.")]
    found = fingerprints.compare(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    check(rows, found)
    assert found[0].near_next == 1.0


def test_sketches_alone_tell_small_differences(spark):
    base = [f"sentence number {k}." for k in range(60)]
    rows = [(0, " ".join(base)), (1, " ".join(base[:57] + ["new."])), (2, "unlike. " + " ".join(f"z{k}." for k in range(60)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    prints = fingerprints.compare(docs).select("doc_id", "fingerprint")
    rows = [(a.doc_id, b.doc_id, a.fingerprint, b.fingerprint) for a in prints.collect() for b in prints.collect()]
    pairs = spark.createDataFrame(rows, "a int, b int, one string, other string")
    found = pairs.selectExpr("a", "b", f"{fingerprints.recovered('one', 'other')} AS n").collect()
    differ = {(r.a, r.b): r.n for r in found}
    assert differ[0, 0] == 0 and differ[0, 1] == differ[1, 0] == 4 and differ[0, 2] is None


def test_stuck_sketches_are_retried_larger(spark):
    for n in (0, 1, 10, 40, 150):
        values = spark.range(n).selectExpr(f"{fingerprints._checked('shiftleft(xxhash64(id) & 1099511627775L, 24)')} AS d")
        held = values.selectExpr("coalesce(collect_list(d), array()) AS d")
        assert held.selectExpr(f"{fingerprints.differing('d')} AS n").first().n == n
        doubled = held.selectExpr("concat(d, slice(d, 1, 7)) AS d")
        assert doubled.selectExpr(f"{fingerprints.differing('d')} AS n").first().n == max(n - 7, 0)


def test_no_python_in_the_plan(documents):
    plan = fingerprints.compare(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_odd_rows(spark, odd, nothing):
    extra = odd.selectExpr("*", "1 AS range", "2 AS place", "3 AS digests", "4 AS guest")
    found = fingerprints.compare(extra).collect()
    assert len(found) == 9
    check([(r.doc_id, r.text) for r in odd.collect()], found)
    without_id = next(r for r in found if r.doc_id is None)
    text = next(r.text for r in odd.collect() if r.doc_id is None)
    assert without_id.edited_sha256 == hashlib.sha256(text[: len(text) - len(text) // 4].encode()).hexdigest()
    assert fingerprints.compare(nothing).count() == 0
    nulls = spark.createDataFrame([(None, "a"), (None, None)], "doc_id bigint, text string")
    assert fingerprints.compare(nulls).count() == 2


def test_peeling_places_a_digest_once():
    # Places are hashed per group for the digest taken out, not for every cell it is held against.
    per_step = fingerprints.peeled("cells", fingerprints.GROUP_CELLS).split("c ^")[0].split("(c, i) ->")[1]
    assert "xxhash64" not in per_step
