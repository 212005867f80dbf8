"""Counts of texts against plain Python, and the language model's probabilities."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbmark.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    words = WORD.findall(text)
    lines, dup = Counter(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += lines[line] > 0
            lines[line] += 1
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked))


PARTS = ["a", "b", "ab", " ", "  ", "\n", "\r\n", "\t", "é", "\U0001f600", "#", "|", "\x0b", "\x1c", "a b c d e f "]


@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=40).map("".join), max_size=6))
@settings(max_examples=300, deadline=None)
def test_counts_of_any_texts(texts):
    found = rules.base_counts(pa.array(texts, pa.string()))
    assert [*zip(*(c.tolist() for c in found))] == [expected(t) for t in texts]


def test_documents_match_plain_python(spark, documents):
    model = rules.train(documents)
    rows = {r.doc_id: r for r in rules.judge(documents, model).collect()}
    for d in documents.collect():
        r = rows[d.doc_id]
        n_words, word_chars, n_symbols, n_dup, n_repeat = expected(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            n_words,
            word_chars,
            n_symbols,
            n_dup,
            n_repeat,
        )
        assert r.base_failed == (n_words < 10 or 100 * n_repeat > 20 * n_words)
        assert not (r.kept and r.base_failed)
    judged = [r for r in rows.values() if not r.base_failed]
    assert sum(r.kept for r in judged) > 0.9 * len(judged)


def test_what_a_model_is_made_of_is_worked_out_once(spark, documents):
    texts = documents.selectExpr("text", rules.language_code())
    for made in rules._levels(texts.mapInArrow(rules._count, rules._COUNTED)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Scan parquet" in plan and "Exchange" not in plan and "Aggregate" not in plan


def test_probabilities_after_a_context_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "abracadabra abba cab", "en"), (2, "a bad cab", "en")], "doc_id int, text string, lang string")
    model = rules.train(docs)
    every = np.arange(1 << rules.SYMBOL_BITS, dtype=np.int64)
    salts = np.full(len(every), rules._salt("en"), np.uint64)
    for context in ("abr", " ca", "zzz", "   ", "bzz"):
        begun = 0
        for c in context:
            begun = (begun << rules.SYMBOL_BITS) | ord(c)
        logs = model.log_probabilities((begun << rules.SYMBOL_BITS) | every, salts)
        assert abs(np.exp(logs).sum() - 1) < 0.02


def test_large_models_mix_up_no_ngrams(spark, monkeypatch):
    rng = np.random.default_rng(0)
    letters = np.array([*map(chr, range(0x61, 0x61 + 200))])
    rows = [(k, "".join(letters[rng.integers(0, 200, 150_000)]), lang) for k, lang in enumerate(("aa", "bb"))]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    one = rules.train(docs)
    monkeypatch.setattr(rules, "SHARD_ROWS", 70_000)
    many = rules.train(docs)
    assert len(one.grams.parts) == 1 and len(many.grams.parts) >= 8
    grams, _, _ = rules._grams(pa.array([rows[0][1]]))
    salt = {lang: np.full(len(grams), rules._salt(lang), np.uint64) for lang in ("aa", "bb", "zz")}
    # A language never learned from knows no n-gram, however full the model is.
    assert (one.log_probabilities(grams, salt["zz"]) == -rules.SYMBOL_BITS * np.log(2)).all()
    for lang in ("aa", "bb", "zz"):
        assert (one.log_probabilities(grams, salt[lang]) == many.log_probabilities(grams, salt[lang])).all()
    assert not one.grams.look_up(rules._key(np.setdiff1d(grams, rules._grams(pa.array([rows[1][1]]))[0]), salt["bb"][0], 4))[1].any()
    scores = [{r.doc_id: r.log_perplexity for r in rules.judge(docs, m).collect()} for m in (one, many)]
    assert scores[0] == scores[1]


def test_text_unlike_the_rest_is_rejected(spark, documents):
    rng = np.random.default_rng(0)
    noise = [
        (10**6 + k, " ".join("".join(chr(c) for c in rng.integers(0x3B1, 0x3C9, 7)) for _ in range(80)), "en", "x", 1)
        for k in range(3)
    ]
    mixed = documents.unionAll(spark.createDataFrame(noise, documents.schema))
    kept = {r.doc_id: r.kept for r in rules.judge(mixed).collect()}
    assert not any(kept[10**6 + k] for k in range(3))


def test_bands_reject_what_the_base_rules_keep(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = rules.judge(docs.select("doc_id", "text", "lang"), keep_text=False)
    assert "text" not in judged.columns
    rows = judged.join(labels, "doc_id", "left").filter("NOT base_failed").collect()
    gone = [r for r in rows if not r.kept]
    assert all((r.band_side == 0) == r.kept for r in rows)
    assert 5 < len(gone) < 0.1 * len(rows)
    bad, good = ([r for r in rows if r.quality == q] for q in (0, 1))
    assert sum(not r.kept for r in bad) > 0.1 * len(bad)
    assert sum(not r.kept for r in good) < 0.03 * len(good)


def test_models_that_are_not_broadcast_give_the_same(spark, odd, documents, monkeypatch):
    long = spark.createDataFrame([(10**6, "many words of one text. " * 30_000, "en")], "doc_id long, text string, lang string")
    docs = documents.select("doc_id", "text", "lang").unionAll(odd.select("doc_id", "text", "lang")).unionAll(long)
    columns = ["doc_id", *rules.MEASURES.names[:5], "base_failed", "kept"]

    def found():
        rows = rules.judge(docs).select(*columns, rules.F.round("log_perplexity", 5).alias("p")).collect()
        return Counter(tuple(r) for r in rows)

    broadcast = found()
    monkeypatch.setattr(rules, "BROADCAST_ROWS", 0)
    assert found() == broadcast and broadcast.total() == docs.count()


def test_symbols_of_all_scripts_stay_apart():
    points = [chr(c) for c in (*range(0x900, 0x980), *range(0x4E00, 0x5E00), 0xAC00, 0xFFFD, 0x1F600)]
    symbols, _ = rules._symbols(pa.array(["".join(points)]))
    assert len(set(symbols.tolist())) == len(points) and max(symbols.tolist()) < 1 << rules.SYMBOL_BITS


def test_odd_rows(odd, nothing):
    extra = odd.selectExpr("*", "1 AS N_words", "2 AS kept", "3 AS judged_by", "4 AS gram", "5 AS fine", "6 AS row")
    rows = rules.judge(extra).collect()
    assert len(rows) == 9 and all((r.judged_by, r.gram, r.fine, r.row) == (3, 4, 5, 6) for r in rows)
    by_id = {r.doc_id: r for r in rows}
    for doc_id in (5, 3, 7, 1, 2):
        assert by_id[doc_id].base_failed and not by_id[doc_id].kept
    assert by_id[9].base_failed and not by_id[None].base_failed
    assert rules.judge(nothing).count() == 0


def test_language_codes(spark):
    langs = spark.createDataFrame([("en",), ("EN-us",), ("de_AT",), ("",), (None,), ("english",), ("x",)], "lang string")
    codes = langs.selectExpr(f"{rules.language_code()} AS c").collect()
    assert [r.c for r in codes] == ["en", "en", "de", "und", "und", "und", "und"]
