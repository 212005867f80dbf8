"""Held-out accuracy of the quality classifier and of language id."""

import random
import zlib

import pytest

from ebbmark.llm import language_id, quality_classifier
from ebbmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    found = QUERIES["op3_quality_classifier"](spark, SF)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert len(rows) > 80 and right > 0.95
    assert all(0 <= r.score <= 1 for r in found.collect())


def test_labels_of_the_held_out_third_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", f"IF({quality_classifier.held_out()}, 1 - quality, quality) AS quality"
    )
    assert quality_classifier.model_from(docs, labels) == quality_classifier.model_from(docs, turned)


def test_quality_of_odd_rows(spark, odd, nothing, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality_classifier.model_from(documents, labels)
    rows = quality_classifier.score(odd.selectExpr("*", "7 AS Score", "8 AS place"), model).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[5] == scores[3]
    assert [r.score for r in rows if r.doc_id == 9] == [scores[9]] * 2
    assert quality_classifier.score(nothing, model).count() == 0
    with pytest.warns(UserWarning, match="no text to learn from"):
        assert quality_classifier.model_from(nothing, labels) is None
    assert {r.score for r in quality_classifier.score(odd, None).collect()} == {0.5}


def learned(spark, rows):
    """A model from texts and labels; ids that are not held out."""
    free = [i for i in range(10 * len(rows) + 10) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([(i, text) for i, (text, _) in zip(free, rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, (_, label) in zip(free, rows)], "doc_id long, quality int")
    return quality_classifier.model_from(docs, labels)


def test_copies_do_not_fill_the_sample(spark, monkeypatch):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    good = [(" ".join(words[(k * 7 + j * (1 + k % 3)) % 10] for j in range(30)), 1) for k in range(60)]
    bad = [("$$ ## " * (k % 9 + 2) + f"%% {k} &&", 0) for k in range(60)]
    monkeypatch.setattr(quality_classifier, "TRAINING_TEXTS", 50)
    plain = learned(spark, good + bad)
    # A third of a label's rows is one text: it counts once.
    copies = learned(spark, good + bad + [good[0]] * 300 + [bad[0]] * 300)
    assert plain == copies


def test_long_texts_are_learned_from_by_passages(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "TRAINING_CHARS", 200)
    pick = random.Random(1)
    vocabulary = {label: ["".join(pick.choices(letters, k=6)) for _ in range(40)] for label, letters in ((1, "aeinrst"), (0, "#$%&*xq"))}
    texts = [(" ".join(pick.choices(vocabulary[label], k=120)), label) for label in (1, 0) for _ in range(20)]
    good, bad = texts[:20], texts[20:]
    model = learned(spark, good + bad)
    docs = spark.createDataFrame(good + bad, "text string, label int")
    assert all((r.score >= 0.5) == r.label for r in quality_classifier.score(docs, model).collect())


def test_uniform_training_texts_still_make_a_model(spark):
    model = learned(spark, [("same text", 1)] * 3 + [("### *** !!!", 0)] * 3)
    docs = spark.createDataFrame([("same text",), ("### *** !!!",)], "text string")
    good, bad = (r.score for r in quality_classifier.score(docs, model).collect())
    assert good > bad


def test_language_on_held_out_documents(spark):
    found = QUERIES["op10_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").filter("held_out").collect()
    right = sum(r.lang_pred == r.lang for r in rows) / len(rows)
    assert len(rows) > 150 and right > 0.97


def test_language_of_odd_rows(spark, odd, nothing, documents):
    model = language_id.train(documents)
    rows = language_id.identify(odd.selectExpr("*", "7 AS score", "8 AS lang_pred"), model).collect()
    assert len(rows) == 9
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert by_id[5] == by_id[3] == by_id[7] == ("und", 0.0)
    assert by_id[9][0] == "en" and by_id[1][0] != "und"
    assert all(0 <= r.score <= 1 for r in rows)
    assert language_id.identify(nothing, model).count() == 0
    assert language_id.train(nothing) is None
    assert {r.lang_pred for r in language_id.identify(odd, None).collect()} == {"und"}


def test_one_language_and_one_family(spark):
    rows = [("the cat and the dog and the bird", "en"), ("der hund und die katze und der vogel", "de")]
    docs = spark.createDataFrame(rows * 3, "text string, lang string")
    both = language_id.identify(docs.select("text"), language_id.train(docs)).collect()
    assert {(r.text, r.lang_pred) for r in both} == set(rows)
    only = language_id.identify(docs.select("text"), language_id.train(docs.filter("lang = 'en'"))).collect()
    assert {r.lang_pred for r in only} == {"en"}
