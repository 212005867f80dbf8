"""Licence notices in texts."""

import random

from ebbmark.llm import license_scan as scan

KNOWN = scan.Templates.of(scan.TEMPLATES)


def names(text):
    return [hit[0] for hit in scan.find([text], KNOWN)[0]]


def test_every_template_is_found_wherever_it_stands():
    rng = random.Random(0)
    filler = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    for name, text in scan.TEMPLATES.items():
        for before in (0, 1, 7, 63, 200):
            around = f"{' '.join(filler[:before])} {text} {' '.join(filler[before:])}"
            assert name in names(around), (name, before)


def test_short_templates_are_found_in_any_context():
    rng = random.Random(1)
    for name in ("MIT", "CC-BY-NC-4.0"):
        texts = []
        for _ in range(2000):
            filler = ["".join(rng.choices("abcdefghij", k=8)) for _ in range(40)]
            before = rng.randrange(12)
            texts.append(" ".join([*filler[:before], scan.TEMPLATES[name], *filler[before:]]))
        assert all([hit[0] for hit in hits] == [name] for hits in scan.find(texts, KNOWN))


def test_containment_decides():
    words = scan.TEMPLATES["MIT-text"].split()
    few = [*words]
    few[40] = "altered"
    assert names(" ".join(few)) == ["MIT-text"]
    for k in range(0, len(few), 9):
        few[k] = f"altered{k}"
    assert names(" ".join(few)) == []
    assert names("Licensed under CC BY 4.0.") == []


def test_other_marks_and_case_do_not_matter():
    assert names("*released UNDER the MIT\nlicense!*") == ["MIT"]


def test_brute_force_over_documents(spark, documents):
    found = {(r.doc_id, r.license): r for r in scan.scan(documents).collect()}
    expected = set()
    for d in documents.collect():
        _, held, _, _ = scan._hashed([d.text])
        for name, own in zip(KNOWN.names, KNOWN.sets):
            if len(own) == 1 and own[0] in set(held.tolist()):
                expected.add((d.doc_id, name))
            elif len(own) > 1 and len(set(own.tolist()) & set(held.tolist())) >= 0.8 * len(own):
                expected.add((d.doc_id, name))
    assert set(found) == expected and found
    lines = {d.doc_id for d in documents.collect() if "Released under the MIT License." in d.text}
    assert lines == {doc_id for doc_id, name in found if name == "MIT"}


def test_odd_rows(spark, odd, nothing):
    assert scan.scan(odd.selectExpr("*", "1 AS license", "2 AS first_word")).count() == 0
    rows = [(None, "Released under the MIT License.", "a")] * 2
    found = scan.scan(spark.createDataFrame(rows, "doc_id int, text string, containment string")).collect()
    assert [(r.doc_id, r.license, r.first_word, r.containment) for r in found] == [(None, "MIT", 0, 1.0)] * 2
    assert scan.scan(nothing).count() == 0
    assert scan.scan(odd, {}).count() == 0
