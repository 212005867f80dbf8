import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ebbmark.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXT = (
    "mail a@b.c_d@e.f.com or x@y or 4111 1111 1111 1111 tel +1 (017) 555-7713; 1.2.3.4.5.6.7.8 "
    "IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789 é 300.1.1.1 \U0001f600 card 4111-1111-1111-1111 "
    "001.002.0003.000255 0000000000256.1.1.1 4111 1111 1111 1112 +12 34 +49 30 901820 x 123-45-6789"
)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    spans = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), place, kind, m.end()))
    spans.sort()
    joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
    counts = [sum(s[2] == kind for s in spans) for kind in BASE]
    return (*counts, hashlib.sha256(joined.encode()).hexdigest()), joined.split(",") if joined else []


def check(frame):
    for row in pii.scan(frame).collect():
        digest, spans = brute(row.text)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256) == digest
        reported = row.spans.split(",") if row.spans else []
        assert set(spans) <= set(reported) and len(row.span_scores.split(",")) == max(1, len(reported))
        assert [s for s in reported if s.split(":")[0] in BASE] == spans


def test_base_spans_of_all_documents(documents):
    check(documents.select("doc_id", "text"))


def test_base_spans_of_odd_texts(spark, odd, nothing):
    check(odd)
    texts = [TEXT, TEXT * 300, "a@b." * 500, "@" * 1000, "1-" * 3000, "+1 " * 3000, "1.1.1.1" * 50, "+" + "1 " * 40, "x@é.de ü@a.de"]
    check(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string"))
    assert pii.scan(nothing).collect() == []


def test_long_runs_stay_linear(spark):
    texts = ["x" * 200_000, "9" * 200_000, "1." * 100_000, "9-" * 100_000, "+" * 200_000, "A1" * 100_000]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    # Four parts and what stands between them, over and over, are addresses by the base pattern.
    addresses = ",".join(f"ip:{k}:{k + 7}" for k in range(0, 200_000, 8))
    assert [r.spans for r in pii.scan(frame).select("doc_id", "spans").orderBy("doc_id").collect()] == ["", "", addresses, "", "", ""]


def scored(spark, text):
    row = pii.scan(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    return dict(zip(row.spans.split(","), map(float, row.span_scores.split(",")), strict=True)) if row.spans else {}


def test_added_kinds_need_checksum_and_words(spark):
    assert scored(spark, "IBAN DE89 3704 0044 0532 0130 00.") == {"iban:5:32": 1.0}
    assert scored(spark, "no DE89 3704 0044 0532 0130 00.") == {"iban:3:30": 0.75}
    assert scored(spark, "IBAN DE88 3704 0044 0532 0130 00.") == {}
    assert scored(spark, "ssn 123-45-6789") == {"ssn:4:15": 0.65}
    assert scored(spark, "part 123-45-6789") == {}
    assert scored(spark, "ssn 000-45-6789 and 123-00-6789") == {}


def test_words_nearby_move_the_score(spark):
    assert scored(spark, "4111111111111111") == {"card:0:16": 0.7}
    assert scored(spark, "credit card 4111111111111111") == {"card:12:28": 1.0}
    assert scored(spark, "test 4111111111111111") == {"card:5:21": 0.4}
    assert scored(spark, "cardboard 4111111111111111") == {"card:10:26": 0.7}
    assert scored(spark, "version 1.2.3.4") == {"ip:8:15": 0.2}


@pytest.mark.parametrize("number, good", [("79927398713", True), ("79927398710", False), ("0", True), ("18", True)])
def test_luhn(spark, number, good):
    assert spark.range(1).select(pii.luhn(F.lit(number))).first()[0] is good
    assert luhn(number) is good


def test_mod_97(spark):
    numbers = ["GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00", "FR1420041010050500013M02606", "GB82WEST12345698765433"]
    frame = spark.createDataFrame([(n,) for n in numbers], "n string")
    assert [r[0] for r in frame.select(pii.mod_97(F.col("n"))).collect()] == [True, True, True, False]


def test_clashing_columns_and_redaction(spark):
    frame = spark.createDataFrame([(1, "call +1 (017) 555-7713 now", "p", "q", "r")], "doc_id int, text string, Spans string, whole_text string, n_EMAIL string")
    found = pii.scan(frame)
    assert found.columns[:3] == ["doc_id", "text", "whole_text"] and len(set(found.columns)) == len(found.columns)
    assert pii.redact(found).select("text", "whole_text", "n_email").first() == ("call [private] now", "q", 0)
