"""Personal data in texts: patterns propose, checksums confirm, words nearby weigh.

Every kind has a pattern, a test its matches must pass (Luhn for cards, mod 97
for account numbers, number ranges) and words that make it likelier or less
likely where they stand close by. The base kinds are reported whenever their
test is passed, each with its score; the other kinds, whose shape alone says
little, only where the score reaches ``LEAST_SCORE``.

DataFrame functions only, one projection over the texts, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbmark.llm.columns import let, others, unused
from ebbmark.llm.spans import listed, matches

LEAST_SCORE = 0.6
WORD_WEIGHT = 0.3


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _has_digits(value: Column, least: int, most: int) -> Column:
    return F.char_length(_digits(value)).between(least, most)


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    doubled = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
        lambda c, i: let(c.cast("int") * (1 + i % 2), lambda v: F.when(v > 9, v - 9).otherwise(v)),
    )
    return F.aggregate(doubled, F.lit(0), lambda n, v: n + v) % 10 == 0


def mod_97(value: Column) -> Column:
    """Whether an account number of capitals and digits leaves 1 modulo 97, its first four characters moved to the end."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        F.lit(0),
        lambda n, c: F.when(c >= "A", n * 100 + F.ascii(c) - 55).otherwise(n * 10 + F.ascii(c) - 48) % 97,
    )
    return rest == 1


def _card(value: Column) -> Column:
    return F.when(_has_digits(value, 14, 19), luhn(_digits(value))).otherwise(False)


def _iban(value: Column) -> Column:
    return F.when(F.char_length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34), mod_97(value)).otherwise(False)


def _ip(value: Column) -> Column:
    part = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return value.rlike(rf"^{part}(\.{part}){{3}}$")


def _ssn(value: Column) -> Column:
    return value.rlike("^[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}$") & ~value.rlike("^(000|666)|-00-|-0000$")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``passes`` tests a match; ``prior`` is the score of one that passes,
    ``near`` and ``far`` are words nearby that raise and lower it.
    """

    name: str
    pattern: str
    prior: float
    passes: Callable[[Column], Column] | None = None
    near: tuple[str, ...] = ()
    far: tuple[str, ...] = ("example", "sample", "dummy", "test")
    base: bool = False


# The base kinds. A match of email and ip can only begin where a run
# of its first characters does, or where the match before it ended; that and the
# possessive quantifiers keep long runs linear, and the matches are the same.
BASE_KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
        near=("email", "e-mail", "mail", "contact", "correo", "courriel"),
        base=True,
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.5,
        _ip,
        near=("ip", "address", "host", "server", "login", "adresse"),
        far=("version", "release", "section", "chapter"),
        base=True,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        0.7,
        _card,
        near=("card", "credit", "debit", "visa", "karte", "tarjeta", "carte"),
        far=("isbn", "order", "test", "example"),
        base=True,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.6,
        lambda value: _has_digits(value, 10, 15),
        near=("phone", "call", "tel", "mobile", "fax", "telefon", "teléfono", "téléphone"),
        base=True,
    ),
)
ADDED_KINDS = (
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
        0.75,
        _iban,
        near=("iban", "account", "konto", "bank", "cuenta", "compte"),
    ),
    Kind("ssn", "(?<![0-9])[0-9]++(?:-[0-9]++)++", 0.35, _ssn, near=("ssn", "social", "security")),
)


def _has_word(near: Column, words: tuple[str, ...]) -> Column:
    return near.rlike(f"(^|[^a-z0-9])({'|'.join(words)})([^a-z0-9]|$)")


def score_of(kind: Kind, before: Column, after: Column) -> Column:
    """The score of a match that passed, from the words next to it (A-Z lower-cased)."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    near = F.translate(F.concat_ws(" ", before, after), capitals, capitals.lower())

    def weigh(words: Column) -> Column:
        raised = F.when(_has_word(words, kind.near), WORD_WEIGHT).otherwise(0.0)
        lowered = F.when(_has_word(words, kind.far), WORD_WEIGHT).otherwise(0.0)
        return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(kind.prior) + raised - lowered)), 2)

    return let(near, weigh)


def _spans_of(text: Column, kind: Kind, place: int) -> Column:
    passed = matches(text, kind.pattern, near=True)
    if kind.passes:
        passed = F.filter(passed, lambda s: kind.passes(s["value"]))
    scored = F.transform(
        passed,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(place).alias("place"),
            s["end"].alias("end"),
            score_of(kind, s["before"], s["after"]).alias("score"),
        ),
    )
    return scored if kind.base else F.filter(scored, lambda s: s["score"] >= LEAST_SCORE)


def _count_of(spans: Column, place: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["place"] == place)).cast("bigint")


def scan(docs: DataFrame, kinds: tuple[Kind, ...] = BASE_KINDS + ADDED_KINDS) -> DataFrame:
    """Every row of ``docs`` with the personal data of its text.

    Adds ``n_<kind>`` and ``base_sha256`` of the base kinds, ``spans`` (all spans
    as kind:start:end, comma-joined, by start, then kind as listed),
    ``span_scores`` (theirs, comma-joined) and ``private_spans``, the spans as an
    array. Spans of different kinds may overlap.

    Null and empty texts have no spans; repeated rows and null ids are rows like
    any other; columns named like a result, in any case, are replaced, all others
    stay; an empty table gives no rows.
    """
    names = [kind.name for kind in kinds]
    base = [(place, kind) for place, kind in enumerate(kinds) if kind.base]
    added = [f"n_{kind.name}" for _, kind in base] + ["base_sha256", "spans", "span_scores", "private_spans"]
    text = unused(docs, "whole_text")
    whole = docs.select(*others(docs, added), F.coalesce(F.col("text").cast("string"), F.lit("")).alias(text))
    every = F.concat(*(_spans_of(F.col(text), kind, place) for place, kind in enumerate(kinds)))
    found = whole.withColumn("private_spans", F.array_sort(every)).drop(text)
    spans = F.col("private_spans")
    based = F.filter(spans, lambda s: s["place"].isin([place for place, _ in base]))
    counts = [_count_of(spans, place).alias(f"n_{kind.name}") for place, kind in base]
    return found.select(
        "*",
        *counts,
        F.sha2(listed(based, names), 256).alias("base_sha256"),
        listed(spans, names).alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",").alias("span_scores"),
    )


def redact(scanned: DataFrame, mark: str = "[private]") -> DataFrame:
    """``text`` with every span replaced by ``mark``; overlapping spans count as one."""
    merged = F.aggregate(
        "private_spans",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("done")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["done"])
            .otherwise(F.concat(acc["done"], F.array(F.expr("text").substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))))
            .alias("done"),
        ),
        lambda acc: F.concat(F.array_join(acc["done"], ""), F.expr("text").substr(acc["at"] + 1, F.char_length("text"))),
    )
    return scanned.withColumn("text", F.when(F.size("private_spans") > 0, merged).otherwise(F.col("text")))
