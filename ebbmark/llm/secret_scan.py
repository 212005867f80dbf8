"""Secrets in texts, told from copied examples by who else holds them.

Candidates are found by patterns. Each one's hash is counted over the corpus by
distinct repositories and distinct owners: a value that many owners hold, or that
stands in many repositories of each owner, is an example out of some manual; one
that an owner holds in a few places looks live. The base
kinds are reported either way, with their class; the other kinds, whose patterns
also match harmless text, are reported only where they look live.

DataFrame functions only, nothing leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbmark.llm.arrays import stored
from ebbmark.llm.columns import others, unused
from ebbmark.llm.spans import listed, matches

# Owners, and repositories for each owner, from which on a value counts as widely copied.
COPIED_OWNERS = 3
COPIED_REPOSITORIES = 10
# A hash that one in so many holders has is joined by broadcast: there are no more of them.
HOT = 1000
REDACTED = "[secret]"


@dataclass(frozen=True)
class Kind:
    """A kind of candidate.

    ``secret`` is the pattern's group that holds the value. ``holds`` are
    patterns the value must contain too, ``least`` its fewest characters and
    ``distinct`` its fewest different ones.
    """

    name: str
    pattern: str
    secret: int = 0
    least: int = 0
    holds: tuple[str, ...] = ()
    distinct: int = 0
    base: bool = False


# The base kinds. Where a minimum length is asked of a whole run of
# characters it stands in the pattern: the matches left are the same.
BASE_KINDS = (
    Kind(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        secret=2,
        least=6,
        base=True,
    ),
    Kind("access", "AKIA[A-Z0-9]{16,}", base=True),
    Kind("hex", "[0-9a-f]{24,}", base=True),
)
# Kinds that count only where one or two owners hold the value.
OWNED_KINDS = (
    Kind("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"),
    Kind("signed", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Kind("random", "[A-Za-z0-9+/_-]{24,}", holds=("[0-9].*[0-9].*[0-9]", "[a-z]", "[A-Z]"), distinct=14),
)


def _spans_of(text: Column, kind: Kind, place: int) -> Column:
    """Spans of one kind: ``(start, place, end, value)`` in code points, by start."""
    spans = F.transform(
        matches(text, kind.pattern, kind.secret),
        lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), s["value"].alias("value")),
    )

    def passes(span: Column) -> Column:
        good = F.char_length(span["value"]) >= kind.least
        for pattern in kind.holds:
            good = good & span["value"].rlike(pattern)
        if kind.distinct:
            good = good & (F.size(F.array_distinct(F.split(span["value"], ""))) >= kind.distinct)
        return good

    return F.filter(spans, passes)


def candidates(docs: DataFrame, kinds: tuple[Kind, ...], text: str, column: str) -> DataFrame:
    """``docs`` with the spans of all kinds in ``column``, ordered by start and kind.

    A span holds the hash of its value, never the value itself.
    """
    every = F.concat(*(_spans_of(F.col(text), kind, place) for place, kind in enumerate(kinds)))
    hashed = F.transform(
        F.array_sort(every),
        lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash")),
    )
    return docs.withColumn(column, hashed)


def ownership(found: DataFrame, candidates: str, owner: str, repository: str) -> DataFrame:
    """Distinct owners and repositories of every candidate hash.

    Combined before each shuffle, so that a value half the corpus holds is a
    few rows per task. A null owner or repository counts as one of its own.
    """
    holders = found.select(
        F.explode(F.array_distinct(F.transform(candidates, lambda s: s["hash"]))).alias("hash"),
        F.col(owner).alias("owner"),
        F.col(repository).alias("repository"),
    ).distinct()
    by_owner = holders.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def live() -> str:
    """SQL for whether a value looks live, from how many owners and repositories hold it."""
    return f"(n_owners < {COPIED_OWNERS} AND n_repositories < {COPIED_REPOSITORIES} * n_owners)"


def _count_of(judged: str, place: int) -> Column:
    return F.size(F.filter(judged, lambda s: s["place"] == place)).cast("bigint")


def _judged(single: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates with ``live``; a hash that many documents hold is no key of a shuffle."""
    every = counts.agg(F.sum("n_repositories")).first()[0] or 0
    # At most HOT hashes.
    hot = F.broadcast(counts.filter(F.col("n_repositories") * HOT >= every).select("hash", "live"))
    rare = single.join(hot.select("hash"), "hash", "left_anti").join(counts.select("hash", "live"), "hash")
    return single.join(hot, "hash").unionByName(rare)


def scan(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    kinds: tuple[Kind, ...] = BASE_KINDS + OWNED_KINDS,
    keep_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` with the secrets of its text.

    Adds ``n_<kind>`` and ``base_sha256`` of the base kinds, ``spans`` (all
    spans as kind:start:end, comma-joined, by start and kind), ``live_spans``
    (those whose value fewer than ``COPIED_OWNERS`` owners hold, in fewer than
    ``COPIED_REPOSITORIES`` repositories each) and ``secret_spans``, the spans as
    an array.

    Null and empty texts have no spans; repeated rows are scanned one by one
    and count as one repository; a null id or owner is counted as a value of
    its own; columns named like a result, in any case, are replaced, all others
    stay; an empty table gives no rows. Without ``keep_text`` the text does not
    travel further.
    """
    spark = docs.sparkSession
    base = [(place, kind) for place, kind in enumerate(kinds) if kind.base]
    added = [f"n_{kind.name}" for _, kind in base] + ["base_sha256", "spans", "live_spans", "secret_spans"]
    kept = others(docs, added if keep_text else [*added, "text"])
    row, found_in, holder, place_of, judged_in, text = (
        unused(docs, name) for name in ("row", "candidates", "owner_of", "repository_of", "judged", "whole_text")
    )
    wanted = docs.select(
        *kept,
        F.col(owner).cast("string").alias(holder),
        F.col(repository).cast("string").alias(place_of),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias(text),
    )
    found = candidates(wanted, kinds, text, found_in).drop(text)
    found = stored(found.withColumn(row, F.monotonically_increasing_id()), spark, "candidates")

    counts = ownership(found, found_in, holder, place_of).withColumn("live", F.expr(live()))
    counts = stored(counts, spark, "ownership")
    some = found.filter(F.size(found_in) > 0)
    single = some.select(row, F.explode(found_in).alias("span")).withColumn("hash", F.col("span.hash"))
    judged = _judged(single, counts).select(row, F.struct("span.start", "span.place", "span.end", "live").alias("span"))
    # One document's spans; as many as its text holds.
    judged = judged.groupBy(row).agg(F.array_sort(F.collect_list("span")).alias(judged_in))
    based_on = [place for place, kind in enumerate(kinds) if kind.base]
    nothing = F.array().cast("array<struct<start:int,place:int,end:int,live:boolean>>")
    rows = some.join(judged, row).unionByName(found.filter(F.size(found_in) == 0).withColumn(judged_in, nothing))

    names = [kind.name for kind in kinds]
    spans = F.filter(judged_in, lambda s: s["place"].isin(based_on) | s["live"])
    based = F.filter(judged_in, lambda s: s["place"].isin(based_on))
    result = rows.withColumn("secret_spans", spans)
    for place, kind in base:
        result = result.withColumn(f"n_{kind.name}", _count_of(judged_in, place))
    result = result.withColumn("base_sha256", F.sha2(listed(based, names), 256))
    result = result.withColumn("spans", listed(F.col("secret_spans"), names))
    result = result.withColumn("live_spans", listed(F.filter("secret_spans", lambda s: s["live"]), names))
    return result.drop(row, found_in, holder, place_of, judged_in)


def redact(scanned: DataFrame) -> DataFrame:
    """The text with every span of ``secret_spans`` replaced by ``REDACTED``; overlaps count as one."""
    cut = F.aggregate(
        "secret_spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("done")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["done"])
            .otherwise(F.concat(acc["done"], F.expr("text").substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(REDACTED)))
            .alias("done"),
        ),
        lambda acc: F.concat(acc["done"], F.expr("text").substr(acc["at"] + 1, F.char_length("text"))),
    )
    return scanned.withColumn("text", F.when(F.size("secret_spans") > 0, cut).otherwise(F.col("text")))
