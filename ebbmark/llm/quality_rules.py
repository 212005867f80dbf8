"""Document rules: counts of a text, and bands of n-gram perplexity per language.

The language model is a modified Kneser-Ney model of character ``ORDER``-grams
per language. Tasks count the n-grams of whole texts, Spark sums the counts and
works out discounts, continuation counts and backed-off probabilities with
groupings and joins. The finished model is kept as sorted arrays of 64-bit
n-gram keys with their log probabilities and backoff weights, split into shards
by the first bits of the key and looked up shard by shard. Models of more than
``BROADCAST_ROWS`` entries are not broadcast: there the n-grams of every document
are joined with their probabilities. Perplexities of all documents give each
language a band per length of text; documents outside it are rejected.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.llm.arrays import Words, code_points, give_back, giving_back, mix, slices, stored, sums_by_row, texts_of
from ebbmark.llm.columns import others, unused
from ebbmark.sources.scratch import scratch_folder

ORDER = 4
# A code point takes 16 bits of an n-gram. Those past 65535 (emoji, rare ideographs)
# share the 2048 values that no code point has, 0xD800 to 0xDFFF.
SYMBOL_BITS = 16
# Entries a shard of the finished model holds, about: 12 bytes each. There are as
# many shards as the model needs; a task holds one at a time.
SHARD_ROWS = 1 << 22
# Entries of the largest model that is broadcast: 800 MB in shards.
BROADCAST_ROWS = 1 << 26
# Text is worked on in pieces of so many bytes, with several shards of up to so
# many times that, as every piece may read every shard.
PIECE_BYTES = 1 << 18
PIECES = 16
# A band reaches this many interquartile ranges beyond the quartiles of the texts
# of its language and length (powers of two between these), where there are
# CLASS_LEAST of them; else beyond those of the language, further for short texts.
BAND_REACH = 3.0
BAND_SHORT = 12.0
LEAST_RANGE = 0.01
SHORTEST, LONGEST = 7, 12
CLASS_LEAST = 30

# Limits of the base rules.
LEAST_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"

_COUNTED = T.StructType(
    [T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())]
)
MEASURES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("log_perplexity", T.DoubleType()),
        T.StructField("n_scored", T.LongType()),
    ]
)


def language_code(column: str = "lang") -> str:
    """SQL for the language a text is judged by: two or three letters, else ``und``.

    So there are at most 18,279 languages, whatever the column holds.
    """
    return f"coalesce(nullif(regexp_extract(lower(CAST(`{column}` AS STRING)), '^([a-z]{{2,3}})([^a-z]|$)', 1), ''), 'und')"


# --- counts of a text ---


def _repeats_before(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether each key has an equal one, same row, at an earlier place."""
    order = np.lexsort((keys, rows))
    same = np.zeros(len(keys), bool)
    same[1:] = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    found = np.zeros(len(keys), bool)
    found[order] = same
    return found


def base_counts(texts: pa.StringArray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    words = Words(texts)
    data, offsets = words.data, words.offsets
    spaces = np.isin(data, np.frombuffer(b" \t\n\v\f\r", np.uint8))
    chars = ((data & 0xC0) != 0x80) & ~spaces
    symbols = np.isin(data, np.frombuffer(SYMBOLS.encode(), np.uint8))

    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    # A line ends at its break or where its text ends.
    ends = np.minimum(np.append(starts[1:], len(data)), len(data))
    ends = np.where((ends > starts) & (data[ends - 1] == 10), ends - 1, ends) if len(data) else ends
    solid = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~spaces, out=solid[1:])
    filled = solid[ends] > solid[starts]
    starts, ends = starts[filled], ends[filled]
    line_rows = np.searchsorted(offsets, starts, "right") - 1
    lines = mix(words.span_hashes(starts, ends) + (ends - starts).astype(np.uint64))
    repeated = _repeats_before(lines, line_rows)
    dup_lines = np.bincount(line_rows[repeated], minlength=len(texts))

    hashes, n, size = words.hashes(), len(words.rows), REPEAT_WINDOW
    marked = np.zeros(n + 1, np.int64)
    if n >= size:
        windows = reduce(lambda total, k: total + mix(hashes[k : n - size + 1 + k], k), range(size), np.uint64(0))
        at = np.flatnonzero(words.rows[: n - size + 1] == words.rows[size - 1 :])
        keys, rows = windows[at], words.rows[at]
        later = _repeats_before(keys, rows)
        earlier = _repeats_before(keys[::-1], rows[::-1])[::-1]
        twice = at[later | earlier]
        np.add.at(marked, twice, 1)
        np.add.at(marked, twice + size, -1)
    covered = np.cumsum(marked[:-1]) > 0
    repeat_words = np.bincount(words.rows[covered], minlength=len(texts))
    return [
        words.counts,
        sums_by_row(chars.astype(np.int64), offsets),
        sums_by_row(symbols.astype(np.int64), offsets),
        dup_lines,
        repeat_words,
    ]


# --- the language model ---


def _symbols(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Code points as 16-bit symbols, white space as one symbol, and where each text begins."""
    points, offsets = code_points(texts)
    symbols = points.astype(np.uint64)
    far = symbols > 0xFFFF
    if far.any():
        symbols[far] = np.uint64(0xD800) + mix(symbols[far]) % np.uint64(2048)
    symbols[(points >= 9) & (points <= 13)] = 32
    return symbols, offsets


def _grams(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ORDER``-grams ending at every symbol (a text begins after spaces), their rows, text offsets."""
    symbols, offsets = _symbols(texts)
    return *_grams_between(symbols, offsets, 0, len(symbols)), offsets


def _grams_between(symbols: np.ndarray, offsets: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(first, last)
    rows = np.searchsorted(offsets, at, "right") - 1
    place = at - offsets[rows]
    grams = symbols[first:last].copy()
    for back in range(1, ORDER):
        before = np.where(place >= back, symbols[np.maximum(at - back, 0)], np.uint64(32))
        grams |= before << np.uint64(SYMBOL_BITS * back)
    return grams, rows


def _pieces(texts: pa.StringArray, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, grams, rows)`` of the texts from first to last; a long text comes in several pieces."""
    for first, last in slices(texts, most):
        symbols, offsets = _symbols(texts.slice(first, last - first))
        for begin in range(0, max(len(symbols), 1), most):
            yield first, last, *_grams_between(symbols, offsets, begin, min(begin + most, len(symbols)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of a task, per language; summed up a slice at a time."""
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in parts])
        counts = np.concatenate([c for _, c in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], np.add.reduceat(counts, first)

    def out(lang: str) -> pa.RecordBatch:
        keys, counts = totals.pop(lang)
        columns = [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, names=_COUNTED.names)

    for batch in batches:
        texts, langs = texts_of(batch.column(0)), np.array(batch.column(1).to_pylist(), object)
        for first, last, grams, rows in _pieces(texts, PIECE_BYTES):
            own = langs[first:last]
            for lang in dict.fromkeys(own):
                keys, counts = np.unique(grams[(own == lang)[rows]], return_counts=True)
                if len(keys):
                    parts = [totals[lang]] if lang in totals else []
                    totals[lang] = merged([*parts, (keys, counts.astype(np.int64))])
                if lang in totals and len(totals[lang][0]) > 2_000_000:
                    yield out(lang)
    for lang in [*totals]:
        yield out(lang)


@dataclass(frozen=True)
class Shards:
    """Logs by 64-bit key: sorted arrays, a power of two of them, by the first bits of the key."""

    parts: list[Broadcast]

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log of each key (0 where there is none), and whether there is one."""
        distinct, places = np.unique(keys, return_inverse=True)
        logs, known = np.zeros(len(distinct)), np.zeros(len(distinct), bool)
        ends = np.searchsorted(_shard_of(distinct, len(self.parts)), np.arange(len(self.parts) + 1))
        for part, first, last in zip(self.parts, ends[:-1], ends[1:]):
            if first == last:
                continue
            held, values = part.value
            if len(held):
                at = np.minimum(np.searchsorted(held, distinct[first:last]), len(held) - 1)
                known[first:last] = held[at] == distinct[first:last]
                logs[first:last] = np.where(known[first:last], values[at], 0)
            if len(self.parts) > 1:
                # A broadcast remembers its value: without this a task would gather all shards.
                del held, values
                vars(part).pop("_value", None)
        return logs[places], known[places]


@dataclass(frozen=True)
class LanguageModel:
    """Log probabilities of n-grams and log backoff weights of contexts."""

    grams: Shards
    contexts: Shards

    def log_probabilities(self, grams: np.ndarray, salts: np.ndarray) -> np.ndarray:
        """Natural logs of the probability of each n-gram's last symbol after the others."""
        grams = grams.astype(np.uint64)
        logs = np.zeros(len(grams))
        todo = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            if not len(todo):
                break
            tail = grams[todo] & np.uint64((1 << (SYMBOL_BITS * order)) - 1)
            value, known = self.grams.look_up(_key(tail, salts[todo], order))
            logs[todo[known]] += value[known]
            todo, tail = todo[~known], tail[~known]
            if len(todo):
                weight, seen = self.contexts.look_up(_key(tail >> np.uint64(SYMBOL_BITS), salts[todo], order))
                logs[todo[seen]] += weight[seen]
        logs[todo] += -SYMBOL_BITS * np.log(2)  # never seen: any symbol
        return logs


def _key(grams: np.ndarray, salts: np.ndarray, order: int) -> np.ndarray:
    """64-bit keys; n-grams of one order and language never share one."""
    return mix(mix(grams.astype(np.uint64), order) ^ salts)


def _shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    bits = n.bit_length() - 1
    return (keys >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(keys), np.int32)


def _salt(lang: str) -> np.uint64:
    return mix(np.frombuffer(lang.encode().ljust(8, b"\0")[:8], np.uint64), 5)[0]


def _discounted(adjusted: DataFrame) -> DataFrame:
    """Adjusted counts ``(lang, gram, n)`` with the discount each n-gram takes.

    The three discounts of a language come from its counts of counts; where one
    of these is missing (little text) half of each count is a fair stand-in.
    """
    ones = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = "(n1 / (n1 + 2 * n2))"
    discounts = [
        F.expr(f"CASE WHEN n{k} > 0 AND n{k + 1} > 0 THEN greatest(0.05D, {k} - {k + 1} * {y} * n{k + 1} / n{k}) ELSE 0.5D END AS d{k}")
        for k in (1, 2, 3)
    ]
    # One row per language, 18,279 at most.
    by_lang = stored(adjusted.groupBy("lang").agg(*ones).select("lang", *discounts), adjusted.sparkSession, "discounts")
    taken = F.expr("CASE n WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END")
    return adjusted.join(F.broadcast(by_lang), "lang").select("lang", "gram", "n", taken.alias("d"))


def _levels(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Interpolated probabilities ``(lang, gram, level, p)`` and backoff weights ``(lang, gram, level, g)``.

    Counts, weights and levels are each written before the next is built on them:
    no count is worked out twice, and plans stay small, which with all their tasks'
    figures are the driver's to hold.
    """
    spark = counted.sparkSession
    adjusted = {ORDER: stored(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), spark, "grams")}
    for order in range(ORDER - 1, 0, -1):
        tail = F.col("gram").bitwiseAND((1 << (SYMBOL_BITS * order)) - 1)
        tails = adjusted[order + 1].groupBy("lang", tail.alias("gram")).agg(F.count("*").alias("n"))
        adjusted[order] = stored(tails, spark, f"tails{order}")
    grams, contexts, lower = [], [], None
    for order in range(1, ORDER + 1):
        level = _discounted(adjusted[order]).withColumn("context", F.shiftrightunsigned("gram", SYMBOL_BITS))
        weights = level.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("held"))
        weights = stored(weights, spark, f"weights{order}")
        level = level.join(weights, ["lang", "context"])
        tail = F.col("gram").bitwiseAND((1 << (SYMBOL_BITS * (order - 1))) - 1)
        if lower is None:
            level = level.withColumn("below", F.lit(2.0**-SYMBOL_BITS))
        else:
            level = level.withColumn("tail", tail).join(lower.withColumnRenamed("gram", "tail"), ["lang", "tail"])
        p = F.expr("(n - d) / total + held / total * below").alias("p")
        lower = stored(level.select("lang", "gram", p), spark, f"level{order}")
        grams.append(lower.withColumn("level", F.lit(order)))
        lower = lower.withColumnRenamed("p", "below")
        contexts.append(weights.selectExpr("lang", "context AS gram", f"{order} AS level", "held / total AS g"))
    return reduce(DataFrame.unionAll, grams), reduce(DataFrame.unionAll, contexts)


def _sharded(rows: DataFrame, value: str, n: int) -> Shards:
    """Rows of a model as ``n`` shards. The driver holds one shard at a time."""
    spark = rows.sparkSession
    kind = T.StructType(
        [T.StructField("key", T.LongType()), T.StructField("log", T.FloatType()), T.StructField("shard", T.IntegerType())]
    )

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts: dict[str, np.uint64] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang in set(langs) - salts.keys():
                salts[lang] = _salt(lang)
            own = np.array([salts[lang] for lang in langs], np.uint64)
            grams, levels, values = (batch.column(k).to_numpy() for k in (1, 2, 3))
            keys = np.zeros(len(grams), np.uint64)
            for order in np.unique(levels):
                at = levels == order
                keys[at] = _key(grams[at], own[at], int(order))
            columns = [keys.view(np.int64), np.log(values).astype(np.float32), _shard_of(keys, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=kind.names)

    path = f"{scratch_folder(spark)}-shards-{uuid.uuid4().hex[:8]}"
    rows.select("lang", "gram", "level", value).mapInArrow(giving_back(keyed), kind).write.partitionBy("shard").parquet(path)
    written = spark.read.schema(kind).parquet(path)
    parts = []
    for k in range(n):
        table = written.filter(F.col("shard") == k).select("key", "log").toArrow()
        keys, logs = table.column("key").to_numpy().view(np.uint64), table.column("log").to_numpy()
        order = np.argsort(keys)
        parts.append(spark.sparkContext.broadcast((keys[order], logs[order])))
        del table, keys, logs, order
        give_back()
    return Shards(parts)


def train(docs: DataFrame, lang: str = "lang") -> LanguageModel | DataFrame:
    """Counts every n-gram of every text of ``docs``; nothing is sampled or pruned.

    A model of more than ``BROADCAST_ROWS`` entries comes as the table of its
    probabilities of whole n-grams, ``(lang, gram, p)``, which has all that the
    texts it was counted from need.
    """
    texts = docs.select(F.col("text").cast("string"), F.expr(language_code(lang)))
    grams, contexts = _levels(texts.mapInArrow(giving_back(_count), _COUNTED))
    entries = grams.count()
    if entries > BROADCAST_ROWS:
        return grams.filter(F.col("level") == ORDER).select("lang", "gram", "p")
    # Contexts are fewer than n-grams.
    n = 1 << max(0, -(-entries // SHARD_ROWS) - 1).bit_length()
    return LanguageModel(_sharded(grams, "p", n), _sharded(contexts, "g", n))


# --- verdicts ---


def _base_columns(texts: pa.StringArray) -> list[pa.Array]:
    """The five counts of each text, worked out a slice at a time."""
    parts = [base_counts(texts.slice(first, last - first)) for first, last in slices(texts, PIECE_BYTES)]
    return [pa.array(np.concatenate([part[k] for part in parts]).astype(np.int64)) for k in range(5)]


def _measured(rows: DataFrame, judged_by: str, model: LanguageModel) -> DataFrame:
    out = T.StructType([*rows.schema.fields, *MEASURES.fields])
    place, lang = rows.columns.index("text"), rows.columns.index(judged_by)
    unit = PIECE_BYTES * min(len(model.grams.parts), PIECES)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts: dict[str, np.uint64] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, langs = texts_of(batch.column(place)), batch.column(lang).to_pylist()
            for code in set(langs) - salts.keys():
                salts[code] = _salt(code)
            own = np.array([salts[code] for code in langs], np.uint64)
            logs, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            for first, last, grams, rows_of in _pieces(texts, unit):
                if not len(grams):
                    continue
                found = model.log_probabilities(grams, own[first:last][rows_of])
                begins = np.flatnonzero(np.append(True, rows_of[1:] != rows_of[:-1]))
                logs[first + rows_of[begins]] += np.add.reduceat(found, begins)
                n[first + rows_of[begins]] += np.diff(np.append(begins, len(grams)))
            values = [*_base_columns(texts), pa.array(-logs / np.maximum(n, 1)), pa.array(n)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *values], names=out.names)

    return rows.mapInArrow(giving_back(measured), out)


def _measured_by_join(rows: DataFrame, judged_by: str, model: DataFrame) -> DataFrame:
    """The same for models that are not broadcast, out of the documents they were counted from."""
    spark = rows.sparkSession
    key = unused(rows, "row")
    rows = stored(rows, spark, "texts").withColumn(key, F.monotonically_increasing_id())
    kind = T.StructType([T.StructField(key, T.LongType()), T.StructField("lang", T.StringType()), *_COUNTED.fields[1:]])
    counted = T.StructType([T.StructField(key, T.LongType()), *MEASURES.fields[:5]])

    def per_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, langs = batch.column(0).to_numpy(), texts_of(batch.column(1)), np.array(batch.column(2).to_pylist(), object)
            for first, last, grams, rows_of in _pieces(texts, PIECE_BYTES):
                order = np.lexsort((grams, rows_of))
                grams, rows_of = grams[order], rows_of[order]
                begins = np.flatnonzero(np.append(True, (grams[1:] != grams[:-1]) | (rows_of[1:] != rows_of[:-1]))) if len(grams) else []
                at = first + rows_of[begins]
                n = np.diff(np.append(begins, len(grams))).astype(np.int64)
                columns = [pa.array(ids[at]), pa.array(langs[at], pa.string()), pa.array(grams[begins].view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=kind.names)

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *_base_columns(texts_of(batch.column(1)))], names=counted.names)

    texts = rows.select(key, "text", judged_by)
    scored = texts.mapInArrow(giving_back(per_text), kind).join(model, ["lang", "gram"]).groupBy(key)
    logs = scored.agg((-F.sum(F.col("n") * F.log("p")) / F.sum("n")).alias("log_perplexity"), F.sum("n").alias("n_scored"))
    counts = texts.mapInArrow(giving_back(base), counted)
    zero = {"log_perplexity": 0.0, "n_scored": 0}
    return rows.join(counts, key).join(logs, key, "left").fillna(zero, [*zero]).select(
        *(F.col(f"`{c}`") for c in rows.columns if c != key), *MEASURES.names
    )


def measure(docs: DataFrame, model: LanguageModel | DataFrame, judged_by: str = "_judged_by") -> DataFrame:
    """``docs`` with the columns of ``MEASURES`` and the language code ``judged_by``; columns of those names are replaced."""
    rows = docs.select(*others(docs, [*MEASURES.names, judged_by]), F.expr(language_code()).alias(judged_by))
    by = _measured if isinstance(model, LanguageModel) else _measured_by_join
    measured = by(rows, judged_by, model)
    # So that sums in another order are the same.
    return measured.withColumn("log_perplexity", F.round("log_perplexity", 9))


def base_failed() -> str:
    return f"(n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words)"


def length_class() -> str:
    return f"least(greatest(CAST(floor(log2(greatest(n_scored, 1))) AS INT), {SHORTEST}), {LONGEST})"


def bands(measured: DataFrame, judged_by: str) -> tuple[DataFrame, DataFrame]:
    """Quartiles of log perplexity over all documents that pass the base rules.

    By language and length, ``(judged_by, class, n, low, high)``, and by language alone.
    """
    passed = measured.filter(f"NOT {base_failed()}").withColumn("class", F.expr(length_class()))
    quartiles = F.percentile_approx("log_perplexity", [0.25, 0.75], 10_000).alias("q")

    def by(*keys: str) -> DataFrame:
        found = passed.groupBy(*keys).agg(F.count("*").alias("n"), quartiles)
        return found.select(*keys, "n", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))

    return by(judged_by, "class"), by(judged_by)


def judge(docs: DataFrame, model: LanguageModel | DataFrame | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with its counts, ``base_failed``, ``band_side`` and ``kept``.

    ``kept`` needs the base rules to hold and the text's log perplexity to lie in
    its band: ``BAND_REACH`` interquartile ranges beyond the quartiles of its
    language and length. Where a language has fewer than ``CLASS_LEAST`` texts of a
    length the quartiles are those of the language, and the reach grows by 1 +
    ``BAND_SHORT`` / sqrt(n) for n code points. ``band_side`` is 1 above the band, -1
    below, 0 inside.

    Null and empty texts have no words and fail; a null or odd ``lang`` is judged
    as ``und``; equal rows get equal verdicts; columns named like a result, in any
    case, are replaced; an empty table gives no rows. What is measured is written
    once, without the texts unless ``keep_text``.
    """
    spark = docs.sparkSession
    judged_by = unused(docs, "judged_by")
    docs = docs.select(*others(docs, [*MEASURES.names, "base_failed", "band_side", "kept"]))
    model = train(docs) if model is None else model
    measured = measure(docs, model, judged_by)
    measured = stored(measured if keep_text else measured.drop("text"), spark, "measured")
    by_class, by_lang = bands(measured, judged_by)

    def limits(found: DataFrame, name: str) -> DataFrame:
        values = F.struct("low", "high", F.greatest(F.col("high") - F.col("low"), F.lit(LEAST_RANGE)).alias("range"))
        return found.withColumn(name, values).drop("n", "low", "high")

    fine, coarse, kind = (unused(measured, name) for name in ("fine", "coarse", "class_of"))
    # At most six rows for each of 18,279 languages, and one.
    by_class = limits(by_class.filter(F.col("n") >= CLASS_LEAST).withColumnRenamed("class", kind), fine)
    judged = (
        measured.withColumn(kind, F.expr(length_class()))
        .join(F.broadcast(by_class), [judged_by, kind], "left")
        .join(F.broadcast(limits(by_lang, coarse)), judged_by, "left")
    )
    reach = F.expr(
        f"{BAND_REACH}D * CASE WHEN {fine} IS NOT NULL THEN {fine}.range "
        f"ELSE {coarse}.range * (1 + {BAND_SHORT}D / sqrt(greatest(n_scored, 1))) END"
    )
    low, high = (F.expr(f"coalesce({fine}.{edge}, {coarse}.{edge})") for edge in ("low", "high"))
    value = F.col("log_perplexity")
    side = F.when(value > high + reach, 1).when(value < low - reach, -1).otherwise(0)
    judged = judged.withColumn("base_failed", F.expr(base_failed())).withColumn("band_side", side)
    judged = judged.withColumn("kept", F.expr("NOT base_failed AND band_side = 0"))
    added = [*MEASURES.names[:6], "base_failed", "band_side", "kept"]
    return judged.select(*(F.col(f"`{c}`") for c in measured.columns if c not in [*added, judged_by, "n_scored"]), *added)
