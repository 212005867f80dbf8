"""Language of texts by hierarchical discrimination.

Linear support vector machines over letter n-grams. The first level tells
language families apart, one machine per family against the rest. Within the
chosen family every pair of languages has a machine of its own, trained on those
two alone, and the language that wins most pairs is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.llm.arrays import code_points, mix, slices, texts_of
from ebbmark.llm.columns import others

# Bounds of what is learned from: languages, distinct texts of each, code points of
# one. Of a longer text a passage is taken.
TRAINING_LANGUAGES = 100
TRAINING_TEXTS = 400
TRAINING_CHARS = 4096
# Parts in which the texts of a language are drawn.
DRAWS = 64
GRAM_SIZES = (1, 2, 3)
FEATURE_BITS = 14
EPOCHS = 20
COST = 10.0
UNKNOWN = "und"

# Families of languages by ISO 639 code. Others are families of their own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt rm ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt ug uz",
    "indic": "as bn gu hi mr ne or pa sa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
}

_PREDICTED = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def family_of(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in FAMILIES.items() if code in codes.split()), f"only {lang}")


@cache
def _letters() -> np.ndarray:
    """Lower-case form of every letter's code point; 0 for what is no letter."""
    points = [ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in range(0x32400)]
    return np.array(points, np.int64)


def grams(texts: pa.StringArray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Hashed letter n-grams per size, where each text's begin, and how many letters it has.

    Runs of other characters count as one gap, which words begin and end with.
    """
    points, offsets = code_points(texts)
    table = _letters()
    letters = np.where(points < len(table), table[np.minimum(points, len(table) - 1)], 0)
    begins = np.zeros(len(letters), bool)
    begins[offsets[:-1][offsets[:-1] < len(letters)]] = True
    before = np.concatenate(([0], letters[:-1]))
    before[begins] = 0
    keep = (letters > 0) | (before > 0)
    places = np.concatenate(([0], np.cumsum(keep)))[offsets]
    counts = np.concatenate(([0], np.cumsum(letters > 0)))[offsets]
    letters = letters[keep]
    rows = np.repeat(np.arange(len(texts)), np.diff(places))
    at = np.arange(len(letters)) - places[rows]
    hashes = []
    whole = np.zeros(len(letters), np.uint64)
    for back in range(max(GRAM_SIZES)):
        earlier = np.zeros(len(letters), np.uint64)
        if back:
            earlier[back:] = np.where(at[back:] >= back, letters[:-back], 0)
        else:
            earlier[:] = letters
        whole = whole + (earlier << np.uint64(21 * back))
        if back + 1 in GRAM_SIZES:
            hashes.append((mix(whole, back + 1) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
    return hashes, [places] * len(hashes), np.diff(counts)


@dataclass(frozen=True)
class Machine:
    """A linear machine on relative n-gram frequencies."""

    weights: np.ndarray
    bias: float

    def margins(self, hashes: list[np.ndarray], places: np.ndarray) -> np.ndarray:
        n = np.maximum(np.diff(places), 1)
        total = np.zeros(len(places) - 1)
        for found in hashes:
            sums = np.concatenate(([0.0], np.cumsum(self.weights[found])))
            total += sums[places[1:]] - sums[places[:-1]]
        return total / n + self.bias


@dataclass(frozen=True)
class LanguageModel:
    families: dict[str, list[str]]
    family_machines: dict[str, Machine]
    pair_machines: dict[tuple[str, str], Machine]

    def predict(self, texts: pa.StringArray) -> tuple[list[str], np.ndarray]:
        """Language and confidence of each text; ``und`` where no letter is found."""
        hashes, (places, *_), letters = grams(texts)
        names = sorted(self.families)
        sure = np.ones(len(texts))
        chosen = np.zeros(len(texts), int)
        if len(names) > 1:
            margins = np.column_stack([self.family_machines[n].margins(hashes, places) for n in names])
            chosen = margins.argmax(1)
            sure = _sigmoid(margins.max(1))
        answer = np.full(len(texts), UNKNOWN, object)
        for k, name in enumerate(names):
            own = np.flatnonzero((chosen == k) & (letters > 0))
            langs = self.families[name]
            if not len(own):
                continue
            wins = np.zeros((len(own), len(langs)))
            least = np.full((len(own), len(langs)), np.inf)
            for i, j in combinations(range(len(langs)), 2):
                margin = self.pair_machines[langs[i], langs[j]].margins(hashes, places)[own]
                wins[:, i] += (margin >= 0) + 1e-3 * _sigmoid(margin)
                wins[:, j] += (margin < 0) + 1e-3 * _sigmoid(-margin)
                least[:, i] = np.minimum(least[:, i], margin)
                least[:, j] = np.minimum(least[:, j], -margin)
            best = wins.argmax(1)
            answer[own] = np.array(langs, object)[best]
            if len(langs) > 1:
                sure[own] *= _sigmoid(least[np.arange(len(own)), best])
        sure[letters == 0] = 0.0
        return answer.tolist(), sure


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(2 * margin, -40, 40)))


def _machine(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """A linear SVM (squared hinge) by dual coordinate descent; a constant feature is the bias."""
    size = 1 << FEATURE_BITS
    mean = np.zeros(size)
    for at, values in features:
        mean[at] += values / len(features)
    scale = 1 / np.sqrt(mean + 1e-5)
    scaled = [(at, values * scale[at]) for at, values in features]
    # Both sides weigh the same, whatever their numbers.
    cost = np.where(labels > 0, 1 / max((labels > 0).sum(), 1), 1 / max((labels < 0).sum(), 1)) * len(labels) / 2 * COST
    w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(labels))
    norms = [float(values @ values) + 1 + 0.5 / c for (_, values), c in zip(scaled, cost)]
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in order.permutation(len(labels)):
            at, values = scaled[i]
            slope = labels[i] * (w[at] @ values + bias) - 1 + alpha[i] * 0.5 / cost[i]
            new = max(alpha[i] - slope / norms[i], 0.0)
            step = (new - alpha[i]) * labels[i]
            if step:
                w[at] += step * values
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return Machine(w * scale, bias)


def train(labelled: DataFrame) -> LanguageModel | None:
    """A model from ``(text, lang)`` rows; ``None`` if none has both.

    Of each language the ``TRAINING_TEXTS`` distinct texts with the smallest
    hashes reach the driver, of longer ones a passage of ``TRAINING_CHARS`` code
    points at a place the hash gives; of more than ``TRAINING_LANGUAGES`` languages
    those with most distinct texts, ties by name. This bounds what is learned
    from, not what is predicted. Copies count once, however many there are. Texts
    are drawn by their hashes, language by language in ``DRAWS`` parts.
    """
    fitting = labelled.filter("length(text) > 0 AND lang IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("place")
    )
    hashes = fitting.select("lang", "place").distinct()
    most = hashes.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(TRAINING_LANGUAGES).select("lang")
    part = Window.partitionBy("lang", F.pmod("place", F.lit(DRAWS))).orderBy("place")
    whole = Window.partitionBy("lang").orderBy("place")
    drawn = hashes.join(F.broadcast(most), "lang")
    for order in (part, whole):
        drawn = drawn.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TRAINING_TEXTS).drop("rank")
    begin = F.expr(f"CASE WHEN length(text) > {TRAINING_CHARS} THEN 1 + pmod(place, length(text) - {TRAINING_CHARS} + 1) ELSE 1 END")
    passage = F.col("text").substr(begin.cast("int"), F.lit(TRAINING_CHARS)).alias("passage")
    # A hundred languages of 400 hashes at most.
    fetched = fitting.join(F.broadcast(drawn), ["lang", "place"]).select("lang", "place", passage).dropDuplicates(["lang", "place"])
    found: dict[str, list[tuple[int, str]]] = {}
    for row in fetched.toLocalIterator():
        found.setdefault(row.lang, []).append((row.place, row.passage))
    texts = {lang: pa.array([text for _, text in sorted(own)], pa.string()) for lang, own in sorted(found.items())}
    features: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for lang, own in texts.items():
        hashes, (places, *_), letters = grams(own)
        features[lang] = []
        for i in np.flatnonzero(letters > 0):
            every = np.concatenate([found[places[i] : places[i + 1]] for found in hashes])
            at, n = np.unique(every, return_counts=True)
            features[lang].append((at, n / (places[i + 1] - places[i])))
    features = {lang: found for lang, found in features.items() if found}
    if not features:
        return None
    families: dict[str, list[str]] = {}
    for lang in sorted(features):
        families.setdefault(family_of(lang), []).append(lang)
    every = [(f, lang) for lang in sorted(features) for f in features[lang]]
    family_machines = {
        name: _machine([f for f, _ in every], np.array([1 if lang in langs else -1 for _, lang in every]))
        for name, langs in families.items()
        if len(families) > 1
    }
    pair_machines = {
        (a, b): _machine(features[a] + features[b], np.array([1] * len(features[a]) + [-1] * len(features[b])))
        for langs in families.values()
        for a, b in combinations(langs, 2)
    }
    return LanguageModel(families, family_machines, pair_machines)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the confidence in it.

    Nothing but ``text`` is an input. Null texts and texts without a letter are
    ``und`` with score 0, and so is every text without a model; equal texts get
    equal answers. Of languages that win equally many pairs the one with the
    larger margins wins, then the first by name; of families with equal margins
    the first by name. Columns named like a result, in any case, are replaced; an
    empty table gives no rows.
    """
    rows = docs.select(*others(docs, _PREDICTED.names))
    if model is None:
        return rows.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    place = rows.columns.index("text")
    out = T.StructType([*rows.schema.fields, *_PREDICTED.fields])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = texts_of(batch.column(place))
            for first, last in slices(texts):
                langs, sure = known.predict(texts.slice(first, last - first))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(sure)], names=out.names)

    return rows.mapInArrow(identified, out)


def held_out(key: str = "doc_id") -> str:
    """SQL condition of the fifth of ids that languages are never learned from."""
    return f"coalesce(crc32(encode(CAST(`{key}` AS STRING), 'utf-8')) % 5 = 0, true)"
