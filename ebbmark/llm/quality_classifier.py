"""Text quality by compression against dictionaries of good and bad text.

Two zstandard dictionaries are built from labelled texts, one per label. A text
is cut into pieces, every piece is compressed with either dictionary and with
none, and the difference of the two sizes, divided by their sum, says which
dictionary knows the text better. A logistic curve fitted on labelled texts the
dictionaries have not seen turns it into a probability.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.llm.arrays import giving_back, texts_of
from ebbmark.llm.columns import others

# Bounds of what is learned from: distinct texts of each label, and code points of
# one. Of a longer text a passage is taken.
TRAINING_TEXTS = 2000
TRAINING_CHARS = 16_384
DICTIONARY_BYTES = 112_640
# Whole texts are compressed in pieces of this many bytes, so that a long
# text's own history does not outweigh the dictionary.
PIECE_BYTES = 2048
LEVEL = 3

_SCORED = T.StructType([T.StructField("score", T.DoubleType())])


@dataclass(frozen=True)
class CompressionModel:
    """Dictionaries of good and bad text and the curve over :func:`differences`."""

    good: bytes
    bad: bytes
    intercept: float
    slope: float

    def probabilities(self, found: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(found * self.slope + self.intercept, -40, 40)))


class _Compressors:
    def __init__(self, good: bytes, bad: bytes):
        self.trained = []
        for content in (good, bad):
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_AUTO)
            known.precompute_compress(level=LEVEL)
            self.trained.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known))

    def difference(self, text: bytes) -> float:
        """Normalised difference of a text's compressed sizes: positive where the good dictionary knows it better."""
        good = bad = 0
        for first in range(0, max(len(text), 1), PIECE_BYTES):
            piece = text[first : first + PIECE_BYTES]
            good += len(self.trained[0].compress(piece))
            bad += len(self.trained[1].compress(piece))
        return (bad - good) / (bad + good)


def differences(texts: list[str], good: bytes, bad: bytes) -> np.ndarray:
    compressors = _Compressors(good, bad)
    return np.array([compressors.difference(t.encode()) for t in texts])


def _dictionary(texts: list[bytes]) -> bytes:
    pieces = [t[i : i + PIECE_BYTES] for t in texts for i in range(0, len(t), PIECE_BYTES)]
    wanted = min(DICTIONARY_BYTES, sum(map(len, pieces)) // 2)
    try:
        return zstandard.train_dictionary(wanted, pieces).as_bytes()
    except zstandard.ZstdError:
        # Too few or too uniform samples for training: the texts themselves serve.
        return b"\n".join(pieces)[-DICTIONARY_BYTES:] or b"\n" * 8


def _curve(found: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic regression by Newton steps; both labels weigh the same."""
    mean, scale = found.mean(), found.std() + 1e-9
    x = np.column_stack([np.ones(len(found)), (found - mean) / scale])
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((labels == 0).sum(), 1)) * len(labels)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (labels - p)) - 0.1 * w
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] - w[1] * mean / scale), float(w[1] / scale)


def _fit(samples: dict[int, list[tuple[int, str]]]) -> CompressionModel | None:
    """A model from hashes and texts of either label; every fourth hash fits the curve."""
    if not all(samples.values()):
        warnings.warn("a label has no text to learn from: every score will be 0.5", stacklevel=3)
        return None
    known, tried = {}, {}
    for label, texts in samples.items():
        known[label] = [text for place, text in texts if place % 4] or [text for _, text in texts]
        tried[label] = [text for place, text in texts if place % 4 == 0] or known[label]
    good, bad = (_dictionary([t.encode() for t in known[label]]) for label in (1, 0))
    found = differences(tried[0] + tried[1], good, bad)
    labels = np.array([0] * len(tried[0]) + [1] * len(tried[1]))
    return CompressionModel(good, bad, *_curve(found, labels))


def score(docs: DataFrame, model: CompressionModel | None) -> DataFrame:
    """``docs`` with ``score``, the probability that a text is good.

    Nothing but ``text`` is an input. Null counts as empty; an empty text has
    a score like any other, equal texts have equal scores, and so no tie needs to
    be decided. Without a model (no labelled text of one of the labels, which
    ``train`` warns of) every score is 0.5. A column named ``score``, in any case,
    is replaced; an empty table gives no rows.
    """
    rows = docs.select(*others(docs, ["score"]))
    if model is None:
        return rows.withColumn("score", F.lit(0.5))
    place = rows.columns.index("text")
    out = T.StructType([*rows.schema.fields, *_SCORED.fields])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _Compressors(model.good, model.bad)
        for batch in batches:
            found = np.array([compressors.difference(t.as_py().encode()) for t in texts_of(batch.column(place))])
            scores = pa.array(model.probabilities(found))
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=out.names)

    return rows.mapInArrow(giving_back(scored), out)


def held_out(key: str = "doc_id") -> str:
    """SQL condition of the third of ids that labels are never learned from."""
    return f"coalesce(crc32(encode(CAST(`{key}` AS STRING), 'utf-8')) % 3 = 1, true)"


def model_from(docs: DataFrame, labels: DataFrame) -> CompressionModel | None:
    """A model from ``labels(doc_id, quality)`` and the texts they belong to; ``None`` where a label has no text.

    Of each label the ``TRAINING_TEXTS`` distinct texts with the smallest hashes
    are learned from, of longer ones a passage of ``TRAINING_CHARS`` code points at
    a place the hash gives. This bounds what is learned from, not what is scored.
    Copies count once, however many there are; a text labelled both ways counts
    for both. Rows of the held-out third, null ids, null labels and empty texts
    are left out.

    The join with the labels carries hashes, never texts; the texts drawn are
    fetched by at most two times ``TRAINING_TEXTS`` broadcast ids.
    """
    learned = labels.filter(f"NOT {held_out()} AND quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    texts = docs.filter("length(text) > 0").select("doc_id", F.col("text").cast("string").alias("text"))
    hashed = texts.select("doc_id", F.xxhash64("text").alias("place"))
    distinct = hashed.join(learned, "doc_id").groupBy("quality", "place").agg(F.min("doc_id").alias("doc_id"))
    drawn = [distinct.filter(F.col("quality") == label).orderBy("place").limit(TRAINING_TEXTS) for label in (0, 1)]
    chosen = drawn[0].unionAll(drawn[1])
    begin = F.expr(f"CASE WHEN length(text) > {TRAINING_CHARS} THEN 1 + pmod(place, length(text) - {TRAINING_CHARS} + 1) ELSE 1 END")
    passage = F.col("text").substr(begin.cast("int"), F.lit(TRAINING_CHARS)).alias("passage")
    fetched = texts.join(F.broadcast(chosen), "doc_id").filter("place = xxhash64(text)").select("quality", "place", passage)
    fetched = fetched.dropDuplicates(["quality", "place"])
    samples: dict[int, dict[int, str]] = {0: {}, 1: {}}
    for row in fetched.toLocalIterator():
        samples[row.quality][row.place] = row.passage
    return _fit({label: sorted(found.items()) for label, found in samples.items()})
