"""Words, shingles and code points of many texts at a time, as numpy arrays.

The operators that leave the JVM get Arrow batches; these helpers work on
slices of a batch of about a megabyte, so that memory follows the longest
single text and not the batch.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbmark.sources.scratch import scratch_folder, scratch_scope

SLICE_BYTES = 1 << 20

# The white space that ends a word, [\x20\x09-\x0D].
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def stored(frame: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """The frame written below the shared scratch folder and read again.

    Cuts the lineage: what follows rereads files if an executor is lost.
    """
    path = f"{scratch_folder(spark)}-{name}-{uuid.uuid4().hex[:8]}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def stored_alone(make: Callable[[], Sequence[DataFrame]], spark: SparkSession, *names: str) -> list[DataFrame]:
    """The frames that ``make`` returns, each ``stored``; what it stored on the way is removed."""
    paths = [f"{scratch_folder(spark)}-{name}-{uuid.uuid4().hex[:8]}" for name in names]
    schemas = []
    with scratch_scope(spark):
        for frame, path in zip(make(), paths, strict=True):
            schemas.append(frame.schema)
            frame.write.parquet(path)
    return [spark.read.schema(schema).parquet(path) for schema, path in zip(schemas, paths)]


def give_back() -> None:
    """Hands memory that is free within this process back to the system."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    # Only some C libraries have it.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same work of a Python task, which gives memory back at its end.

    Workers are used again by later tasks and jobs; what they keep adds up on an executor.
    """

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            # By name, so that a worker clears its own module's tables.
            give_back()

    return whole


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.StringArray:
    """A text column with nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def slices(texts: pa.StringArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes of text; a longer text stands alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first, done = 0, 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, done + most, "right")))
        yield first, last
        first, done = last, int(ends[last - 1])


def raw_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins (one more at the end)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    if offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a multiply and shift finalizer)."""
    h = h + np.uint64((salt * _ODD + 0x632BE59BD9B4E019) & _MASK)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@cache
def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(256, dtype=np.uint64), 7)
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"][:n]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts.

    ``starts`` and ``ends`` are byte positions over all texts, ``rows`` the
    text of each word, ``bounds`` the first word of each text (one more at the
    end). Texts that end without white space do not run into the next.
    """

    def __init__(self, texts: pa.StringArray):
        self.data, self.offsets = raw_bytes(texts)
        solid = ~_space_table()[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate(([False], solid[:-1])) & ~edge[:-1]
        after = np.concatenate((solid[1:], [False])) & ~edge[1:]
        self.starts = np.flatnonzero(solid & ~before)
        self.ends = np.flatnonzero(solid & ~after) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)
        self.rows = np.repeat(np.arange(len(texts)), self.counts)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of the bytes between each start and end; ``lower`` folds A-Z first."""
        up, down = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_byte_values(lower)[self.data] * up[:-1], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])

    def hashes(self, lower: bool = False) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends, lower)


@cache
def _space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SPACES)] = True
    return table


def shingles(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words, their rows and first words; a shorter text is one run."""
    n = len(hashes)
    whole = np.zeros(n, np.uint64)
    for k in range(min(size, n)):
        whole[: n - k] += mix(hashes[k:], k + 1)
    full = np.zeros(n, bool)
    if n >= size:
        full[: n - size + 1] = words.rows[: n - size + 1] == words.rows[size - 1 :]
    at = np.flatnonzero(full)
    keys, rows, places = [mix(whole[at])], [words.rows[at]], [at - words.bounds[words.rows[at]]]
    for length in range(1, min(size, n + 1)):
        short = np.flatnonzero(words.counts == length)
        if len(short):
            first = words.bounds[short]
            total = np.full(len(short), length, np.uint64)
            for k in range(length):
                total += mix(hashes[first + k], k + 1)
            keys.append(mix(total, 99))
            rows.append(short)
            places.append(np.zeros(len(short), np.int64))
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(places)


def distinct_pairs(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys without repeats within a row, ordered by row and key."""
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return keys[fresh], rows[fresh]


def code_points(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, and where each begins (one more at the end)."""
    data, offsets = raw_bytes(texts)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return points, heads[offsets]


# Bits of a membership filter: a million words of 64, whatever the input.
FILTER_BITS = 1 << 26


def membership(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap in which the hash of every value of a column is set.

    Of a size that does not grow with the data: a value not met before may be
    let through, one that is there never stays out.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    words = ids.groupBy(F.shiftright(bit, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({column}), 64) AS INT))")).alias("bits")
    )
    found = words.toArrow()
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    del found
    give_back()
    return bitmap


def may_hold(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether values with these hashes (``xxhash64``) are in a membership filter."""
    return (bitmap[(hashes % FILTER_BITS) >> 6] >> (hashes & 63) & 1).astype(bool)


def sums_by_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each row, rows being given by where they begin."""
    totals = np.zeros(len(values) + 1, values.dtype if values.dtype.kind in "fu" else np.int64)
    np.cumsum(values, out=totals[1:])
    return totals[offsets[1:]] - totals[offsets[:-1]]
