"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two, the
binary digits of n, with ``SEQUENCE`` as the largest. Every piece is a sequence
of its own, so that no sequence crosses documents and none needs padding;
pieces of equal length make a bucket, from which batches of one shape are drawn.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbmark.llm.arrays import giving_back, slices, texts_of

SEQUENCE = 2048
END_ID = 1

_PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
# Fixed value: how this vocabulary's tokenizer cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def _tokenizer(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of a tokenizer file, behind the quicker of two equal encoders.

    The ids are those of the ``tokenizers`` library. An added token's string in a
    text is that token, and what stands before and after it is cut by itself.
    """
    file = json.loads(Path(path).read_text(encoding="utf-8"))
    vocabulary, added = file["model"]["vocab"], {t["content"]: t["id"] for t in file["added_tokens"]}
    if any(t.get(flag) for t in file["added_tokens"] for flag in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError(f"{path} has added tokens that take in the text around them")
    # In such files printable Latin bytes stand for themselves, the others for 256, 257, ...
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    value = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {bytes(value[c] for c in piece): i for piece, i in vocabulary.items() if all(c in value for c in piece)}
    # An added token's own string is no product of merges: its id is no rank.
    for content in added:
        ranks.pop(content.encode(), None)
    return tiktoken.Encoding("of-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


def token_ids(text: str, path: str) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit numbers."""
    return array("I", _tokenizer(path).encode(text, allowed_special="all")).tobytes()


def piece_lengths(n: int, most: int = SEQUENCE) -> list[int]:
    """Lengths of the pieces of n tokens, longest first: n // ``most`` full ones, then binary digits."""
    full, rest = divmod(n, most)
    return [most] * full + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer_path: str, most: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece, with its token ids as little-endian 32-bit ``ids``.

    ``sequence_id`` numbers the sequences and is unique; ``bucket`` is the
    length class a sequence belongs to. A null or empty text is the end id
    alone. Rows are packed one by one: repeated rows have pieces of their own,
    a null ``doc_id`` stays null. Columns besides ``doc_id`` and ``text`` are
    ignored; an empty table gives no rows.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("the sequence length must be a power of two")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            texts = texts_of(batch.column(1))
            for first, last in slices(texts):
                rows: list[list] = [[] for _ in _PIECE.names]
                for i in range(first, last):
                    doc_id = batch.column(0)[i].as_py()
                    encoded = token_ids(texts[i].as_py(), tokenizer_path) + end
                    n, start = len(encoded) // 4, 0
                    for length in piece_lengths(n, most):
                        piece = encoded[4 * start : 4 * (start + length)]
                        for column, value in zip(rows, (doc_id, start, length, zlib.crc32(piece), n, piece)):
                            column.append(value)
                        start += length
                arrays = [pa.array(v, t) for v, t in zip(rows, [pa.int64()] * 5 + [pa.binary()])]
                yield pa.RecordBatch.from_arrays(arrays, names=_PIECE.names)

    pieces = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(giving_back(packed), _PIECE)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
        "ids",
    )
