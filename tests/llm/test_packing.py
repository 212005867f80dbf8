"""Pieces against the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ebbmark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [e.ids + [1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_hold_every_id_once(spark, documents):
    rows = documents.collect()
    ids = {r.doc_id: found for r, found in zip(rows, expected_ids([r.text for r in rows]))}
    pieces = packing.pack(documents, PATH).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    by_doc = defaultdict(list)
    for p in pieces:
        assert p.length & (p.length - 1) == 0 and p.length <= 2048 and p.offset == 0 and 1 << p.bucket == p.length
        by_doc[p.doc_id].append(p)
    assert by_doc.keys() == ids.keys()
    for doc_id, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        at = 0
        for p in own:
            part = np.array(ids[doc_id][at : at + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32, bytes(p.ids)) == (at, len(ids[doc_id]), zlib.crc32(part), part)
            at += p.length
        assert at == len(ids[doc_id])


def test_odd_texts_are_encoded_alike():
    texts = ["a  b\n c\t d", "x  ", "\n\n a", "a　b 　 c", "it's  'll", "<|endoftext|> a", "hello <|endoftext|> world<|endoftext|><|endoftext|>\n  <|endoftext", "12 3  4\r\n 5", "", "\0\x1c é"]
    found = [np.frombuffer(packing.token_ids(t, PATH), "<u4").tolist() + [1] for t in texts]
    assert found == expected_ids(texts)


def test_added_tokens_are_one_id():
    ids = np.frombuffer(packing.token_ids("hello <|endoftext|> world", PATH), "<u4").tolist()
    assert len(ids) == 4 and 50256 in ids


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 4096, 10_000])
def test_lengths_are_binary_digits(n):
    lengths = packing.piece_lengths(n)
    assert sum(lengths) == n and all(x & (x - 1) == 0 for x in lengths) and lengths == sorted(lengths, reverse=True)
    short = [x for x in lengths if x < 2048]
    assert len(short) == len(set(short))


def test_odd_rows(odd, nothing):
    pieces = packing.pack(odd.selectExpr("*", "1 AS start", "2 AS ids"), PATH).collect()
    tokens = defaultdict(int)
    for p in pieces:
        tokens[p.doc_id] += p.length
    ids = expected_ids([None, "one", " \t\n ", "é中\U0001f600 𝒳 "])
    assert tokens[5] == 1 and tokens[3] == 1
    assert tokens[2] == 2 * len(ids[1]) and tokens[7] == len(ids[2]) and tokens[1] == len(ids[3])
    assert packing.pack(nothing, PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(nothing, PATH, most=1000)
