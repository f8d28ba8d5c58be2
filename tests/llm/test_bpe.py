"""Byte-level BPE against the tiktoken library, and round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from panelfold.llm import bpe
from panelfold.llm.queries import QUERIES

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return bpe._vocabulary(f.read(), P.PATTERN)


def odd_texts():
    r = random.Random(5)
    return [
        "", " ", "a", "a" * 5000, "ab" * 3000, " " * 3000 + "x", "\n\n \t x", "日本語テキスト" * 50, "!" * 700, "🙂" * 300, "don't we'll 12345678901234",
        "<|endoftext|> hi", "a" * 1500 + "b" * 900, "".join(r.choice("abcde \n1'!é") for _ in range(20000)),
        "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(900)),
    ]


def test_same_ids_as_the_library(vocabulary, library):
    texts = odd_texts() * 2
    ids, counts = bpe.Encoder(vocabulary).encode(texts)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts):
        assert ids[end - n : end].tolist() == library.encode_ordinary(text)
    assert bpe.decode_flat(vocabulary, ids, counts).to_pylist() == [t.encode() for t in texts]


def test_long_and_short_ways_agree(vocabulary):
    r = random.Random(1)
    for _ in range(30):
        piece = "".join(r.choice("thearonig") for _ in range(r.randint(2, 300))).encode()
        assert bpe._merge_long(vocabulary, piece).tolist() == bpe._merge_matrix(vocabulary, [piece], len(piece))[0].tolist()


def test_a_long_text_splits_like_a_short_one(vocabulary, monkeypatch):
    text = "".join(random.Random(2).choice(["word ", "x  ", "\n\n", " 12 ", "it's "]) for _ in range(5000))
    whole = vocabulary.pattern.findall(text)
    monkeypatch.setattr(bpe, "_CHUNK", 100)
    assert bpe.split_text(vocabulary, text) == whole


def test_forgetting_pieces_changes_nothing(vocabulary, monkeypatch):
    texts = odd_texts()
    want = bpe.Encoder(vocabulary).encode(texts)[0].tolist()
    monkeypatch.setattr(bpe, "_KEPT", 3)
    coder = bpe.Encoder(vocabulary)
    assert [i for t in texts for i in coder.encode([t])[0].tolist()] == want


def test_columns_nulls_and_repeats(spark, docs, library):
    rows = [(1, "Hello world"), (2, None), (None, ""), (1, "Hello world"), (3, "x" * 200_000)]
    out = bpe.encode_documents(docs(rows), PATH, P.PATTERN, decoded="back")
    assert out.columns == ["doc_id", "text", "h", "row_key", "first", "score_", "ids", "back"]
    for r in out.collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()
    again = bpe.decode_documents(out.select("doc_id", "text", "ids"), PATH, P.PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in again)
    assert bpe.encode_documents(docs([]), PATH, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_documents(docs(rows), PATH, P.PATTERN, ids="H")


def test_query(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op1_byte_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
