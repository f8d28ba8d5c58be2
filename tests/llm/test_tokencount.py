"""Token counts against the tokenizers library's unigram model over the same pieces."""

import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from panelfold.llm import tokencount as C
from panelfold.llm.queries import QUERIES


@pytest.fixture(scope="module")
def pieces():
    return C.read_vocabulary(P.path("piece_bpe_32k.model"))


def library(pieces):
    least = min(s for _, s in pieces)
    bytes_ = [(f"<0x{b:02X}>", least) for b in range(256)]
    t = Tokenizer(models.Unigram([("<unk>", least), *bytes_, *pieces], unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=C.MARK, prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def odd():
    r = random.Random(2)
    return [" ", "  ", "a", " a", "a ", "▁▁x", "日本語 🙂 x\n\ny\t", "x" * 500, " ".join("".join(r.choice("abcé🙂▁ \n") for _ in range(12)) for _ in range(200)), "<0x41> <unk> <s>"]


def test_odd_texts(pieces):
    count = library(pieces)
    assert C.Counter(pieces).texts(odd())[:, 0].tolist() == [count(t) for t in odd()]


def test_ties(pieces):
    """Scores of few different values, so that many segmentations tie."""
    r = random.Random(8)
    for _ in range(40):
        some = {"".join(r.choice("ab▁") for _ in range(r.randint(1, 4))) for _ in range(12)}
        vocabulary = tuple((p, float(-r.randint(1, 3))) for p in sorted(some))
        count = library(vocabulary)
        texts = ["".join(r.choice("ab c") for _ in range(r.randint(1, 30))) for _ in range(30)]
        assert C.Counter(vocabulary).texts(texts)[:, 0].tolist() == [count(t) for t in texts]


def test_edge_rows(docs, pieces):
    out = C.count_tokens(docs([(1, None), (2, ""), (3, "ein Wort"), (3, "ein Wort"), (4, "lang " * 50_000)]), pieces)
    assert out.columns[-2:] == ["n_tokens", "n_unknown_bytes"]
    got = {r.doc_id: (r.n_tokens, r.n_unknown_bytes) for r in out.collect()}
    count = library(pieces)
    assert got == {1: (0, 0), 2: (0, 0), 3: (count("ein Wort"), 0), 4: (count("lang " * 50_000), 0)}
    assert C.count_tokens(docs([]), pieces).count() == 0


def test_query(spark, sf, pieces):
    count = library(pieces)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op3_token_counts"](spark, sf).collect()} == {i: count(t) if t else 0 for i, t in texts.items()}
