"""Token files against the library, and what a reader asks of them."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from panelfold.llm import queries
from panelfold.llm.tokenfiles import Encoder, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
MADE = open(PATH, encoding="utf-8").read()
ODD = [
    "", " ", "a", " a", "a ", "a  b", "a \n b", "a\n b", "a \nb", "\na", "a\n", "\n\na", "foo.\nBar, baz!", "it's 's  's we'll", "x  y", "x  y", "a\x1c b",
    "<|endoftext|> <|endoftext|>", "ünï 1 22 3.5 ..!? \t\tz", "漢字 かな 🙂 é", "a" * 3000, "\r\n x\r\n", " \n", "\n", "a\n\n b", "straße. ÅÄÖ;", "a.b a's. x's b!'s c.\n\td", "word##' y@@ \nz!!",
]


def _library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def _ids(text):
    return _library().encode(text or "", add_special_tokens=False).ids


def _lists(ids, n):
    return [part.tolist() for part in np.split(ids, np.cumsum(n)[:-1])] if len(n) else []


def test_encoder_equals_the_library():
    assert _lists(*Encoder(MADE)(pa.array(ODD))) == [_ids(t) for t in ODD]
    plain = [t for t in ODD if t and "  " not in t and not {"\n", " "} & {t[0], t[-1]} and " \n" not in t and "\n " not in t] * 2
    encode = Encoder(MADE)
    for texts in (plain, plain[::-1], [None, "a b"], []):
        assert _lists(*encode(pa.array(texts, pa.string()), b"\x07\0\0\0")) == [[*_ids(t), 7] for t in texts]
    assert Encoder(MADE).by_stretch


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    e = Encoder(open(path, encoding="utf-8").read())
    assert not e.by_stretch
    assert _lists(*e(pa.array(ODD))) == [t.encode(x, add_special_tokens=False).ids for x in ODD]


@pytest.fixture(scope="module")
def rows():
    each = [(k * 7 % 26, t, f"s{k % 3}") for k, t in enumerate(ODD)]
    return [*each, (None, "no id", "s0"), (None, None, None), (5, "same id", "s1"), (5, "same id", "s1"), (99, "word " * 40_000, "s2")]


def test_files(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    files = write_tokens(docs, str(tmp_path / "t"), PATH, end_id=0)
    got = files.read().toArrow().to_pylist()
    assert sorted((r["doc_id"] or -1, r["source"] or "", r["tokens"]) for r in got) == sorted((i or -1, s or "", [*_ids(t), 0]) for i, t, s in rows)
    got.sort(key=lambda r: r["start"])
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)
    ends = np.cumsum([len(r["tokens"]) for r in got])
    assert [r["start"] for r in got] == [0, *ends[:-1]] and [r["n_tokens"] for r in got] == [len(r["tokens"]) for r in got]
    # Reading part by part gives the same order.
    stored = [v for part in sorted((tmp_path / "t/ids").glob("part-*")) for v in pq.read_table(part)["tokens"].to_pylist()]
    assert stored == [r["tokens"] for r in got]
    sums = {(r["start"], r["n_tokens"]): r["ids_crc32"] for r in files.checksums().collect()}
    assert sums == {(r["start"], r["n_tokens"]): zlib.crc32(np.array(r["tokens"], "<u4").tobytes()) for r in got}


def test_selective_reads(spark, tmp_path):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text number ', id) AS text")
    files = write_tokens(docs, str(tmp_path / "t"), PATH)
    some = files.read(1000, 1009)
    plan = some._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,1000), LessThanOrEqual(doc_id,1009)" in plan.replace(", IsNotNull(part)", "")
    assert sorted((r.doc_id, r.tokens) for r in some.collect()) == [(k, [*_ids(f"text number {k}"), 0]) for k in range(1000, 1010)]
    assert "tokens:array" not in files.metadata()._jdf.queryExecution().executedPlan().toString()
    part = next((tmp_path / "t/ids").glob("part-*"))
    group = pq.ParquetFile(part).metadata.row_group(0)
    for k in range(group.num_columns):
        column = group.column(k)
        assert column.has_column_index and column.has_offset_index
        if column.path_in_schema.startswith("tokens"):
            assert any("DICTIONARY" in e or "DELTA" in e for e in column.encodings)


def test_empty_and_refused(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    files = write_tokens(docs, str(tmp_path / "t"), PATH)
    assert files.checksums().collect() == [] and files.metadata().columns == ["doc_id", "n_tokens", "start"]
    with pytest.raises(ValueError):
        write_tokens(spark.createDataFrame([(1, "a", 1)], "doc_id long, text string, Part int"), str(tmp_path / "u"), PATH)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    start, want = 0, []
    for r in sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()):
        ids = [*_ids(r.text), 0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = queries.QUERIES["op13_token_files"](spark, sf)
    assert sorted(map(tuple, found.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want
