"""The pipeline's stages, each against its operator, and on odd tables."""

import pytest

import corpus_pipeline as C
from panelfold.llm import decontaminate, repeats, simhash, toxicity
from panelfold.llm.common import stage
from panelfold.llm.queries import toxicity_models


def test_stages_in_order():
    assert [n for n, _ in C.STAGES] == ["toxicity", "simhash", "suffix_dedup", "decontaminate", "byte_bpe"]


def test_each_stage_takes_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, step in C.STAGES:
        out = stage(step(spark, docs, sf), "test")
        before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before) and len(after) == out.count()
        gone = set(before) - set(after)
        if name == "toxicity":
            scores = toxicity.score_texts(docs, toxicity_models(spark, docs.select("doc_id", "text"), sf)).collect()
            assert gone == {r.doc_id for r in scores if r.score >= 0.7}
        elif name == "simhash":
            assert gone == {r.doc_id for r in simhash.near_duplicates(docs).collect() if r.doc_id != r.component_id} and gone
        elif name == "suffix_dedup":
            kept = {r.doc_id: bytes(r.kept).decode("utf-8", "ignore") for r in repeats.remove_repeats(docs).collect()}
            assert not gone and {i: r.text for i, r in after.items()} == kept
            assert all(r.n_chars == len(r.text) for i, r in after.items() if r.text != before[i].text)
        elif name == "decontaminate":
            assert gone == {r.doc_id for r in decontaminate.find_items(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()} and gone
        if name != "byte_bpe":
            assert out.columns == columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        else:
            assert not gone and all(r.n_tokens == len(r.ids) // 4 for r in after.values())
        docs = out


def test_run(spark, sf):
    out = C.run(spark, sf)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_tokens"] and out.count() > 100


@pytest.mark.parametrize("name,step", C.STAGES)
def test_odd_rows(spark, sf, name, step):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, ids_ int"
    rows = [(1, None, None, None, None, None, None), (None, "some words here", "en", "s", 3, "k", 1), (2, "", "en", "s", 0, "k", 1), (3, "other words there", None, "s", 17, "k", 2), (3, "other words there", None, "s", 17, "k", 2)]
    docs = spark.createDataFrame(rows, schema)
    out = step(spark, docs, sf)
    assert out.columns[: len(docs.columns)] == docs.columns and out.count() >= 2
    assert step(spark, docs.where("false"), sf).count() == 0


def test_leaks_are_told_by_row(spark, tmp_path):
    item = "the quick brown fox jumps over the lazy dog while the other animals of the farm sleep"
    spark.createDataFrame([(None, item), (3, "another item of some eight words or more here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = [(None, f"we saw {item} today"), (1, f"{item} again"), (1, "a clean text that shares its id"), (None, "clean without an id"), (2, f"{item[:40]} only")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(texts)], "doc_id long, text string, row int")
    out = C.drop_leaks(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and sorted(r.row for r in out.collect()) == [2, 3, 4]


def test_one_row_of_each_group_of_copies_stays_whatever_its_id(spark, sf):
    texts = [" ".join(f"{w}{k}" for k in range(60)) for w in ("alpha", "beta", "gamma")]
    ids = [(5, 0), (None, 0), (5, 0), (9, 0), (7, 1), (7, 1), (None, 2), (None, 2), (7, 2)]
    docs = spark.createDataFrame([(i, texts[t], "x") for i, t in ids[:8]], "doc_id long, text string, row string").repartition(3)
    out = C.drop_near_copies(spark, docs, sf)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, texts.index(r.text)) for r in out.collect()) == [(0, 2), (5, 0), (7, 1)]
    # An id that two texts share does not make them copies.
    docs = spark.createDataFrame([(i, texts[t]) for i, t in ids], "doc_id long, text string")
    assert sorted((r.doc_id, texts.index(r.text)) for r in C.drop_near_copies(spark, docs, sf).collect()) == [(5, 0), (7, 1), (7, 2)]
