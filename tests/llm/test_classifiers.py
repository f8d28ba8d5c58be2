"""Toxicity and quality on held-out labels, and their edge cases."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelfold.llm import quality, toxicity
from panelfold.llm.queries import QUERIES

FULL = "/root/testdata/sf0.1"


def invented(n=1200, seed=4):
    """(row, text, label): some words occur only in texts of label 1, copies have many words in common."""
    r = random.Random(seed)
    common = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    bad = ["vile", "nasty", "rotten"]
    rows = []
    for i in range(n):
        words = r.choices(common, k=r.randint(5, 120))
        label = int(r.random() < 0.3)
        if label:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randint(0, len(words)), r.choice(bad))
        rows.append((i, " ".join(words), label))
    copy = rows[0][1]
    return rows + [(n + k, copy + " " + r.choice(common), rows[0][2]) for k in range(100)]


@pytest.fixture(scope="module")
def models(spark):
    return toxicity.fit(spark.createDataFrame(invented(), "row long, text string, toxic int"), "toxic")


def test_both_models_are_distributions(models):
    words = np.exp(models.word).sum(axis=1)
    assert np.allclose(words, 1)
    size = models.word.shape[1]
    for c in (0, 1):
        for v in np.unique(models.pairs // size)[:20]:
            at = np.nonzero(models.pairs // size == v)[0]
            w = models.pairs[at] % size
            total = np.exp(models.pair[c, at]).sum() + np.exp(models.rest[c, v]) * (1 - np.exp(models.word[c, w]).sum())
            assert math.isclose(total, 1, rel_tol=1e-6)


def test_toxic_words_decide(spark, models, docs):
    rows = [(i, t) for i, t, _ in invented(seed=9)]
    label = {i: y for i, _, y in invented(seed=9)}
    scored = toxicity.score_texts(docs(rows), models, details=True).collect()
    right = np.mean([(r.score >= 0.7) == label[r.doc_id] for r in scored])
    assert right > 0.97 and all(0 <= r.score <= 1 for r in scored)


def test_rare_words_say_nothing(models):
    e = models.evidence(["qqq zzz xxx", "vile qqq"])
    assert abs(e[0, 1] - e[0, 0]) < 1 < 2 < e[1, 2]


def test_edge_rows(models, docs):
    rows = [(1, None), (2, ""), (3, "12 !!"), (4, "vile " * 50_000), (5, "vile"), (5, "vile")]
    out = toxicity.score_texts(docs(rows), models)
    assert out.columns == ["doc_id", "text", "h", "row_key", "first", "score_", "score"]
    got = {r.doc_id: r.score for r in out.collect()}
    assert got[1] == got[2] == got[3] and got[4] > 0.7 and got[5] > 0.7 and all(0 <= s <= 1 for s in got.values())
    assert toxicity.score_texts(docs([]), models).count() == 0
    with pytest.raises(ValueError):
        toxicity.score_texts(docs(rows), models, score="H")


@pytest.mark.parametrize("labels", [[], [0] * 30, [1] * 30])
def test_without_both_classes(spark, docs, labels):
    rows = spark.createDataFrame([(i, f"text {i} of some words", y) for i, y in enumerate(labels)], "row long, text string, label int")
    prior = toxicity.fit(rows, "label")
    assert {round(r.score, 6) for r in toxicity.score_texts(docs([(1, "a b"), (2, None)]), prior).collect()} == {round((sum(labels) + 1) / (len(labels) + 2), 6)}
    rules = quality.fit(rows, "label")
    assert rules.rules == () and {round(r.score, 6) for r in quality.score_texts(docs([(1, "a b"), (2, None)]), rules).collect()} == {round((sum(labels) + 1) / (len(labels) + 2), 6)}


def test_training_rows_are_bounded_and_reduced(spark, docs):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (3, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs([(1, "a"), (3, None), (4, "d")]), labels, "toxic", F.lit(True))
    assert sorted((r.row, r.text, r.toxic) for r in rows.collect()) == [(1, "a", 1), (3, "", 0)]
    many = spark.createDataFrame([(i, 0) for i in range(100)], "doc_id long, toxic int")
    assert toxicity.training_rows(docs([(i, "t") for i in range(100)]), many, "toxic", F.lit(True), most=10).count() == 10


def slow_holds(rule, statistic):
    return all(statistic[s] <= t if below else statistic[s] > t for s, below, t in rule)


def test_compiled_rules_equal_the_plain_reading(spark, docs):
    rules = (((("letters", False, 0.5), ("log_words", True, 3.0)), 1.5), ((("upper", False, 0.2),), -2.0))
    ensemble = quality.Ensemble(rules, 0.25)
    rows = [(1, "SOME LOUD text"), (2, "quiet words | and | bars"), (3, ""), (4, None), (5, "w " * 50_000), (6, "12 34!!")]
    df = docs(rows)
    statistics = {r.doc_id: r.asDict() for r in df.select("doc_id", *[c.alias(n) for n, c in quality.statistics(F.coalesce("text", F.lit(""))).items()]).collect()}
    for r in quality.score_texts(df, ensemble).collect():
        z = 0.25 + sum(w for rule, w in rules if slow_holds(rule, statistics[r.doc_id]))
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)))
    assert all(v == 0 for n, v in statistics[3].items() if n not in ("doc_id", "distinct_lines"))
    assert statistics[1]["upper"] == 8 / 12 and statistics[1]["distinct_words"] == 1.0 and statistics[2]["bars"] == 2 / 6


def test_tree_rules_are_paths():
    text = "\n".join(
        ["  Tree 0 (weight 1.0):", "    If (feature 0 <= 1.5)", "     If (feature 0 <= 0.5)", "      Predict: 0.0", "     Else (feature 0 > 0.5)", "      Predict: 1.0",
         "    Else (feature 0 > 1.5)", "     If (feature 1 <= 2.0)", "      Predict: 1.0", "     Else (feature 1 > 2.0)", "      Predict: 0.0"]
    )
    assert quality.tree_rules(text, ["a", "b"]) == [
        (("a", True, 1.5),), (("a", True, 0.5),), (("a", False, 0.5), ("a", True, 1.5)), (("a", False, 1.5),), (("a", False, 1.5), ("b", True, 2.0)), (("a", False, 1.5), ("b", False, 2.0)),
    ]


def test_quality_has_no_python_in_its_plan(docs):
    plan = quality.score_texts(docs([(1, "a")]).coalesce(1), quality.Ensemble((((("upper", False, 0.2),), -2.0),), 0.25))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def auc(score, label):
    order = np.argsort(np.argsort(score))
    n = label.sum()
    return (order[label == 1].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


@pytest.mark.parametrize("name,column,parts,rest,least", [("op2_quality", "quality", 4, 2, 0.99), ("op7_toxicity", "toxic", 3, 1, 0.85)])
def test_queries_on_held_out_labels(spark, name, column, parts, rest, least):
    rows = QUERIES[name](spark, FULL).toPandas()
    documents = spark.read.parquet(f"{FULL}/documents.parquet").select("doc_id").toPandas()
    assert sorted(rows["doc_id"]) == sorted(documents["doc_id"])
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % parts == rest for i in rows["doc_id"]]).all()
    assert (rows["predicted"] == (rows["score"] >= 0.7)).all() and rows["score"].between(0, 1).all()
    labels = spark.read.parquet(f"{FULL}/labels.parquet").toPandas().merge(rows, on="doc_id")
    held = labels[labels["held_out"]]
    assert auc(held["score"].to_numpy(), held[column].to_numpy()) > least
    if name == "op7_toxicity":  # clean documents are left alone
        assert held[held["toxic"] == 0]["predicted"].mean() < 0.02
