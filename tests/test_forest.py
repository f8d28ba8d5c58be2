import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelfold.operators import forest as by_node
from panelfold.operators import models as m

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.integers(0, 20, 900), rng.integers(0, 7, 900) / 4, rng.integers(0, 2, 900), rng.integers(0, 30, 900) * -1.5])
    y = x @ [0.5, 2.0, 5.0, 0.1] + x[:, 0] * x[:, 2] + rng.normal(0, 1, 900)
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, y double").repartition(4).cache()


@pytest.fixture
def small(monkeypatch):
    """Sizes from which a few hundred rows are many."""
    monkeypatch.setattr(m, "MANY_ROWS", 100)
    for name, value in (("BLOCK_ROWS", 64), ("BLOCKS_A_TASK", 3), ("NODE_ROWS", 250), ("SENT_BYTES", 30_000), ("COMMON_BYTES", 30_000), ("_LONG", 120), ("_ALONE", 40), ("_ROWS", 50), ("_NODES", 4)):
        monkeypatch.setattr(by_node, name, value)


def test_trees_without_draws_are_sparks(spark, data, small, monkeypatch):
    same = {"numTrees": 2, "maxDepth": 6, "minInstancesPerNode": 4, "bootstrap": False, "featureSubsetStrategy": "all"}
    own = m.fit_forest(data, COLS, "y", **same)
    assert isinstance(own, m.GrownForest)
    monkeypatch.setattr(m, "MANY_ROWS", 10_000)
    sparks = m.fit_forest(data, COLS, "y", **same)
    assert not isinstance(sparks, m.GrownForest)
    assert [(t.numNodes, t.depth) for t in own.model.trees] == [(t.numNodes, t.depth) for t in sparks.model.trees]
    # to the last split: what each row is told, and by which gains
    told = [[r[0] for r in f.predict(data).orderBy(*COLS, "y").select("prediction").collect()] for f in (own, sparks)]
    assert np.allclose(*told, rtol=0, atol=1e-9)
    shares = [dict(m.importance(f, spark).collect()) for f in (own, sparks)]
    assert all(abs(shares[0][c] - shares[1][c]) < 1e-9 for c in COLS)
    assert np.allclose(own.model.featureImportances.toArray(), sparks.model.featureImportances.toArray(), atol=1e-12)


def test_many_rows_are_never_given_to_a_fit_that_counts_every_node_in_every_task(spark, data, small, monkeypatch, tmp_path):
    seen, fit = [], m.RandomForestRegressor.fit
    monkeypatch.setattr(m.RandomForestRegressor, "fit", lambda self, rows: seen.append(rows.count()) or fit(self, rows))
    own = m.fit_forest(data, COLS, "y", numTrees=4, maxDepth=5)
    table = m.importance(own, spark).collect()
    assert seen == [] and abs(sum(r[1] for r in table) - 100) < 1e-9
    upper, below = own.trees.upper, own.trees.below
    # the sample of a tree has as many rows as the table, about; every node below the upper ones is one task's
    roots = upper.where("id = 0").select("n").unionByName(below.where("sub = 0 AND id = 0").select("n")).collect()
    assert len(roots) == 4 and all(abs(r[0] - 900) < 6 * math.sqrt(900) for r in roots) and len({r[0] for r in roots}) > 1
    assert below.agg(F.max("n")).first()[0] <= by_node.NODE_ROWS and upper.where("NOT sent AND n <= 250").count() == 0
    assert own.model.getNumTrees == 4 and set(seen) == {2}  # its settings alone
    assert np.allclose(own.model.featureImportances.toArray(), own.trees.shares(), atol=1e-12)
    m.save_model(own, str(tmp_path / "m"))
    again = m.load_model(str(tmp_path / "m"), own.name, COLS)
    assert again.predict(data).exceptAll(own.predict(data)).count() == 0
    assert m.regression_scores(own.predict(data), "y", "prediction").first()["r2"] > 0.8
    # the same rows, the same trees
    twice = m.fit_forest(data, COLS, "y", numTrees=4, maxDepth=5).trees
    nodes = ("tree", "id", "left", "right", "feature", "bin")
    assert all(a.select(*nodes).exceptAll(b.select(*nodes)).count() == 0 for a, b in ((twice.below, below), (twice.upper, upper)))


def test_draws_are_poisson_numbers():
    s = by_node.Settings(1, 5, 32, 2, 4, 1.0, 0.0, 1.0, 1.0)
    w = by_node._drawn(s, 3, 8, 200_000)
    assert np.array_equal(w, by_node._drawn(s, 3, 8, 200_000)) and not np.array_equal(w, by_node._drawn(s, 4, 8, 200_000))
    for k in range(6):
        p = math.exp(-1) / math.factorial(k)
        assert abs((w == k).mean() - p) < 5 * math.sqrt(p / len(w))


def test_thresholds_follow_sparks_rule():
    few = by_node._thresholds(np.array([1.0, 2.0, 5.0]), np.array([7, 1, 1]), 32)
    assert few.tolist() == [1.5, 3.5]
    many = by_node._thresholds(np.arange(1000.0), np.ones(1000, int), 32)
    assert len(many) == 31 and np.abs(many - np.arange(1, 32) * 1000 / 32 + 0.5).max() <= 1
    values, counts = by_node._fewer(np.arange(1e5), np.ones(100_000, int))
    assert len(values) <= by_node.POINTS and counts.sum() == 100_000 and values[-1] == 99_999


def test_unknown_labels_are_refused(spark, data, small):
    with pytest.raises(Exception, match="label"):
        m.fit_forest(data.withColumn("y", F.when(F.col("a") > 3, F.col("y"))), COLS, "y", numTrees=2, maxDepth=2)
