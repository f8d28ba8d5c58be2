import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelfold.operators import stats, trends


def test_constant_columns(spark, rows):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    assert rows(stats.correlate(df, "a", "b"))[0][0] is None
    line = stats.fit_line(df, "a", "b").first()
    assert line["slope"] == 0.0 and line["intercept"] == 5.0
    assert stats.fit_line(df, "b", "a").first()["slope"] is None


def test_matrix_pairwise_against_listwise(spark):
    data = [(1.0, 2.0, None), (2.0, 1.0, 5.0), (3.0, 5.0, 1.0), (4.0, 4.0, 2.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    get = lambda m: {(r["a"], r["b"]): r["r"] for r in m.collect()}
    pair, full = get(stats.correlation_matrix(df, ["a", "b", "c"])), get(stats.correlation_matrix(df, ["a", "b", "c"], complete_rows=True))
    arr = np.array(data, dtype=float)
    assert math.isclose(pair["a", "b"], np.corrcoef(arr[:, 0], arr[:, 1])[0, 1])
    assert math.isclose(full["a", "b"], np.corrcoef(arr[1:, 0], arr[1:, 1])[0, 1])
    assert len(pair) == 9 and pair["b", "a"] == pair["a", "b"] and math.isclose(pair["c", "c"], 1.0)


def test_box_whiskers_and_outliers(spark, rows):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    r = stats.box_stats(df, ["g"], "v").first()
    assert (r["n"], r["q1"], r["median"], r["q3"], r["low_whisker"], r["high_whisker"], r["outliers"]) == (5, 2.0, 3.0, 4.0, 1.0, 4.0, 1)
    assert rows(stats.box_outliers(df, ["g"], "v")) == [("g", 100.0)]


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(3).normal(0, 1, 500)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r["n"] for r in stats.histogram(df, "v", 40).orderBy("bin").collect()]
    assert got == np.histogram(values, 40)[0].tolist()
    flat = stats.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4).orderBy("bin").collect()
    assert sum(r["n"] for r in flat) == 2 and len(flat) == 4
    assert stats.histogram(df.limit(0), "v").count() == 0


def test_minmax_and_steps(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 7.0), ("b", 3.0, 7.0)], "g string, x double, y double")
    out = rows(trends.minmax_profile(df, ["x", "y"]))
    assert [r[2] for r in out] == [0.0, 0.0] and abs(out[1][1] - 1) < 1e-8
    assert rows(trends.minmax_profile(df.limit(0), ["x"])) == []
    series = spark.createDataFrame([(1, 5.0), (2, 4.0), (3, 6.0)], "t int, v double")
    assert [r[2] for r in rows(trends.step_change(series, [], "t", ["v"], floor=0.0))] == [None, 0.0, 2.0]


def test_mean_by_dimension_equals_join_then_average(spark, rows):
    facts = spark.createDataFrame([("a", 1, 1.0), ("a", 1, None), ("b", 1, 4.0), ("c", 1, 7.0), ("x", 1, 100.0)], "k string, t int, v double")
    dim = spark.createDataFrame([("a", "R"), ("b", "R"), ("c", "S")], "k string, g string")
    out = trends.mean_by_dimension(facts, dim, "k", ["t"], ["g"], {"m": "v"})
    plain = facts.join(dim, "k").groupBy("g", "t").agg(F.avg("v").alias("m"))
    assert rows(out) == rows(plain) == [("R", 1, 2.5), ("S", 1, 7.0)]


def test_first_last_and_lags(spark, rows):
    df = spark.createDataFrame([("a", 2, 5.0), ("a", 1, 2.0), ("a", 3, 9.0)], "k string, t int, v double")
    assert rows(trends.first_last_change(df, ["k"], "t", "v")) == [("a", 2.0, 9.0, 3, 7.0)]
    assert [r[3:] for r in rows(trends.lag_features(df, ["k"], "t", "v"))] == [(None, None, None), (2.0, None, 3.0), (5.0, 2.0, 4.0)]


def test_burden_needs_every_part_for_a_score(spark, rows):
    dim = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "k string, n string")
    f = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    g = spark.createDataFrame([("a", 10.0)], "k string, w double")
    out = trends.burden_score(dim, {"f": (f, "v"), "g": (g, "w")}, "k", F.col("f") + F.col("g"), 30, ["n"])
    assert [tuple(r) for r in out.select("k", "score").collect()] == [("a", 11.0), ("b", None)]


@pytest.mark.parametrize("rate", [0.0, None])
def test_share_of_a_missing_mean(spark, rate):
    df = spark.createDataFrame([(rate,)], "r double")
    got = df.select(trends.share_of_mean(df, "r", 31.5, 12.0, 58.0).alias("s")).first()["s"]
    assert got == (12.0 if rate == 0.0 else None)


def test_all_pairs_in_one_pass(spark):
    """Forty columns with gaps, against numpy pair by pair."""
    import numpy as np

    from panelfold.operators.stats import correlation_matrix

    r = np.random.default_rng(8)
    x = r.normal(size=(400, 40)) + 1e6 * r.normal(size=40)
    x[:, 1] = 2 * x[:, 0] + 3
    x[:, 2] = 0.1  # constant
    x[r.random(x.shape) < 0.2] = np.nan
    x[:, 3] = np.nan  # never known
    x[:200, 4], x[200:, 5] = np.nan, np.nan  # never together
    names = [f"v{i}" for i in range(40)]
    rows = [[None if np.isnan(v) else float(v) for v in row] for row in x]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(g.a, g.b): g.r for g in correlation_matrix(df, names).collect()}
    assert len(got) == 1600
    for i in range(40):
        for j in range(40):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            want = np.corrcoef(a, b)[0, 1] if both.sum() > 1 and np.ptp(a) > 0 and np.ptp(b) > 0 else None
            assert (got[names[i], names[j]] is None) == (want is None), (i, j)
            assert want is None or abs(got[names[i], names[j]] - want) < 1e-9
    known = names[6:12]
    listwise = {(g.a, g.b): g.r for g in correlation_matrix(df, known, complete_rows=True).collect()}
    full = x[:, 6:12][~np.isnan(x[:, 6:12]).any(axis=1)]
    assert all(abs(listwise[a, b] - np.corrcoef(full, rowvar=False)[i, j]) < 1e-9 for i, a in enumerate(known) for j, b in enumerate(known))
    assert all(g.r is None for g in correlation_matrix(df.where("false"), names[:3]).collect())
