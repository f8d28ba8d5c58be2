import numpy as np
import pytest
from pyspark.sql import functions as F

from panelfold.operators import features as fe
from panelfold.operators import models as m


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, [1, 5, 20], (300, 3))
    y = x @ [2.0, -0.5, 0.1] + 30 + rng.normal(0, 0.3, 300)
    pdf = [(f"k{i // 10}", 1990 + i % 10, *map(float, x[i]), float(y[i])) for i in range(300)]
    return spark.createDataFrame(pdf, "k string, t int, a double, b double, c double, y double").cache()


def test_ridge_matches_closed_form(data):
    cols = ["a", "b", "c"]
    scaled = fe.apply_zscore(data, fe.fit_zscore(data, cols))
    fitted = m.fit_ridge(scaled, cols, "y", alpha=7.0)
    pdf = scaled.toPandas()
    z, y = pdf[cols].to_numpy(), pdf["y"].to_numpy()
    want = np.linalg.solve(z.T @ z + 7.0 * np.eye(3), z.T @ (y - y.mean()))
    assert np.allclose(fitted.model.coefficients.toArray(), want, atol=1e-9)
    assert abs(fitted.model.intercept - y.mean()) < 1e-9


def test_scaling_uses_training_rows_and_population_deviation(spark, data, rows):
    train = data.where("t < 1995")
    mean, sd = fe.fit_zscore(train, ["a"])["a"]
    a = train.toPandas()["a"]
    assert abs(mean - a.mean()) < 1e-12 and abs(sd - a.std(ddof=0)) < 1e-12
    flat = spark.createDataFrame([(2.0,), (2.0,)], "a double")
    assert rows(fe.apply_zscore(flat, fe.fit_zscore(flat, ["a"]))) == [(0.0,), (0.0,)]


def test_split_is_disjoint_and_whole(data):
    for keys in (["k", "t"], ["k"]):
        train, test = fe.train_test(data, fe.split_share(keys))
        assert train.count() + test.count() == 300 and test.count() > 0
        assert train.join(test, keys, "left_semi").count() == 0
        again, _ = fe.train_test(data.repartition(13), fe.split_share(keys))
        assert again.exceptAll(train).count() == 0


def test_one_hot_drops_the_first_level(spark, rows):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "g string, v int")
    out = fe.one_hot(df, fe.levels_of(df, ["g"], most=10))
    assert out.columns == ["v", "g_b", "g_c"]
    assert rows(out) == [(1, 1.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 1.0)]
    with pytest.raises(ValueError):
        fe.levels_of(df, ["g"], most=2)


def test_scores_and_champion(spark, rows):
    df = spark.createDataFrame([("p", 1.0, 1.0), ("p", 3.0, 3.0), ("q", 1.0, 2.0), ("q", 3.0, 2.0)], "model string, y double, p double")
    s = m.regression_scores(df, "y", "p", ["model"])
    got = {r["model"]: r for r in s.collect()}
    assert (got["p"]["r2"], got["p"]["rmse"], got["q"]["r2"], got["q"]["mae"]) == (1.0, 0.0, 0.0, 1.0)
    assert abs(got["q"]["mape"] - (1 + 1 / 3) / 2 * 100) < 1e-9
    assert m.champion(s).first()["model"] == "p"
    tie = spark.createDataFrame([("z", 0.5), ("a", 0.5)], "model string, r2 double")
    assert m.champion(tie).first()["model"] == "a"
    flat = m.regression_scores(df.withColumn("y", F.lit(1.0)), "y", "p", ["model"]).first()
    assert flat["r2"] is None


def test_trees_importance_and_saving(spark, data, tmp_path):
    cols = ["a", "b", "c"]
    forest = m.fit_forest(data, cols, "y", numTrees=5, maxDepth=4)
    boosted = m.fit_boosted(data, cols, "y", maxIter=5, maxDepth=3, stepSize=0.3)
    table = m.score_models({f.name: f.predict(data) for f in (forest, boosted)}, "y")
    assert {r["model"] for r in table.where("r2 > 0.5").collect()} == {"Random Forest", "Boosted Trees"}
    imp = m.importance(forest, spark).collect()
    assert {r["feature"] for r in imp} == set(cols) and abs(sum(r["importance_pct"] for r in imp) - 100) < 1e-9
    assert [r["importance_pct"] for r in imp] == sorted((r["importance_pct"] for r in imp), reverse=True)
    m.save_model(forest, str(tmp_path / "m"))
    again = m.load_model(str(tmp_path / "m"), forest.name, cols)
    assert again.predict(data).agg(F.sum("prediction")).first() == forest.predict(data).agg(F.sum("prediction")).first()


def test_risk_labels_weights_and_classifier(data):
    labelled = m.risk_labels(data, "y", m.risk_bounds(data, "y"))
    counts = {r[0]: r[1] for r in labelled.groupBy("risk").count().collect()}
    assert counts == {"Low": 75, "Medium": 75, "High": 75, "Critical": 75}
    w = m.balanced_weights(labelled.where("risk != 'Low' OR t < 1992"), "risk")
    totals = [r[0] for r in w.groupBy("risk").agg(F.round(F.sum("weight"), 6)).select("round(sum(weight), 6)").collect()]
    assert len(set(totals)) == 1
    fitted = m.fit_risk(labelled, ["a", "b", "c"], numTrees=10, maxDepth=5)
    assert m.classifier_scores(fitted, labelled)["accuracy"] > 0.7
    out = m.risk_table(fitted, labelled, "k")
    assert out.where("risk_probability < 0.25 OR risk_probability > 1").count() == 0
    assert {r[0] for r in out.select("predicted_risk_cat").distinct().collect()} <= set(m.RISK_LEVELS)


def test_forecast_bounds_hold_their_share(data):
    f = m.fit_forecast(data, "k", "t", "y", ["a"], coverage=0.8, maxIter=5, maxDepth=2)
    assert f.low < 0 < f.high and f.rmse > 0 and f.fitted.name == m.FORECAST_NAME
    last = data.agg(F.max("t")).first()[0]
    out = m.forecast_table(f, data, "k", "t", "y", last)
    assert out.count() == 30 and out.where("predicted_le_lower > predicted_le_total OR predicted_le_upper < predicted_le_total").count() == 0


def test_forecast_frame_follows_the_calendar(spark, rows):
    data = [("a", 1990, 1.0), ("a", 1992, 3.0), ("a", 1993, 4.0), ("a", 2020, 9.0), ("b", 1993, 5.0)]
    out = m.forecast_frame(spark.createDataFrame(data, "k string, t int, y double"), "k", "t", "y")
    assert rows(out, "k", "t", "y_lag1", "y_lag2", "next", "y_delta") == [
        ("a", 1990, None, None, None, None), ("a", 1992, None, 1.0, 4.0, None), ("a", 1993, 3.0, None, None, 1.0),
        ("a", 2020, None, None, None, None), ("b", 1993, None, None, None, None),
    ]
    with pytest.raises(Exception, match="repeated"):
        m.forecast_frame(spark.createDataFrame(data + [data[0]], "k string, t int, y double"), "k", "t", "y").collect()


def test_forecast_answers_for_one_year_and_names_the_rest(spark, data):
    f = m.fit_forecast(data, "k", "t", "y", ["a"], maxIter=2, maxDepth=2)
    years = sorted(r[0] for r in data.select("t").distinct().collect())
    gone = data.select("k").first()[0]
    rest = data.where((F.col("k") != gone) | (F.col("t") != years[-2]))
    out = {r.k: r.predicted_le_total for r in m.forecast_table(f, rest, "k", "t", "y", years[-2]).collect()}
    assert len(out) == 30 and out[gone] is None and all(v is not None for k, v in out.items() if k != gone)


def test_prediction_table_rounds_before_the_error(spark, rows):
    df = spark.createDataFrame([("a", 1, 10.0, 9.996), ("x", 1, 1.0, 2.0)], "k string, t int, y double, p double")
    dim = spark.createDataFrame([("a", "A")], "k string, n string")
    out = m.prediction_table(df, ["k", "t"], "y", "p", dim, "k")
    assert rows(out) == [("a", 1, 10.0, 10.0, 0.0, 0.0, "A"), ("x", 1, 1.0, 2.0, -1.0, 1.0, None)]
    raw = m.prediction_table(df, ["k", "t"], "y", "p", dim, "k", rounded=False)
    assert abs(rows(raw)[0][4] - 0.004) < 1e-9


def test_forest_is_grown_by_several_fits_of_few_tasks(spark, data, tmp_path, monkeypatch):
    for name, value in (("FEW_ROWS", 10), ("TASK_ROWS", 100), ("FIT_TREES", 4)):
        monkeypatch.setattr(m, name, value)
    seen = []
    for kind in (m.RandomForestRegressor, m.RandomForestClassifier):
        fit = kind.fit
        monkeypatch.setattr(kind, "fit", lambda self, rows, fit=fit: seen.append((self.getNumTrees(), rows.rdd.getNumPartitions(), self.getSeed())) or fit(self, rows))
    forest = m.fit_forest(data.repartition(7), ["a", "b", "c"], "y", numTrees=10, maxDepth=4)
    assert sorted(s[:2] for s in seen) == [(2, 3), (4, 3), (4, 3)] and len({s[2] for s in seen}) == 3
    assert len(forest.model.trees) == 10 and abs(sum(r[1] for r in m.importance(forest, spark).collect()) - 100) < 1e-9
    mean = sum(t.transform(m.assemble(data, ["a", "b", "c"])).selectExpr("sum(prediction)").first()[0] for t in forest.model.trees) / 10
    assert abs(forest.predict(data).selectExpr("sum(prediction)").first()[0] - mean) < 1e-6
    m.save_model(forest, str(tmp_path / "m"))
    again = m.load_model(str(tmp_path / "m"), forest.name, forest.features)
    assert len(again.model.trees) == 10 and again.predict(data).exceptAll(forest.predict(data)).count() == 0
    # every tree has every row: where trees have no choice, the forest is the group's mean
    whole = m.fit_forest(data.withColumn("p", F.col("t").cast("double")), ["p"], "y", numTrees=9, bootstrap=False, featureSubsetStrategy="all")
    got = whole.predict(data.withColumn("p", F.col("t").cast("double"))).groupBy("t").agg(F.max("prediction").alias("p"), F.avg("y").alias("y"))
    assert all(abs(r.p - r.y) < 1e-9 for r in got.collect())
    seen.clear()
    risk = m.fit_risk(data.withColumn("risk", F.element_at(F.array(*map(F.lit, m.RISK_LEVELS)), (F.col("t") % 4 + 1).cast("int"))), ["a", "b"], numTrees=6)
    assert len(seen) == 2 and len(risk.model.trees) == 6 and risk.model.numClasses == 4
    assert risk.predict(data).select("probability").first()[0].toArray().sum() > 0.999


def test_risk_is_predicted_once_for_both_scores(data, monkeypatch):
    rows = data.withColumn("risk", F.element_at(F.array(*map(F.lit, m.RISK_LEVELS)), (F.col("t") % 4 + 1).cast("int")))
    risk = m.fit_risk(rows, ["a", "b"], numTrees=3, maxDepth=3)
    judged = []
    scores = m.label_scores
    monkeypatch.setattr(m, "label_scores", lambda found: judged.append(found) or scores(found))
    got = m.classifier_scores(risk, rows)
    assert "UDF" not in judged[0]._jdf.queryExecution().optimizedPlan().toString()  # the trees are asked before
    pairs = [(m.RISK_LEVELS[int(r.prediction)], r.risk) for r in risk.predict(rows).collect()]
    assert abs(got["accuracy"] - sum(a == b for a, b in pairs) / len(pairs)) < 1e-9


def test_boosting_deals_its_rows_evenly(spark, data, monkeypatch):
    monkeypatch.setattr(m, "FEW_ROWS", 10)
    seen = []
    fit = m.GBTRegressor.fit
    monkeypatch.setattr(m.GBTRegressor, "fit", lambda self, rows: seen.append(rows.rdd.glom().map(len).collect()) or fit(self, rows))
    boosted = m.fit_boosted(data.coalesce(1), ["a", "b", "c"], "y", maxIter=2, maxDepth=2)
    assert len(seen[0]) == spark.sparkContext.defaultParallelism and sum(seen[0]) == 300 and max(seen[0]) - min(seen[0]) <= 1
    assert boosted.predict(data).count() == 300
