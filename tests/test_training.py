"""The modelling job on a panel derived from the given tables."""

import pytest
from pyspark.sql import functions as F

from panelfold.checks import testbed as tb
from panelfold import schemas
from panelfold.plans import cards, star, training, views
from panelfold.sources import sinks

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def panel(spark):
    return tb.stored_panel(spark, SF_DIR)


def test_shape(panel):
    assert len(panel.columns) == 33 and panel.count() > 50
    # 26 measures without the target and its parts, 4 engineered columns and 7 dummies
    assert panel.groupBy("country_code", "year").count().where("count > 1").count() == 0
    table = training.feature_panel(panel)
    names = [c for c in table.columns if c not in training.EXCLUDE]
    assert len(names) == 37
    assert names[:3] == ["infant_mortality_per_1000", "under5_mortality_per_1000", "adult_mortality_male_per_1000"]
    assert names[26:30] == ["mean_bmi_overall", "metabolic_risk_index", "healthcare_density", "cvd_burden_ratio"]
    assert not {"region_AFRICA", "income_group_High income"} & set(names)
    assert len(star.MEASURES) == 29


def test_split_by_country_keeps_countries_apart(panel):
    p = training.prepare(panel, by_entity=True)
    assert p.train.join(p.test, "country_code", "left_semi").count() == 0
    assert p.train.count() + p.test.count() == panel.na.drop().count()


def test_whole_job(spark, panel, tmp_path):
    p = training.prepare(panel)
    trained = training.train_all(p, forest={"numTrees": 10, "maxDepth": 5}, boosted={"maxIter": 5, "maxDepth": 3})
    table = training.scores(trained)
    assert {r["model"] for r in table.collect()} == set(trained)
    assert table.where(F.col("n") != p.test.count()).count() == 0
    best = training.export(panel, p, trained, tb.dim_countries(spark, SF_DIR), str(tmp_path))
    assert best == table.orderBy(F.col("r2").desc()).first()["model"]
    assert sinks.read_features(spark, str(tmp_path / "features")) == p.features
    predictions = spark.read.parquet(str(tmp_path / "test_predictions"))
    assert predictions.count() == p.test.count() and predictions.where("country_name IS NULL").count() == 0
    scores = spark.read.json(str(tmp_path / "scores"))
    assert scores.where("champion").select("model").first()[0] == best
    assert spark.read.parquet(str(tmp_path / "panel")).count() == panel.count()
    # the feature panel has every row, and the categories as they are
    features = spark.read.parquet(str(tmp_path / "feature_panel"))
    assert features.count() == panel.count() and set(panel.columns) < set(features.columns) and {"region", "income_group"} <= set(features.columns)
    assert p.left_out == panel.count() - panel.na.drop().count()


def test_models_fill_the_tables_that_the_cards_read(spark, panel, tmp_path):
    facts = tb.fact_life_expectancy(spark, SF_DIR)
    risk = training.risk_job(panel, numTrees=10, maxDepth=4)
    forecast = training.forecast_job(facts, 2000, maxIter=3, maxDepth=3)
    predictions, metrics = training.store_results(str(tmp_path), risk, forecast)
    assert [f.name for f in predictions.schema] == schemas.TABLES["ml_predictions"].names
    assert [f.name for f in metrics.schema] == schemas.TABLES["ml_model_metrics"].names
    distribution = cards.risk_distribution(predictions).collect()
    assert sum(r.country_count for r in distribution) == panel.na.drop(subset=[*training.RISK_FEATURES]).select("country_code").distinct().count()
    one = cards.model_metrics(metrics).collect()
    assert len(one) == 1 and 0 <= one[0].accuracy <= 1 and 0 <= one[0].f1_score <= 1 and one[0].top_features.count(",") == 4
    tables = {"dim_countries": tb.dim_countries(spark, SF_DIR), "fact_life_expectancy": facts}
    shown = cards.forecast_vs_actual(tables, predictions, 2000)
    assert shown.count() == facts.select("country_code").distinct().count()
    assert shown.where("forecast_le_2001 IS NOT NULL").count() > 0
    assert metrics.where("model_name = 'Boosted_LifeExpectancyForecaster'").first().rmse > 0


def test_views_check_their_columns(panel):
    with pytest.raises(ValueError):
        views.trend(panel, "country_code")
    with pytest.raises(ValueError):
        views.trend(panel, "mean_bmi_male", by="year")


def test_empty_radar(panel):
    assert views.radar(panel, 1890).count() == 0
    assert views.radar(panel, 1998, ["nowhere"]).count() == 0
