"""The modelling job: features, split, three regressors, scores, champion and artefacts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelfold.functions.formulas import engineered_features
from panelfold.operators import features as fe
from panelfold.operators import models as m
from panelfold.plans.star import CATEGORIES, TARGET
from panelfold.schemas import TABLES
from panelfold.session import stage
from panelfold.sources import sinks

# Keys, target and columns derived from it, which are no features.
EXCLUDE = (
    "country_code", "year", "life_expectancy_total", "life_expectancy_male", "life_expectancy_female", "gender_le_gap",
)


# Regions and income classes are few; a panel with more of them is refused.
MOST_LEVELS = 1000


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    features: list[str]
    scaling: dict[str, tuple[float, float]]
    left_out: int  # rows with an unknown feature or target


def engineered(panel: DataFrame) -> DataFrame:
    """Every row of the panel with its engineered columns, categories as they are."""
    return panel.withColumns(engineered_features())


def feature_panel(panel: DataFrame, levels: Mapping[str, list[str]] | None = None) -> DataFrame:
    """The panel with engineered columns and 0/1 columns for its categories."""
    return fe.one_hot(engineered(panel), levels or fe.levels_of(panel, CATEGORIES, MOST_LEVELS))


def prepare(panel: DataFrame, by_entity: bool = False, levels: Mapping[str, list[str]] | None = None) -> Prepared:
    """Split 80/20 and fit the scaling on the training part only.

    Splitting by row puts neighbouring years of one country on both sides; ``by_entity`` keeps a
    country together.  Rows with an unknown feature are left out, as the models need all of them, and counted.
    """
    table = stage(feature_panel(panel, levels), "features")
    names = fe.feature_list(table.columns, EXCLUDE)
    known = table.na.drop(subset=[*names, TARGET])
    left_out = table.count() - known.count()
    table = known
    share = fe.split_share(["country_code"] if by_entity else ["country_code", "year"])
    train, test = fe.train_test(table, share)
    return Prepared(train, test, names, fe.fit_zscore(train, names), left_out)


def train_all(p: Prepared, forest: Mapping | None = None, boosted: Mapping | None = None) -> dict[str, tuple[m.Fitted, DataFrame]]:
    """Each model with its predictions on the test part.  Only ridge sees scaled features."""
    scaled_train, scaled_test = (fe.apply_zscore(d, p.scaling) for d in (p.train, p.test))
    ridge = m.fit_ridge(scaled_train, p.features, TARGET)
    trees = m.fit_forest(p.train, p.features, TARGET, **(forest or {}))
    boost = m.fit_boosted(p.train, p.features, TARGET, **(boosted or {}))
    return {
        ridge.name: (ridge, ridge.predict(scaled_test)),
        trees.name: (trees, trees.predict(p.test)),
        boost.name: (boost, boost.predict(p.test)),
    }


def scores(trained: Mapping[str, tuple[m.Fitted, DataFrame]]) -> DataFrame:
    return m.score_models({name: df for name, (_, df) in trained.items()}, TARGET)


def export(panel: DataFrame, p: Prepared, trained: Mapping[str, tuple[m.Fitted, DataFrame]], dim: DataFrame, folder: str) -> str:
    """Write panel, feature panel, predictions, models, scores and feature list; returns the champion's name."""
    spark = panel.sparkSession
    table = scores(trained)
    best = m.champion(table).first()["model"]
    sinks.replace_table(panel, f"{folder}/panel")
    sinks.replace_table(engineered(panel), f"{folder}/feature_panel")
    names = dim.select("country_code", "country_name", "region", "income_group")
    predicted = m.prediction_table(trained[best][1], ["country_code", "year"], TARGET, "prediction", names, "country_code", rounded=False)
    sinks.replace_table(predicted, f"{folder}/test_predictions")
    for name, (fitted, _) in trained.items():
        m.save_model(fitted, f"{folder}/models/{name.lower().replace(' ', '_')}")
    scaling = [(c, mean, sd) for c, (mean, sd) in p.scaling.items()]
    spark.createDataFrame(scaling, "feature string, mean double, sd double").coalesce(1).write.mode("overwrite").json(f"{folder}/scaling")
    sinks.write_metrics(table.withColumn("champion", F.col("model") == best), f"{folder}/scores")
    sinks.write_features(spark, p.features, f"{folder}/features")
    return best


# Measures the risk classifier sees; none of them enters the score its label comes from.
RISK_FEATURES = (
    "obesity_prevalence_pct", "life_expectancy_total", "infant_mortality_per_1000", "physicians_per_1000", "health_expenditure_pct_gdp",
    "high_sbp_deaths", "smoking_deaths", "mean_bmi_male",
)
FORECAST_FEATURES = ("infant_mortality_per_1000", "physicians_per_1000")


def burden(panel: DataFrame, out: str = "score") -> DataFrame:
    score = F.col("hiv_prevalence_pct") * 10 + F.col("cvd_deaths_per_100k") / 50 + F.col("diabetes_prevalence_pct")
    return panel.withColumn(out, score)


def _top(fitted: m.Fitted, df: DataFrame, n: int = 5) -> str:
    return ", ".join(r["feature"] for r in m.importance(fitted, df.sparkSession, n).collect())


def risk_job(panel: DataFrame, features: Sequence[str] = RISK_FEATURES, **settings) -> tuple[DataFrame, DataFrame]:
    """(predictions, metrics) of the risk classifier in the store's shape.

    Countries are split first; the quartiles behind the labels and the classifier are fitted on the training
    part, accuracy and f1 come from the other.  Every country's last complete year is predicted.
    """
    rows = stage(burden(panel).na.drop(subset=[*features, "score"]).select("country_code", "year", "score", *features), "risk-rows")
    train, test = fe.train_test(rows, fe.split_share(["country_code"]))
    bounds = m.risk_bounds(train, "score")
    fitted = m.fit_risk(m.risk_labels(train, "score", bounds), features, **settings)
    scored = m.classifier_scores(fitted, m.risk_labels(test, "score", bounds)) if test.head(1) else {"accuracy": None, "f1": None}
    last = rows.groupBy("country_code").agg(F.max_by(F.struct(*features), "year").alias("r")).select("country_code", "r.*")
    metrics = _metrics(panel, fitted, accuracy=scored["accuracy"], f1_score=scored["f1"])
    return sinks.conform(m.risk_table(fitted, last, "country_code"), TABLES["ml_predictions"]), metrics


def forecast_job(life: DataFrame, year: int, features: Sequence[str] = FORECAST_FEATURES, **settings) -> tuple[DataFrame, DataFrame]:
    """(predictions, metrics) of the forecaster for the year after ``year``; a country it cannot answer for has NULLs."""
    f = m.fit_forecast(life, "country_code", "year", TARGET, features, **settings)
    table = m.forecast_table(f, life, "country_code", "year", TARGET, year)
    return sinks.conform(table, TABLES["ml_predictions"]), _metrics(life, f.fitted, rmse=f.rmse)


def _metrics(df: DataFrame, fitted: m.Fitted, **figures: float | None) -> DataFrame:
    row = {"model_name": fitted.name, "top_features": _top(fitted, df), **figures}
    schema = TABLES["ml_model_metrics"]
    return df.sparkSession.createDataFrame([tuple(row.get(f.name) for f in schema.fields)], schema)


def store_results(folder: str, *results: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Write the models' predictions and metrics as the two tables the report cards read."""
    predictions, metrics = (reduce(DataFrame.unionByName, parts) for parts in zip(*results))
    return sinks.replace_table(predictions, f"{folder}/ml_predictions"), sinks.replace_table(metrics, f"{folder}/ml_model_metrics")
