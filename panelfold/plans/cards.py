"""The six report cards over the store's tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelfold.functions.scalars import category_rank
from panelfold.operators.combine import left_join_where
from panelfold.operators.models import FORECAST_NAME, RISK_NAME
from panelfold.operators.trends import burden_score, mean_by_dimension

# Order of risk categories.
RISK_ORDER = ("Critical", "High", "Medium", "Low")
# The names under which the modelling job stores its results.
RISK_MODEL = RISK_NAME
FORECAST_MODEL = FORECAST_NAME

KEY = "country_code"


def life_trend(tables: Mapping[str, DataFrame], since: int = 1990) -> DataFrame:
    """Mean life expectancy per region and year."""
    facts = tables["fact_life_expectancy"].where(F.col("year") >= since)
    means = mean_by_dimension(facts, tables["dim_countries"], KEY, ["year"], ["region"], {"avg_le": "life_expectancy_total"})
    return means.withColumn("avg_le", F.round("avg_le", 2)).orderBy("year", "region")


def double_burden(tables: Mapping[str, DataFrame], year: int = 2019, n: int = 30) -> DataFrame:
    """The countries with the highest combined burden.

    One row per country of the dimension.  Only the epidemic average is of one year.
    """
    sources = {
        "avg_hiv_prev": (tables["fact_hiv_aids"].where(F.col("year") == year), "prevalence_pct"),
        "avg_cvd_rate": (tables["fact_cardiovascular"], "age_std_death_rate"),
        "avg_diab_prev": (tables["fact_diabetes_obesity"], "diabetes_prevalence_pct"),
    }
    score = F.col("avg_hiv_prev") * 10 + F.col("avg_cvd_rate") / 50 + F.col("avg_diab_prev")
    dim = tables["dim_countries"].select(KEY, "country_name", "region")
    top = burden_score(dim, sources, KEY, score, n, ["country_name", KEY])
    return top.withColumnRenamed("score", "double_burden_score").drop(KEY)


def gender_gap(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Female minus male life expectancy and physicians per region and year, widest gap first."""
    facts = tables["fact_life_expectancy"].na.drop(subset=["life_expectancy_female", "life_expectancy_male"])
    columns = {
        "gender_gap_years": F.col("life_expectancy_female") - F.col("life_expectancy_male"),
        "physicians_per_1000": F.col("physicians_per_1000"),
    }
    means = mean_by_dimension(facts, tables["dim_countries"], KEY, ["year"], ["region"], columns)
    return means.withColumns(
        {"gender_gap_years": F.round("gender_gap_years", 2), "physicians_per_1000": F.round("physicians_per_1000", 3)}
    ).orderBy(F.col("gender_gap_years").desc(), "region", "year")


def risk_distribution(predictions: DataFrame, model: str = RISK_MODEL) -> DataFrame:
    """Countries per predicted risk category and the mean confidence, in the fixed order."""
    return (
        predictions.where(F.col("model_name") == model)
        .groupBy("predicted_risk_cat")
        .agg(
            F.count(F.lit(1)).alias("country_count"),
            F.round(F.avg("risk_probability") * 100, 1).alias("avg_confidence_pct"),
        )
        .orderBy(category_rank("predicted_risk_cat", RISK_ORDER))
    )


def model_metrics(metrics: DataFrame, model: str = RISK_MODEL) -> DataFrame:
    """Scores of one model."""
    return metrics.where(F.col("model_name") == model).select("model_name", "top_features", "accuracy", "f1_score")


def forecast_vs_actual(
    tables: Mapping[str, DataFrame], predictions: DataFrame, year: int = 2022, model: str = FORECAST_MODEL
) -> DataFrame:
    """Forecast with bounds next to the actual value of ``year``, where there is one.

    Pass ``model`` for forecasts stored under another name than those of ``operators.models``.
    """
    mine = predictions.where(F.col("model_name") == model).join(
        tables["dim_countries"].select(KEY, "country_name", "region"), KEY, "inner"
    )
    actual = tables["fact_life_expectancy"].select(KEY, F.col("life_expectancy_total").alias(f"actual_le_{year}"), "year")
    joined = left_join_where(mine, actual, [KEY], F.col("year") == year)
    forecast = f"forecast_le_{year + 1}"
    return joined.select(
        KEY,
        "country_name",
        "region",
        F.col("predicted_le_total").alias(forecast),
        F.col("predicted_le_lower").alias("ci_lower"),
        F.col("predicted_le_upper").alias("ci_upper"),
        f"actual_le_{year}",
    ).orderBy(F.col(forecast).desc(), KEY)
