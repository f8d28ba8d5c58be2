"""The flat analytic panel: one wide row per (country, year)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelfold.operators.combine import star_join
from panelfold.operators.shape import require

# Panel columns per fact, as {panel name: store name}.
LIFE = {
    c: c
    for c in (
        "life_expectancy_total", "life_expectancy_male", "life_expectancy_female", "infant_mortality_per_1000",
        "under5_mortality_per_1000", "adult_mortality_male_per_1000", "adult_mortality_female_per_1000",
        "physicians_per_1000", "hospital_beds_per_1000", "health_expenditure_pct_gdp",
    )
}
CARDIO = {
    "cvd_deaths_total": "deaths_total",
    "cvd_deaths_per_100k": "deaths_per_100k",
    "cvd_dalys_per_100k": "dalys_per_100k",
    "cvd_share_of_deaths_pct": "share_of_deaths_pct",
    "high_sbp_deaths": "high_sbp_deaths",
    "high_cholesterol_deaths": "high_cholesterol_deaths",
    "smoking_deaths": "smoking_deaths",
    "obesity_deaths": "obesity_deaths",
}
EPIDEMIC = {
    "hiv_prevalence_pct": "prevalence_pct",
    "hiv_deaths_total": "aids_deaths_total",
    "art_coverage_pct": "pct_on_antiretroviral",
}
METABOLIC = {
    c: c
    for c in (
        "diabetes_prevalence_pct", "diabetes_deaths_per_100k", "obesity_prevalence_pct", "overweight_prevalence_pct",
        "child_obesity_pct", "mean_bmi_male", "mean_bmi_female", "diabetes_health_spend_usd",
    )
}
MEASURES = [*LIFE, *CARDIO, *EPIDEMIC, *METABOLIC]
CATEGORIES = ["region", "income_group"]
TARGET = "life_expectancy_total"


def _part(fact: DataFrame, names: dict[str, str]) -> DataFrame:
    return fact.select("country_code", "year", *[F.col(src).cast("double").alias(out) for out, src in names.items()])


def flat_panel(dim: DataFrame, life: DataFrame, cardio: DataFrame, epidemic: DataFrame, metabolic: DataFrame) -> DataFrame:
    """Inner join of the facts and the dimension: 2 keys, 29 measures and 2 categories.

    Rows need a target value and a region.
    """
    facts = [_part(life, LIFE), _part(cardio, CARDIO), _part(epidemic, EPIDEMIC), _part(metabolic, METABOLIC)]
    panel = star_join(dim.select("country_code", *CATEGORIES), facts, "country_code", "year")
    panel = require(panel, not_null=[TARGET, "region"]).where(F.col("region") != "")
    return panel.select("country_code", "year", *MEASURES, *CATEGORIES)
