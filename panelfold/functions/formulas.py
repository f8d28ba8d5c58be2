"""Derived indicators.  Every coefficient is a named entry that callers can override."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelfold.functions.scalars import clip, half_even, half_even_long, positive_or

# Coefficients of the derived indicators.
COEFFICIENTS: Mapping[str, float] = {
    "dalys_per_rate": 2.15,
    "share_scale": 31.5,
    "share_min": 12.0,
    "share_max": 58.0,
    "cholesterol_per_sbp": 0.68,
    "obesity_per_sbp": 0.52,
    "adult_share": 0.62,
    "min_people_living": 10.0,
    "children_living": 0.055,
    "new_child": 0.075,
    "orphaned": 1.65,
    "prevalence_base": 3.5,
    "prevalence_per_death_rate": 0.16,
    "prevalence_per_obesity": 0.22,
    "prevalence_min": 2.0,
    "prevalence_max": 26.0,
    "overweight_per_obesity": 1.85,
    "overweight_min": 6.0,
    "overweight_max": 85.0,
    "child_per_obesity": 0.36,
    "bmi_male_base": 22.2,
    "bmi_male_per_obesity": 0.16,
    "bmi_female_base": 22.8,
    "bmi_female_per_obesity": 0.18,
    "spend_base": 125.0,
    "spend_per_prevalence": 48.0,
    "gender_offset": 2.5,
}


def rate_per(count: Column, population: Column, scale: float) -> Column:
    """Events per ``scale`` inhabitants; NULL for an unknown or zero population."""
    return F.try_divide(count, population) * F.lit(float(scale))


def cardio_indicators(rate: str, sbp: str, mean_rate: Column, k: Mapping[str, float] = COEFFICIENTS) -> dict[str, Column]:
    """Burden and risk-factor columns from an age-standardised rate and a blood-pressure column.

    ``mean_rate`` is the overall mean of ``rate``; a missing or zero mean counts as 1.
    """
    r, s = F.col(rate), F.col(sbp)
    mean = F.coalesce(F.when(mean_rate != 0, mean_rate), F.lit(1.0))
    return {
        "deaths_per_100k": r,
        "dalys_per_100k": half_even(r * k["dalys_per_rate"], 4),
        "share_of_deaths_pct": half_even(
            clip(F.lit(k["share_scale"]) * (r / mean), k["share_min"], k["share_max"]), 4
        ),
        "high_cholesterol_deaths": half_even(s * k["cholesterol_per_sbp"], 4),
        "obesity_deaths": half_even(s * k["obesity_per_sbp"], 4),
    }


def epidemic_indicators(
    prevalence: str,
    deaths: str,
    new_cases: str,
    death_rate: str,
    population: str,
    k: Mapping[str, float] = COEFFICIENTS,
) -> dict[str, Column]:
    """Rates, people living with the disease and the estimates for children.

    The estimates read ``deaths`` and ``new_cases`` before those are rounded to whole counts.
    """
    p, d, n, pop = (F.col(c) for c in (prevalence, deaths, new_cases, population))
    living = F.rint(clip(p / 100.0 * (pop * k["adult_share"]), lo=k["min_people_living"]))
    return {
        "aids_deaths_per_100k": half_even(positive_or(death_rate, rate_per(d, pop, 100_000)), 4),
        "new_infections_per_1000": half_even(rate_per(n, pop, 1000), 4),
        "people_living_with_hiv": living.cast("bigint"),
        "children_living_with_hiv": half_even_long(living * k["children_living"]),
        "new_child_infections": half_even_long(n * k["new_child"]),
        "children_orphaned_by_aids": half_even_long(d * k["orphaned"]),
        "aids_deaths_total": half_even_long(d),
        "new_infections_total": half_even_long(n),
    }


def diabetes_prevalence(prevalence: str, death_rate: str, obesity: str, k: Mapping[str, float] = COEFFICIENTS) -> Column:
    """The given prevalence where positive, else a bounded linear estimate."""
    estimate = (
        F.lit(k["prevalence_base"])
        + F.col(death_rate) * k["prevalence_per_death_rate"]
        + F.col(obesity) * k["prevalence_per_obesity"]
    )
    return half_even(positive_or(prevalence, clip(estimate, k["prevalence_min"], k["prevalence_max"])), 4)


def metabolic_indicators(prevalence: str, death_rate: str, obesity: str, k: Mapping[str, float] = COEFFICIENTS) -> dict[str, Column]:
    """Weight, body-mass and spending columns.  ``prevalence`` is the completed one."""
    o = F.col(obesity)
    return {
        "diabetes_age_std_rate": half_even(death_rate, 4),
        "overweight_prevalence_pct": half_even(
            clip(o * k["overweight_per_obesity"], k["overweight_min"], k["overweight_max"]), 4
        ),
        "child_obesity_pct": half_even(o * k["child_per_obesity"], 4),
        "mean_bmi_male": half_even(F.lit(k["bmi_male_base"]) + o * k["bmi_male_per_obesity"], 3),
        "mean_bmi_female": half_even(F.lit(k["bmi_female_base"]) + o * k["bmi_female_per_obesity"], 3),
        "diabetes_health_spend_usd": half_even(
            F.lit(k["spend_base"]) + F.col(prevalence) * k["spend_per_prevalence"], 2
        ),
    }


def gendered_life(total: str, male: str, female: str, k: Mapping[str, float] = COEFFICIENTS) -> dict[str, Column]:
    """Fill a missing or non-positive male or female value from the total."""
    t = F.col(total)
    return {
        male: positive_or(male, half_even(t - k["gender_offset"], 3)),
        female: positive_or(female, half_even(t + k["gender_offset"], 3)),
    }


def gap(a: str, b: str) -> Column:
    return F.col(a) - F.col(b)


def midpoint(a: str, b: str) -> Column:
    return (F.col(a) + F.col(b)) / 2.0


def product_index(a: str, b: str, scale: float = 1.0) -> Column:
    return F.col(a) * F.col(b) / F.lit(float(scale))


def safe_ratio(a: str, b: str) -> Column:
    """``a / b``, NULL where ``b`` is zero."""
    return F.try_divide(F.col(a), F.col(b))


def engineered_features() -> dict[str, Column]:
    """The five engineered columns of the flat panel."""
    return {
        "gender_le_gap": gap("life_expectancy_female", "life_expectancy_male"),
        "mean_bmi_overall": midpoint("mean_bmi_male", "mean_bmi_female"),
        "metabolic_risk_index": product_index("diabetes_prevalence_pct", "obesity_prevalence_pct", 100.0),
        "healthcare_density": product_index("physicians_per_1000", "health_expenditure_pct_gdp"),
        "cvd_burden_ratio": safe_ratio("cvd_deaths_per_100k", "cvd_dalys_per_100k"),
    }
