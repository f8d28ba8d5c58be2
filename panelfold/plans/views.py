"""Parameterised views: the data behind each chart.  An empty selection means all."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelfold.functions.scalars import category_rank
from panelfold.operators import shape, stats, trends
from panelfold.operators.combine import fact_to_fact
from panelfold.plans.etl import INCOME_GROUPS
from panelfold.session import stage

# Indicators a view may show, and the columns of the matrix, the radar and the cards.
INDICATORS = (
    "life_expectancy_total", "cvd_deaths_per_100k", "diabetes_prevalence_pct", "obesity_prevalence_pct",
    "infant_mortality_per_1000", "physicians_per_1000", "health_expenditure_pct_gdp", "hiv_prevalence_pct",
    "mean_bmi_male", "mean_bmi_female",
)
RADAR = (
    "cvd_deaths_per_100k", "diabetes_prevalence_pct", "obesity_prevalence_pct", "infant_mortality_per_1000",
    "hiv_prevalence_pct", "physicians_per_1000",
)
KPI = {
    "avg_life": "life_expectancy_total",
    "avg_cvd": "cvd_deaths_per_100k",
    "avg_diabetes": "diabetes_prevalence_pct",
    "avg_obesity": "obesity_prevalence_pct",
    "avg_physicians": "physicians_per_1000",
}
LIFE_MATRIX = (
    "life_expectancy_total", "infant_mortality_per_1000", "under5_mortality_per_1000", "adult_mortality_male_per_1000",
    "adult_mortality_female_per_1000", "physicians_per_1000", "hospital_beds_per_1000", "health_expenditure_pct_gdp",
    "neonatal_mortality_per_1000",
)
RISK_FACTORS = ("high_sbp_deaths", "high_cholesterol_deaths", "smoking_deaths", "obesity_deaths")
METABOLIC_TREND = ("diabetes_prevalence_pct", "obesity_prevalence_pct", "overweight_prevalence_pct")
RISK_PERIODS = (1990, 2005)

Values = Iterable[str] | None


def _chosen(panel: DataFrame, years: tuple[int, int], regions: Values = None, incomes: Values = None) -> DataFrame:
    rows = shape.period_between(panel, "year", *years)
    return shape.select_filters(rows, {"region": regions, "income_group": incomes})


def kpi(panel: DataFrame, years: tuple[int, int] = (2000, 2022), regions: Values = None, incomes: Values = None) -> DataFrame:
    return trends.kpi_cards(_chosen(panel, years, regions, incomes), "country_code", KPI)


def world_map(panel: DataFrame, indicator: str, year: int, regions: Values = None) -> DataFrame:
    c = shape.checked_column(indicator, INDICATORS)
    rows = shape.select_filters(shape.snapshot(panel, "year", year), {"region": regions})
    return shape.require(rows, [c]).select("country_code", "region", "income_group", c)


def trend(
    panel: DataFrame, indicator: str, by: str = "region", years: tuple[int, int] = (1990, 2022), chosen: Values = None
) -> DataFrame:
    c = shape.checked_column(indicator, INDICATORS)
    g = shape.checked_column(by, ("region", "income_group"))
    rows = shape.select_filters(shape.period_between(panel, "year", *years), {g: chosen})
    return trends.mean_by(rows, ["year", g], {c: c})


def scatter(
    panel: DataFrame, x: str, y: str, extra: Sequence[str] = (), years: tuple[int, int] = (2000, 2022), regions: Values = None
) -> DataFrame:
    """Points with every shown column known."""
    rows = _chosen(panel, years, regions)
    columns = list(dict.fromkeys([x, y, *extra]))
    return shape.require(rows, columns).select("country_code", "year", "region", "income_group", *columns)


def scatter_lines(
    panel: DataFrame, x: str, y: str, by: str = "region", extra: Sequence[str] = (), years: tuple[int, int] = (2000, 2022),
    regions: Values = None,
) -> DataFrame:
    """Least squares line per group over the points of ``scatter``."""
    return stats.fit_line(scatter(panel, x, y, extra, years, regions), x, y, [by])


def boxes(panel: DataFrame, indicator: str, by: str = "region", years: tuple[int, int] = (2000, 2022), regions: Values = None) -> DataFrame:
    c = shape.checked_column(indicator, INDICATORS)
    return stats.box_stats(_chosen(panel, years, regions), [by], c, derived=False)  # filters that reach the stored panel


def correlation(panel: DataFrame, years: tuple[int, int] = (2000, 2022), regions: Values = None, columns: Sequence[str] = INDICATORS) -> DataFrame:
    """Matrix over rows with every indicator known, two digits."""
    return stats.correlation_matrix(_chosen(panel, years, regions), columns, complete_rows=True, digits=2)


def ranking(panel: DataFrame, indicator: str, year: int, n: int, bottom: bool = False, regions: Values = None) -> DataFrame:
    c = shape.checked_column(indicator, INDICATORS)
    rows = shape.select_filters(shape.snapshot(panel, "year", year), {"region": regions})
    rows = shape.require(rows, [c]).select("country_code", "region", "income_group", c)
    return shape.top_n(rows, c, n, ["country_code"], ascending=bottom)


def income_distribution(panel: DataFrame, indicator: str, year: int) -> DataFrame:
    """Box statistics per income group in their natural order; not filtered by region."""
    c = shape.checked_column(indicator, INDICATORS)
    out = stats.box_stats(shape.snapshot(panel, "year", year), ["income_group"], c, derived=False)
    return out.withColumn("rank", category_rank("income_group", INCOME_GROUPS)).orderBy("rank")


def gender_gap_trend(panel: DataFrame, years: tuple[int, int] = (1990, 2022), regions: Values = None) -> DataFrame:
    rows = _chosen(panel, years, regions)
    gap = F.col("life_expectancy_female") - F.col("life_expectancy_male")
    return trends.mean_by(rows, ["year", "region"], {"gender_gap": gap})


def income_trend(panel: DataFrame, indicator: str, years: tuple[int, int] = (1990, 2022), incomes: Values = None) -> DataFrame:
    return trend(panel, indicator, "income_group", years, incomes)


def radar(panel: DataFrame, year: int, regions: Values = None, columns: Sequence[str] = RADAR) -> DataFrame:
    """Regional means of one year, each scaled over the regions; no rows when nothing is selected."""
    rows = shape.select_filters(shape.snapshot(panel, "year", year), {"region": regions})
    return trends.minmax_profile(trends.mean_by(rows, ["region"], {c: c for c in columns}), columns)


def composition(dim: DataFrame, by: str) -> DataFrame:
    """Countries per category, with shares."""
    return trends.share_by(dim, shape.checked_column(by, ("region", "income_group")))


def enriched(fact: DataFrame, dim: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """A fact with attributes of the dimension; same-named fact columns give way."""
    return fact.drop(*attributes).join(dim.select("country_code", *attributes), "country_code", "inner")


def year_snapshot(fact: DataFrame, dim: DataFrame, year: int) -> DataFrame:
    return enriched(shape.snapshot(fact, "year", year), dim, ["country_name", "region", "income_group"])


def latest_bubble(fact: DataFrame, dim: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Latest year of a fact with names and groups, all shown columns known."""
    rows = enriched(shape.latest_snapshot(fact, "year"), dim, ["country_name", "region", "income_group"])
    return shape.require(rows, needed).select("country_code", "country_name", "region", "income_group", "year", *needed)


def frames(fact: DataFrame, dim: DataFrame, needed: Sequence[str], first: int = 1990, last: int = 2022, step: int = 2) -> DataFrame:
    """Every ``step``-th year of a fact with names, groups and population."""
    rows = shape.periods_in(fact, "year", range(first, last + 1, step))
    rows = enriched(rows, dim, ["country_name", "region", "income_group", "population"])
    return shape.require(rows, needed).select("country_code", "country_name", "region", "income_group", "population", "year", *needed)


def global_trend(fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    return trends.mean_by(fact, ["year"], {c: c for c in columns})


def global_change(fact: DataFrame, column: str) -> DataFrame:
    """First and last yearly mean and their difference: one row."""
    return trends.first_last_change(global_trend(fact, [column]), [], "year", column)


def regional_trend(fact: DataFrame, dim: DataFrame, column: str) -> DataFrame:
    return trends.mean_by_dimension(fact, dim, "country_code", ["year"], ["region"], {column: column})


def regional_last_point(fact: DataFrame, dim: DataFrame, column: str) -> DataFrame:
    return trends.first_last_change(regional_trend(fact, dim, column), ["region"], "year", column).select(
        "region", F.col("last_period").alias("year"), F.col("last").alias(column)
    )


def sampled_scatter(rows: DataFrame, x: str, y: str, n: int, seed: int) -> DataFrame:
    """Sampled points, each with the line and r of all rows."""
    known = shape.require(rows, [x, y])
    line = stats.fit_line(known, x, y)
    r = stats.correlate(known, x, y).select("r").scalar()
    points = shape.repeatable_sample(known, n, ["country_code", "year"], seed)
    return points.select("country_code", "year", "region", x, y).withColumns(
        {"slope": line.select("slope").scalar(), "intercept": line.select("intercept").scalar(), "r": r}
    )


def sample_fit(left: DataFrame, right: DataFrame, dim: DataFrame, x: str, y: str, n: int, seed: int) -> DataFrame:
    """Sampled points of two facts joined on country and year, with names and the sample's own line and r."""
    joined = fact_to_fact(left, right, "country_code", "year", x, y)
    named = joined.join(dim.select("country_code", "country_name", "region"), "country_code")
    sample = stage(shape.repeatable_sample(named, n, ["country_code", "year"], seed), "sample")
    line = stats.fit_line(sample, x, y)
    r = stats.correlate(sample, x, y).select("r").scalar()
    return sample.select("country_code", "country_name", "region", "year", x, y).withColumns(
        {"slope": line.select("slope").scalar(), "intercept": line.select("intercept").scalar(), "r": r}
    )


def threshold_fit(fact: DataFrame, x: str, y: str, gate: str, above: float) -> DataFrame:
    """Line and r over known points whose gate column exceeds a threshold."""
    rows = shape.require(fact, [x, y]).where(F.col(gate) > above)
    both = stats.fit_line(rows, x, y)
    return both.withColumn("r", stats.correlate(rows, x, y).select("r").scalar())


def yearly_spread(fact: DataFrame, column: str) -> DataFrame:
    return trends.spread_by(fact, ["year"], column)


def risk_factor_bars(fact: DataFrame, columns: Sequence[str] = RISK_FACTORS, periods: Sequence[int] = RISK_PERIODS) -> DataFrame:
    return trends.period_means(fact, "year", periods, columns)


def metabolic_trend(fact: DataFrame, columns: Sequence[str] = METABOLIC_TREND) -> DataFrame:
    """Yearly means and their increase over the year before, decreases shown as zero."""
    return trends.step_change(global_trend(fact, columns), [], "year", columns, floor=0.0)
