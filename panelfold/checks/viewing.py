"""The parameterised views and the report cards over the star schema."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from panelfold.checks import testbed as tb
from panelfold.checks.registry import query
from panelfold.checks.testbed import with_ctes
from panelfold.plans import cards, views

YEARS = (1996, 2000)
REGIONS = ["ASIA", "EUROPE", "AFRICA"]
_IN = "region IN ('ASIA', 'EUROPE', 'AFRICA')"
_SPAN = "year BETWEEN 1996 AND 2000"


def _r(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _near(df, *columns):
    return df.withColumns({c: tb.near(c, 65536) for c in columns})


def _grid(e, c):
    return tb.near_sql(e, c, 65536)


def _avg(columns, digits=6):
    return ", ".join(f"round(avg({c}), {digits}) AS {c}" for c in columns)


@query(
    with_ctes(
        f"SELECT count(DISTINCT country_code) AS entities, {', '.join(f'round(avg({c}), 6) AS {n}' for n, c in views.KPI.items())} "
        f"FROM panel WHERE {_SPAN} AND {_IN} AND income_group IN ('Low income', 'High income')"
    )
)
def view_kpi(spark, d):
    return _r(views.kpi(tb.stored_panel(spark, d), YEARS, REGIONS, ["Low income", "High income"]), 6, *views.KPI)


@query(
    with_ctes(
        "SELECT country_code, region, income_group, health_expenditure_pct_gdp FROM panel "
        "WHERE year = 1998 AND health_expenditure_pct_gdp IS NOT NULL"
    )
)
def view_map(spark, d):
    c = "health_expenditure_pct_gdp"
    return views.world_map(tb.stored_panel(spark, d), c, 1998)


@query(with_ctes(f"SELECT year, region, {_avg(['obesity_prevalence_pct'])} FROM panel WHERE {_SPAN} AND {_IN} GROUP BY 1, 2"))
def view_trend(spark, d):
    return _r(views.trend(tb.stored_panel(spark, d), "obesity_prevalence_pct", "region", YEARS, REGIONS), 6, "obesity_prevalence_pct")


_POINTS = "SELECT * FROM panel WHERE {} AND {} AND health_expenditure_pct_gdp IS NOT NULL AND life_expectancy_total IS NOT NULL"


@query(
    with_ctes(
        "SELECT country_code, year, region, income_group, health_expenditure_pct_gdp, life_expectancy_total, mean_bmi_male FROM points",
        {"points": _POINTS.format(_SPAN, _IN)},
    )
)
def view_scatter(spark, d):
    x, y, z = "health_expenditure_pct_gdp", "life_expectancy_total", "mean_bmi_male"
    return views.scatter(tb.stored_panel(spark, d), x, y, [z], YEARS, REGIONS)


def _lines(by, x, y):
    return (
        f"SELECT {by}, round(regr_slope({y}, {x}), 5) AS slope, round(regr_intercept({y}, {x}), 5) AS intercept, "
        f"round(regr_r2({y}, {x}), 5) AS r2, CAST(regr_count({y}, {x}) AS BIGINT) AS n FROM points GROUP BY 1"
    )


@query(with_ctes(_lines("region", "health_expenditure_pct_gdp", "life_expectancy_total"), {"points": _POINTS.format(_SPAN, _IN)}))
def view_expenditure_lines(spark, d):
    out = views.scatter_lines(tb.stored_panel(spark, d), "health_expenditure_pct_gdp", "life_expectancy_total", "region", (), YEARS, REGIONS)
    return _r(out, 5, "slope", "intercept", "r2")


@query(with_ctes(_lines("region", "obesity_prevalence_pct", "diabetes_prevalence_pct"), {"points": f"SELECT * FROM panel WHERE {_SPAN}"}))
def view_obesity_diabetes_lines(spark, d):
    out = views.scatter_lines(tb.stored_panel(spark, d), "obesity_prevalence_pct", "diabetes_prevalence_pct", "region", (), YEARS)
    return _r(out, 5, "slope", "intercept", "r2")


@query(with_ctes(_lines("income_group", "infant_mortality_per_1000", "life_expectancy_total"), {"points": f"SELECT * FROM panel WHERE {_SPAN}"}))
def view_infant_life_lines(spark, d):
    out = views.scatter_lines(tb.stored_panel(spark, d), "infant_mortality_per_1000", "life_expectancy_total", "income_group", (), YEARS)
    return _r(out, 5, "slope", "intercept", "r2")


def _box_ctes(by, column, where):
    return {
        "chosen": f"SELECT {by} AS g, {column} AS v FROM panel WHERE {where}",
        "qs": "SELECT g, quantile_cont(v, 0.25) AS q1, median(v) AS med, quantile_cont(v, 0.75) AS q3 FROM chosen GROUP BY 1",
        "fenced": "SELECT c.*, q1, med, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM chosen c JOIN qs USING (g)",
    }


def _box(by):
    return f"""SELECT g AS {by}, count(*) AS n, {_grid('any_value(q1)', 'q1')}, {_grid('any_value(med)', 'median')}, {_grid('any_value(q3)', 'q3')},
  min(v) FILTER (v BETWEEN lo AND hi) AS low_whisker, max(v) FILTER (v BETWEEN lo AND hi) AS high_whisker,
  count(*) FILTER (v < lo OR v > hi) AS outliers FROM fenced GROUP BY 1"""


_BOX_COLUMNS = ("q1", "median", "q3")


@query(with_ctes(_box("region"), _box_ctes("region", "diabetes_prevalence_pct", f"{_SPAN} AND {_IN}")))
def view_boxes(spark, d):
    return _near(views.boxes(tb.stored_panel(spark, d), "diabetes_prevalence_pct", "region", YEARS, REGIONS), *_BOX_COLUMNS)


@query(with_ctes(_box("income_group"), _box_ctes("income_group", "diabetes_prevalence_pct", "year = 1998")))
def view_income_distribution(spark, d):
    out = views.income_distribution(tb.stored_panel(spark, d), "diabetes_prevalence_pct", 1998)
    return _near(out.drop("rank"), *_BOX_COLUMNS)


@query(
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 2) AS r FROM complete" for a, b in product(views.INDICATORS, views.INDICATORS)
        ),
        {"complete": f"SELECT * FROM panel WHERE {_SPAN} AND {_IN} AND health_expenditure_pct_gdp IS NOT NULL"},
    )
)
def view_correlation(spark, d):
    return views.correlation(tb.stored_panel(spark, d), YEARS, REGIONS)


@query(
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM fact_life_expectancy"
            for a, b in product(views.LIFE_MATRIX, views.LIFE_MATRIX)
        )
    )
)
def view_life_matrix(spark, d):
    from panelfold.operators.stats import correlation_matrix

    return correlation_matrix(tb.fact_life_expectancy(spark, d), views.LIFE_MATRIX, digits=6)


@query(
    with_ctes("""
SELECT side, country_code, region, income_group, v AS cvd_deaths_per_100k FROM (
  (SELECT 'top' AS side, country_code, region, income_group, cvd_deaths_per_100k AS v FROM panel WHERE year = 1998 ORDER BY v DESC, country_code LIMIT 12)
  UNION ALL
  (SELECT 'bottom', country_code, region, income_group, cvd_deaths_per_100k AS v FROM panel WHERE year = 1998 ORDER BY v, country_code LIMIT 12))""")
)
def view_ranking(spark, d):
    p, c = tb.stored_panel(spark, d), "cvd_deaths_per_100k"
    top = views.ranking(p, c, 1998, 12).select(F.lit("top").alias("side"), "*")
    bottom = views.ranking(p, c, 1998, 12, bottom=True).select(F.lit("bottom").alias("side"), "*")
    return top.unionByName(bottom)


@query(
    with_ctes(
        f"SELECT year, region, round(avg(life_expectancy_female - life_expectancy_male), 6) AS gender_gap FROM panel WHERE {_SPAN} GROUP BY 1, 2"
    )
)
def view_gender_gap(spark, d):
    return _r(views.gender_gap_trend(tb.stored_panel(spark, d), YEARS), 6, "gender_gap")


@query(
    with_ctes(
        f"SELECT year, income_group, {_avg(['cvd_deaths_per_100k'])} FROM panel WHERE {_SPAN} AND income_group IN ('Low income', 'High income') GROUP BY 1, 2"
    )
)
def view_income_trend(spark, d):
    out = views.income_trend(tb.stored_panel(spark, d), "cvd_deaths_per_100k", YEARS, ["Low income", "High income"])
    return _r(out, 6, "cvd_deaths_per_100k")


@query(
    with_ctes(
        "SELECT region, "
        + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-9), 5) AS {c}" for c in views.RADAR)
        + " FROM means",
        {"means": f"SELECT region, {', '.join(f'avg({c}) AS {c}' for c in views.RADAR)} FROM panel WHERE year = 1998 GROUP BY 1"},
    )
)
def view_radar(spark, d):
    return _r(views.radar(tb.stored_panel(spark, d), 1998), 5, *views.RADAR)


@query(
    with_ctes("SELECT income_group, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM dim_countries), 6) AS share_pct FROM dim_countries GROUP BY 1")
)
def view_composition(spark, d):
    return _r(views.composition(tb.dim_countries(spark, d), "income_group"), 6, "share_pct")


@query(
    with_ctes("""
SELECT f.country_code, f.year, country_name, region, income_group, life_expectancy_total
FROM fact_life_expectancy f JOIN dim_countries d ON f.country_code = d.country_code WHERE year = 2000""")
)
def view_year_snapshot(spark, d):
    out = views.year_snapshot(tb.fact_life_expectancy(spark, d), tb.dim_countries(spark, d), 2000)
    return out.select("country_code", "year", "country_name", "region", "income_group", "life_expectancy_total")


@query(
    with_ctes(
        """SELECT round(arg_min(m, year), 6) AS first, round(arg_max(m, year), 6) AS last, max(year) AS last_period, round(arg_max(m, year) - arg_min(m, year), 6) AS change FROM yearly""",
        {"yearly": "SELECT year, avg(life_expectancy_total) AS m FROM fact_life_expectancy GROUP BY 1"},
    )
)
def view_global_change(spark, d):
    return _r(views.global_change(tb.fact_life_expectancy(spark, d), "life_expectancy_total"), 6, "first", "last", "change")


@query(with_ctes("SELECT region, year, round(avg(life_expectancy_total), 6) AS life_expectancy_total FROM life_by_region GROUP BY 1, 2"))
def view_regional_trend(spark, d):
    out = views.regional_trend(tb.fact_life_expectancy(spark, d), tb.dim_countries(spark, d), "life_expectancy_total")
    return _r(out, 6, "life_expectancy_total")


@query(
    with_ctes(
        "SELECT region, max(year) AS year, round(arg_max(m, year), 6) AS life_expectancy_total FROM yearly GROUP BY 1",
        {"yearly": "SELECT region, year, avg(life_expectancy_total) AS m FROM life_by_region GROUP BY 1, 2"},
    )
)
def view_regional_last_point(spark, d):
    out = views.regional_last_point(tb.fact_life_expectancy(spark, d), tb.dim_countries(spark, d), "life_expectancy_total")
    return _r(out, 6, "life_expectancy_total")


@query(
    with_ctes(
        f"SELECT region, {_grid('median(life_expectancy_total)', 'median')}, (SELECT {_grid('median(life_expectancy_total)', 'm')} FROM snap) AS overall_median FROM snap GROUP BY 1",
        {"snap": "SELECT * FROM life_by_region WHERE year = 2000"},
    )
)
def view_region_medians(spark, d):
    from panelfold.operators.trends import group_medians

    snap = views.year_snapshot(tb.fact_life_expectancy(spark, d), tb.dim_countries(spark, d), 2000)
    return _near(group_medians(snap, "region", "life_expectancy_total"), "median", "overall_median")


@query(
    with_ctes(
        "SELECT year, " + ", ".join(_grid(e, c) for e, c in (("m", "mean"), ("s", "sd"), ("q", "median"), ("(m - s)", "lower"), ("(m + s)", "upper"))) + " FROM yearly",
        {"yearly": "SELECT year, avg(deaths_per_100k) AS m, stddev_samp(deaths_per_100k) AS s, median(deaths_per_100k) AS q FROM fact_cardiovascular GROUP BY 1"},
    )
)
def view_yearly_spread(spark, d):
    return _near(views.yearly_spread(tb.fact_cardiovascular(spark, d), "deaths_per_100k"), "mean", "sd", "median", "lower", "upper")


@query(
    with_ctes(
        " UNION ALL ".join(
            f"SELECT year, '{c}' AS variable, round(avg({c}), 6) AS mean FROM fact_cardiovascular WHERE year IN (1995, 1998) "
            "OR year = (SELECT max(year) FROM fact_cardiovascular) GROUP BY 1"
            for c in views.RISK_FACTORS
        )
    )
)
def view_risk_factor_bars(spark, d):
    return _r(views.risk_factor_bars(tb.fact_cardiovascular(spark, d), periods=(1995, 1998)), 6, "mean")


@query(
    with_ctes(
        "SELECT year, "
        + ", ".join(
            f"round({c}, 6) AS {c}, round(greatest({c} - lag({c}) OVER (ORDER BY year), CASE WHEN lag({c}) OVER (ORDER BY year) IS NOT NULL THEN 0 END), 6) AS {c}_step"
            for c in views.METABOLIC_TREND
        )
        + " FROM yearly",
        {"yearly": f"SELECT year, {', '.join(f'avg({c}) AS {c}' for c in views.METABOLIC_TREND)} FROM fact_diabetes_obesity GROUP BY 1"},
    )
)
def view_metabolic_trend(spark, d):
    out = views.metabolic_trend(tb.fact_diabetes_obesity(spark, d))
    return _r(out, 6, *[c for c in out.columns if c != "year"])


@query(
    with_ctes("""
SELECT f.country_code, country_name, region, income_group, f.year, mean_bmi_male, obesity_prevalence_pct
FROM fact_diabetes_obesity f JOIN dim_countries d ON f.country_code = d.country_code WHERE f.year = (SELECT max(year) FROM fact_diabetes_obesity)""")
)
def view_latest_bubble(spark, d):
    needed = ["mean_bmi_male", "obesity_prevalence_pct"]
    return views.latest_bubble(tb.fact_diabetes_obesity(spark, d), tb.dim_countries(spark, d), needed)


@query(
    with_ctes("""
SELECT f.country_code, country_name, region, income_group, population, f.year, health_expenditure_pct_gdp, life_expectancy_total
FROM fact_life_expectancy f JOIN dim_countries d ON f.country_code = d.country_code WHERE f.year % 2 = 0 AND health_expenditure_pct_gdp IS NOT NULL""")
)
def view_frames(spark, d):
    needed = ["health_expenditure_pct_gdp", "life_expectancy_total"]
    return views.frames(tb.fact_life_expectancy(spark, d), tb.dim_countries(spark, d), needed)


@query(
    with_ctes(
        "SELECT round(regr_slope(y, x), 5) AS slope, round(regr_intercept(y, x), 5) AS intercept, round(regr_r2(y, x), 5) AS r2, "
        "CAST(count(*) AS BIGINT) AS n, round(corr(x, y), 6) AS r FROM gated",
        {"gated": "SELECT pct_on_antiretroviral AS x, aids_deaths_per_100k AS y FROM fact_hiv_aids WHERE prevalence_pct > 0.2"},
    )
)
def view_threshold_fit(spark, d):
    out = views.threshold_fit(tb.fact_hiv_aids(spark, d), "pct_on_antiretroviral", "aids_deaths_per_100k", "prevalence_pct", 0.2)
    return _r(_r(out, 5, "slope", "intercept", "r2"), 6, "r")


def _fit_sql(x, y, rows):
    near = ", ".join(tb.near_sql(f"(SELECT {f}({y}, {x}) FROM {rows})", c, 1 << 16) for f, c in (("regr_slope", "slope"), ("regr_intercept", "intercept"), ("corr", "r")))
    return near


def _near_fit(df):
    return df.withColumns({c: tb.near(c, 1 << 16) for c in ("slope", "intercept", "r")})


@query(
    with_ctes(
        f"""
SELECT country_code, year, region, infant_mortality_per_1000, life_expectancy_total, {_fit_sql('infant_mortality_per_1000', 'life_expectancy_total', 'life_by_region')}
FROM life_by_region ORDER BY md5(concat_ws('|', '42', country_code, year)), country_code, year LIMIT 3500"""
    )
)
def view_sampled_scatter(spark, d):
    """A seeded sample of points with the line of all rows."""
    return _near_fit(views.sampled_scatter(tb.life_by_region(spark, d), "infant_mortality_per_1000", "life_expectancy_total", 3500, 42))


@query(
    with_ctes(
        f"SELECT *, {_fit_sql('deaths_per_100k', 'life_expectancy_total', 'drawn')} FROM drawn",
        {
            "drawn": """
SELECT c.country_code, d.country_name, d.region, c.year, c.deaths_per_100k, l.life_expectancy_total FROM fact_cardiovascular c
JOIN fact_life_expectancy l ON l.country_code = c.country_code AND l.year = c.year JOIN dim_countries d ON d.country_code = c.country_code
ORDER BY md5(concat_ws('|', '11', c.country_code, c.year)), c.country_code, c.year LIMIT 3000"""
        },
    )
)
def view_sample_fit(spark, d):
    """Points, line and r of a seeded sample of two joined facts."""
    s = tb.star(spark, d)
    return _near_fit(views.sample_fit(s["fact_cardiovascular"], s["fact_life_expectancy"], s["dim_countries"], "deaths_per_100k", "life_expectancy_total", 3000, 11))


# --- report cards -----------------------------------------------------------------------------------


@query(with_ctes("SELECT region, year, round(avg(life_expectancy_total), 2) AS avg_le FROM life_by_region WHERE year > 1989 GROUP BY ALL"))
def card_life_trend(spark, d):
    return cards.life_trend(tb.star(spark, d))


# Each measure's mean per country by itself; only the first is of one year, and it decides who takes part.
_BURDEN = {
    "epidemic": "SELECT country_code AS k, avg(prevalence_pct) AS share FROM fact_hiv_aids WHERE year = 1997 GROUP BY k",
    "heart": "SELECT country_code AS k, avg(age_std_death_rate) AS rate FROM fact_cardiovascular GROUP BY k",
    "sugar": "SELECT country_code AS k, avg(diabetes_prevalence_pct) AS pct FROM fact_diabetes_obesity GROUP BY k",
    "burden": "SELECT k, share, rate, pct, 10 * share + rate / 50 + pct AS total FROM epidemic LEFT JOIN heart USING (k) LEFT JOIN sugar USING (k)",
}


@query(
    with_ctes(
        f"""
SELECT who.country_name, who.region, {tb.near_sql('share', 'avg_hiv_prev')}, {tb.near_sql('rate', 'avg_cvd_rate')}, {tb.near_sql('pct', 'avg_diab_prev')},
  {tb.near_sql('total', 'double_burden_score')}
FROM burden, dim_countries who WHERE who.country_code = k ORDER BY total DESC NULLS LAST, who.country_name LIMIT 30""",
        _BURDEN,
    )
)
def card_double_burden(spark, d):
    out = cards.double_burden(tb.star(spark, d), 1997)
    return out.select("country_name", "region", *[tb.near(c) for c in ("avg_hiv_prev", "avg_cvd_rate", "avg_diab_prev", "double_burden_score")])


@query(
    with_ctes("""
SELECT region, year, round(avg(gap), 2) AS gender_gap_years, round(avg(physicians_per_1000), 3) AS physicians_per_1000
FROM (SELECT *, life_expectancy_female - life_expectancy_male AS gap FROM life_by_region) WHERE gap IS NOT NULL GROUP BY ALL""")
)
def card_gender_gap(spark, d):
    return cards.gender_gap(tb.star(spark, d))


# A predictions table in the store's shape: the last known value moved by fixed steps.
_PREDICTIONS = {
    "ml_predictions": """
SELECT country_code, 'RandomForest_RiskClassifier' AS model_name, CASE WHEN m > 70 THEN 'Low' WHEN m > 64 THEN 'Medium' WHEN m > 60 THEN 'High' ELSE 'Critical' END AS predicted_risk_cat,
  k / CAST(8 AS DOUBLE) AS risk_probability, m AS predicted_le_total, m - 2 AS predicted_le_lower, m + 2 AS predicted_le_upper
FROM (SELECT country_code, arg_max(life_expectancy_total, year) AS m, count(*) AS k FROM fact_life_expectancy GROUP BY 1)"""
}


def _predictions(spark, d, model):
    f = tb.fact_life_expectancy(spark, d).groupBy("country_code")
    last = f.agg(F.max_by("life_expectancy_total", "year").alias("m"), F.count(F.lit(1)).alias("k"))
    m = F.col("m")
    risk = F.when(m > 70, "Low").when(m > 64, "Medium").when(m > 60, "High").otherwise("Critical")
    return last.select(
        "country_code", F.lit(model).alias("model_name"), risk.alias("predicted_risk_cat"), (F.col("k") / 8.0).alias("risk_probability"),
        m.alias("predicted_le_total"), (m - 2).alias("predicted_le_lower"), (m + 2).alias("predicted_le_upper"),
    )


@query(
    with_ctes(
        "SELECT c AS predicted_risk_cat, n AS country_count, round(100 * p / n, 1) AS avg_confidence_pct "
        "FROM (SELECT predicted_risk_cat AS c, count(*) AS n, sum(risk_probability) AS p FROM ml_predictions GROUP BY c)",
        _PREDICTIONS,
    )
)
def card_risk_distribution(spark, d):
    return cards.risk_distribution(_predictions(spark, d, cards.RISK_MODEL))


_METRICS = {
    **_PREDICTIONS,
    "ml_model_metrics": """
SELECT 'RandomForest_RiskClassifier' AS model_name, arg_min(predicted_risk_cat, (-n, predicted_risk_cat)) AS top_features,
  round(max(n) / CAST(sum(n) AS DOUBLE), 6) AS accuracy, round(min(n) / CAST(sum(n) AS DOUBLE), 6) AS f1_score
FROM (SELECT predicted_risk_cat, count(*) AS n FROM ml_predictions GROUP BY 1)
UNION ALL SELECT 'other', 'x', 0.0, 0.0""",
}


@query(
    with_ctes("SELECT model_name, top_features, accuracy, f1_score FROM ml_model_metrics WHERE model_name = 'RandomForest_RiskClassifier'", _METRICS)
)
def card_model_metrics(spark, d):
    """The card over a metrics table with two models; the figures stand in for scores, from the category counts."""
    n = _predictions(spark, d, cards.RISK_MODEL).groupBy("model_name", "predicted_risk_cat").agg(F.count(F.lit(1)).alias("n"))
    share = lambda f: F.round(f("n") / F.sum("n").cast("double"), 6)
    top = F.min_by("predicted_risk_cat", F.struct(-F.col("n"), F.col("predicted_risk_cat")))
    metrics = n.groupBy("model_name").agg(top.alias("top_features"), share(F.max).alias("accuracy"), share(F.min).alias("f1_score"))
    return cards.model_metrics(metrics.unionByName(metrics.withColumn("model_name", F.lit("other"))))


@query(
    with_ctes(
        """
SELECT guess.country_code, who.country_name, who.region, guess.predicted_le_total AS forecast_le_2001, guess.predicted_le_lower AS ci_lower,
  guess.predicted_le_upper AS ci_upper, (SELECT max(was.life_expectancy_total) FROM fact_life_expectancy was WHERE was.country_code = guess.country_code AND was.year = 2000) AS actual_le_2000
FROM ml_predictions guess, dim_countries who WHERE who.country_code = guess.country_code""",
        _PREDICTIONS,
    )
)
def card_forecast(spark, d):
    return cards.forecast_vs_actual(tb.star(spark, d), _predictions(spark, d, cards.FORECAST_MODEL), 2000)
