"""Feature preparation, models and their tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelfold.checks import testbed as tb
from panelfold.checks.registry import query
from panelfold.checks.testbed import table, with_ctes
from panelfold.functions import scalars as sc
from panelfold.operators import features as fe
from panelfold.operators import models, shape, stats
from panelfold.plans import cards, training
from panelfold.plans.star import MEASURES, TARGET
from panelfold.session import scratch_dir, stage
from panelfold.sources import sinks

_LEVELS = {
    "region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "income_group": ["High income", "Low income", "Lower middle income", "Upper middle income"],
}
_SHARE = "(CAST(country_code AS BIGINT) * 7 + year * 31) % 100"


def _share():
    return F.pmod(F.col("country_code").cast("bigint") * 7 + F.col("year") * 31, F.lit(100))


@query(
    with_ctes(
        "SELECT country_code, year, "
        + ", ".join(
            f"CASE WHEN {c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{c}_{v}\"" for c, vs in _LEVELS.items() for v in sorted(vs)[1:]
        )
        + " FROM panel"
    )
)
def one_hot(spark, d):
    p = tb.stored_panel(spark, d).select("country_code", "year", *_LEVELS)
    return fe.one_hot(p, fe.levels_of(tb.dim_countries(spark, d), list(_LEVELS), most=100))


@query(
    with_ctes(
        f"SELECT CASE WHEN {_SHARE} < 80 THEN 'train' ELSE 'test' END AS part, count(*) AS n, round(avg(life_expectancy_total), 6) AS mean, "
        "round(stddev_samp(life_expectancy_total), 6) AS sd FROM panel GROUP BY 1"
    )
)
def deterministic_split(spark, d):
    train, test = fe.train_test(tb.stored_panel(spark, d), _share())
    parts = train.select(F.lit("train").alias("part"), TARGET).unionByName(test.select(F.lit("test").alias("part"), TARGET))
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(TARGET), 6).alias("mean"), F.round(F.stddev_samp(TARGET), 6).alias("sd")
    )


@query(
    with_ctes(
        "SELECT country_code, year, "
        + ", ".join(
            f"round(({c} - (SELECT avg({c}) FROM train)) / (SELECT stddev_pop({c}) FROM train), 6) AS {c}"
            for c in ("infant_mortality_per_1000", "obesity_prevalence_pct")
        )
        + " FROM panel",
        {"train": f"SELECT * FROM panel WHERE {_SHARE} < 80"},
    )
)
def zscore(spark, d):
    cols = ["infant_mortality_per_1000", "obesity_prevalence_pct"]
    p = tb.stored_panel(spark, d).select("country_code", "year", *cols)
    train, _ = fe.train_test(p, _share())
    return fe.apply_zscore(p, fe.fit_zscore(train, cols)).withColumns({c: F.round(c, 6) for c in cols})


@query(
    with_ctes(
        "SELECT round(count(*) * covar_pop(z, y) / (count(*) + 1.0::DOUBLE), 6) AS coefficient, round(avg(y), 6) AS intercept FROM scaled",
        {
            "scaled": "SELECT life_expectancy_total AS y, (mean_bmi_male - avg(mean_bmi_male) OVER ()) / stddev_pop(mean_bmi_male) OVER () AS z FROM panel"
        },
    )
)
def ridge_one_feature(spark, d):
    p = tb.stored_panel(spark, d).select("mean_bmi_male", TARGET)
    scaled = fe.apply_zscore(p, fe.fit_zscore(p, ["mean_bmi_male"]))
    fitted = models.fit_ridge(scaled, ["mean_bmi_male"], TARGET).model
    return spark.createDataFrame(
        [(round(float(fitted.coefficients[0]), 6), round(float(fitted.intercept), 6))], "coefficient double, intercept double"
    )


def _line_predictions(spark, d):
    """Predictions of two straight lines, as a models' comparison whose scores SQL can repeat."""
    p = tb.stored_panel(spark, d)
    parts = []
    for x in ("infant_mortality_per_1000", "adult_mortality_male_per_1000"):
        line = stats.fit_line(p, x, TARGET)
        guess = line.select("intercept").scalar() + line.select("slope").scalar() * F.col(x)
        parts.append(p.select(F.lit(x).alias("model"), TARGET, guess.alias("prediction")))
    return parts[0].unionByName(parts[1])


_LINES = {
    f"line{i}": f"SELECT regr_slope(life_expectancy_total, {x}) AS m, regr_intercept(life_expectancy_total, {x}) AS b FROM panel"
    for i, x in enumerate(("infant_mortality_per_1000", "adult_mortality_male_per_1000"))
}
_SCORED = {
    **_LINES,
    "predicted": "SELECT 'infant_mortality_per_1000' AS model, life_expectancy_total AS y, b + m * infant_mortality_per_1000 AS p FROM panel, line0 "
    "UNION ALL SELECT 'adult_mortality_male_per_1000', life_expectancy_total, b + m * adult_mortality_male_per_1000 FROM panel, line1",
    "scores": "SELECT model, 1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2, sqrt(avg((y - p) ** 2)) AS rmse, avg(abs(y - p)) AS mae, "
    "avg(abs(y - p) / abs(y)) * 100 AS mape, count(*) AS n FROM predicted GROUP BY 1",
}
_SCORE_COLUMNS = ("r2", "rmse", "mae", "mape")
_ROUNDED_SCORES = "model, n, " + ", ".join(f"round({c}, 6) AS {c}" for c in _SCORE_COLUMNS)


def _rounded_scores(df):
    return df.withColumns({c: F.round(c, 6) for c in _SCORE_COLUMNS})


@query(with_ctes(f"SELECT {_ROUNDED_SCORES} FROM scores", _SCORED))
def regression_metrics(spark, d):
    return _rounded_scores(models.regression_scores(_line_predictions(spark, d), TARGET, "prediction", ["model"]))


@query(with_ctes(f"SELECT {_ROUNDED_SCORES} FROM scores ORDER BY r2 DESC LIMIT 1", _SCORED))
def champion(spark, d):
    scored = models.regression_scores(_line_predictions(spark, d), TARGET, "prediction", ["model"])
    return _rounded_scores(models.champion(scored))


@query(
    with_ctes("""
SELECT m.country_code, m.year, actual, predicted, round_even(actual - predicted, 2) AS error, abs(round_even(actual - predicted, 2)) AS abs_error, country_name, region
FROM (SELECT country_code, year, infant_mortality_per_1000 / 4 AS actual, CAST(year - 1960 AS DOUBLE) AS predicted FROM panel) m
LEFT JOIN dim_countries d ON m.country_code = d.country_code""")
)
def prediction_names(spark, d):
    """The predictions table with its own error columns; the guess is a number both engines hold exactly."""
    p = tb.stored_panel(spark, d).withColumns({"actual_value": F.col("infant_mortality_per_1000") / 4, "guess": (F.col("year") - 1960).cast("double")})
    dim = tb.dim_countries(spark, d).select("country_code", "country_name", "region")
    return models.prediction_table(p, ["country_code", "year"], "actual_value", "guess", dim, "country_code")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5(concat_ws('|', '42', o_orderkey)), o_orderkey LIMIT 3500")
def seeded_sample(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return shape.repeatable_sample(o, 3500, ["o_orderkey"], 42)


_MD5_SHARE = "CAST('0x' || substr(md5(concat_ws('|', '42', country_code, year)), 1, 8) AS BIGINT) % 100"


@query(with_ctes(f"SELECT country_code, year, {_MD5_SHARE} AS share, {_MD5_SHARE} < 80 AS in_train FROM panel"))
def keyed_split(spark, d):
    """The split that the modelling job uses."""
    p = tb.stored_panel(spark, d).select("country_code", "year", fe.split_share(["country_code", "year"]).alias("share"))
    train, test = fe.train_test(p, F.col("share"))
    return train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))


def _prepared(spark, d):
    return training.prepare(tb.stored_panel(spark, d), levels=_LEVELS)


_KNOWN = " AND ".join(f"{c} IS NOT NULL" for c in MEASURES) + " AND nullif(cvd_dalys_per_100k, 0) IS NOT NULL"


@query(
    with_ctes(
        f"""
SELECT 'Ridge Regression' AS model, count(*) FILTER (share >= 80) AS n, true AS close, (SELECT count(*) FROM panel) - count(*) AS left_out
FROM (SELECT {_MD5_SHARE} AS share FROM panel WHERE {_KNOWN})"""
    )
)
def ridge_full(spark, d):
    """Ridge on the 37 features: tested rows, rows left out, and whether its solution is that of the normal equations."""
    p = _prepared(spark, d)
    train, test = (fe.apply_zscore(x, p.scaling) for x in (p.train, p.test))
    fitted = models.fit_ridge(train, p.features, TARGET)
    x, y = F.array(*p.features), F.col(TARGET)
    predicted = stage(fitted.predict(train).select(x.alias("x"), (y - F.col("prediction")).alias("rest")), "ridge-rest")
    # At the solution every feature's product with the residuals equals alpha times its coefficient.
    products = predicted.agg(*[F.sum(F.col("x")[i] * F.col("rest")) for i in range(len(p.features))]).first()
    close = all(abs(a - models.RIDGE_ALPHA * float(b)) < 1e-4 * max(1.0, abs(float(b))) for a, b in zip(products, fitted.model.coefficients))
    scores = models.score_models({fitted.name: fitted.predict(test)}, TARGET)
    return scores.select("model", "n", F.lit(close).alias("close"), F.lit(p.left_out).cast("long").alias("left_out"))


_GROUP_MEANS = "SELECT year, round(avg(life_expectancy_total), 6) AS prediction, 100.0::DOUBLE AS importance_pct FROM panel GROUP BY year"


def _group_means(spark, d, fit):
    """One feature of few values, every row and every feature for each tree: the prediction is the group's mean."""
    rows = tb.stored_panel(spark, d).select(F.col("year").cast("double").alias("period"), "year", TARGET)
    fitted = fit(rows, ["period"], TARGET)
    share = models.importance(fitted, spark).first()["importance_pct"]
    return fitted.predict(rows).select("year", F.round("prediction", 6).alias("prediction"), F.lit(round(share, 6)).alias("importance_pct")).distinct()


@query(with_ctes(_GROUP_MEANS))
def forest_group_means(spark, d):
    """The forest at its full number of trees."""
    return _group_means(spark, d, lambda *a: models.fit_forest(*a, bootstrap=False, featureSubsetStrategy="all"))


@query(with_ctes(_GROUP_MEANS))
def stored_forest(spark, d):
    """A small forest, written, read and asked again."""

    def fit(*a):
        fitted = models.fit_forest(*a, numTrees=5, bootstrap=False, featureSubsetStrategy="all")
        folder = f"{scratch_dir(spark)}/model-{uuid.uuid4().hex}"
        models.save_model(fitted, folder)
        return models.load_model(folder, fitted.name, fitted.features)

    return _group_means(spark, d, fit)


@query(with_ctes(_GROUP_MEANS))
def boosted_group_means(spark, d):
    """Boosted trees at their full number of rounds."""
    return _group_means(spark, d, lambda *a: models.fit_boosted(*a, subsamplingRate=1.0, featureSubsetStrategy="all"))


@query()
def forest_importance(spark, d):
    """The fifteen most important features of the full forest."""
    p = _prepared(spark, d)
    return models.importance(models.fit_forest(p.train, p.features, TARGET), spark, 15)


@query()
def boosted_predictions(spark, d):
    """Test predictions of the full boosting with the countries' names."""
    p = _prepared(spark, d)
    fitted = models.fit_boosted(p.train, p.features, TARGET)
    dim = tb.dim_countries(spark, d).select("country_code", "country_name", "region", "income_group")
    return models.prediction_table(fitted.predict(p.test), ["country_code", "year"], TARGET, "prediction", dim, "country_code")


@query()
def risk_classifier(spark, d):
    """Risk categories from the full balanced forest, as the distribution card."""
    return cards.risk_distribution(training.risk_job(tb.stored_panel(spark, d))[0])


@query(
    with_ctes("""
SELECT f.country_code, f.year, p.life_expectancy_total AS life_expectancy_total_lag1, q.life_expectancy_total AS life_expectancy_total_lag2,
  n.life_expectancy_total AS next, f.life_expectancy_total - p.life_expectancy_total AS life_expectancy_total_delta
FROM fact_life_expectancy f LEFT JOIN fact_life_expectancy p ON p.country_code = f.country_code AND p.year = f.year - 1
LEFT JOIN fact_life_expectancy q ON q.country_code = f.country_code AND q.year = f.year - 2
LEFT JOIN fact_life_expectancy n ON n.country_code = f.country_code AND n.year = f.year + 1""")
)
def forecast_frame(spark, d):
    facts = tb.fact_life_expectancy(spark, d).select("country_code", "year", TARGET)
    return models.forecast_frame(facts, "country_code", "year", TARGET).drop(TARGET)


@query()
def next_year_forecast(spark, d):
    """Forecasts of the year after 2000 with bounds, as the forecast card of the full boosting."""
    predictions, _ = training.forecast_job(tb.fact_life_expectancy(spark, d), 2000)
    return cards.forecast_vs_actual(tb.star(spark, d), predictions, 2000)


# --- checked parts of the two jobs ------------------------------------------------------------------

_LEVEL = "CASE WHEN {s} <= q1 THEN 'Low' WHEN {s} <= q2 THEN 'Medium' WHEN {s} <= q3 THEN 'High' ELSE 'Critical' END"
_RISK = {
    "scored": f"SELECT country_code, year, infant_mortality_per_1000 + diabetes_prevalence_pct AS score, {_SHARE} < 80 AS train FROM panel",
    "ends": "SELECT quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS q2, quantile_cont(score, 0.75) AS q3 FROM scored WHERE train",
    "labelled": f"SELECT country_code, year, train, {_LEVEL.format(s='score')} AS risk FROM scored, ends",
}


def _risk_rows(spark, d):
    p = tb.stored_panel(spark, d)
    score = F.col("infant_mortality_per_1000") + F.col("diabetes_prevalence_pct")
    rows = p.select("country_code", "year", score.alias("score"), (_share() < 80).alias("train"))
    return models.risk_labels(rows, "score", models.risk_bounds(rows.where("train"), "score"))


@query(
    with_ctes(
        """
SELECT country_code, year, risk, round((SELECT count(*) FROM labelled WHERE train) / (4.0 * count(*) OVER (PARTITION BY risk)), 6) AS weight FROM labelled WHERE train""",
        _RISK,
    )
)
def risk_labels(spark, d):
    """Quartile labels and balanced weights of the training rows."""
    return models.balanced_weights(_risk_rows(spark, d).where("train"), "risk").select("country_code", "year", "risk", F.round("weight", 6).alias("weight"))


@query(
    with_ctes(
        """
SELECT round(avg(CASE WHEN risk = guess THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round((SELECT sum(rows * f1) / sum(rows) FROM (
  SELECT sum(CASE WHEN risk = c THEN 1 ELSE 0 END) AS rows, 2.0 * sum(CASE WHEN risk = c AND guess = c THEN 1 ELSE 0 END)
    / (sum(CASE WHEN risk = c THEN 1 ELSE 0 END) + sum(CASE WHEN guess = c THEN 1 ELSE 0 END)) AS f1
  FROM judged, (VALUES ('Low'), ('Medium'), ('High'), ('Critical')) v(c) GROUP BY c)), 6) AS f1 FROM judged""",
        {
            **_RISK,
            "judged": "SELECT a.risk, b.risk AS guess FROM labelled a JOIN labelled b ON b.country_code = a.country_code AND b.year = a.year - 1 WHERE NOT a.train",
        },
    )
)
def risk_scores(spark, d):
    """Accuracy and F1 of taking last year's category, on the rows outside the training part."""
    rows = stage(_risk_rows(spark, d).select("country_code", "year", "train", "risk"), "risk")
    number = (sc.category_rank("risk", models.RISK_LEVELS) - 1).cast("double")
    before = rows.select("country_code", (F.col("year") + 1).alias("year"), number.alias("prediction"))
    judged = rows.where(~F.col("train")).withColumn("label", number).join(before, ["country_code", "year"])
    found = models.label_scores(stage(judged.select("label", "prediction"), "judged"))
    return spark.createDataFrame([(round(found["accuracy"], 6), round(found["f1"], 6))], "accuracy double, f1 double")


# The last known value as a forecast: SQL can repeat it, and its errors are those of any model to the interval.
_LAST_VALUE = {
    "errors": """SELECT d.region, f.year, n.life_expectancy_total - f.life_expectancy_total AS residual
FROM fact_life_expectancy f JOIN fact_life_expectancy n ON n.country_code = f.country_code AND n.year = f.year + 1
JOIN dim_countries d ON d.country_code = f.country_code""",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY region ORDER BY residual) AS place, count(*) OVER (PARTITION BY region) AS n FROM errors WHERE year < 1999""",
    "bounds": """SELECT region, max(n) AS n, max(residual) FILTER (place = floor((n + 1) * 0.1 + 1e-9)) AS low,
  max(residual) FILTER (place = ceil((n + 1) * 0.9 - 1e-9)) AS high FROM ranked GROUP BY region""",
}


@query(
    with_ctes(
        """
SELECT region, b.n AS n, low, high, count(*) AS later, count(*) FILTER (coalesce(residual >= low, true) AND coalesce(residual <= high, true)) AS inside
FROM errors JOIN bounds b USING (region) WHERE year >= 1999 GROUP BY ALL""",
        _LAST_VALUE,
    )
)
def forecast_bounds(spark, d):
    """Conformal bounds by region from the years before 1999, and how many later errors lie inside."""
    facts = tb.life_by_region(spark, d).select("country_code", "region", "year", TARGET)
    frame = models.forecast_frame(facts, "country_code", "year", TARGET).where(F.col("next").isNotNull())
    errors = stage(frame.select("region", "year", (F.col("next") - F.col(TARGET)).alias("residual")), "errors")
    bounds = stage(models.conformal_bounds(errors.where("year < 1999"), ["region"], coverage=0.8), "bounds")
    held = models.coverage(errors.where("year >= 1999"), bounds, "region").withColumnRenamed("n", "later")
    return bounds.join(held, "region")


@query(
    with_ctes(
        "SELECT p.*, round(life_expectancy_female - life_expectancy_male, 6) AS gender_le_gap, round(physicians_per_1000 * health_expenditure_pct_gdp, 6) AS healthcare_density "
        f"FROM (SELECT country_code, year, {', '.join(MEASURES)} FROM panel) p"
    )
)
def panel_export(spark, d):
    """The engineered panel as it is exported: every row and measure, read back."""
    stored = sinks.replace_table(training.engineered(tb.stored_panel(spark, d)), f"{scratch_dir(spark)}/export-{uuid.uuid4().hex}")
    more = [F.round(c, 6).alias(c) for c in ("gender_le_gap", "healthcare_density")]
    return stored.select("country_code", "year", *MEASURES, *more)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25")
def ordered_head(spark, d):
    """The first rows of an ordered table."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return shape.head(o, ["o_totalprice", "o_orderkey"], 25)


_TWO = "SELECT country_code, year, region, life_expectancy_total AS y FROM panel"


@query(
    with_ctes(
        "SELECT DISTINCT region, year, round(avg(y) OVER (PARTITION BY region, year), 6) AS prediction FROM two",
        {"two": _TWO},
    )
)
def forest_two_features(spark, d):
    """Two features and trees deep enough to part every pair of their values: the prediction is the pair's mean."""
    return _pair_means(spark, d, lambda *a: models.fit_forest(*a, numTrees=20, minInstancesPerNode=1, bootstrap=False, featureSubsetStrategy="all"))


@query(
    with_ctes(
        "SELECT DISTINCT region, year, round(avg(y) OVER (PARTITION BY region, year), 6) AS prediction FROM two",
        {"two": _TWO},
    )
)
def boosted_two_features(spark, d):
    """The same of boosted trees, each of which is deep enough too."""
    return _pair_means(spark, d, lambda *a: models.fit_boosted(*a, maxIter=5, maxDepth=14, subsamplingRate=1.0, featureSubsetStrategy="all"))


def _pairs(spark, d):
    place = F.array_position(F.array(*[F.lit(r) for r in _LEVELS["region"]]), F.col("region")).cast("double")
    return tb.stored_panel(spark, d).select(F.col("year").cast("double").alias("period"), place.alias("place"), "region", "year", TARGET)


def _pair_means(spark, d, fit):
    rows = _pairs(spark, d)
    fitted = fit(rows, ["period", "place"], TARGET)
    return fitted.predict(rows).select("region", "year", F.round("prediction", 6).alias("prediction")).distinct()


_REGIONS = "[" + ", ".join(f"'{r}'" for r in _LEVELS["region"]) + "]"


def _best_split(rows: str, by: str = "") -> str:
    """The cut of one feature that takes away most of the squares about the mean, of all rows or of each part."""
    part, of = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    values = f"SELECT {part}f, v, count(*) AS n, sum(y) AS s FROM {rows} GROUP BY ALL"
    sums = f"""SELECT {part}f, v, sum(n) OVER (PARTITION BY {part}f ORDER BY v) AS nl, sum(s) OVER (PARTITION BY {part}f ORDER BY v) AS sl,
      sum(n) OVER (PARTITION BY {part}f) AS n, sum(s) OVER (PARTITION BY {part}f) AS s FROM ({values})"""
    gains = f"SELECT {part}f, v, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM ({sums}) WHERE nl < n"
    return f"SELECT * FROM ({gains}) QUALIFY row_number() OVER ({of} ORDER BY gain DESC) = 1"


_LONG = "SELECT {more}'period' AS f, period AS v, y FROM {rows} UNION ALL SELECT {more}'place', place, y FROM {rows}"
_TREE = {
    "two": f"SELECT CAST(year AS DOUBLE) AS period, CAST(list_position({_REGIONS}, region) AS DOUBLE) AS place, life_expectancy_total AS y FROM panel",
    "long": _LONG.format(more="", rows="two"),
    "root": _best_split("long"),
    "sides": "SELECT CASE WHEN CASE root.f WHEN 'period' THEN period ELSE place END <= root.v THEN 0 ELSE 1 END AS side, period, place, y FROM two, root",
    "side_long": _LONG.format(more="side, ", rows="sides"),
    "leaves": _best_split("side_long", "side"),
    "gains": "SELECT f, gain FROM root UNION ALL SELECT f, gain FROM leaves",
}


@query(
    with_ctes(
        "SELECT f AS feature, round(100 * coalesce(sum(gain), 0) / (SELECT sum(gain) FROM gains), 6) AS importance_pct "
        "FROM (VALUES ('period'), ('place')) v(f) LEFT JOIN gains USING (f) GROUP BY f",
        _TREE,
    )
)
def tree_importance(spark, d):
    """Importance of two features in trees of two levels, from the squares that each split takes away."""
    rows = _pairs(spark, d)
    fitted = models.fit_forest(rows, ["period", "place"], TARGET, numTrees=10, maxDepth=2, minInstancesPerNode=1, bootstrap=False, featureSubsetStrategy="all")
    return models.importance(fitted, spark).withColumn("importance_pct", F.round("importance_pct", 6))
