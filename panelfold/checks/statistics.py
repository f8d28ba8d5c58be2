"""Correlations, lines, boxes, histograms and profiles."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from panelfold.checks import testbed as tb
from panelfold.checks.registry import query
from panelfold.checks.testbed import EVENT_TYPES, table, with_ctes
from panelfold.operators import quality, quantiles, stats

_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_WIDE = tuple(f"v_{t}" for t in EVENT_TYPES)


@query("""
SELECT event_type, 'value' AS variable, count(*) AS n, round(quantile_cont(value, 0.1), 6) AS p10, round(median(value), 6) AS p50,
  round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1
""")
def group_quantiles(spark, d):
    q = quantiles.exact_quantiles(table(spark, d, "events"), ["event_type"], ["value"], [0.1, 0.5, 0.99])
    at = [F.round(F.col("quantiles")[i], 6).alias(n) for i, n in enumerate(("p10", "p50", "p99"))]
    return q.select("event_type", "variable", "n", *at)


@query("SELECT round(corr(l_extendedprice, l_quantity), 8) AS r, count(*) AS n FROM lineitem")
def corr_pair(spark, d):
    return stats.correlate(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice").withColumn("r", F.round("r", 8))


@query(
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS r FROM wide_indicators" for a, b in product(_WIDE, _WIDE)
        )
    )
)
def corr_matrix_pairwise(spark, d):
    return stats.correlation_matrix(tb.wide_indicators(spark, d), _WIDE, digits=8)


@query(
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS r FROM complete" for a, b in product(_WIDE, _WIDE)
        ),
        {"complete": "SELECT * FROM wide_indicators WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _WIDE)},
    )
)
def corr_matrix_listwise(spark, d):
    return stats.correlation_matrix(tb.wide_indicators(spark, d), _WIDE, complete_rows=True, digits=8)


@query("""
SELECT l_returnflag, l_linestatus, round(corr(l_extendedprice, l_quantity), 8) AS r, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def corr_by_group(spark, d):
    out = stats.correlate(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag", "l_linestatus"])
    return out.withColumn("r", F.round("r", 8))


def _rounded_line(df):
    return df.withColumns({c: F.round(c, 5) for c in ("slope", "intercept", "r2")})


@query("""
SELECT round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 5) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 5) AS r2, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem
""")
def ols_line(spark, d):
    return _rounded_line(stats.fit_line(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice"))


@query("""
SELECT event_type, round(regr_slope(value, user_id), 5) AS slope, round(regr_intercept(value, user_id), 5) AS intercept,
  round(regr_r2(value, user_id), 5) AS r2, CAST(regr_count(value, user_id) AS BIGINT) AS n FROM events GROUP BY 1
""")
def ols_by_group(spark, d):
    return _rounded_line(stats.fit_line(table(spark, d, "events"), "user_id", "value", ["event_type"]))


_FENCED = """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS med, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
f AS (SELECT e.*, q1, med, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM events e JOIN q USING (event_type))
"""


@query(
    _FENCED
    + """
SELECT event_type, count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
  min(value) FILTER (value BETWEEN lo AND hi) AS low_whisker, max(value) FILTER (value BETWEEN lo AND hi) AS high_whisker,
  count(*) FILTER (value < lo OR value > hi) AS outliers
FROM f GROUP BY 1"""
)
def box_stats(spark, d):
    out = stats.box_stats(table(spark, d, "events"), ["event_type"], "value", derived=False)
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query(_FENCED + "SELECT event_id, event_type, value FROM f WHERE value < lo OR value > hi")
def box_outliers(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    return stats.box_outliers(e, ["event_type"], "value")


@query("""
WITH line AS (SELECT regr_slope(l_extendedprice, l_quantity) AS m, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem),
res AS (SELECT l_extendedprice - (b + m * l_quantity) AS e FROM lineitem, line),
span AS (SELECT min(e) AS lo, max(e) AS hi, avg(e) AS mean FROM res),
bins AS (SELECT CAST(unnest(range(40)) AS INTEGER) AS bin),
hit AS (SELECT CAST(least(floor((e - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS bin, count(*) AS n FROM res, span GROUP BY 1)
SELECT bins.bin, round(lo + bins.bin * ((hi - lo) / 40), 4) AS from_value, round(lo + (bins.bin + 1) * ((hi - lo) / 40), 4) AS to_value,
  coalesce(hit.n, 0) AS n, abs(mean) < 0.0001 AS centred
FROM bins CROSS JOIN span LEFT JOIN hit ON bins.bin = hit.bin
""")
def histogram_residual(spark, d):
    li = table(spark, d, "lineitem")
    line = stats.fit_line(li, "l_quantity", "l_extendedprice")
    fitted = line.select("intercept").scalar() + line.select("slope").scalar() * F.col("l_quantity")
    h = stats.histogram(li.select((F.col("l_extendedprice") - fitted).alias("e")), "e", 40)
    return h.select(
        "bin", F.round("from_value", 4).alias("from_value"), F.round("to_value", 4).alias("to_value"), "n", (F.abs("mean") < 0.0001).alias("centred")
    )


@query("""
WITH line AS (SELECT regr_slope(l_extendedprice, l_quantity) AS m, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem),
err AS (SELECT abs(l_extendedprice - (b + m * l_quantity)) AS e FROM lineitem, line)
SELECT count(*) AS n, round(avg(e), 4) AS mean_abs, round(median(e), 4) AS median_abs, count(*) FILTER (e > 10000) AS above FROM err
""")
def error_statistics(spark, d):
    li = table(spark, d, "lineitem")
    line = stats.fit_line(li, "l_quantity", "l_extendedprice")
    fitted = line.select("intercept").scalar() + line.select("slope").scalar() * F.col("l_quantity")
    out = stats.error_stats(li.select(F.abs(F.col("l_extendedprice") - fitted).alias("e")), "e", 10000.0)
    return out.withColumns({c: F.round(c, 4) for c in ("mean_abs", "median_abs")})


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS sd, min({c}) AS min, "
        f"round(quantile_cont({c}, 0.25), 5) AS q1, round(median({c}), 5) AS median, round(quantile_cont({c}, 0.75), 5) AS q3, max({c}) AS max "
        "FROM lineitem"
        for c in _NUMERIC
    )
)
def profile_numeric(spark, d):
    out = quality.describe_numeric(table(spark, d, "lineitem"), _NUMERIC, derived=False)
    return out.withColumns({c: F.round(c, 5) for c in ("mean", "sd", "q1", "median", "q3")})


_PROFILED = ("o_orderstatus", "o_orderpriority", "o_custkey", "o_totalprice")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST(sum(n) AS BIGINT) AS present, count(*) AS distinct_values, "
        "arg_min(v, (-n, v)) AS top, max(n) AS freq "
        f"FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1)"
        for c in _PROFILED
    )
)
def profile_all(spark, d):
    return quality.describe_all(table(spark, d, "orders"), _PROFILED)


@query(
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, count(*) - count({c}) AS missing FROM wide_indicators HAVING count(*) > count({c})"
            for c in ("user_id", "day", *_WIDE)
        )
    )
)
def missing_report(spark, d):
    return quality.missing_report(tb.wide_indicators(spark, d))


@query(
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, '{t}' AS type, count({c}) AS present FROM sparse_panel"
            for c, t in (("c_custkey", "bigint"), ("year", "int"), ("v", "double"), ("w", "double"))
        )
    )
)
def column_info(spark, d):
    return quality.column_info(tb.sparse_panel(spark, d))


@query(
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd FROM sparse_panel" for c in ("v", "w")
        )
    )
)
def mean_sd(spark, d):
    out = stats.mean_sd(tb.sparse_panel(spark, d), ["v", "w"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "sd")})
