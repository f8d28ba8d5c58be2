"""Trends, changes over time, scores, rankings and data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelfold.checks import testbed as tb
from panelfold.checks.registry import query
from panelfold.checks.testbed import EVENT_TYPES, table, with_ctes
from panelfold.functions.scalars import category_rank
from panelfold.operators import clean, quality, shape, trends


def _orders(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"), "o_totalprice", "o_orderpriority", "o_orderstatus"
    )


def _regions(spark, d):
    c, g = table(spark, d, "customer"), tb.geography(spark, d)
    return c.join(g, c.c_nationkey == g.n_nationkey).select("c_custkey", F.col("r_name").alias("region"))


@query("""
SELECT r_name AS region, CAST(year(o_orderdate) AS INTEGER) AS year, round(avg(o_totalprice) * 1024) / 1024 AS avg_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE year(o_orderdate) >= 1990 GROUP BY 1, 2
""")
def regional_trend(spark, d):
    """The flagship: group means of a fact by an attribute of its dimension and the year."""
    facts = _orders(spark, d).where(F.col("year") >= 1990)
    out = trends.mean_by_dimension(facts, _regions(spark, d), "c_custkey", ["year"], ["region"], {"avg_price": "o_totalprice"})
    return out.select("region", "year", tb.near("avg_price")).orderBy("year", "region")


@query("""
WITH late AS (SELECT o_custkey AS c, avg(o_totalprice) AS price FROM orders WHERE year(o_orderdate) = 1999 GROUP BY c),
     done AS (SELECT o_custkey AS c, avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS closed FROM orders GROUP BY c)
SELECT c_custkey, c_name, round(price * 1024) / 1024 AS price, round(closed * 1024) / 1024 AS closed, round((price / 2 + closed) * 1024) / 1024 AS score
FROM late JOIN customer ON c_custkey = c LEFT JOIN done USING (c) ORDER BY price / 2 + closed DESC NULLS LAST, c_custkey LIMIT 3000
""")
def burden_score(spark, d):
    """Customers with an order of one year, by a score over two averages; those without a closed order rank last."""
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    sources = {
        "price": (o.where(F.year("o_orderdate") == 1999), "o_totalprice"),
        "closed": (o.withColumn("v", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), "v"),
    }
    dim = table(spark, d, "customer").select("c_custkey", "c_name")
    top = trends.burden_score(dim, sources, "c_custkey", F.col("price") / 2 + F.col("closed"), 3000, ["c_custkey"])
    return top.select("c_custkey", "c_name", *[tb.near(c) for c in ("price", "closed", "score")])


@query("""
SELECT r_name AS region, CAST(year(o_orderdate) AS INTEGER) AS year, round(avg(l_extendedprice - l_quantity * 1000) * 1024) / 1024 AS gap
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2
""")
def gap_by_group(spark, d):
    """The gap is summed per order, then per customer and year, before each join."""
    gap = F.col("l_extendedprice") - F.col("l_quantity") * 1000
    per_order = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(gap).alias("s"), F.count(gap).alias("n"))
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"))
    yearly = (
        per_order.join(o, per_order.l_orderkey == o.o_orderkey).groupBy("c_custkey", "year").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    )
    out = yearly.join(_regions(spark, d), "c_custkey").groupBy("region", "year").agg((F.sum("s") / F.sum("n")).alias("gap"))
    return out.withColumn("gap", tb.near("gap"))


@query("""
WITH s AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS mean, stddev_samp(value) AS sd, median(value) AS median FROM events GROUP BY 1)
SELECT day, round(mean, 6) AS mean, round(sd, 6) AS sd, round(median, 6) AS median, round(mean - sd, 6) AS lower, round(mean + sd, 6) AS upper FROM s
""")
def trend_mean_median_sd(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    out = trends.spread_by(e, ["day"], "value")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "sd", "median", "lower", "upper")})


@query("""
SELECT user_id, arg_min(value, event_id) AS first, arg_max(value, event_id) AS last, max(event_id) AS last_period,
  round(arg_max(value, event_id) - arg_min(value, event_id), 6) AS change FROM events GROUP BY 1
""")
def first_last_delta(spark, d):
    out = trends.first_last_change(table(spark, d, "events"), ["user_id"], "event_id", "value")
    return out.withColumn("change", F.round("change", 6))


@query("""
WITH t AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, avg(o_totalprice) AS price FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, year, round(price, 3) AS price,
  round(greatest(price - lag(price) OVER (PARTITION BY o_orderpriority ORDER BY year), CASE WHEN year > (SELECT min(year) FROM t) THEN 0.0::DOUBLE END), 3) AS price_step
FROM t
""")
def yoy_clip(spark, d):
    means = trends.mean_by(_orders(spark, d), ["o_orderpriority", "year"], {"price": "o_totalprice"})
    out = trends.step_change(means, ["o_orderpriority"], "year", ["price"], floor=0.0)
    return out.withColumns({c: F.round(c, 3) for c in ("price", "price_step")})


_MINMAX = ("price", "quantity")


@query("""
WITH t AS (SELECT l_returnflag, avg(l_extendedprice) AS price, avg(l_quantity) AS quantity FROM lineitem GROUP BY 1)
SELECT l_returnflag, round((price - (SELECT min(price) FROM t)) / ((SELECT max(price) - min(price) FROM t) + 1e-9), 5) AS price,
  round((quantity - (SELECT min(quantity) FROM t)) / ((SELECT max(quantity) - min(quantity) FROM t) + 1e-9), 5) AS quantity FROM t
""")
def minmax_profile(spark, d):
    means = trends.mean_by(table(spark, d, "lineitem"), ["l_returnflag"], {"price": "l_extendedprice", "quantity": "l_quantity"})
    return trends.minmax_profile(means, _MINMAX).withColumns({c: F.round(c, 5) for c in _MINMAX})


@query("""
SELECT o_orderkey, round(least(greatest(31.5::DOUBLE * (o_totalprice / (SELECT avg(o_totalprice) FROM orders)), 12), 58), 6) AS share FROM orders
""")
def share_of_mean(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.round(trends.share_of_mean(o, "o_totalprice", 31.5, 12.0, 58.0), 6).alias("share"))


@query(
    with_ctes("""
SELECT c_custkey, year, v, lag(v, 1) OVER w AS v_lag1, lag(v, 2) OVER w AS v_lag2, v - lag(v, 1) OVER w AS v_delta
FROM sparse_panel WINDOW w AS (PARTITION BY c_custkey ORDER BY year)""")
)
def lag_features(spark, d):
    return trends.lag_features(tb.sparse_panel(spark, d).drop("w"), ["c_custkey"], "year", "v")


@query("""
SELECT c_mktsegment, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM customer), 6) AS share_pct FROM customer GROUP BY 1
""")
def value_counts_share(spark, d):
    return trends.share_by(table(spark, d, "customer"), "c_mktsegment").withColumn("share_pct", F.round("share_pct", 6))


@query("SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL")
def distinct_domain(spark, d):
    return shape.distinct_values(table(spark, d, "events"), "event_type")


@query("""
SELECT count(DISTINCT user_id) AS entities, round(avg(value), 6) AS avg_value, round(avg(event_id), 4) AS avg_id
FROM events WHERE event_type IN ('click', 'view')
""")
def kpi_cards(spark, d):
    e = shape.select_filters(table(spark, d, "events"), {"event_type": ["click", "view"], "user_id": None})
    out = trends.kpi_cards(e, "user_id", {"avg_value": "value", "avg_id": "event_id"})
    return out.withColumns({"avg_value": F.round("avg_value", 6), "avg_id": F.round("avg_id", 4)})


@query("""
WITH o AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT o_orderkey, year FROM o WHERE year = (SELECT max(year) FROM o)
""")
def snapshot_latest(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return shape.latest_snapshot(o, "year")


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1996, 1998, 2000) GROUP BY 1
""")
def stepped_years(spark, d):
    rows = shape.periods_in(_orders(spark, d), "year", range(1990, 2002, 2))
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT 'top' AS side, s_suppkey, s_acctbal FROM (SELECT * FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 15)
UNION ALL SELECT 'bottom', s_suppkey, s_acctbal FROM (SELECT * FROM supplier ORDER BY s_acctbal, s_suppkey LIMIT 15)
""")
def top_bottom(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    top = shape.top_n(s, "s_acctbal", 15, ["s_suppkey"]).select(F.lit("top").alias("side"), "*")
    bottom = shape.top_n(s, "s_acctbal", 15, ["s_suppkey"], ascending=True).select(F.lit("bottom").alias("side"), "*")
    return top.unionByName(bottom)


@query("""
SELECT o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 ELSE 0 END::BIGINT AS rank,
  count(*) AS n, round(avg(o_totalprice), 1) AS mean_price FROM orders GROUP BY 1
""")
def category_order(spark, d):
    out = trends.mean_by(_orders(spark, d), ["o_orderpriority"], {"mean_price": "o_totalprice"}, digits=1)
    n = _orders(spark, d).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    rank = category_rank("o_orderpriority", ["1-URGENT", "3-MEDIUM", "2-HIGH"])
    return out.join(n, "o_orderpriority").withColumn("rank", rank).orderBy("rank", "o_orderpriority")


@query("""
SELECT event_type, round(median(value), 6) AS median, (SELECT round(median(value), 6) FROM events) AS overall_median FROM events GROUP BY 1
""")
def group_median_order(spark, d):
    out = trends.group_medians(table(spark, d, "events"), "event_type", "value")
    return out.withColumns({c: F.round(c, 6) for c in ("median", "overall_median")})


_RISK = ("l_quantity", "l_discount", "l_tax")


@query(
    " UNION ALL ".join(
        f"SELECT CAST(year(l_shipdate) AS INTEGER) AS year, '{c}' AS variable, round(avg({c}), 6) AS mean FROM lineitem "
        "WHERE year(l_shipdate) IN (1995, 1998) OR year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem) GROUP BY 1"
        for c in _RISK
    )
)
def risk_factor_periods(spark, d):
    li = table(spark, d, "lineitem").withColumn("year", F.year("l_shipdate"))
    return trends.period_means(li, "year", [1995, 1998], _RISK).withColumn("mean", F.round("mean", 6))


@query(
    with_ctes("""
SELECT 'sparse' AS table_name, count(*) AS row_count, min(year) AS first_period, max(year) AS last_period,
  round_even((count(*) * 2 - count(v) - count(w)) / (count(*) * 4)::DOUBLE * 100, 2) AS null_pct,
  CASE WHEN (count(*) * 2 - count(v) - count(w)) / (count(*) * 4)::DOUBLE * 100 < 1 THEN 'complete' ELSE 'incomplete' END AS status FROM sparse_panel
UNION ALL SELECT 'customer', count(*), NULL, NULL, 0.0::DOUBLE, 'complete' FROM customer""")
)
def dq_audit(spark, d):
    return quality.audit({"sparse": tb.sparse_panel(spark, d), "customer": table(spark, d, "customer")})


@query("""
SELECT count(*) AS groups, CAST(sum(n - 1) AS BIGINT) AS extra_rows FROM
  (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
""")
def duplicate_keys(spark, d):
    return quality.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    with_ctes("""
SELECT 'deaths_per_100k' AS a, 'age_std_death_rate' AS b, bool_and(coalesce(deaths_per_100k = age_std_death_rate, false)) AS identical FROM fact_cardiovascular
UNION ALL SELECT 'deaths_per_100k', 'dalys_per_100k', bool_and(coalesce(deaths_per_100k = dalys_per_100k, false)) FROM fact_cardiovascular""")
)
def redundant_column(spark, d):
    f = tb.fact_cardiovascular(spark, d)
    return quality.identical_columns(f, [("deaths_per_100k", "age_std_death_rate"), ("deaths_per_100k", "dalys_per_100k")])


@query("""
SELECT 'c_acctbal' AS variable, min(c_acctbal) AS min, max(c_acctbal) AS max, count(*) FILTER (c_acctbal < 0) AS below FROM customer
UNION ALL SELECT 'c_custkey', min(c_custkey)::DOUBLE, max(c_custkey)::DOUBLE, count(*) FILTER (c_custkey < 0) FROM customer
""")
def range_check(spark, d):
    return quality.range_check(table(spark, d, "customer"), ["c_acctbal", "c_custkey"])


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal <= 0")
def anomaly_report(spark, d):
    return clean.not_above(table(spark, d, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("customer", "orders", "lineitem", "events")))
def table_counts(spark, d):
    return quality.table_counts({t: table(spark, d, t) for t in ("customer", "orders", "lineitem", "events")})


@query(
    with_ctes(
        " UNION ALL ".join(
            f"SELECT CAST(day AS DATE) AS day, '{t}' AS event_type, round(avg(v_{t}), 6) AS mean FROM wide_indicators GROUP BY 1" for t in EVENT_TYPES
        )
    )
)
def mean_several_by_period(spark, d):
    """Means of several columns by period, brought to long form."""
    cols = [f"v_{t}" for t in EVENT_TYPES]
    means = trends.mean_by(tb.wide_indicators(spark, d), ["day"], {t: c for t, c in zip(EVENT_TYPES, cols)}, digits=6)
    return means.unpivot(["day"], list(EVENT_TYPES), "event_type", "mean")
