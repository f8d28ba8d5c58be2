"""Cleaning and gap filling."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelfold.checks.registry import query
from panelfold.checks.testbed import (
    cents,
    geography,
    imputed_sql,
    interpolated_sql,
    near,
    near_sql,
    sparse_panel,
    table,
    with_ctes,
)
from panelfold.functions import scalars as sc
from panelfold.operators import clean, impute, shape


@query(
    with_ctes(
        f"SELECT c_custkey, year, {near_sql('v', 'v')}, {near_sql('w', 'w')} FROM interp",
        interpolated_sql("sparse_panel", "c_custkey", "year", ["v", "w"]),
    )
)
def panel_interpolate(spark, d):
    out = impute.interpolate(sparse_panel(spark, d), ["c_custkey"], "year", ["v", "w"])
    return out.select("c_custkey", "year", near("v"), near("w"))


@query(
    with_ctes(
        f"SELECT event_type, event_id, {near_sql('v', 'v')} FROM interp",
        {"long_keys": "SELECT event_type, event_id, CASE WHEN event_id % 3 = 0 THEN CAST(round(value * 100) AS BIGINT) / 64 END AS v FROM events", **interpolated_sql("long_keys", "event_type", "event_id", ["v"])},
    )
)
def panel_interpolate_long(spark, d):
    """A fifth of all events to a key: the keys are cut into segments."""
    e = table(spark, d, "events")
    rows = e.select("event_type", "event_id", F.when(F.col("event_id") % 3 == 0, cents("value") / 64).alias("v"))
    return impute.interpolate_long(rows, ["event_type"], "event_id", ["v"]).select("event_type", "event_id", near("v"))


@query(
    with_ctes(
        """
SELECT c_custkey, year,
  last_value(v IGNORE NULLS) OVER (PARTITION BY c_custkey ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v,
  first_value(w IGNORE NULLS) OVER (PARTITION BY c_custkey ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w
FROM sparse_panel"""
    )
)
def panel_fill_directions(spark, d):
    forward = impute.fill_forward(sparse_panel(spark, d), ["c_custkey"], "year", ["v"])
    return impute.fill_backward(forward, ["c_custkey"], "year", ["w"])


@query(
    with_ctes(
        f"SELECT c_custkey, year, {near_sql('v', 'v')}, {near_sql('w', 'w')} FROM imputed",
        imputed_sql("sparse_panel", "c_custkey", "year", ["v", "w"]),
    )
)
def panel_impute_full(spark, d):
    out = impute.impute_panel(sparse_panel(spark, d), ["c_custkey"], "year", ["v", "w"])
    return out.select("c_custkey", "year", near("v"), near("w"))


@query(
    with_ctes(
        f"""
SELECT i.c_custkey, i.year, {near_sql('i.v', 'v')}, p.v IS NULL AS v_imputed
FROM imputed i JOIN sparse_panel p ON i.c_custkey = p.c_custkey AND i.year = p.year""",
        imputed_sql("sparse_panel", "c_custkey", "year", ["v"], constant=0.01),
    )
)
def panel_impute_constant(spark, d):
    out = impute.impute_panel(sparse_panel(spark, d), ["c_custkey"], "year", ["v"], constant=0.01, flags=True)
    return out.select("c_custkey", "year", near("v"), "v_imputed")


@query("""
WITH masked AS (SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice < 480000 THEN o_totalprice END AS p FROM orders),
by_key AS (SELECT o_custkey AS k, median(p) AS m FROM masked GROUP BY 1),
filled AS (SELECT o_orderkey, o_custkey, coalesce(p, m) AS p FROM masked JOIN by_key ON o_custkey = k)
SELECT o_orderkey, o_custkey, round(coalesce(p, (SELECT median(p) FROM filled)) * 1024) / 1024 AS o_totalprice FROM filled
""")
def sentinel_repair(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return clean.repair_sentinel(o, "o_custkey", ["o_totalprice"], 480000).withColumn("o_totalprice", near("o_totalprice"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= 480000")
def sentinel_report(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return clean.sentinel_rows(o, ["o_totalprice"], 480000)


@query("""
SELECT c_custkey,
  CASE c_custkey WHEN 3 THEN 'Macau' WHEN 7 THEN 'NA' ELSE trim('  ' || c_name || ' ') END AS c_name,
  CASE c_custkey WHEN 5 THEN CAST(62049 AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
  coalesce(substr(nullif(CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END, ''), 1, 6), 'N/A') AS segment
FROM customer
""")
def key_override_trim(spark, d):
    c = table(spark, d, "customer").withColumn("c_name", F.concat(F.lit("  "), "c_name", F.lit(" ")))
    c = clean.trim_text(c, ["c_name"])
    c = clean.override_cells(c, "c_custkey", {"c_name": {3: "Macau", 7: "NA"}, "c_acctbal": {5: 62049.0}})
    gappy = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", "c_name", "c_acctbal", sc.text_or(gappy, "N/A", 6).alias("segment"))


_MESSY_SQL = """
SELECT event_id, CASE WHEN event_type = 'error' AND value < 10 THEN 'x' WHEN event_type = 'signup' AND value < 5 THEN 'NaN'
  WHEN event_type = 'view' AND value < 5 THEN '' WHEN value > 300 THEN 'Infinity' WHEN value > 200 THEN '-Infinity'
  ELSE CAST(value AS VARCHAR) END AS t FROM events"""


@query(f"""
WITH messy AS ({_MESSY_SQL}), num AS (SELECT event_id, TRY_CAST(t AS DOUBLE) AS v FROM messy),
safe AS (SELECT event_id, v, CASE WHEN isfinite(v) THEN v END AS x FROM num)
SELECT event_id, x, CAST(round_even(x, 0) AS BIGINT) AS n, CASE WHEN x IS NOT NULL THEN least(greatest(x, 12), 58) END AS bounded,
  CASE WHEN NOT isnan(v) THEN v = 'Infinity'::DOUBLE END AS infinite
FROM safe
""")
def safe_numeric(spark, d):
    e, v = table(spark, d, "events"), F.col("value")
    kind = F.col("event_type")
    text = (
        F.when((kind == "error") & (v < 10), "x")
        .when((kind == "signup") & (v < 5), "NaN")
        .when((kind == "view") & (v < 5), "")
        .when(v > 300, "Infinity")
        .when(v > 200, "-Infinity")
        .otherwise(v.cast("string"))
    )
    x = e.select("event_id", text.alias("t"))
    return x.select(
        "event_id",
        sc.safe_double("t").alias("x"),
        sc.safe_long("t").alias("n"),
        sc.clip(sc.safe_double("t"), 12.0, 58.0).alias("bounded"),
        (sc.coerce_numeric("t") == float("inf")).alias("infinite"),
    )


@query("""
SELECT o_orderkey, round_even(o_totalprice / 64, 2) AS two, round_even(o_totalprice / 64, 4) AS four,
  CAST(round_even(o_totalprice / 64, 0) AS BIGINT) AS whole FROM orders
""")
def half_even_rounding(spark, d):
    x = F.col("o_totalprice") / 64
    return table(spark, d, "orders").select(
        "o_orderkey", sc.half_even(x, 2).alias("two"), sc.half_even(x, 4).alias("four"), sc.half_even_long(x).alias("whole")
    )


@query("""
SELECT CASE WHEN c_mktsegment IN ('AUTOMOBILE') AND c_acctbal < 0 THEN 'Low income'
            WHEN r_name IN ('EUROPE', 'AMERICA') THEN 'High income'
            WHEN r_name IN ('ASIA') THEN 'Upper middle income' ELSE 'Lower middle income' END AS tier, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def tier_classify(spark, d):
    c, g = table(spark, d, "customer"), geography(spark, d)
    rules = [
        (F.col("c_mktsegment").isin("AUTOMOBILE") & (F.col("c_acctbal") < 0), "Low income"),
        (F.col("r_name").isin("EUROPE", "AMERICA"), "High income"),
        (F.col("r_name").isin("ASIA"), "Upper middle income"),
    ]
    tiers = c.join(g, c.c_nationkey == g.n_nationkey).select(sc.first_match(rules, "Lower middle income").alias("tier"))
    return tiers.groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_orderkey, coalesce(c_acctbal, 10000000) AS balance,
  CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE round_even(o_totalprice - 2.5, 3) END AS male,
  CASE WHEN trunc(c_acctbal) > 0 THEN CAST(trunc(c_acctbal) AS BIGINT) ELSE 5000000 END AS people
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o_custkey = c_custkey
""")
def fallback_chain(spark, d):
    c = table(spark, d, "customer").where(F.col("c_acctbal") >= 0)
    known = c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal"), F.col("c_acctbal").alias("balance"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    o = o.join(known.select("o_custkey", "c_acctbal"), "o_custkey", "left")
    o = shape.with_lookup(o, known, "o_custkey", "balance", 10_000_000.0)
    whole = F.col("c_acctbal").cast("bigint")
    return o.select(
        "o_orderkey",
        "balance",
        sc.positive_or("c_acctbal", sc.half_even(F.col("o_totalprice") - 2.5, 3)).alias("male"),
        sc.positive_or(whole, F.lit(5_000_000).cast("bigint")).alias("people"),
    )


@query("""
SELECT l_returnflag, count(nullif(l_discount, 0)) AS discounts, count(*) - count(nullif(l_tax, 0)) AS untaxed,
  CAST(sum(CAST(round(coalesce(nullif(l_discount, 0), 1) * 100) AS BIGINT)) AS BIGINT) AS filled_cents
FROM lineitem GROUP BY 1
""")
def falsy_defaults(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_returnflag",
        sc.falsy_to_null("l_discount").alias("disc"),
        sc.falsy_to_null("l_tax").alias("tax"),
        sc.number_or("l_discount", 1.0).alias("filled"),
    )
    return rows.groupBy("l_returnflag").agg(
        F.count("disc").alias("discounts"), F.count_if(F.col("tax").isNull()).alias("untaxed"), F.sum(cents("filled")).alias("filled_cents")
    )


@query("""
SELECT l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, count(CAST(NULL AS DOUBLE)) AS absent,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price_cents FROM lineitem GROUP BY 1
""")
def resolve_columns(spark, d):
    wanted = {"quantity": ["no such", "quantity"], "price": ["price", "tax"], "absent": ["hypertension"]}
    li = shape.resolve_measures(table(spark, d, "lineitem"), wanted)
    return li.groupBy("l_linestatus").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.count("absent").alias("absent"),
        F.sum(cents("price")).alias("price_cents"),
    )


@query("""
WITH coded AS (SELECT c_custkey, c_name,
  CASE WHEN c_mktsegment = 'BUILDING' THEN ' ' || lower(substr(c_mktsegment, 1, 3)) || ' ' WHEN c_mktsegment = 'FURNITURE' THEN 'FU'
       WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE substr(c_mktsegment, 1, 3) END AS code,
  CASE WHEN c_acctbal < 0 THEN '  ' ELSE c_name END AS label FROM customer)
SELECT c_custkey, upper(trim(code)) AS code FROM coded WHERE length(trim(code)) = 3 AND trim(label) <> ''
""")
def valid_code_rows(spark, d):
    seg = F.col("c_mktsegment")
    code = (
        F.when(seg == "BUILDING", F.concat(F.lit(" "), F.lower(F.substring(seg, 1, 3)), F.lit(" ")))
        .when(seg == "FURNITURE", "FU")
        .when(seg == "MACHINERY", F.lit(None).cast("string"))
        .otherwise(F.substring(seg, 1, 3))
    )
    label = F.when(F.col("c_acctbal") < 0, "  ").otherwise(F.col("c_name"))
    rows = table(spark, d, "customer").select("c_custkey", code.alias("code"), label.alias("label"))
    return clean.valid_rows(rows, "code", "label").select("c_custkey", sc.clean_code("code").alias("code"))


@query("""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND year(o_orderdate) BETWEEN 1996 AND 1999
""")
def filter_selections(spark, d):
    o = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    o = shape.period_between(o, "year", 1996, 1999)
    o = shape.select_filters(o, {"o_orderpriority": ["1-URGENT", "5-LOW"], "o_orderstatus": []})
    return o.select("o_orderkey", "o_orderdate")
