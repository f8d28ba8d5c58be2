"""Feeds, pivots, nested records, star joins and referential checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelfold import schemas
from panelfold.checks import testbed as tb
from panelfold.checks.registry import query
from panelfold.checks.testbed import table, with_ctes
from panelfold.operators import combine, quality, shape
from panelfold.plans import star as star_plan
from panelfold.sources import files


@query(
    with_ctes("""
SELECT coalesce(a.nation, b.nation) AS nation, coalesce(a.year, b.year) AS year, coalesce(a.code, b.code) AS code, order_cents, quantity
FROM feed_a a FULL JOIN feed_b b ON a.nation = b.nation AND a.year = b.year AND a.code IS NOT DISTINCT FROM b.code""")
)
def feed_outer_merge(spark, d):
    return combine.merge_feeds(tb.keyed_feeds(spark, d), ["nation", "year", "code"])


@query("""
SELECT user_id, CAST(ts AS DATE) AS day, arg_min(props, event_id) AS first_props,
  arg_max(value, event_id) FILTER (event_type = 'click') AS click, arg_max(value, event_id) FILTER (event_type = 'view') AS view_value,
  arg_max(value, event_id) FILTER (event_type = 'purchase') AS purchase, arg_max(value, event_id) FILTER (event_type = 'error') AS error,
  arg_max(value, event_id) FILTER (event_type = 'signup') AS signup
FROM events GROUP BY 1, 2
""")
def indicator_pivot(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts")).withColumnRenamed("props", "first_props")
    tags = {"click": "click", "view_value": "view", "purchase": "purchase", "error": "error", "signup": "signup"}
    return combine.pivot_feeds(e, ["user_id", "day"], "event_type", "value", ["event_id"], tags, ["first_props"])


def customer_documents(spark, d):
    """One nested JSON text per customer."""
    # few bytes a customer, but much work: dealt to all cores, however few files the table has, and not made where the nations are
    c, g = table(spark, d, "customer").repartition(spark.sparkContext.defaultParallelism, "c_custkey"), tb.geography(spark, d)
    named = F.struct(F.col("c_name").alias("common"))
    doc = F.struct(
        F.substring("c_mktsegment", 1, 2).alias("cca2"),
        F.concat(F.lit(" "), F.lower(tb.letters("c_custkey"))).alias("cca3"),
        F.when(F.col("c_acctbal") > 0, named).alias("name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("subregion"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal")).alias("area"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.array((F.col("c_nationkey") + 0.5).cast("double"), F.lit(-7.25).cast("double"))).alias("latlng"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.array("n_name", "r_name")).alias("capital"),
        F.create_map(F.lit("l1"), F.col("n_name"), F.lit("l2"), F.col("r_name")).alias("languages"),
        F.create_map(F.col("n_name"), F.struct(F.col("r_name").alias("symbol")), F.lit("XX"), F.struct(F.lit("x").alias("symbol"))).alias("currencies"),
    )
    return c.join(F.broadcast(g), c.c_nationkey == g.n_nationkey).select("c_custkey", F.to_json(doc).alias("body"))


def parsed_documents(spark, d):
    docs = customer_documents(spark, d)
    return docs.select("c_custkey", F.from_json("body", schemas.COUNTRY_JSON).alias("j")).select("c_custkey", "j.*")


@query("""
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name END AS common, n_name || ',XX' AS currency_codes, n_name || '/' || r_name AS language_names,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN n_name || '+' || r_name END AS capitals,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_nationkey + CAST(0.5 AS DOUBLE) END AS lat
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def nested_flatten(spark, d):
    return parsed_documents(spark, d).select(
        "c_custkey",
        F.col("name.common").alias("common"),
        F.array_join(F.map_keys("currencies"), ",").alias("currency_codes"),
        F.array_join(F.map_values("languages"), "/").alias("language_names"),
        F.array_join("capital", "+").alias("capitals"),
        F.try_element_at("latlng", F.lit(1)).alias("lat"),
    )


def paged(rows, keys, record):
    """API-like pages: one ``[meta, [record, ...]]`` text per key.  The keys bound the records of a page."""
    return paged_feeds(rows, keys, {"body": record})


def paged_feeds(rows, keys, records):
    """Pages of several feeds, a column each, from one grouping of the rows."""
    meta = F.struct(F.lit(1).alias("page"))
    pages = rows.groupBy(*keys).agg(*[F.sort_array(F.collect_list(record)).alias(name) for name, record in records.items()])
    body = lambda name: F.concat(F.lit("["), F.to_json(meta), F.lit(","), F.to_json(name), F.lit("]"))
    return pages.select(*keys, *[body(name).alias(name) for name in records])


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS code, CAST(o.year AS INTEGER) AS year, o.n AS value
FROM customer LEFT JOIN (SELECT o_custkey, year(o_orderdate) AS year, CAST(count(*) AS DOUBLE) AS n FROM orders GROUP BY 1, 2) o ON c_custkey = o_custkey
WHERE o.year IS NOT NULL
""")
def paged_json_explode(spark, d):
    yearly = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    record = F.struct(
        F.col("o_custkey").cast("string").alias("countryiso3code"), F.col("y").cast("string").alias("date"), F.col("n").cast("string").alias("value")
    )
    pages = paged(yearly, ["o_custkey"], record)
    records = files.explode_pages(pages, "body", schemas.PAGED_RECORD)
    return records.select(
        F.col("countryiso3code").alias("code"), F.col("date").try_cast("int").alias("year"), F.col("value").try_cast("double").alias("value")
    )


_PANEL_COLUMNS = ", ".join(["country_code", "year", *star_plan.MEASURES, "region", "income_group"])


@query(with_ctes(f"SELECT {_PANEL_COLUMNS} FROM panel"))
def star_panel(spark, d):
    return tb.panel(spark, d)


@query(
    with_ctes("SELECT count(*) AS row_count, count(DISTINCT country_code) AS entities, min(year) AS first_period, max(year) AS last_period FROM panel")
)
def panel_coverage(spark, d):
    return quality.coverage(tb.panel(spark, d), "country_code", "year")


@query(
    with_ctes("""
SELECT h.country_code, h.year, h.prevalence_pct, c.deaths_per_100k
FROM fact_hiv_aids h JOIN fact_cardiovascular c ON h.country_code = c.country_code AND h.year = c.year""")
)
def fact_to_fact(spark, d):
    h, c = tb.fact_hiv_aids(spark, d), tb.fact_cardiovascular(spark, d)
    return combine.fact_to_fact(h, c, "country_code", "year", "prevalence_pct", "deaths_per_100k")


def _orders(spark, d):
    return table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")


@query("SELECT o_orderkey, o_custkey AS c_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def semi_valid_keys(spark, d):
    return combine.known_keys(_orders(spark, d).select("o_orderkey", "c_custkey"), tb.good_customers(spark, d), "c_custkey")


@query("""
SELECT o_custkey AS c_custkey, count(*) AS orphan_rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1
""")
def orphan_report(spark, d):
    lost = combine.orphans(_orders(spark, d), tb.good_customers(spark, d), "c_custkey")
    return lost.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("orphan_rows"))


@query("""
WITH kept AS (SELECT * FROM customer WHERE c_acctbal >= 0),
kept_orders AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM kept))
SELECT 'customer' AS table_name, count(*) AS row_count FROM kept UNION ALL SELECT 'orders', count(*) FROM kept_orders
""")
def cascade_delete(spark, d):
    c = table(spark, d, "customer")
    dim, facts = combine.cascade_delete(c, {"orders": _orders(spark, d)}, "c_custkey", F.col("c_acctbal") < 0)
    return quality.table_counts({"customer": dim, **facts})


@query("""
SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o_custkey = c_custkey
""")
def left_enrich(spark, d):
    names = tb.good_customers(spark, d).select("c_custkey", "c_name", "c_mktsegment")
    return _orders(spark, d).join(names, "c_custkey", "left").select("o_orderkey", "c_name", "c_mktsegment")


@query("""
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND year(o_orderdate) = 2001
""")
def left_on_filter(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    joined = combine.left_join_where(c, _orders(spark, d), ["c_custkey"], F.year("o_orderdate") == 2001)
    return joined.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("""
SELECT coalesce(c_acctbal, 10000000) = 10000000 AS defaulted, count(*) AS n
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o_custkey = c_custkey GROUP BY 1
""")
def lookup_default(spark, d):
    o = shape.with_lookup(_orders(spark, d), tb.good_customers(spark, d), "c_custkey", "c_acctbal", 10_000_000.0)
    return o.groupBy((F.col("c_acctbal") == 10_000_000.0).alias("defaulted")).agg(F.count(F.lit(1)).alias("n"))
