"""The whole load from raw feeds, upserts, table writes and the streaming load."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from panelfold import schemas
from panelfold.checks import testbed as tb
from panelfold.checks.joining import paged, paged_feeds, parsed_documents
from panelfold.checks.registry import query
from panelfold.checks.testbed import half_even_sql, imputed_sql, letters_sql, table, with_ctes
from panelfold.operators import combine, quality
from panelfold.operators.features import levels_of
from panelfold.operators.upsert import merge_upsert
from panelfold.plans import etl
from panelfold.session import scratch_dir, stage
from panelfold.sources import files, sinks
from panelfold.streaming.incremental import stream_upsert

_CODE = f"({letters_sql('c_custkey')})"
_LOW_INCOME = ", ".join(f"'{c}'" for c in etl.LOW_INCOME_CODES)


def _population(spark, d):
    """Population records: the balance of customers, with empty and zero values that must be left out."""
    c = table(spark, d, "customer")
    value = F.when(F.col("c_mktsegment") == "FURNITURE", "0").when(F.col("c_mktsegment") != "AUTOMOBILE", F.col("c_acctbal").cast("string"))
    record = F.struct(tb.letters("c_custkey").alias("countryiso3code"), F.lit("2022").alias("date"), value.alias("value"))
    pages = paged(c, ["c_custkey"], record)
    return etl.population_lookup(files.explode_pages(pages, "body", schemas.PAGED_RECORD))


_POP_SQL = f"""SELECT {_CODE} AS code, max(CAST(floor(c_acctbal) AS BIGINT)) AS pop FROM customer
WHERE c_mktsegment NOT IN ('FURNITURE', 'AUTOMOBILE') AND c_acctbal <> 0 GROUP BY 1"""

_COUNTRIES_SQL = f"""
SELECT {_CODE} AS country_code, substr(c_mktsegment, 1, 2) AS country_code_2, c_name AS country_name, r_name AS region, n_name AS sub_region,
  CASE WHEN {_CODE} IN ({_LOW_INCOME}) THEN 'Low income' ELSE 'Lower middle income' END AS income_group,
  CASE WHEN coalesce(p.pop, CASE WHEN c_mktsegment <> 'MACHINERY' AND c_acctbal <> 0 THEN CAST(trunc(c_acctbal * 60) AS BIGINT) END) > 0
       THEN coalesce(p.pop, CAST(trunc(c_acctbal * 60) AS BIGINT)) ELSE 5000000 END AS population,
  CASE WHEN c_mktsegment <> 'MACHINERY' AND c_acctbal <> 0 THEN c_acctbal ELSE 1000 END AS area_km2,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN n_name || ', ' || r_name ELSE 'N/A' END AS capital, n_name || ', ' || r_name AS languages, n_name || ', XX' AS currency,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_nationkey + CAST(0.5 AS DOUBLE) ELSE 0 END AS lat,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(-7.25 AS DOUBLE) ELSE 0 END AS lon
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN pops p ON p.code = {_CODE}
WHERE c_acctbal > 0"""


def _countries(spark, d):
    return etl.clean_countries(etl.extract_countries(parsed_documents(spark, d), _population(spark, d)))


@query(with_ctes("SELECT * FROM countries", {"pops": _POP_SQL, "countries": _COUNTRIES_SQL}))
def load_countries(spark, d):
    return _countries(spark, d)


# --- indicator API ------------------------------------------------------------------------------

# Which orders feed which indicator.
_API = {
    "life_expectancy_total": "true",
    "life_expectancy_male": "o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "life_expectancy_female": "o_orderpriority NOT IN ('1-URGENT', '2-HIGH')",
    "infant_mortality_per_1000": "o_orderstatus = 'F'",
    "under5_mortality_per_1000": "o_orderstatus = 'O'",
    "adult_mortality_male_per_1000": "o_orderstatus <> 'P'",
    "adult_mortality_female_per_1000": "o_orderstatus = 'P'",
    "neonatal_mortality_per_1000": "o_orderpriority = '1-URGENT'",
    "physicians_per_1000": "o_orderpriority = '5-LOW'",
    "hospital_beds_per_1000": "o_orderkey % 3 = 0",
    "health_expenditure_pct_gdp": "o_orderkey % 5 <> 0",
}


def _indicator_records(spark, d):
    """One feed per indicator, a page of records per customer; a year without orders has an empty value."""
    o = table(spark, d, "orders").withColumn("code", tb.letters("o_custkey"))
    yearly = o.groupBy("code", F.year("o_orderdate").alias("y")).agg(
        *[F.max(F.when(F.expr(cond), tb.cents("o_totalprice"))).alias(c) for c, cond in _API.items()]
    )

    def record(c):
        return F.struct(
            F.col("code").alias("countryiso3code"),
            F.col("y").cast("string").alias("date"),
            (F.col(c) / 64).cast("string").alias("value"),
            F.struct(F.col("code").alias("value")).alias("country"),
        )

    # the pages of all feeds are made by one grouping, and each feed reads its own
    pages = stage(paged_feeds(yearly, ["code"], {c: record(c) for c in _API}), "api")

    def feed(c):
        return files.explode_pages(pages.select("code", F.col(c).alias("body")), "body", schemas.PAGED_RECORD)

    return etl.tag_feeds({etl.INDICATORS[c]: feed(c) for c in _API}, "tag")


_API_CTES = {
    "pops": _POP_SQL,
    "countries": _COUNTRIES_SQL,
    "api": f"""SELECT {letters_sql("o_custkey")} AS country_code, CAST(year(o_orderdate) AS INTEGER) AS year, """
    + ", ".join(f"max(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER ({f}) / 64 AS {c}" for c, f in _API.items())
    + " FROM orders GROUP BY 1, 2",
    "known": "SELECT * FROM api WHERE country_code IN (SELECT country_code FROM countries)",
}


@query(with_ctes("SELECT country_code, country_code AS country_name, year, " + ", ".join(_API) + " FROM api", _API_CTES))
def extract_indicators(spark, d):
    wide = etl.extract_indicators(_indicator_records(spark, d), "tag", ["feed_no", "at"])
    return wide.select("country_code", "country_name", "year", *_API)


# Every price is above zero, so neither gender's value is taken from the total.
_LIFE_OUT = ", ".join(etl.INDICATORS)


@query(
    with_ctes(
        f"SELECT country_code, country_code AS country_name, year, {_LIFE_OUT}, 'World Bank API' AS data_source FROM imputed",
        {**_API_CTES, **imputed_sql("known", "country_code", "year", list(_API), digits=3)},
    )
)
def load_life_expectancy(spark, d):
    return etl.clean_life(etl.extract_indicators(_indicator_records(spark, d), "tag", ["feed_no", "at"]), _countries(spark, d))


# --- CSV-like feeds -------------------------------------------------------------------------------


def _feeds(spark, d, names):
    """Headed feeds keyed by (Entity, Code, Year); each measure is the highest order of some kind."""
    kinds = [
        F.lit(True),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
        F.col("o_orderstatus") == "F",
        F.col("o_orderpriority") == "5-LOW",
        F.col("o_orderstatus") == "O",
    ][: len(names)]
    x = tb.cents("o_totalprice") / 65536
    # orders pass one shuffle by their number, and the keys' texts are made once a customer and year
    yearly = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("Year")).agg(
        *[F.count_if(kind).alias(f"n{i}") for i, kind in enumerate(kinds)], *[F.max(F.when(kind, x)).alias(f"x{i}") for i, kind in enumerate(kinds)]
    )
    keys = [F.concat(F.lit("E"), F.col("o_custkey").cast("string")).alias("Entity"), tb.letters("o_custkey").alias("Code"), "Year"]
    numbers = [c for i in range(len(kinds)) for c in (f"n{i}", f"x{i}")]
    rows = stage(yearly.select(*keys, *numbers), "feeds")  # read by every feed
    return [rows.where(F.col(f"n{i}") > 0).select("Entity", "Code", "Year", F.col(f"x{i}").cast("string").alias(name)) for i, name in enumerate(names)]


def _raw(spark, d, names):
    return combine.merge_feeds(_feeds(spark, d, names), ["Entity", "Year", "Code"])


_KINDS_SQL = ("", "FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH'))", "FILTER (o_orderstatus = 'F')", "FILTER (o_orderpriority = '5-LOW')", "FILTER (o_orderstatus = 'O')")


def _feed_ctes(columns):
    code = letters_sql("o_custkey")
    cols = ", ".join(f"max(CAST(round(o_totalprice * 100) AS BIGINT)) {k} / 65536 AS {c}" for c, k in zip(columns, _KINDS_SQL))
    return {
        "pops": _POP_SQL,
        "countries": _COUNTRIES_SQL,
        "feed": f"SELECT {code} AS country_code, 'E' || o_custkey AS country_name, CAST(year(o_orderdate) AS INTEGER) AS year, {cols} FROM orders GROUP BY ALL",
        "known": "SELECT * FROM feed WHERE country_code IN (SELECT country_code FROM countries)",
    }


_CARDIO_NAMES = ["Total deaths from cardiovascular diseases", "Age-standardized rate", "Hypertension, adults", "Share of adults who smoke"]
_CARDIO = list(etl.CARDIO_COLUMNS)


@query(
    with_ctes(
        f"""
SELECT country_code, country_name, year, age_std_death_rate AS deaths_per_100k, CAST(round_even(deaths_total, 0) AS BIGINT) AS deaths_total, age_std_death_rate,
  round_even(age_std_death_rate * 2.15::DOUBLE, 4) AS dalys_per_100k,
  round(round_even(least(greatest(31.5::DOUBLE * (age_std_death_rate / (SELECT avg(age_std_death_rate) FROM imputed)), 12), 58), 4) * 256) / 256 AS share_of_deaths_pct,
  high_sbp_deaths, round_even(high_sbp_deaths * 0.68::DOUBLE, 4) AS high_cholesterol_deaths, smoking_deaths,
  round_even(high_sbp_deaths * 0.52::DOUBLE, 4) AS obesity_deaths, 'Our World in Data / WHO' AS data_source
FROM imputed""",
        {**_feed_ctes(_CARDIO), **imputed_sql("known", "country_code", "year", _CARDIO, digits=4)},
    )
)
def load_cardiovascular(spark, d):
    out = etl.clean_cardio(_raw(spark, d, _CARDIO_NAMES), _countries(spark, d))
    # the overall mean is a sum in task order, so its share is compared on a grid
    return out.withColumn("share_of_deaths_pct", tb.near("share_of_deaths_pct", 256))


_EPIDEMIC_NAMES = ["Prevalence in adults", "AIDS-related deaths", "Number of new HIV infections", "Death rate from HIV", "Antiretroviral coverage"]
_EPIDEMIC = list(etl.EPIDEMIC_COLUMNS)


@query(
    with_ctes(
        """
SELECT country_code, country_name, year, round(prevalence_pct, 5) AS prevalence_pct, CAST(living AS BIGINT) AS people_living_with_hiv,
  CAST(round_even(new_infections_total, 0) AS BIGINT) AS new_infections_total, round_even(new_infections_total / pop * 1000, 4) AS new_infections_per_1000,
  CAST(round_even(aids_deaths_total, 0) AS BIGINT) AS aids_deaths_total,
  round_even(CASE WHEN aids_deaths_per_100k > 0 THEN aids_deaths_per_100k ELSE aids_deaths_total / pop * 100000 END, 4) AS aids_deaths_per_100k,
  round(pct_on_antiretroviral, 5) AS pct_on_antiretroviral, CAST(round_even(living * 0.055::DOUBLE, 0) AS BIGINT) AS children_living_with_hiv,
  CAST(round_even(new_infections_total * 0.075::DOUBLE, 0) AS BIGINT) AS new_child_infections,
  CAST(round_even(aids_deaths_total * 1.65::DOUBLE, 0) AS BIGINT) AS children_orphaned_by_aids, 'Our World in Data / UNAIDS' AS data_source
FROM living_rows""",
        {
            **_feed_ctes(_EPIDEMIC),
            **imputed_sql("known", "country_code", "year", _EPIDEMIC, constant=0.01),
            "scaled": "SELECT i.*, c.population::DOUBLE AS pop FROM imputed i JOIN countries c ON i.country_code = c.country_code",
            "living_rows": "SELECT *, round_even(greatest(prevalence_pct / 100 * (pop * 0.62::DOUBLE), 10), 0) AS living FROM scaled",
        },
    )
)
def load_hiv_aids(spark, d):
    out = etl.clean_epidemic(_raw(spark, d, _EPIDEMIC_NAMES), _countries(spark, d))
    return out.withColumns({c: F.round(c, 5) for c in ("prevalence_pct", "pct_on_antiretroviral")})


_METABOLIC_NAMES = ["Total deaths from diabetes", "Death rate from diabetes", "Obesity among adults", "Diabetes prevalence"]
_METABOLIC = list(etl.METABOLIC_COLUMNS)


@query(
    with_ctes(
        """
SELECT country_code, country_name, year, diabetes_prevalence_pct, CAST(round_even(diabetes_deaths_total, 0) AS BIGINT) AS diabetes_deaths_total,
  diabetes_deaths_per_100k, diabetes_deaths_per_100k AS diabetes_age_std_rate, obesity_prevalence_pct,
  round_even(least(greatest(obesity_prevalence_pct * 1.85::DOUBLE, 6), 85), 4) AS overweight_prevalence_pct,
  round_even(obesity_prevalence_pct * 0.36::DOUBLE, 4) AS child_obesity_pct,
  round_even(22.2::DOUBLE + obesity_prevalence_pct * 0.16::DOUBLE, 3) AS mean_bmi_male,
  round_even(22.8::DOUBLE + obesity_prevalence_pct * 0.18::DOUBLE, 3) AS mean_bmi_female,
  round_even(125 + diabetes_prevalence_pct * 48, 2) AS diabetes_health_spend_usd, 'Our World in Data / WHO' AS data_source
FROM done""",
        {
            **_feed_ctes(_METABOLIC),
            **imputed_sql("known", "country_code", "year", _METABOLIC, digits=4),
            "done": """SELECT * REPLACE (round_even(CASE WHEN diabetes_prevalence_pct > 0 THEN diabetes_prevalence_pct ELSE
  least(greatest(3.5 + diabetes_deaths_per_100k * 0.16 + obesity_prevalence_pct * 0.22, 2), 26) END, 4) AS diabetes_prevalence_pct) FROM imputed""",
        },
    )
)
def load_diabetes_obesity(spark, d):
    return etl.clean_metabolic(_raw(spark, d, _METABOLIC_NAMES), _countries(spark, d))


# --- derived indicators on the panel --------------------------------------------------------------


@query(
    with_ctes("""
SELECT country_code, year, round(life_expectancy_female - life_expectancy_male, 6) AS gender_le_gap, round((mean_bmi_male + mean_bmi_female) / 2, 6) AS mean_bmi_overall,
  round(diabetes_prevalence_pct * obesity_prevalence_pct / 100, 6) AS metabolic_risk_index,
  round(physicians_per_1000 * health_expenditure_pct_gdp, 6) AS healthcare_density,
  round(cvd_deaths_per_100k / nullif(cvd_dalys_per_100k, 0), 6) AS cvd_burden_ratio FROM panel""")
)
def derived_indicators(spark, d):
    from panelfold.functions.formulas import engineered_features

    return tb.stored_panel(spark, d).select("country_code", "year", *[F.round(e, 6).alias(n) for n, e in engineered_features().items()])


# --- writes ---------------------------------------------------------------------------------------


def _upsert_sides(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    status = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    rows = o.join(status, "o_orderkey")
    target = rows.where(F.col("o_orderstatus") != "P").select(*o.columns)
    source = rows.where(F.col("y") >= 1998).select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice")).otherwise(F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.lit("0-NEW").alias("o_orderpriority"),
    )
    return target, source


_UPSERT_SQL = """
WITH t AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
s AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice ELSE o_totalprice + 1 END AS price FROM orders WHERE year(o_orderdate) >= 1998),
m AS (SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
  coalesce(s.price, t.o_totalprice) AS o_totalprice, CASE WHEN t.o_orderkey IS NULL THEN '0-NEW' ELSE t.o_orderpriority END AS o_orderpriority,
  CASE WHEN t.o_orderkey IS NULL THEN 'inserted' WHEN s.o_orderkey IS NULL THEN 'untouched' WHEN s.price = t.o_totalprice THEN 'unchanged' ELSE 'updated' END AS _action
  FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey)
"""


@query(_UPSERT_SQL + "SELECT * FROM m")
def upsert_merge(spark, d):
    target, source = _upsert_sides(spark, d)
    # repeated source rows collapse to the last by price; a union of two joins would claim their partitioning and not keep it
    price = F.col("o_totalprice")
    repeated = source.withColumn("o_totalprice", F.explode(F.array(price, price - 5)))
    return merge_upsert(target, repeated, ["o_orderkey"], ["o_totalprice"], order=["o_totalprice"], action=True)


@query(_UPSERT_SQL + "SELECT _action AS action, count(*) AS rows FROM m GROUP BY 1")
def upsert_counts(spark, d):
    target, source = _upsert_sides(spark, d)
    return sinks.upsert_report(target, source, ["o_orderkey"], ["o_totalprice"])


def _folder(spark, label):
    return os.path.join(scratch_dir(spark), f"{label}-{uuid.uuid4().hex}")


@query("""
SELECT t AS table_name, n AS source_rows, n AS sink_rows, true AS same FROM
  (SELECT 'customer' AS t, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders)
""")
def table_replace_counts(spark, d):
    source = {t: table(spark, d, t) for t in ("customer", "orders")}
    folder = _folder(spark, "tables")
    sink = {t: sinks.replace_table(df, f"{folder}/{t}") for t, df in source.items()}
    return quality.reconcile(source, sink)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, d):
    c = table(spark, d, "customer")
    folder = _folder(spark, "csv")
    c.write.option("header", True).csv(f"{folder}/customer.csv")
    return files.load_first_available(spark, "customer", [f"{folder}/none", folder], c.schema)


@query(_UPSERT_SQL + "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM m")
def stream_upsert_orders(spark, d):
    """The streaming load over a landing folder, then a second run that finds nothing new."""
    target, source = _upsert_sides(spark, d)
    folder = _folder(spark, "stream")
    sinks.write_version(target, f"{folder}/table", 0)
    source.write.parquet(f"{folder}/landing")
    for _ in range(2):
        stream_upsert(
            spark, f"{folder}/landing", source.schema, f"{folder}/table", ["o_orderkey"], ["o_totalprice"], f"{folder}/progress"
        )
    return sinks.read_version(spark, f"{folder}/table")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_lines_round_trip(spark, d):
    c = table(spark, d, "customer")
    folder = _folder(spark, "json")
    c.write.json(folder)
    return files.read_json(spark, folder, c.schema)


@query("SELECT CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS position, feature FROM (SELECT DISTINCT c_mktsegment AS feature FROM customer)")
def feature_list_round_trip(spark, d):
    """A feature list made of the levels of a column, as written and read."""
    names = levels_of(table(spark, d, "customer"), ["c_mktsegment"], most=100)["c_mktsegment"]
    folder = _folder(spark, "features")
    sinks.write_features(spark, names, folder)
    return spark.createDataFrame(list(enumerate(sinks.read_features(spark, folder))), "position int, feature string")


@query("SELECT 'dim_countries' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'fact_hiv_aids', 0")
def created_tables(spark, d):
    """Tables of the store created in the catalog; creating them again leaves the dimension's rows alone."""
    database = f"store_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    some = {t: schemas.TABLES[t] for t in ("dim_countries", "fact_hiv_aids")}
    sinks.create_tables(spark, some, database)
    sinks.conform(tb.dim_countries(spark, d), some["dim_countries"]).write.insertInto(f"{database}.dim_countries")
    sinks.create_tables(spark, some, database)
    return quality.table_counts({t: spark.table(f"{database}.{t}") for t in some})
