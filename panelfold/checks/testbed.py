"""The star schema, sparse panels and raw feeds, derived from the given tables.

Every relation exists twice: as a DataFrame and as a SQL common table expression for the oracles.
Prices enter as whole cents, so their sums are exact and both engines see the same doubles.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

URGENT = ("1-URGENT", "2-HIGH")

# Income class of each market segment; a fifth segment shares the first class.
SEGMENT_CLASS = {
    "AUTOMOBILE": "High income",
    "BUILDING": "Upper middle income",
    "FURNITURE": "Lower middle income",
}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up once, so later reads start no job of their own."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def near(c: str, steps: int = 1024) -> Column:
    """A value on a binary grid.  Decimal data never falls half-way between two grid points, as it does
    when it is rounded to decimals, so the last bits of a sum cannot decide the comparison."""
    return (F.round(F.col(c) * steps) / steps).alias(c)


def near_sql(e: str, c: str, steps: int = 1024) -> str:
    return f"round({e} * {steps}) / {steps} AS {c}"


def _code_places(k: str, div: str) -> list[str]:
    """Places of a code's three signs: 26 capital letters, then signs of a long alphabet, which no table outgrows."""
    more = f"({k} {div} 17576)"
    return [f"(({k} {div} {d}) % 26 + 26 * (({more} {div} {m}) % 770))" for d, m in ((1, 1), (26, 770), (676, 592900))]


def letters(k: str) -> Column:
    """Three signs from an integer column: capital letters up to 17,576."""
    signs = [f"CASE WHEN {i} < 26 THEN chr(65 + {i}) ELSE decode(unhex(hex(19942 + {i})), 'UTF-16BE') END" for i in _code_places(k, "div")]
    return F.expr(" || ".join(signs))


def letters_sql(k: str) -> str:
    return " || ".join(f"chr(CAST(CASE WHEN {i} < 26 THEN 65 + {i} ELSE 19942 + {i} END AS INTEGER))" for i in _code_places(k, "//"))


# --- the star schema --------------------------------------------------------------------------


def geography(spark: SparkSession, d: str) -> DataFrame:
    """Nation with its region."""
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def dim_countries(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    g = geography(spark, d)
    income = F.lit("Low income")
    for segment, label in SEGMENT_CLASS.items():
        income = F.when(F.col("c_mktsegment") == segment, label).otherwise(income)
    return c.join(g, c.c_nationkey == g.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("country_code"),
        F.col("c_name").alias("country_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("sub_region"),
        income.alias("income_group"),
        (cents("c_acctbal") + 200000).alias("population"),
    )


def _yearly(spark: SparkSession, d: str, where: Column | None = None) -> DataFrame:
    o = table(spark, d, "orders")
    if where is not None:
        o = o.where(where)
    return o.groupBy(
        F.col("o_custkey").cast("string").alias("country_code"), F.year("o_orderdate").alias("year")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(cents("o_totalprice")).alias("s"),
        F.min(cents("o_totalprice")).alias("mn"),
        F.max(cents("o_totalprice")).alias("mx"),
        F.count_if(F.col("o_orderpriority").isin(*URGENT)).alias("hi"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
    )


_YEARLY_SQL = """
SELECT CAST(o_custkey AS VARCHAR) AS country_code, CAST(year(o_orderdate) AS INTEGER) AS year,
       count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS s,
       min(CAST(round(o_totalprice * 100) AS BIGINT)) AS mn, max(CAST(round(o_totalprice * 100) AS BIGINT)) AS mx,
       CAST(count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS BIGINT) AS hi,
       CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS f
FROM orders {where} GROUP BY 1, 2
"""

# One formula text per column serves both engines.
_LIFE = {
    "life_expectancy_total": "40 + CAST(s AS DOUBLE) / (n * 100) / 10000",
    "life_expectancy_male": "40 + CAST(s AS DOUBLE) / (n * 100) / 10000 - 1 - hi",
    "life_expectancy_female": "40 + CAST(s AS DOUBLE) / (n * 100) / 10000 + 2 + f",
    "infant_mortality_per_1000": "CAST(5 + 10 * n AS DOUBLE)",
    "under5_mortality_per_1000": "CAST(mn AS DOUBLE) / 100000",
    "adult_mortality_male_per_1000": "CAST(mx AS DOUBLE) / 50000",
    "adult_mortality_female_per_1000": "CAST(mn AS DOUBLE) / 50000",
    "neonatal_mortality_per_1000": "CASE WHEN hi > 0 THEN CAST(3 * hi AS DOUBLE) END",
    "physicians_per_1000": "CAST(hi AS DOUBLE) + CAST(n AS DOUBLE) / 2",
    "hospital_beds_per_1000": "CAST(f AS DOUBLE) + CAST(n AS DOUBLE) / 4",
    "health_expenditure_pct_gdp": "CASE WHEN n % 3 <> 0 THEN CAST(s % 1000 AS DOUBLE) / 100 END",
}
_EPIDEMIC = {
    "prevalence_pct": "CAST(n AS DOUBLE) / 8",
    "people_living_with_hiv": "n * 1000",
    "aids_deaths_total": "n * 7",
    "aids_deaths_per_100k": "CAST(s AS DOUBLE) / (n * 100000)",
    "pct_on_antiretroviral": "CAST(mn % 10000 AS DOUBLE) / 100",
}
_METABOLIC = {
    "diabetes_prevalence_pct": "CAST(s AS DOUBLE) / (n * 5000000)",
    "diabetes_deaths_total": "n * 11",
    "diabetes_deaths_per_100k": "CAST(mx AS DOUBLE) / 1000000",
    "obesity_prevalence_pct": "10 + CAST(s % 5000 AS DOUBLE) / 100",
    "overweight_prevalence_pct": "(10 + CAST(s % 5000 AS DOUBLE) / 100) * 1.5",
    "child_obesity_pct": "CAST(s % 700 AS DOUBLE) / 100",
    "mean_bmi_male": "22 + CAST(s % 900 AS DOUBLE) / 100",
    "mean_bmi_female": "23 + CAST(mx % 900 AS DOUBLE) / 100",
    "diabetes_health_spend_usd": "125 + CAST(mn AS DOUBLE) / 100000",
}
_CARDIO = {
    "deaths_total": "n * 100",
    "deaths_per_100k": "CAST(s AS DOUBLE) / (n * 10000)",
    "age_std_death_rate": "CAST(s AS DOUBLE) / (n * 10000)",
    "dalys_per_100k": "CAST(s AS DOUBLE) / (n * 10000) * 2.25 + tax",
    "share_of_deaths_pct": "CAST(12 + q % 46 AS DOUBLE)",
    "high_sbp_deaths": "CAST(q AS DOUBLE)",
    "high_cholesterol_deaths": "CAST(q AS DOUBLE) / 2 + tax",
    "smoking_deaths": "CAST(tax AS DOUBLE)",
    "obesity_deaths": "CAST(q AS DOUBLE) / 4 + n",
}


def _spark_expr(text: str) -> Column:
    # decimal literals are decimals in Spark and doubles are wanted on both sides
    return F.expr(re.sub(r"(?<![\w.])(\d+\.\d+)", r"\1D", text))


def _with(df: DataFrame, formulas: dict[str, str]) -> DataFrame:
    return df.select("country_code", "year", *[_spark_expr(e).alias(c) for c, e in formulas.items()])


def _sql_with(source: str, formulas: dict[str, str]) -> str:
    cols = ", ".join(f"{re.sub(r'(?<![\w.])(\d+\.\d+)', r'CAST(\1 AS DOUBLE)', e)} AS {c}" for c, e in formulas.items())
    return f"SELECT country_code, year, {cols} FROM ({source}) y"


def fact_life_expectancy(spark: SparkSession, d: str) -> DataFrame:
    return _with(_yearly(spark, d), _LIFE)


def fact_hiv_aids(spark: SparkSession, d: str) -> DataFrame:
    return _with(_yearly(spark, d, F.col("o_orderpriority").isin(*URGENT)), _EPIDEMIC)


def fact_diabetes_obesity(spark: SparkSession, d: str) -> DataFrame:
    return _with(_yearly(spark, d, F.col("o_orderstatus") == "F"), _METABOLIC)


def fact_cardiovascular(spark: SparkSession, d: str) -> DataFrame:
    """Line items by customer and ship year.

    They meet their orders as they are: an order has few lines and those of several years, so reducing them per order
    and year first would cost one more shuffle and spare hardly a row.
    """
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        F.year("l_shipdate").alias("year"),
        cents("l_extendedprice").alias("s"),
        F.col("l_quantity").cast("bigint").alias("q"),
        cents("l_tax").alias("tax"),
    )
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("country_code"))
    yearly = (
        lines.join(o, lines.l_orderkey == o.o_orderkey)
        .groupBy("country_code", "year")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("s", "q", "tax")])
    )
    return _with(yearly, _CARDIO)


FACT_COLUMNS = {
    "fact_life_expectancy": tuple(_LIFE),
    "fact_cardiovascular": tuple(_CARDIO),
    "fact_hiv_aids": tuple(_EPIDEMIC),
    "fact_diabetes_obesity": tuple(_METABOLIC),
}


def star(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "dim_countries": dim_countries(spark, d),
        "fact_life_expectancy": fact_life_expectancy(spark, d),
        "fact_cardiovascular": fact_cardiovascular(spark, d),
        "fact_hiv_aids": fact_hiv_aids(spark, d),
        "fact_diabetes_obesity": fact_diabetes_obesity(spark, d),
    }


def panel(spark: SparkSession, d: str) -> DataFrame:
    """The flat panel of the star; each fact is joined as it leaves its own grouping by (country, year)."""
    from panelfold.plans.star import flat_panel

    tables = star(spark, d)
    return flat_panel(tables["dim_countries"], *[tables[f] for f in ("fact_life_expectancy", "fact_cardiovascular", "fact_hiv_aids", "fact_diabetes_obesity")])


_stored: dict[tuple[str, str], DataFrame] = {}


def stored_panel(spark: SparkSession, d: str) -> DataFrame:
    """The flat panel as a written table, made once per session, the way the views and models read it."""
    from panelfold.session import stage

    key = (spark.sparkContext.applicationId, d)
    if key not in _stored:
        _stored[key] = stage(panel(spark, d), "panel")
    return _stored[key]


def life_by_region(spark: SparkSession, d: str) -> DataFrame:
    """Life facts with the region of their country."""
    s = dim_countries(spark, d).select("country_code", "region")
    return fact_life_expectancy(spark, d).join(s, "country_code")


# --- sparse panels and feeds ------------------------------------------------------------------


def sparse_panel(spark: SparkSession, d: str) -> DataFrame:
    """P1: every customer in every year; v is the mean price of urgent orders, w that of finished ones."""
    o = table(spark, d, "orders")
    span = o.agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi"))
    years = F.sequence(span.select("lo").scalar(), span.select("hi").scalar())
    grid = table(spark, d, "customer").select("c_custkey", F.explode(years).alias("year"))
    price = cents("o_totalprice")
    urgent, done = F.col("o_orderpriority").isin(*URGENT), F.col("o_orderstatus") == "F"

    def mean(cond: Column) -> Column:
        return F.try_divide(F.sum(F.when(cond, price)).cast("double"), F.count_if(cond) * 100)

    known = o.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).agg(
        mean(urgent).alias("v"), mean(done).alias("w")
    )
    return grid.join(known, ["c_custkey", "year"], "left")


def wide_indicators(spark: SparkSession, d: str) -> DataFrame:
    """P2: mean value per user, day and event type, one column per type."""
    e = table(spark, d, "events")
    price = cents("value")
    means = [
        F.try_divide(F.sum(F.when(F.col("event_type") == t, price)).cast("double"), F.count_if(F.col("event_type") == t) * 100).alias(
            f"v_{t}"
        )
        for t in EVENT_TYPES
    ]
    return e.groupBy("user_id", F.to_date("ts").alias("day")).agg(*means)


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def good_customers(spark: SparkSession, d: str) -> DataFrame:
    """P3: customers with a balance that is not negative."""
    return table(spark, d, "customer").where(F.col("c_acctbal") >= 0)


def keyed_feeds(spark: SparkSession, d: str) -> list[DataFrame]:
    """P5: two feeds keyed by nation, year and a code that is NULL for every fifth nation."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    code = F.when(F.col("nation") % 5 != 0, F.concat(F.lit("C"), F.col("nation").cast("string")))
    # both facts are reduced per key before they meet the dimension
    o = (
        table(spark, d, "orders")
        .where(F.year("o_orderdate") <= 2000)
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.sum(cents("o_totalprice")).alias("v"))
    )
    a = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("nation"), "year").agg(F.sum("v").alias("order_cents"))
    li = (
        table(spark, d, "lineitem")
        .where(F.year("l_shipdate") >= 1996)
        .groupBy("l_suppkey", F.year("l_shipdate").alias("year"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    )
    b = li.join(s, li.l_suppkey == s.s_suppkey).groupBy(F.col("s_nationkey").alias("nation"), "year").agg(F.sum("q").alias("quantity"))
    return [x.withColumn("code", code) for x in (a, b)]


# --- the same as common table expressions ------------------------------------------------------

CTES: dict[str, str] = {
    "dim_countries": """
SELECT CAST(c_custkey AS VARCHAR) AS country_code, c_name AS country_name, r_name AS region, n_name AS sub_region,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'High income' WHEN 'BUILDING' THEN 'Upper middle income'
            WHEN 'FURNITURE' THEN 'Lower middle income' ELSE 'Low income' END AS income_group,
       CAST(round(c_acctbal * 100) AS BIGINT) + 200000 AS population
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "fact_life_expectancy": _sql_with(_YEARLY_SQL.format(where=""), _LIFE),
    "fact_hiv_aids": _sql_with(_YEARLY_SQL.format(where="WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"), _EPIDEMIC),
    "fact_diabetes_obesity": _sql_with(_YEARLY_SQL.format(where="WHERE o_orderstatus = 'F'"), _METABOLIC),
    "fact_cardiovascular": _sql_with(
        """
SELECT CAST(o_custkey AS VARCHAR) AS country_code, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS s,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q,
       CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS tax
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
        _CARDIO,
    ),
    "life_by_region": "SELECT f.*, d.region FROM fact_life_expectancy f JOIN dim_countries d USING (country_code)",
    "panel": """
SELECT l.country_code, l.year, l.life_expectancy_total, l.life_expectancy_male, l.life_expectancy_female,
       l.infant_mortality_per_1000, l.under5_mortality_per_1000, l.adult_mortality_male_per_1000,
       l.adult_mortality_female_per_1000, l.physicians_per_1000, l.hospital_beds_per_1000, l.health_expenditure_pct_gdp,
       CAST(c.deaths_total AS DOUBLE) AS cvd_deaths_total, c.deaths_per_100k AS cvd_deaths_per_100k,
       c.dalys_per_100k AS cvd_dalys_per_100k, c.share_of_deaths_pct AS cvd_share_of_deaths_pct,
       c.high_sbp_deaths, c.high_cholesterol_deaths, c.smoking_deaths, c.obesity_deaths,
       h.prevalence_pct AS hiv_prevalence_pct, CAST(h.aids_deaths_total AS DOUBLE) AS hiv_deaths_total,
       h.pct_on_antiretroviral AS art_coverage_pct,
       m.diabetes_prevalence_pct, m.diabetes_deaths_per_100k, m.obesity_prevalence_pct, m.overweight_prevalence_pct,
       m.child_obesity_pct, m.mean_bmi_male, m.mean_bmi_female, m.diabetes_health_spend_usd, d.region, d.income_group
FROM fact_life_expectancy l JOIN dim_countries d ON l.country_code = d.country_code
JOIN fact_cardiovascular c ON l.country_code = c.country_code AND l.year = c.year
JOIN fact_hiv_aids h ON l.country_code = h.country_code AND l.year = h.year
JOIN fact_diabetes_obesity m ON l.country_code = m.country_code AND l.year = m.year
WHERE l.life_expectancy_total IS NOT NULL AND d.region IS NOT NULL AND d.region <> ''""",
    "sparse_panel": """
SELECT g.c_custkey, g.year, k.v, k.w FROM
  (SELECT c_custkey, CAST(y AS INTEGER) AS year FROM customer,
     (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS y FROM orders) years) g
LEFT JOIN (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS DOUBLE)
      / nullif(count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) * 100, 0) AS v,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (o_orderstatus = 'F') AS DOUBLE)
      / nullif(count(*) FILTER (o_orderstatus = 'F') * 100, 0) AS w
  FROM orders GROUP BY 1, 2) k ON g.c_custkey = k.o_custkey AND g.year = k.year""",
    "wide_indicators": "SELECT user_id, CAST(ts AS DATE) AS day, "
    + ", ".join(
        f"CAST(sum(CAST(round(value * 100) AS BIGINT)) FILTER (event_type = '{t}') AS DOUBLE) "
        f"/ nullif(count(*) FILTER (event_type = '{t}') * 100, 0) AS v_{t}"
        for t in EVENT_TYPES
    )
    + " FROM events GROUP BY 1, 2",
    "good_customers": "SELECT * FROM customer WHERE c_acctbal >= 0",
    "feed_a": """
SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE WHEN c_nationkey % 5 <> 0 THEN 'C' || c_nationkey END AS code,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS order_cents
FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) <= 2000 GROUP BY 1, 2""",
    "feed_b": """
SELECT s_nationkey AS nation, CAST(year(l_shipdate) AS INTEGER) AS year,
       CASE WHEN s_nationkey % 5 <> 0 THEN 'C' || s_nationkey END AS code,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE year(l_shipdate) >= 1996 GROUP BY 1, 2""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the expressions it names, directly or through one another, in order."""
    pool = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in pool.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit_guarded(name, definition)

    open_names: set[str] = set()

    def visit_guarded(name: str, definition: str) -> None:
        if name in open_names:
            return
        open_names.add(name)
        visit(re.sub(rf"\b{name}\b", "", definition))
        needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({pool[n]})" for n in needed) + "\n" + body


def interpolated_sql(source: str, key: str, period: str, columns: list[str]) -> dict[str, str]:
    """Expressions ``interp`` and its helper: position-spaced interpolation of ``source``, an oracle's view of it."""
    w = f"PARTITION BY {key} ORDER BY {period}"
    numbered = f"SELECT *, row_number() OVER ({w}) AS rn FROM {source}"
    ends, outs = [], []
    for c in columns:
        past = f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        ahead = f"OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        at = f"CASE WHEN {c} IS NOT NULL THEN rn END"
        ends += [
            f"last_value({c} IGNORE NULLS) {past} AS {c}_p",
            f"last_value({at} IGNORE NULLS) {past} AS {c}_pr",
            f"first_value({c} IGNORE NULLS) {ahead} AS {c}_n",
            f"first_value({at} IGNORE NULLS) {ahead} AS {c}_nr",
        ]
        outs.append(
            f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_p IS NULL THEN {c}_n WHEN {c}_n IS NULL THEN {c}_p "
            f"ELSE {c}_p + ({c}_n - {c}_p) / ({c}_nr - {c}_pr) * (rn - {c}_pr) END AS {c}"
        )
    return {
        "interp_numbered": numbered,
        "interp_ends": f"SELECT *, {', '.join(ends)} FROM interp_numbered",
        "interp": f"SELECT * REPLACE ({', '.join(outs)}) FROM interp_ends",
    }


def imputed_sql(source: str, key: str, period: str, columns: list[str], digits: int | None = None, constant: float | None = None) -> dict[str, str]:
    """``interp`` completed to ``imputed``: period median, then overall median or a constant."""
    out = interpolated_sql(source, key, period, columns)
    meds = ", ".join(f"median({c}) AS {c}_m" for c in columns)
    out["interp_by_period"] = f"SELECT {period} AS mp, {meds} FROM interp GROUP BY 1"
    out["interp_overall"] = "SELECT " + ", ".join(f"median({c}) AS {c}_o" for c in columns) + " FROM interp"

    def cell(c: str) -> str:
        last = f"CAST({constant} AS DOUBLE)" if constant is not None else f"(SELECT {c}_o FROM interp_overall)"
        e = f"coalesce({c}, {c}_m, {last})"
        return f"{e if digits is None else half_even_sql(e, digits)} AS {c}"

    out["imputed"] = (
        f"SELECT * REPLACE ({', '.join(cell(c) for c in columns)}) FROM interp LEFT JOIN interp_by_period ON interp.{period} = mp"
    )
    return out


def half_even_sql(e: str, digits: int) -> str:
    return f"round_even({e}, {digits})"
