"""The load job on the star schema: a first load, and a second one that overlaps it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelfold import schemas
from panelfold.checks import testbed as tb
from panelfold.checks.joining import _PANEL_COLUMNS
from panelfold.checks.loading import _folder
from panelfold.checks.registry import query
from panelfold.checks.testbed import with_ctes
from panelfold.operators import quality
from panelfold.plans import load
from panelfold.plans.delta import PanelStore
from panelfold.plans.star import flat_panel
from panelfold.sources import sinks
from panelfold.streaming.maintained import MaintainedMeans, stream_means

# Two measures of each fact that the comparison looks at, in the store's types.
_SHOWN = {
    "fact_life_expectancy": ("life_expectancy_total", "physicians_per_1000"),
    "fact_cardiovascular": ("deaths_total", "high_sbp_deaths"),
    "fact_hiv_aids": ("people_living_with_hiv", "prevalence_pct"),
    "fact_diabetes_obesity": ("obesity_prevalence_pct", "mean_bmi_male"),
}
FIRST, SECOND = 1999, 1998  # last year of the first load, first year of the second


def _loads(spark, d, table):
    """The rows of both loads; the second has other names and sources, and larger measures."""
    rows = tb.star(spark, d)[table].withColumns({"country_name": F.concat(F.lit("n"), "country_code"), "data_source": F.lit("one")})
    later = rows.where(F.col("year") >= SECOND).withColumns(
        {"country_name": F.lit("other"), "data_source": F.lit("two"), **{c: F.col(c) + 1 for c in _SHOWN[table]}}
    )
    return rows.where(F.col("year") <= FIRST), later


def _shown(table):
    types = {f.name: f.dataType.simpleString() for f in schemas.TABLES[table].fields}
    return {c: types[c] for c in _SHOWN[table]}


def _sql(table):
    def value(c, kind):
        new = f"f.{c} + CASE WHEN f.year >= {SECOND} THEN 1 ELSE 0 END"
        return f"CAST(CAST({new} AS {kind}) AS DOUBLE) AS {c}" if "decimal" in kind else f"{new} AS {c}"

    cells = ", ".join(value(c, k) for c, k in _shown(table).items())
    first = f"f.year <= {FIRST}"
    return with_ctes(
        f"SELECT f.country_code, f.year, {cells}, CASE WHEN {first} THEN 'n' || f.country_code ELSE 'other' END AS country_name, "
        f"CASE WHEN {first} THEN 'one' ELSE 'two' END AS data_source, true AS first_time_kept FROM {table} f"
    )


def _upserted(table):
    def run(spark, d):
        root = _folder(spark, "store")
        first, second = _loads(spark, d, table)
        load.load_table(spark, root, table, first, "first")
        # Read before the second load rewrites files.
        from panelfold.session import stage

        stamps = stage(load.read_table(spark, root, table).select("country_code", "year", F.col("loaded_at").alias("was")), "stamps")
        for _ in range(2):  # loading twice is loading once
            load.load_table(spark, root, table, second, "second")
        out = load.read_table(spark, root, table).join(stamps, ["country_code", "year"], "left")
        kept = F.col("loaded_at").isNotNull() & F.coalesce(F.col("loaded_at") == F.col("was"), F.lit(True))
        cells = [F.col(c).cast("double" if "decimal" in k else k).alias(c) for c, k in _shown(table).items()]
        return out.select("country_code", "year", *cells, "country_name", "data_source", kept.alias("first_time_kept"))

    return run


for _table in _SHOWN:
    query(_sql(_table), f"upsert_{_table}")(_upserted(_table))


@query(
    with_ctes("""
SELECT country_code, country_name, region, CASE WHEN CAST(country_code AS BIGINT) % 2 = 0 THEN population + 5 ELSE population END AS population,
  CASE WHEN CAST(country_code AS BIGINT) % 2 = 0 THEN 'again ' || sub_region ELSE sub_region END AS sub_region, true AS first_time_kept FROM dim_countries""")
)
def upsert_dim_countries(spark, d):
    """A second load of every other country changes its attributes and its time of update only."""
    root = _folder(spark, "store")
    dim = tb.dim_countries(spark, d)
    load.load_table(spark, root, "dim_countries", dim, "first")
    again = dim.where(F.col("country_code").cast("bigint") % 2 == 0).withColumns(
        {"population": F.col("population") + 5, "sub_region": F.concat(F.lit("again "), "sub_region")}
    )
    for _ in range(2):
        load.load_table(spark, root, "dim_countries", again, "second")
    out = load.read_table(spark, root, "dim_countries")
    later = F.col("updated_at") > F.col("created_at")
    kept = F.col("created_at").isNotNull() & (later == (F.col("country_code").cast("bigint") % 2 == 0))
    return out.select("country_code", "country_name", "region", "population", "sub_region", kept.alias("first_time_kept"))


_DIM_COLUMNS = ("country_code", "country_name", "region", "sub_region", "income_group", "population")


def _audit_sql(table):
    """Rows, periods and the share of empty cells; a column that the fixture lacks is empty throughout."""
    audited = [c for c in schemas.TABLES[table].names if c not in quality.AUDIT_SKIP]
    given = _DIM_COLUMNS if table == schemas.DIMENSION else ("country_code", "year", *tb.FACT_COLUMNS[table])
    nulls = " + ".join([f"count(*) * {sum(c not in given for c in audited)}", *[f"count(*) FILTER ({c} IS NULL)" for c in audited if c in given]])
    periods = ["CAST(NULL AS INTEGER)"] * 2 if table == schemas.DIMENSION else ["CAST(min(year) AS INTEGER)", "CAST(max(year) AS INTEGER)"]
    pct = f"round_even(({nulls}) / (count(*) * {len(audited)}) * 100.0, 2)"
    return (
        f"SELECT '{table}' AS table_name, count(*) AS row_count, {periods[0]} AS first_period, {periods[1]} AS last_period, {pct} AS null_pct, "
        f"CASE WHEN {pct} < 1.0 THEN 'complete' ELSE 'incomplete' END AS status FROM {table}"
    )


@query(with_ctes(" UNION ALL ".join(_audit_sql(t) for t in (schemas.DIMENSION, *schemas.FACTS))))
def audit_star(spark, d):
    """Rows, periods and empty cells of all five tables of the loaded store."""
    tables = load.load_star(spark, _folder(spark, "store"), tb.star(spark, d), "only")
    counts, report = load.load_report(tables)
    return report.join(counts, ["table_name", "row_count"])


@query(with_ctes(f"SELECT {_PANEL_COLUMNS} FROM panel"))
def star_panel_bucketed(spark, d):
    """The flat panel over facts that are stored by country and year, so that they meet without a shuffle."""
    root, name = _folder(spark, "buckets"), f"b{uuid.uuid4().hex}"
    star = tb.star(spark, d)
    stored = {t: sinks.write_bucketed(star[t], f"{name}_{t}", schemas.KEYS[t], buckets=16, path=f"{root}/{t}") for t in schemas.FACTS}
    return flat_panel(star[schemas.DIMENSION], *[stored[t] for t in schemas.FACTS])


@query(
    with_ctes(
        f"SELECT c_custkey, year, {tb.near_sql('v', 'v')}, {tb.near_sql('w', 'w')} FROM imputed",
        tb.imputed_sql("sparse_panel", "c_custkey", "year", ["v", "w"]),
    )
)
def delta_loads(spark, d):
    """The imputed panel after loads that bring new customers and correct others, the last of them twice."""
    rows = tb.sparse_panel(spark, d)
    store = PanelStore(spark, _folder(spark, "delta"), ["c_custkey"], "year", ["v", "w"], buckets=16)
    part = F.col("c_custkey") % 16
    wrong = F.when((part == 4) & (F.col("year") > 1996), F.lit(None)).when(part == 5, F.col("v") + 1000).otherwise(F.col("v"))
    store.load(rows.where(part != 3).withColumn("v", wrong))
    store.load(rows.where(part.isin(3, 4)))
    for _ in range(2):
        store.load(rows.where((part == 5) | (F.col("c_custkey") == 1)))
    return store.read().select("c_custkey", "year", tb.near("v"), tb.near("w"))


@query(with_ctes(" UNION ALL ".join(_audit_sql(t) for t in (schemas.DIMENSION, *schemas.FACTS))))
def audit_of_writes(spark, d):
    """The same figures, taken by the jobs that write the tables."""
    return load.load_audited(spark, _folder(spark, "audited"), tb.star(spark, d))


@query("""
SELECT o_orderkey, 'changed' AS status, 'o_totalprice' AS columns FROM orders WHERE o_orderkey % 97 = 0
UNION ALL SELECT o_orderkey, 'changed', 'o_custkey,o_orderpriority' FROM orders WHERE o_orderkey % 101 = 0 AND o_orderkey % 97 <> 0
UNION ALL SELECT o_orderkey, 'missing', '' FROM orders WHERE o_orderkey % 103 = 0 AND o_orderkey % 97 <> 0 AND o_orderkey % 101 <> 0
UNION ALL SELECT -o_orderkey, 'extra', '' FROM orders WHERE o_orderkey % 103 = 0 AND o_orderkey % 97 <> 0 AND o_orderkey % 101 <> 0
""")
def reconcile_content(spark, d):
    """A written table with changed cells and exchanged rows, of as many rows as its source."""
    o = tb.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    k = F.col("o_orderkey")
    price, other = k % 97 == 0, (k % 101 == 0) & (k % 97 != 0)
    gone = (k % 103 == 0) & ~price & ~other
    sink = o.withColumns({
        "o_totalprice": F.when(price, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_custkey": F.when(other, -F.col("o_custkey")).otherwise(F.col("o_custkey")),
        "o_orderpriority": F.when(other, F.lit(None)).otherwise(F.col("o_orderpriority")),
        "o_orderkey": F.when(gone, -k).otherwise(k),
    })
    stored = sinks.replace_table(sink, f"{_folder(spark, 'reconciled')}/orders")
    found = quality.reconcile_content(o, stored, ["o_orderkey"])
    return found.withColumn("columns", F.array_join(F.array_sort("columns"), ","))


@query(
    with_ctes("""
SELECT country_code, year, life_expectancy_total FROM fact_life_expectancy
WHERE CAST(country_code AS BIGINT) % 7 <> 0 OR (CAST(country_code AS BIGINT) % 14 = 0 AND year >= 1999)""")
)
def deletes_and_replays(spark, d):
    """Countries that were deleted stay so when an older load is repeated; what a later load brings of them is there."""
    facts = tb.fact_life_expectancy(spark, d).select("country_code", "year", "life_expectancy_total")
    path, keys = f"{_folder(spark, 'ordered')}/facts", ["country_code", "year"]
    number = F.col("country_code").cast("bigint")
    first = lambda: sinks.upsert_ordered(spark, path, facts, keys, ["life_expectancy_total"], "year", at=1)
    first()
    sinks.delete_ordered(spark, path, facts.where(number % 7 == 0).select("country_code").distinct(), ["country_code"], "year", at=2)
    sinks.upsert_ordered(spark, path, facts.where((number % 14 == 0) & (F.col("year") >= 1999)), keys, ["life_expectancy_total"], "year", at=3)
    first()
    sinks.delete_ordered(spark, path, facts.where(number % 7 == 0).select("country_code").distinct(), ["country_code"], "year", at=2)
    return sinks.read_ordered(spark, path).select("country_code", "year", "life_expectancy_total")


@query("""
SELECT o_orderpriority, count(*) AS n, round(avg(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE o_totalprice + 100 END) * 64) / 64 AS mean_price
FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 4 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority) FROM orders) GROUP BY 1
""")
def stream_group_means(spark, d):
    """Means by priority after corrections that move orders between groups, and after files that are late or come twice."""
    o = tb.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    folder, k = _folder(spark, "means"), F.col("o_orderkey")
    wrong = o.withColumns({"o_totalprice": F.col("o_totalprice") + 100, "seq": F.lit(2)})
    right = o.where(k % 2 == 0).withColumns({"o_orderpriority": F.when(k % 4 == 0, "1-URGENT").otherwise(F.col("o_orderpriority")), "seq": F.lit(3)})
    late = o.where(k % 3 == 0).withColumns({"o_totalprice": F.lit(1.0), "seq": F.lit(1)})
    store = MaintainedMeans(spark, f"{folder}/store", ["o_orderkey"], ["o_orderpriority"], ["o_totalprice"], "seq", buckets=8)
    for part in (wrong, right, late, right):
        part.write.mode("append").parquet(f"{folder}/landing")
        stream_means(store, f"{folder}/landing", part.schema, f"{folder}/checkpoint")
    out = store.read()
    return out.select("o_orderpriority", "n", tb.near("o_totalprice", 64).alias("mean_price"))
