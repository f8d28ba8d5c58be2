"""Profiling and data-quality reports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelfold.functions.scalars import half_even
from panelfold.operators.quantiles import exact_quantiles
from panelfold.session import stage

# Columns a null audit leaves out.
AUDIT_SKIP = ("id", "created_at", "updated_at", "loaded_at")


def _rows_from(one: DataFrame, cells) -> DataFrame:
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def audit(tables: Mapping[str, DataFrame], period: str = "year", limit_pct: float = 1.0, raise_on: bool = False) -> DataFrame:
    """Per table: rows, first and last period, share of NULL cells in percent, and a status.

    One aggregation per table.  ``raise_on`` makes the job fail on a table at or above the limit.
    """
    reports = []
    for name, df in tables.items():
        audited = [c for c in df.columns if c not in AUDIT_SKIP]
        nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in audited])
        has_period = period in df.columns
        cells = F.greatest(F.col("row_count") * len(audited), F.lit(1))
        share = half_even(F.col("nulls") / cells * 100.0, 2)
        status = F.when(share < limit_pct, "complete").otherwise("incomplete")
        if raise_on:
            status = F.when(share >= limit_pct, F.raise_error(F.lit(f"{name}: too many NULL cells"))).otherwise(F.lit("complete"))
        one = df.agg(
            F.count(F.lit(1)).alias("row_count"),
            (F.min(period) if has_period else F.lit(None)).cast("int").alias("first_period"),
            (F.max(period) if has_period else F.lit(None)).cast("int").alias("last_period"),
            nulls.alias("nulls"),
        )
        reports.append(
            one.select(
                F.lit(name).alias("table_name"), "row_count", "first_period", "last_period", share.alias("null_pct"), status.alias("status")
            )
        )
    return reduce(DataFrame.unionByName, reports)


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns that hold NULLs, and how many."""
    names = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    cells = [F.struct(F.lit(c).alias("variable"), F.col(c).alias("missing")) for c in names]
    return _rows_from(one, cells).where(F.col("missing") > 0)


def describe_numeric(df: DataFrame, columns: Sequence[str], derived: bool = True) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column.

    The rows are read three times: a ``derived`` input is written once first, a stored table is read again.
    """
    df = stage(df.select(*columns), "described") if derived else df
    cols = {c: F.col(c).cast("double") for c in columns}
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.count(x).alias("n"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("sd"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            ).alias(c)
            for c, x in cols.items()
        ]
    )
    moments = _rows_from(one, [F.col(c) for c in columns])
    q = exact_quantiles(df, [], columns, [0.25, 0.5, 0.75]).select(
        "variable", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    return moments.join(q, "variable", "left")


def describe_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values present, distinct values, the most frequent one (ties: smallest text) and its count.

    Values are counted per (column, value) first, so no task holds a column's whole domain.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.explode(cells).alias("c"))
        .select("c.*")
        .where(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("variable").agg(
        F.sum("n").alias("present"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def column_info(df: DataFrame) -> DataFrame:
    """Column, its type and the number of values present."""
    one = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return _rows_from(
        one,
        [F.struct(F.lit(c).alias("variable"), F.lit(t).alias("type"), F.col(c).alias("present")) for c, t in df.dtypes],
    )


def identical_columns(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """For each pair, whether the columns agree in every row; a NULL on either side is a difference."""
    one = df.agg(
        *[F.bool_and(F.coalesce(F.col(a) == F.col(b), F.lit(False))).alias(str(i)) for i, (a, b) in enumerate(pairs)]
    )
    return _rows_from(
        one,
        [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(str(i)).alias("identical")) for i, (a, b) in enumerate(pairs)],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row, and the rows beyond the first of each."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return counts.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, failing the job if a key repeats."""
    rest = [c for c in df.columns if c not in keys]
    n = F.count(F.lit(1))
    grouped = df.groupBy(*keys).agg(F.any_value(F.struct(*rest)).alias("r"), n.alias("n"))
    ok = F.when(F.col("n") > 1, F.raise_error(F.lit("repeated key")).cast("boolean")).otherwise(F.lit(True))
    return grouped.where(ok).select(*keys, "r.*").select(*df.columns)


def range_check(df: DataFrame, columns: Sequence[str], floor: float = 0.0) -> DataFrame:
    """Smallest and largest value and the number below ``floor`` per column."""
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
                F.count_if(F.col(c) < floor).alias("below"),
            ).alias(c)
            for c in columns
        ]
    )
    return _rows_from(one, [F.col(c) for c in columns])


def coverage(df: DataFrame, entity: str, period: str) -> DataFrame:
    """Rows, distinct entities and the period span of a panel."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(entity).alias("entities"),
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()],
    )


def reconcile(source: Mapping[str, DataFrame], sink: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table before and after a load."""
    a = table_counts(source).withColumnRenamed("row_count", "source_rows")
    b = table_counts(sink).withColumnRenamed("row_count", "sink_rows")
    return a.join(b, "table_name", "full_outer").withColumn("same", F.col("source_rows").eqNullSafe(F.col("sink_rows")))


# --- reconciliation by content -------------------------------------------------------------------


def _row_hash(columns: Sequence[str]) -> Column:
    """A row's hash; a NULL counts by its place, as a hash leaves it out otherwise."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def content_digest(df: DataFrame, keys: Sequence[str], parts: int = 1024) -> DataFrame:
    """(part, n, total, mixed): rows of each range of key hashes, and the sum and exclusive or of their hashes.

    The digest does not depend on the order of rows or of tasks, counts repeated rows, and is one aggregation.
    """
    part = F.pmod(_row_hash(keys), F.lit(parts)).cast("int")
    rows = df.select(part.alias("part"), _row_hash(sorted(df.columns)).alias("h"))
    return rows.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.bit_xor("h").alias("mixed"))


def reconcile_content(source: DataFrame, sink: DataFrame, keys: Sequence[str], parts: int = 1024) -> DataFrame:
    """Where two tables of one schema differ: (keys, status, columns), no rows if they hold the same rows as often.

    Digests are compared first; only the rows of parts that differ are looked at, by key and row hash.  A key
    is ``missing`` (in the source only), ``extra`` (in the sink only) or ``changed``: then ``columns`` names the cells that
    differ, if it has one row on either side, and is empty if one side repeats a row.
    """
    if sorted(source.columns) != sorted(sink.columns):
        raise ValueError("the tables have different columns")
    names = sorted(source.columns)
    a, b = content_digest(source, keys, parts), content_digest(sink, keys, parts)
    facts = ("n", "total", "mixed")
    both = a.join(b.select(F.col("part").alias("p"), *[F.col(c).alias(f"{c}_b") for c in facts]), F.col("part") == F.col("p"), "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"{c}_b")) for c in facts])
    unlike = [r[0] for r in both.where(~same).select(F.coalesce("part", "p")).collect()]  # at most ``parts``
    part = F.pmod(_row_hash(keys), F.lit(parts)).cast("int")
    marked = [df.where(part.isin(unlike)).select(*names).withColumn("__side", F.lit(k)) for k, df in enumerate((source, sink))]
    # Copies of a row are counted before rows of a key meet.
    counts = marked[0].unionByName(marked[1]).groupBy(*names).agg(*[F.count_if(F.col("__side") == k).alias(f"__n{k}") for k in (0, 1)])
    odd = counts.where("__n0 <> __n1")
    rest = [c for c in names if c not in keys]
    cells = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(1).alias("one"))
    side = lambda k: F.col(f"__n{k}") > F.col(f"__n{1 - k}")
    # The first odd row of either side tells the cells; a key with more of them has no list.
    each = odd.groupBy(*keys).agg(
        *[f.alias(f"__{n}{k}") for k in (0, 1) for n, f in (("rows", F.count_if(side(k))), ("row", F.min(F.when(side(k), cells))), ("had", F.sum(f"__n{k}")))]
    )
    differ = F.array_compact(F.array(*[F.when(~F.col(f"__row0.{c}").eqNullSafe(F.col(f"__row1.{c}")), F.lit(c)) for c in rest])) if rest else F.array().cast("array<string>")
    single = (F.col("__rows0") == 1) & (F.col("__rows1") == 1)
    status = F.when(F.col("__had1") == 0, "missing").when(F.col("__had0") == 0, "extra").otherwise("changed")
    listed = F.when((status == "changed") & single, differ).otherwise(F.array().cast("array<string>"))
    return each.select(*keys, status.alias("status"), listed.alias("columns"))


# --- the audit of a write, taken while it is written -----------------------------------------------


class WriteAudit:
    """The audit of one table, collected by the job that writes it: no second scan.

    Write ``of(df)`` instead of ``df``; after the write, ``report`` is the row that ``audit`` would give for the table.
    """

    def __init__(self, spark, table: str, columns: Sequence[str], period: str = "year", limit_pct: float = 1.0):
        self.spark, self.table, self.period, self.limit_pct = spark, table, period, limit_pct
        self.audited = [c for c in columns if c not in AUDIT_SKIP]
        self.observation = Observation(f"audit-{uuid.uuid4().hex}")
        self.has_period = period in columns

    def of(self, df: DataFrame) -> DataFrame:
        nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(self.audited)]
        periods = [F.min(self.period).cast("int").alias("first_period"), F.max(self.period).cast("int").alias("last_period")] if self.has_period else []
        return df.observe(self.observation, F.count(F.lit(1)).alias("row_count"), *periods, *nulls)

    def empty_cells(self) -> dict[str, int]:
        """NULL cells by column."""
        seen = self.observation.get
        return {c: seen[f"null_{i}"] for i, c in enumerate(self.audited)}

    def report(self) -> DataFrame:
        seen, nulls = self.observation.get, sum(self.empty_cells().values())
        n = seen["row_count"]
        one = self.spark.createDataFrame(
            [(self.table, n, seen.get("first_period"), seen.get("last_period"), nulls)], "table_name string, row_count long, first_period int, last_period int, nulls long"
        )
        share = half_even(F.col("nulls") / F.lit(max(n * len(self.audited), 1)) * 100.0, 2)
        return one.withColumn("null_pct", share).withColumn("status", F.when(F.col("null_pct") < self.limit_pct, "complete").otherwise("incomplete")).drop("nulls")
