"""Group means, changes over time, normalisation and composite scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelfold.functions.scalars import clip
from panelfold.operators.combine import average_then_join, known_keys
from panelfold.operators.impute import one_per_period
from panelfold.operators.quantiles import OVERALL, medians_wide
from panelfold.operators.sizing import join_small
from panelfold.session import stage


def mean_by(df: DataFrame, by: Sequence[str], columns: Mapping[str, Column | str], digits: int | None = None) -> DataFrame:
    """Means per group: ``columns`` maps output name to a column or an expression."""
    means = {n: F.avg(c) for n, c in columns.items()}
    return df.groupBy(*by).agg(*[(m if digits is None else F.round(m, digits)).alias(n) for n, m in means.items()])


def mean_by_dimension(
    facts: DataFrame, dim: DataFrame, key: str, by_fact: Sequence[str], by_dim: Sequence[str], columns: Mapping[str, Column | str]
) -> DataFrame:
    """Means per (dimension attribute, fact attribute), with the facts reduced before the join.

    Sums and counts per (key, fact attribute) are joined to the dimension and added up, so the join
    carries one row per key and attribute however many rows a frequent key has.
    """
    parts = []
    for n, c in columns.items():
        parts += [F.sum(c).alias(f"__s_{n}"), F.count(c).alias(f"__c_{n}")]
    partial = facts.groupBy(key, *by_fact).agg(*parts)
    joined = partial.join(dim.select(key, *by_dim), key, "inner")
    means = [F.try_divide(F.sum(f"__s_{n}"), F.sum(f"__c_{n}")).alias(n) for n in columns]
    return joined.groupBy(*by_dim, *by_fact).agg(*means)


def spread_by(df: DataFrame, by: Sequence[str], column: str, derived: bool = True) -> DataFrame:
    """Mean, median, sample standard deviation and the one-deviation band per group.

    The rows are read three times: a ``derived`` input is written once first, a stored table is read again.
    """
    df = stage(df.select(*by, column), "spread") if derived else df
    stats = df.groupBy(*by).agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd"))
    medians = medians_wide(df, by, [column]).withColumnRenamed(f"{column}_median", "median")
    out = join_small(stats, medians, list(by), "left")
    return out.withColumns({"lower": F.col("mean") - F.col("sd"), "upper": F.col("mean") + F.col("sd")})


def group_medians(df: DataFrame, group: str, column: str) -> DataFrame:
    """Median per group, highest first, next to the overall median."""
    both = medians_wide(df, [group], [column], overall=True).withColumnRenamed(f"{column}_median", "median")
    both = stage(both, "group-medians")
    overall = both.where(OVERALL).select("median").scalar()
    groups = both.where(~F.col(OVERALL)).drop(OVERALL)
    return groups.withColumn("overall_median", overall).orderBy(F.col("median").desc(), group)


def share_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per category and their share in percent."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(column)).scalar()
    return counts.withColumn("share_pct", F.col("n") * 100.0 / total)


def kpi_cards(df: DataFrame, entity: str, means: Mapping[str, str]) -> DataFrame:
    """One row: distinct entities and the mean of each listed column."""
    return df.agg(F.count_distinct(entity).alias("entities"), *[F.avg(c).alias(n) for n, c in means.items()])


def first_last_change(df: DataFrame, by: Sequence[str], period: str, column: str) -> DataFrame:
    """First and last value of each series and the change between them."""
    out = df.groupBy(*by).agg(
        F.min_by(column, period).alias("first"), F.max_by(column, period).alias("last"), F.max(period).alias("last_period")
    )
    return out.withColumn("change", F.col("last") - F.col("first"))


def step_change(df: DataFrame, by: Sequence[str], period: str, columns: Sequence[str], floor: float | None = None) -> DataFrame:
    """Difference to the previous row of an aggregated series; the first row stays NULL.

    Without ``by`` the input must be one aggregated series: the window then holds one row per period, and a
    repeated period fails the job.
    """
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(period)
    if not by:
        again = F.lag(period).over(w) == F.col(period)
        df = df.withColumn(period, F.when(again, F.raise_error(F.lit("repeated period")).cast(df.schema[period].dataType)).otherwise(F.col(period)))
    return df.withColumns({f"{c}_step": clip(F.col(c) - F.lag(c).over(w), lo=floor) for c in columns})


def lag_features(df: DataFrame, key: Sequence[str], period: str, column: str, lags: Sequence[int] = (1, 2)) -> DataFrame:
    """Values of earlier rows of a key and the change to the nearest one; a repeated (key, period) fails the job."""
    df = one_per_period(df, key, period)
    w = Window.partitionBy(*key).orderBy(period)
    out = df.withColumns({f"{column}_lag{n}": F.lag(column, n).over(w) for n in lags})
    return out.withColumn(f"{column}_delta", F.col(column) - F.col(f"{column}_lag{lags[0]}"))


def minmax_profile(df: DataFrame, columns: Sequence[str], eps: float = 1e-9) -> DataFrame:
    """Scale each column of a group table to 0..1 over its groups; all bounds come in one scalar subquery."""
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    bounds = df.agg(F.struct(*ends)).scalar()
    return df.withColumns(
        {c: (F.col(c) - bounds[f"lo_{c}"]) / (bounds[f"hi_{c}"] - bounds[f"lo_{c}"] + F.lit(eps)) for c in columns}
    )


def share_of_mean(df: DataFrame, column: str, scale: float, lo: float, hi: float) -> Column:
    """Value over the overall mean, scaled and bounded; a missing or zero mean counts as 1."""
    mean = df.agg(F.avg(column)).scalar()
    return clip(F.lit(scale) * (F.col(column) / F.coalesce(F.when(mean != 0, mean), F.lit(1.0))), lo, hi)


def burden_score(
    dim: DataFrame, sources: Mapping[str, tuple[DataFrame, str]], key: str, score: Column, n: int, tie: Sequence[str]
) -> DataFrame:
    """Top ``n`` entities by a score over per-entity averages; entities without a row in the first fact drop out.

    A row whose measure is NULL is a row: its entity stays, with a NULL score.
    """
    first, _ = next(iter(sources.values()))
    rows = average_then_join(known_keys(dim, first, key), sources, key)
    return rows.withColumn("score", score).orderBy(F.col("score").desc_nulls_last(), *tie).limit(n)


def period_means(df: DataFrame, period: str, periods: Sequence, columns: Sequence[str], with_latest: bool = True) -> DataFrame:
    """Mean of several columns in chosen periods (and the latest), as (period, variable, mean) rows."""
    keep = F.col(period).isin(list(periods))
    if with_latest:
        keep = keep | (F.col(period) == df.agg(F.max(period)).scalar())
    means = df.where(keep).groupBy(period).agg(*[F.avg(c).alias(c) for c in columns])
    return means.unpivot([period], list(columns), "variable", "mean")
