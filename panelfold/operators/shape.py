"""Filters, projections and samples."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelfold.functions.scalars import in_or_all, is_present


def find_column(keywords: Sequence[str], columns: Iterable[str]) -> str | None:
    """First column whose lower-cased name holds a keyword; an earlier keyword wins over an earlier column."""
    names = list(columns)
    return next((c for k in keywords for c in names if k in c.lower()), None)


def resolve_measures(df: DataFrame, wanted: Mapping[str, Sequence[str]], among: Iterable[str] | None = None) -> DataFrame:
    """Add one numeric column per entry of ``wanted`` from the source column its keywords find.

    A measure without a matching source column is NULL.  Only the schema is inspected.
    """
    from panelfold.functions.scalars import coerce_numeric

    pool = list(among) if among is not None else df.columns
    found = {name: find_column(keys, pool) for name, keys in wanted.items()}
    return df.withColumns(
        {
            name: coerce_numeric(F.col(f"`{src}`")) if src else F.lit(None).cast("double")
            for name, src in found.items()
        }
    )


def period_between(df: DataFrame, period: str, lo, hi) -> DataFrame:
    return df.where(F.col(period).between(lo, hi))


def snapshot(df: DataFrame, period: str, at) -> DataFrame:
    return df.where(F.col(period) == at)


def latest_snapshot(df: DataFrame, period: str) -> DataFrame:
    """Rows of the last period, found by a one-value scalar subquery."""
    return df.where(F.col(period) == df.agg(F.max(period)).scalar())


def periods_in(df: DataFrame, period: str, periods: Iterable) -> DataFrame:
    """Rows of listed periods, for example ``range(1990, 2023, 2)``."""
    return df.where(F.col(period).isin(list(periods)))


def select_filters(df: DataFrame, selections: Mapping[str, Iterable | None]) -> DataFrame:
    """Multi-select filters; an empty selection keeps all non-null values of the column."""
    for c, values in selections.items():
        df = df.where(in_or_all(c, values))
    return df


def require(df: DataFrame, not_null: Sequence[str] = (), not_blank: Sequence[str] = ()) -> DataFrame:
    for c in not_null:
        df = df.where(F.col(c).isNotNull())
    for c in not_blank:
        df = df.where(is_present(c))
    return df


def checked_column(name: str, allowed: Iterable[str]) -> str:
    """A column chosen by a caller's parameter, refused unless it is one of ``allowed``."""
    options = list(allowed)
    if name not in options:
        raise ValueError(f"{name!r} is not one of {options}")
    return name


def repeatable_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their keys; all rows when there are fewer.

    The draw depends on the keys alone, so it is the same for any partitioning and can be repeated in SQL.
    """
    draw: Column = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(draw, *keys).limit(n)


def top_n(df: DataFrame, by: str, n: int, tie: Sequence[str], ascending: bool = False) -> DataFrame:
    """Top or bottom ``n`` rows; ``tie`` columns make the choice unique and NULLs come last either way."""
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(first, *tie).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a given order, NULLs last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def with_lookup(df: DataFrame, lookup: DataFrame, key: str, column: str, default) -> DataFrame:
    """Left N:1 lookup with a default for keys that are absent or map to nothing.

    A lookup that repeats a key is reduced to its largest value, so rows are never multiplied.
    """
    one = lookup.groupBy(key).agg(F.max(column).alias(column))
    return df.join(one, key, "left").withColumn(
        column, F.coalesce(F.col(column), F.lit(default))
    )
