"""Feature preparation: dummies, feature lists, splits and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]], drop_first: bool = True) -> DataFrame:
    """0/1 columns named ``column_level`` in alphabetical order, the first level left out.

    Levels are given by the caller (see ``levels_of``), so the columns are known to the planner.
    """
    out = {}
    for c, values in levels.items():
        for v in sorted(values)[1 if drop_first else 0 :]:
            out[f"{c}_{v}"] = F.when(F.col(c) == F.lit(v), 1.0).otherwise(0.0)
    return df.withColumns(out).drop(*levels)


def levels_of(df: DataFrame, columns: Sequence[str], most: int) -> dict[str, list[str]]:
    """The levels of category columns.  A column with more than ``most`` levels is refused, not cut."""
    out = {}
    for c in columns:
        found = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(most + 1).collect()]
        if len(found) > most:
            raise ValueError(f"{c} has more than {most} levels")
        out[c] = sorted(found)
    return out


def feature_list(columns: Sequence[str], exclude: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in set(exclude)]


def split_share(keys: Sequence[str], seed: int = 42) -> Column:
    """A repeatable number in 0..99 from the keys, the same for any partitioning and repeatable in SQL."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def train_test(df: DataFrame, share: Column, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Disjoint parts that together hold every row.  With entity keys only in ``share``, an entity stays on one side."""
    return df.where(share < train_pct), df.where(share >= train_pct)


def fit_zscore(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column of the training rows: two numbers per column."""
    one = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(F.col(c)).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (one[f"m_{c}"], one[f"s_{c}"]) for c in columns}


def apply_zscore(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Standardise; a constant column becomes zero."""
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in fitted.items()})


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)
