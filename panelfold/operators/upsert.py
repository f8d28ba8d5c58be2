"""Idempotent upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACTION = "_action"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``; equal orders are settled by the row's content.

    An aggregate rather than a ranking window: copies of a hot key are reduced map-side.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    last_by = F.struct(*[F.col(c) for c in order], F.xxhash64(*rest))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), last_by).alias("r")).select(*keys, "r.*").select(*df.columns)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    order: Sequence[str] = (),
    touch: Sequence[str] = (),
    stamp: Sequence[str] = (),
    action: bool = False,
) -> DataFrame:
    """Insert new keys, and on known keys overwrite only the ``update`` columns.

    Other columns keep the target's value on a match.  ``stamp`` columns get the current time on
    insert; ``touch`` columns get it on insert and on every match, also where no value differs.  ``action`` adds what happened:
    inserted, updated, unchanged (matched, same values) or untouched (no source row).
    """
    src = latest_per_key(source, keys, order)
    timed = set(touch) | set(stamp)
    payload = [c for c in target.columns if c not in keys]
    s = src.select(*[F.col(k).alias(f"__s_{k}") for k in keys], *[F.col(c).alias(f"__s_{c}") for c in payload if c in src.columns], F.lit(True).alias("__s"))
    t = target.withColumn("__t", F.lit(True))
    cond = reduce(lambda a, b: a & b, [t[k] == s[f"__s_{k}"] for k in keys])
    j = t.join(s, cond, "full_outer")

    in_s, in_t = F.col("__s").isNotNull(), F.col("__t").isNotNull()
    differs = reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in update if c in src.columns], F.lit(False)
    )
    what = (
        F.when(in_s & ~in_t, "inserted").when(in_s & in_t & differs, "updated").when(in_s, "unchanged").otherwise("untouched")
    )

    def cell(c: str):
        if c in touch:
            return F.when(in_s, F.current_timestamp()).otherwise(F.col(c))
        if c in timed:
            return F.when(in_t, F.col(c)).otherwise(F.current_timestamp())
        if c not in src.columns:
            return F.col(c)
        new = F.col(f"__s_{c}")
        return F.when(in_s, new).otherwise(F.col(c)) if c in update else F.when(in_t, F.col(c)).otherwise(new)

    cells = [F.coalesce(F.col(c), F.col(f"__s_{c}")).alias(c) if c in keys else cell(c).alias(c) for c in target.columns]
    return j.select(*cells, *([what.alias(ACTION)] if action else []))


def upsert_counts(merged: DataFrame) -> DataFrame:
    """Rows per action of a merge made with ``action=True``."""
    return merged.groupBy(ACTION).agg(F.count(F.lit(1)).alias("rows"))
