"""Joins with a small derived side, whose size is measured."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelfold.session import stage

# Bytes of a side that is broadcast, by its rows and the width of its columns.
BROADCAST_BYTES = 16 << 20
_TEXT_BYTES = 64


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row in memory; texts and nested values count as ``_TEXT_BYTES`` each."""
    return 16 + sum(8 + (_TEXT_BYTES if f.dataType.simpleString() in ("string", "binary") or "<" in f.dataType.simpleString() else 0) for f in df.schema.fields)


def join_small(
    rows: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", known_rows: int | None = None
) -> DataFrame:
    """Join a derived side that is usually small (group statistics, bounds, medians) on null-safe keys.

    The side is written once and counted, unless the caller has done so.  Up to ``BROADCAST_BYTES`` it is
    broadcast, so the large side is not shuffled at all; beyond that both sides are shuffled on the keys
    and adaptive execution splits hot partitions.
    """
    if known_rows is None:
        small = stage(small, "small")
        known_rows = small.count()
    renamed = small.withColumnsRenamed({k: f"__{k}" for k in on})
    right = F.broadcast(renamed) if known_rows * row_bytes(small) <= BROADCAST_BYTES else renamed
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in on])
    return rows.join(right, cond, how).drop(*[f"__{k}" for k in on])
