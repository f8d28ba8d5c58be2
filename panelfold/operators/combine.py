"""Merging feeds, joining facts to dimensions, and referential checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merge_feeds(feeds: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer merge of any number of feeds in which NULL keys match each other.

    A union followed by one grouping: grouping treats NULLs as equal, needs one shuffle for all
    feeds instead of one per pair, and combines map-side, so a frequent key is no hot spot.  A feed
    must be unique on the keys and measure names must not repeat; a repeated key fails the job.
    """
    measures = [[c for c in f.columns if c not in keys] for f in feeds]
    names = [c for group in measures for c in group]
    if len(names) != len(set(names)):
        raise ValueError("measure names repeat across feeds")
    marked = [f.withColumn("__feed", F.lit(i)) for i, f in enumerate(feeds)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    rows = [F.count(F.when(F.col("__feed") == i, 1)).alias(f"__n{i}") for i in range(len(feeds))]
    merged = stacked.groupBy(*keys).agg(*rows, *[F.max(c).alias(c) for c in names])
    most = reduce(F.greatest, [F.col(f"__n{i}") for i in range(len(feeds))]) if len(feeds) > 1 else F.col("__n0")
    return merged.where(
        F.when(most > 1, F.raise_error(F.lit("a feed repeats a key")).cast("boolean")).otherwise(F.lit(True))
    ).select(*keys, *names)


def pivot_feeds(
    records: DataFrame,
    keys: Sequence[str],
    tag: str,
    value: str,
    seq: Sequence[str],
    measures: Mapping[str, str],
    first_seen: Sequence[str] = (),
) -> DataFrame:
    """Long records to one wide row per key: ``measures`` maps output column to tag value.

    The last record by ``seq`` wins in each cell; ``first_seen`` columns keep the first one's text.
    Conditional aggregates over a known list of tags: one shuffle, combined map-side, no extra job.
    """
    order = F.col(seq[0]) if len(seq) == 1 else F.struct(*[F.col(c) for c in seq])
    if len(seq) == 2 and all(records.schema[c].dataType == T.IntegerType() and not records.schema[c].nullable for c in seq):
        # the same order as one number: every cell of a wide row carries its own
        order = F.col(seq[0]).cast("long") * F.lit(1 << 32) + F.col(seq[1])
    picks: list[Column] = [F.min_by(c, order).alias(c) for c in first_seen]
    for name, code in measures.items():
        mine = F.col(tag) == code
        picks.append(F.max_by(F.when(mine, F.col(value)), F.when(mine, order)).alias(name))
    return records.groupBy(*keys).agg(*picks)


def star_join(dim: DataFrame, facts: Sequence[DataFrame], key: str, period: str) -> DataFrame:
    """Inner join of facts on (key, period) and of the dimension on the key.

    Facts meet first: they share the partitioning on (key, period).  The dimension comes last, and is
    broadcast or shuffled as its measured size allows.
    """
    panel = reduce(lambda a, b: a.join(b, [key, period], "inner"), facts)
    return panel.join(dim, key, "inner")


def fact_to_fact(left: DataFrame, right: DataFrame, key: str, period: str, x: str, y: str) -> DataFrame:
    """One measure of each of two facts, where both have the (key, period)."""
    return left.select(key, period, x).join(right.select(key, period, y), [key, period], "inner")


def known_keys(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return rows.join(dim.select(key), key, "left_semi")


def orphans(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows without a dimension row."""
    return rows.join(dim.select(key), key, "left_anti")


def cascade_delete(dim: DataFrame, facts: Mapping[str, DataFrame], key: str, deleted: Column) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Delete dimension rows and, with them, the fact rows that refer to them."""
    kept = dim.where(~F.coalesce(deleted, F.lit(False)))
    return kept, {name: known_keys(fact, kept, key) for name, fact in facts.items()}


def left_join_where(left: DataFrame, right: DataFrame, on: Sequence[str], right_filter: Column) -> DataFrame:
    """Left join whose ON clause also restricts the right side: unmatched left rows stay."""
    return left.join(right.where(right_filter), list(on), "left")


def average_then_join(dim: DataFrame, sources: Mapping[str, tuple[DataFrame, str]], key: str) -> DataFrame:
    """Per-key averages of several facts next to the dimension.

    ``sources`` maps output column to (fact, measure).  Each fact is reduced to one row per key before
    it is joined, so the facts' rows never multiply one another.
    """
    out = dim
    for name, (fact, measure) in sources.items():
        out = out.join(fact.groupBy(key).agg(F.avg(measure).alias(name)), key, "left")
    return out
