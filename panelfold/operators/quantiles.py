"""Exact quantiles of groups of any size.

The built-in exact ``percentile`` gathers all distinct values of a group in one task.  Here a group
is never gathered: a first pass counts rows on a fixed, order-preserving grid (partial aggregation,
a bounded number of cells per group), the cells that hold the wanted ranks are picked from those
counts, and a last pass ranks only the rows inside them.  A cell that still holds too many rows is
split again, evenly between its smallest and largest value, before it is ranked.

Counts, smallest and largest values are exact whatever the task order, so a partition that is
recomputed after a lost executor falls into the same cells.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelfold.operators.sizing import join_small
from panelfold.session import stage

# About 0.1 % relative width; magnitudes below 1e-6 share the cell around zero.
_CELLS_PER_E_FOLD = 1024
_UNIT = 1e6

# Rows of one cell that a single task may rank, and the parts a fuller cell is split into.
MAX_CELL_ROWS = 4_000_000
_SPLIT = 4096

OVERALL = "all_groups"


def _cell(value: Column) -> Column:
    magnitude = F.least(F.abs(value), F.lit(1e300)) * _UNIT
    return (F.signum(value) * F.floor(F.log1p(magnitude) * _CELLS_PER_E_FOLD)).cast("bigint")


def _melt(df: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(groups, variable, value) rows without NULLs, which are left out before the columns are taken apart."""
    if len(columns) == 1:
        long = df.select(*groups, F.lit(columns[0]).alias("variable"), F.col(columns[0]).cast("double").alias("value"))
        return long.where(F.col("value").isNotNull())
    cells = F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value"))) for c in columns])
    long = df.select(*groups, F.explode(F.array_compact(cells)).alias("c")).select(*groups, "c.variable", "c.value")
    return long.where(F.col("value").isNotNull())


def _wanted_ranks(total: Column, probs: Sequence[float]) -> Column:
    """0-based ranks on both sides of every quantile position."""
    positions = [(total - 1) * F.lit(float(p)) for p in probs]
    return F.array_distinct(F.array(*[f(pos).cast("bigint") for pos in positions for f in (F.floor, F.ceil)]))


def _holding(cells: DataFrame) -> DataFrame:
    """Cells that hold a wanted rank, each with its own ranks only."""
    return cells.withColumn("ranks", F.expr("filter(ranks, r -> r >= below AND r < below + n)")).where(F.size("ranks") > 0)


_EXTENT = (  # built per call: column expressions need a session
    lambda: F.count(F.lit(1)).alias("n"),
    lambda: F.min("value").alias("lo"),
    lambda: F.max("value").alias("hi"),
)


# What a cell carries along: rows below it, rows of its group, and its wanted ranks.
_FACTS = ("below", "total", "ranks")


def _inside(long: DataFrame, cells: DataFrame, groups: Sequence[str], overall: bool, n_cells: int) -> DataFrame:
    """Rows of the picked cells, which are disjoint value ranges; rows of all groups' cells once more under their mark."""
    facts = cells.drop("n")
    if not overall:
        joined = join_small(long, facts, [*groups, "variable", "cell"], known_rows=n_cells)
    else:
        own = join_small(long, facts.where(~F.col(OVERALL)), [*groups, "variable", "cell"], known_rows=n_cells)
        shared = join_small(long.drop(*groups), facts.where(OVERALL), ["variable", "cell"], known_rows=n_cells)
        joined = own.unionByName(shared)
    return joined.where((F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")))


def _split(long: DataFrame, cells: DataFrame, groups: Sequence[str], keys: Sequence[str], overall: bool, n_cells: int) -> DataFrame:
    """Replace each picked cell by those of its even parts that hold a wanted rank."""
    width = F.col("hi") - F.col("lo")
    part = F.least(F.floor(F.coalesce(F.try_divide(F.col("value") - F.col("lo"), width), F.lit(0.0)) * _SPLIT), F.lit(_SPLIT - 1))
    parent = [*keys, "cell", "first_lo"]
    rows = _inside(long, cells.withColumn("first_lo", F.col("lo")), groups, overall, n_cells).withColumn("part", part)
    # the cell's own facts are grouping keys, which keeps this a hash aggregation of plain numbers
    parts = rows.groupBy(*parent, *_FACTS, "part").agg(*[e() for e in _EXTENT])
    before = Window.partitionBy(*parent).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("below", F.col("below") + F.sum("n").over(before) - F.col("n"))
    return _holding(parts).drop("part", "first_lo")


def cell_counts(df: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows, smallest and largest value by group, variable and grid cell: what quantiles are picked from.

    Counts of disjoint parts of a table are merged by ``merged_counts``, so each part is counted once.
    """
    long = _melt(df, groups, columns).withColumn("cell", _cell(F.col("value")))
    return long.groupBy(*groups, "variable", "cell").agg(*[e() for e in _EXTENT])


def merged_counts(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Cell counts of several parts as those of their union."""
    return counts.groupBy(*groups, "variable", "cell").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], columns: Sequence[str], probs: Sequence[float], overall: bool = False, counts: DataFrame | None = None
) -> DataFrame:
    """Linear-interpolated quantiles per group and column.

    Returns ``groups``, ``variable`` (the column's name), ``n`` (values that are not NULL) and
    ``quantiles`` (one entry per probability, in the given order).  ``overall`` adds the quantiles
    over all groups, marked in ``all_groups``, from the same passes.  ``counts`` are the cell counts of
    ``df`` where they are known already; then the rows are only read to rank the picked cells.
    """
    at = _at_ranks(df, groups, columns, lambda total: _wanted_ranks(total, probs), overall, counts)
    return at.select(*groups, *([OVERALL] if overall else []), "variable", "n", F.array(*[_interpolated(p) for p in probs]).alias("quantiles"))


def order_statistics(df: DataFrame, groups: Sequence[str], columns: Sequence[str], ranks: Callable[[Column], Sequence[Column]]) -> DataFrame:
    """Values at ranks that depend on the number of values: ``ranks`` gives 0-based ranks from the group's count.

    Returns ``groups``, ``variable``, ``n`` and ``at``, a map from rank to value; a rank outside the group is not in
    it, and a group without any of its ranks is not in the result.
    """

    def wanted(total: Column) -> Column:
        return F.array_distinct(F.filter(F.array(*[r.cast("bigint") for r in ranks(total)]), lambda r: (r >= 0) & (r < total)))

    return _at_ranks(df, groups, columns, wanted)


def _at_ranks(
    df: DataFrame, groups: Sequence[str], columns: Sequence[str], wanted: Callable[[Column], Column], overall: bool = False, counts: DataFrame | None = None
) -> DataFrame:
    """(groups, variable, n, at): the values at the wanted ranks."""
    keys = [*groups, *([OVERALL] if overall else []), "variable"]
    long = _melt(df, groups, columns).withColumn("cell", _cell(F.col("value")))

    if counts is None:
        counts = cell_counts(df, groups, columns)
        counts = stage(counts, "cell-counts") if overall else counts
    if overall:
        # The cells of all groups are sums of the groups' cells: the rows are counted once.
        each = counts.withColumn(OVERALL, F.lit(False))
        every = each.groupBy("variable", "cell").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        empty = [F.lit(None).cast(df.schema[g].dataType).alias(g) for g in groups]
        counts = each.unionByName(every.select(*empty, "variable", "cell", "n", "lo", "hi", F.lit(True).alias(OVERALL)))
    by_cell = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    counts = (
        counts.withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
        .withColumn("below", F.sum("n").over(by_cell) - F.col("n"))
        .withColumn("ranks", wanted(F.col("total")))
    )
    cells = _holding(counts)
    while True:
        cells = stage(cells, "cells")
        fullest = F.max(F.when(F.col("lo") < F.col("hi"), F.col("n")))
        n_cells, most = cells.agg(F.count(F.lit(1)), fullest).first()
        if most is None or most <= MAX_CELL_ROWS:
            break
        cells = _split(long, cells, groups, keys, overall, n_cells)

    inside = Window.partitionBy(*keys, "cell", "lo").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    hits = (
        _inside(long, cells, groups, overall, n_cells)
        .groupBy(*keys, "cell", "lo", *_FACTS, "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("first", F.col("below") + F.sum("n").over(inside) - F.col("n"))
        .withColumn("hit", F.expr("filter(ranks, r -> r >= first AND r < first + n)"))
        .where(F.size("hit") > 0)
        .select(*keys, "total", "value", F.explode("hit").alias("rank"))
    )
    return hits.groupBy(*keys).agg(
        F.any_value("total").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"),  # an entry for each wanted rank
    )


def _interpolated(p: float) -> Column:
    """The quantile from the values ``at`` ranks of ``n``; infinities stay what they are, and no NaN comes out."""
    pos = (F.col("n") - 1) * F.lit(float(p))
    lo = F.element_at("at", F.floor(pos).cast("bigint"))
    hi = F.element_at("at", F.ceil(pos).cast("bigint"))
    share = pos - F.floor(pos)
    apart = hi - lo
    out = F.when(lo == hi, lo).when(F.abs(apart) < float("inf"), lo + apart * share).otherwise(lo * (1 - share) + hi * share)
    return F.when(~F.isnan(out), out)


def bounded_quantiles(df: DataFrame, groups: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The same for many groups of a bounded size each, such as an entity's periods, in one pass.

    Values are counted per group, so copies combine before the shuffle, and ranked within it.  For groups of
    any size take ``exact_quantiles``.
    """
    keys = [*groups, "variable"]
    counts = _melt(df, groups, columns).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("c"))
    up_to = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("n", F.sum("c").over(Window.partitionBy(*keys))).withColumn("first", F.sum("c").over(up_to) - F.col("c"))
    hit = F.filter(_wanted_ranks(F.col("n"), probs), lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("c")))
    hits = ranked.select(*keys, "n", "value", F.explode(hit).alias("rank"))
    at = hits.groupBy(*keys).agg(F.any_value("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
    return at.select(*keys, "n", F.array(*[_interpolated(p) for p in probs]).alias("quantiles"))


def medians_wide(
    df: DataFrame, groups: Sequence[str], columns: Sequence[str], suffix: str = "_median", overall: bool = False, bounded: bool = False
) -> DataFrame:
    """One row per group with the median of every column; ``overall`` adds a row for all groups together.

    ``bounded`` is for many groups that are small by their nature (see ``bounded_quantiles``).
    """
    q = bounded_quantiles(df, groups, columns, [0.5]) if bounded else exact_quantiles(df, groups, columns, [0.5], overall)
    pick = [F.max(F.when(F.col("variable") == c, F.col("quantiles")[0])).alias(f"{c}{suffix}") for c in columns]
    return q.groupBy(*groups, *([OVERALL] if overall else [])).agg(*pick)
