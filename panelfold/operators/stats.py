"""Correlation, regression lines, box statistics, histograms and error statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelfold.operators.quantiles import exact_quantiles
from panelfold.operators.sizing import join_small
from panelfold.session import stage


def pearson(x: Column, y: Column) -> Column:
    """Pearson r over the rows where both are known; NULL for a constant column.

    The built-in ``corr`` divides by zero there, which fails the job in ANSI mode.
    """
    return F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x)))


def correlate(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson r and the pairs it rests on, overall or per group."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    return df.groupBy(*by).agg(pearson(x, y).alias("r"), F.regr_count(y, x).alias("n"))


_GRAM = "i int, j int, n long, mx double, my double, sxx double, syy double, sxy double, xlo double, xhi double, ylo double, yhi double"


def gram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each pair of columns (i <= j), over the rows where both are known: n, means, squares and products about them, extremes.

    One pass over the columns: a task multiplies blocks of rows with the mask of what is known, so all pairs
    come from a few matrix products, and sends one row a pair.  Every column is taken from its first known value on, so a
    constant one has squares of zero.
    """
    k = len(columns)
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])

    def block(batches):
        import numpy as np
        import pyarrow as pa

        start = np.full(k, np.nan)
        n, s, q, p = (np.zeros((k, k)) for _ in range(4))
        lo, hi = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            known = ~np.isnan(x)
            for c in np.nonzero(np.isnan(start) & known.any(axis=0))[0]:
                start[c] = x[known[:, c].argmax(), c]
            mask, moved = known.astype(float), np.where(known, x - start, 0.0)
            n += mask.T @ mask
            s += moved.T @ mask  # [i, j]: of column i where j is known
            q += (moved * moved).T @ mask
            p += moved.T @ moved
            for j in range(k):
                both = known & known[:, j : j + 1]
                lo[:, j] = np.minimum(lo[:, j], np.where(both, x, np.inf).min(axis=0, initial=np.inf))
                hi[:, j] = np.maximum(hi[:, j], np.where(both, x, -np.inf).max(axis=0, initial=-np.inf))
        i, j = np.nonzero(np.triu(n > 0))
        if len(i):
            mean = s / np.maximum(n, 1)
            sq, at = q - s * mean, np.nan_to_num(start)[:, None] + mean
            cells = [n[i, j].astype(np.int64), at[i, j], at[j, i], sq[i, j], sq[j, i], (p - s * mean.T)[i, j], lo[i, j], hi[i, j], lo[j, i], hi[j, i]]
            names = [f.split()[0] for f in _GRAM.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, cells)], names=names)

    # One row a task and pair: written, so that the common means are known when the parts' are taken from them.
    parts = stage(values.mapInArrow(block, _GRAM), "gram")
    means = parts.groupBy("i", "j").agg(*[(F.sum(F.col("n") * F.col(m)) / F.sum("n")).alias(g) for m, g in (("mx", "gx"), ("my", "gy"))])
    dx, dy = F.col("mx") - F.col("gx"), F.col("my") - F.col("gy")
    about = {"sxx": dx * dx, "syy": dy * dy, "sxy": dx * dy}
    return parts.join(F.broadcast(means), ["i", "j"]).groupBy("i", "j").agg(  # one row a pair
        F.sum("n").alias("n"),
        *[F.any_value(g).alias(m) for m, g in (("mx", "gx"), ("my", "gy"))],
        *[F.sum(F.col(s) + F.col("n") * moved).alias(s) for s, moved in about.items()],
        *[f(c).alias(c) for c, f in (("xlo", F.min), ("xhi", F.max), ("ylo", F.min), ("yhi", F.max))],
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], complete_rows: bool = False, digits: int | None = None) -> DataFrame:
    """All pairs as (a, b, r) rows from one pass.

    Pairs use the rows where both are known, or only fully known rows with ``complete_rows``.  A column that is constant
    there, or never known, has NULL.
    """
    if complete_rows:
        df = df.na.drop(subset=list(columns))
    varies = (F.col("xlo") < F.col("xhi")) & (F.col("ylo") < F.col("yhi"))
    r = F.when(varies, F.try_divide("sxy", F.sqrt(F.greatest("sxx", F.lit(0.0))) * F.sqrt(F.greatest("syy", F.lit(0.0)))))
    r = F.when(varies & (F.col("i") == F.col("j")), 1.0).otherwise(r if digits is None else F.round(r, digits))
    found = gram(df, columns).select("i", "j", r.alias("r"))
    names = F.array(*[F.lit(c) for c in columns])
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    every = df.sparkSession.createDataFrame(pairs, "i int, j int").join(F.broadcast(found), ["i", "j"], "left")  # one row a pair
    name = lambda c: F.element_at(names, F.col(c) + 1)
    one = every.select(name("i").alias("a"), name("j").alias("b"), "r")
    return one.unionAll(every.where("i <> j").select(name("j"), name("i"), "r"))


def fit_line(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least squares line, r squared, r and the number of points, overall or per group."""
    a, b = F.col(y).cast("double"), F.col(x).cast("double")
    return df.groupBy(*by).agg(
        F.regr_slope(a, b).alias("slope"),
        F.regr_intercept(a, b).alias("intercept"),
        F.regr_r2(a, b).alias("r2"),
        F.regr_count(a, b).alias("n"),
    )


def quartiles(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    q = exact_quantiles(df, by, [column], [0.25, 0.5, 0.75])
    return q.select(
        *by,
        "n",
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )


def _fenced(df: DataFrame, by: Sequence[str], column: str, reach: float) -> DataFrame:
    spread = F.col("q3") - F.col("q1")
    fences = quartiles(df, by, column).withColumns(
        {"low_fence": F.col("q1") - reach * spread, "high_fence": F.col("q3") + reach * spread}
    )
    return join_small(df.where(F.col(column).isNotNull()), fences, by)


def box_stats(df: DataFrame, by: Sequence[str], column: str, reach: float = 1.5, derived: bool = True) -> DataFrame:
    """Quartiles, whisker ends (last points inside the fences) and the number of points outside.

    The rows are read three times: a ``derived`` input is written once first, a stored table is read again.
    """
    df = stage(df.select(*by, column), "box") if derived else df
    v = F.col(column)
    inside = (v >= F.col("low_fence")) & (v <= F.col("high_fence"))
    fenced = _fenced(df.select(*by, column), by, column, reach)
    return fenced.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.any_value(c).alias(c) for c in ("q1", "median", "q3")],
        F.min(F.when(inside, v)).alias("low_whisker"),
        F.max(F.when(inside, v)).alias("high_whisker"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, by: Sequence[str], column: str, reach: float = 1.5) -> DataFrame:
    """Rows beyond the fences of their group."""
    fenced = _fenced(df, by, column, reach)
    out = fenced.where((F.col(column) < F.col("low_fence")) | (F.col(column) > F.col("high_fence")))
    return out.select(*df.columns)


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, the last one closed; empty bins are kept.

    Every row carries the overall mean.
    """
    v = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    lo, hi, mean = v.agg(F.min("v"), F.max("v"), F.avg("v")).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, from_value double, to_value double, n bigint, mean double")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    at = F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1)).cast("int")
    counts = v.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("from_value"),
        (F.lit(lo) + (F.col("bin") + 1) * width).alias("to_value"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.lit(mean).alias("mean"),
    )


def error_stats(df: DataFrame, abs_error: str, limit: float = 3.0) -> DataFrame:
    """Mean and median absolute error and the rows above a limit."""
    median = exact_quantiles(df, [], [abs_error], [0.5]).select(F.col("quantiles")[0].alias("m")).scalar()
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.avg(abs_error).alias("mean_abs"), F.count_if(F.col(abs_error) > limit).alias("above")
    ).withColumn("median_abs", median)


def mean_sd(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, mean, sd) rows from one pass."""
    one = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"s_{c}") for c in columns])
    cells = [F.struct(F.lit(c).alias("variable"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("sd")) for c in columns]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
