"""Gap filling on panels with one row per (key, period)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelfold.operators.quantiles import OVERALL, medians_wide
from panelfold.operators.sizing import join_small
from panelfold.session import stage


def interpolate(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    columns: Sequence[str],
    spacing: str = "position",
) -> DataFrame:
    """Linear interpolation within a key in period order; the ends take the nearest value.

    ``spacing='position'`` treats rows as equally spaced, ``'period'`` uses the period's distance.
    A key must have at most one row per period, which also bounds the rows a key can hold; a
    repeated (key, period) fails the job.  All columns share one shuffle on the keys.
    """
    if spacing not in ("position", "period"):
        raise ValueError("spacing is 'position' or 'period'")
    forward = Window.partitionBy(*keys).orderBy(F.col(period).asc())
    backward = Window.partitionBy(*keys).orderBy(F.col(period).desc())
    so_far = forward.rowsBetween(Window.unboundedPreceding, 0)
    # "From here on" read as a running frame over the reversed order: linear in the rows of a key.
    from_here = backward.rowsBetween(Window.unboundedPreceding, 0)

    at = F.row_number().over(forward) if spacing == "position" else F.col(period)
    repeated = F.lag(period).over(forward) == F.col(period)
    placed = df.withColumn(
        "__at", F.when(repeated, F.raise_error(F.lit("repeated (key, period)")).cast("double")).otherwise(at.cast("double"))
    )
    values = {c: F.col(c).cast("double") for c in columns}
    known = {c: F.when(v.isNotNull(), F.struct(F.col("__at").alias("at"), v.alias("v"))) for c, v in values.items()}
    ends = placed.withColumns(
        {
            **{f"__p_{c}": F.last(k, ignorenulls=True).over(so_far) for c, k in known.items()},
            **{f"__n_{c}": F.last(k, ignorenulls=True).over(from_here) for c, k in known.items()},
        }
    )

    helpers = ["__at", *[f"__p_{c}" for c in columns], *[f"__n_{c}" for c in columns]]
    return ends.withColumns({c: _between(values[c], F.col(f"__p_{c}"), F.col(f"__n_{c}")) for c in columns}).drop(*helpers)


def interpolate_long(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    columns: Sequence[str],
    spacing: str = "position",
    segments: int | None = None,
) -> DataFrame:
    """``interpolate`` for keys of any length: no task holds a key as a whole.

    Rows are cut into ranges of (key, period), so a long key lies in several segments.  Each segment is filled by
    windows of its own; what lies beyond its ends comes from a table of one row a segment: the last value known
    before it, the first one behind it, and how many rows there are before it.  Keys and periods must
    not be NULL.  ``segments`` ranges are made, by default as many as shuffle partitions.
    """
    if spacing not in ("position", "period"):
        raise ValueError("spacing is 'position' or 'period'")
    order = [*keys, period]
    ranged = df.repartitionByRange(segments, *order) if segments else df.repartitionByRange(*order)
    rows = stage(ranged.withColumn("__segment", F.spark_partition_id()), "segments")
    inside = Window.partitionBy(*keys, "__segment").orderBy(period)
    here = F.row_number().over(inside).cast("double")
    placed = rows.withColumn("__at", here if spacing == "position" else F.col(period).cast("double"))
    values = {c: F.col(c).cast("double") for c in columns}
    known = {c: F.when(v.isNotNull(), F.struct(F.col("__at").alias("at"), v.alias("v"))) for c, v in values.items()}
    ends = placed.withColumns({f"__k_{c}": k for c, k in known.items()}).withColumn("__again", F.lag(period).over(inside) == F.col(period))

    # One row a key and segment; keys of one segment have one row.
    each = ends.groupBy(*keys, "__segment").agg(
        F.count("*").cast("double").alias("__n"),
        F.min(period).alias("__lo"),
        F.max(period).alias("__hi"),
        *[f(f"__k_{c}").alias(f"__{e}_{c}") for c in columns for e, f in (("f", F.min), ("l", F.max))],
    )
    before = Window.partitionBy(*keys).orderBy("__segment").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*keys).orderBy(F.desc("__segment")).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(before), F.lit(0.0)) if spacing == "position" else F.lit(0.0)
    each = stage(each.withColumn("__shift", shift), "segment-ends")
    moved = lambda c, e: F.when(F.col(f"__{e}_{c}").isNotNull(), F.struct((F.col(f"__{e}_{c}.at") + F.col("__shift")).alias("at"), F.col(f"__{e}_{c}.v").alias("v")))
    carried = each.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__segment").alias("__s"),
        "__shift",
        (F.col("__lo") == F.max("__hi").over(before)).alias("__joint"),
        *[F.last(moved(c, "l"), ignorenulls=True).over(before).alias(f"__b_{c}") for c in columns],
        *[F.last(moved(c, "f"), ignorenulls=True).over(behind).alias(f"__a_{c}") for c in columns],
    )
    same = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)], F.col("__segment") == F.col("__s"))
    joined = ends.join(carried, same)
    bad = F.coalesce("__again", F.lit(False)) | (F.coalesce("__joint", F.lit(False)) & (F.row_number().over(inside) == 1))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    from_here = Window.partitionBy(*keys, "__segment").orderBy(F.desc(period)).rowsBetween(Window.unboundedPreceding, 0)
    whole = {c: F.when(F.col(f"__k_{c}").isNotNull(), F.struct((F.col(f"__k_{c}.at") + F.col("__shift")).alias("at"), F.col(f"__k_{c}.v").alias("v"))) for c in columns}
    filled = joined.withColumns(
        {
            "__at": F.when(bad, F.raise_error(F.lit("repeated (key, period)")).cast("double")).otherwise(F.col("__at") + F.col("__shift")),
            **{f"__p_{c}": F.coalesce(F.last(whole[c], ignorenulls=True).over(so_far), F.col(f"__b_{c}")) for c in columns},
            **{f"__q_{c}": F.coalesce(F.last(whole[c], ignorenulls=True).over(from_here), F.col(f"__a_{c}")) for c in columns},
        }
    )
    return filled.withColumns({c: _between(values[c], F.col(f"__p_{c}"), F.col(f"__q_{c}")) for c in columns}).select(*df.columns)


def _between(value: Column, p: Column, n: Column) -> Column:
    """A known value, or what lies on the line between the known ones ``p`` and ``n`` (structs of place and value), or the only one of them."""
    slope = (n["v"] - p["v"]) / (n["at"] - p["at"])
    return F.when(value.isNotNull(), value).when(p.isNull(), n["v"]).when(n.isNull(), p["v"]).otherwise(p["v"] + slope * (F.col("__at") - p["at"]))


def one_per_period(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """``df``, where a repeated (key, period) fails the job."""
    again = F.lag(period).over(Window.partitionBy(*keys).orderBy(period)) == F.col(period)
    return df.withColumn(period, F.when(again, F.raise_error(F.lit("repeated (key, period)")).cast(df.schema[period].dataType)).otherwise(F.col(period)))


def fill_forward(df: DataFrame, keys: Sequence[str], period: str, columns: Sequence[str]) -> DataFrame:
    """The last known value; a key has one row per period, and a repeated one fails the job."""
    df = one_per_period(df, keys, period)
    w = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def fill_backward(df: DataFrame, keys: Sequence[str], period: str, columns: Sequence[str]) -> DataFrame:
    """The next known value, under the same condition."""
    df = one_per_period(df, keys, period)
    w = Window.partitionBy(*keys).orderBy(F.col(period).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def impute_panel(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    columns: Sequence[str],
    digits: int | None = None,
    constant: float | None = None,
    flags: bool = False,
) -> DataFrame:
    """Interpolate, then the period's median, then the overall median (or ``constant`` instead of it).

    Both medians are those of the interpolated column, before any median fill.  ``flags`` adds
    ``<column>_imputed``.  The interpolated panel is written once and read by the median passes.
    """
    from panelfold.functions.scalars import half_even

    source = df.withColumns({f"{c}_imputed": F.col(c).isNull() for c in columns}) if flags else df
    panel = stage(interpolate(source, keys, period, columns), "interpolated")
    medians = medians_wide(panel, [period], columns, "__median", overall=constant is None)
    last = {c: F.lit(constant) for c in columns}
    if constant is None:
        medians = stage(medians, "medians")
        whole = medians.where(OVERALL).select(F.struct(*[f"{c}__median" for c in columns])).scalar()
        last = {c: whole[f"{c}__median"] for c in columns}
        medians = medians.where(~F.col(OVERALL)).drop(OVERALL)
    joined = join_small(panel, medians, [period], "left")

    def complete(c: str):
        out = F.coalesce(F.col(c), F.col(f"{c}__median"), last[c].cast("double"))
        return out if digits is None else half_even(out, digits)

    return joined.withColumns({c: complete(c) for c in columns}).drop(*[f"{c}__median" for c in columns])
