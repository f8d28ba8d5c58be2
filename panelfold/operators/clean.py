"""Row and cell repairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelfold.functions.scalars import is_code, is_present
from panelfold.operators.quantiles import exact_quantiles, medians_wide
from panelfold.session import stage


def trim_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim text columns (all of them by default); NULL stays NULL."""
    names = columns if columns is not None else [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.trim(c) for c in names})


def valid_rows(df: DataFrame, code: str, name: str | None = None, length: int = 3) -> DataFrame:
    """Drop rows with a bad code or, where a name column is given, a blank name."""
    df = df.where(is_code(code, length))
    return df if name is None else df.where(is_present(name))


def override_cells(df: DataFrame, key: str, overrides: Mapping[str, Mapping[object, object]]) -> DataFrame:
    """Set single cells: ``{column: {key value: new value}}``.

    The overrides are literals of the call, so they become one CASE per column and need no join.
    """
    out = {}
    for column, cells in overrides.items():
        c = F.col(column)
        kind = df.schema[column].dataType
        expr = None
        for k, v in cells.items():
            branch = F.col(key) == F.lit(k)
            value = F.lit(v).cast(kind)
            expr = F.when(branch, value) if expr is None else expr.when(branch, value)
        out[column] = c if expr is None else expr.otherwise(c)
    return df.withColumns(out)


def mask_sentinel(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """Values at or above a sentinel threshold become NULL."""
    return df.withColumns({c: F.when(F.col(c) < threshold, F.col(c)) for c in columns})


def sentinel_rows(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """Rows in which any of the columns holds a sentinel."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c) >= threshold, F.lit(False))
    return df.where(hit)


def not_above(df: DataFrame, column: str, bound: float = 0.0) -> DataFrame:
    """Rows whose value is impossible: at or below a bound that it must exceed.  NULL is unknown, not impossible."""
    return df.where(F.col(column) <= bound)


def repair_sentinel(df: DataFrame, key: str, columns: Sequence[str], threshold: float) -> DataFrame:
    """Sentinel to NULL, then the key's median, then the overall median of the result so far.

    A key has one row per period, so its medians are ranked within the key in one pass.
    """
    masked = mask_sentinel(df, columns, threshold)
    by_key = medians_wide(masked, [key], columns, bounded=True)
    keys = by_key.withColumnRenamed(key, "__key")
    filled = masked.join(keys, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    filled = filled.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}_median")) for c in columns}).drop(*[f"{c}_median" for c in columns])
    filled = stage(filled, "repaired")
    overall = stage(overall_medians(filled, columns), "overall")
    # Scalar subqueries: no number passes through the driver.
    return filled.withColumns({c: F.coalesce(F.col(c), overall.select(c).scalar()) for c in columns})


def overall_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the median per column over all rows, NULL where all values are."""
    q = exact_quantiles(df, [], columns, [0.5])
    return q.agg(*[F.max(F.when(F.col("variable") == c, F.col("quantiles")[0])).alias(c) for c in columns])
