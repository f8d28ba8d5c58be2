"""Scalar cleaning expressions.  All are native column expressions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN becomes NULL; applied at every source boundary so no NaN lives inside the engine."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def falsy_to_null(c: Column | str, *, text: bool = False) -> Column:
    """NULL, and zero (or the empty text), count as missing.  Opt-in: a true zero is lost."""
    c = _col(c)
    return F.when(c != ("" if text else F.lit(0)), c)


def safe_double(c: Column | str) -> Column:
    """Anything that is not a finite number becomes NULL."""
    x = _col(c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def safe_long(c: Column | str) -> Column:
    """``safe_double`` rounded half to even; values beyond the long range become NULL."""
    return F.rint(safe_double(c)).try_cast("bigint")


def coerce_numeric(c: Column | str) -> Column:
    """Numeric where the text is numeric, else NULL; infinities are kept, NaN is not."""
    return nan_to_null(_col(c).try_cast("double"))


def half_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even on the scaled double, the rounding array libraries use."""
    c = _col(c)
    return F.rint(c) if digits == 0 else F.rint(c * float(10**digits)) / float(10**digits)


def half_even_long(c: Column | str) -> Column:
    return F.rint(_col(c)).cast("bigint")


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a value; NULL stays NULL (``least``/``greatest`` alone would return the bound)."""
    c = _col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def clean_code(c: Column | str) -> Column:
    """Trimmed, upper-cased code."""
    return F.upper(F.trim(_col(c)))


def is_code(c: Column | str, length: int = 3) -> Column:
    """True for a non-null code of the given length after cleaning; never NULL."""
    return F.coalesce(F.length(clean_code(c)) == length, F.lit(False))


def is_present(c: Column | str) -> Column:
    """True where text is neither NULL nor blank; never NULL."""
    return F.coalesce(F.trim(_col(c)) != "", F.lit(False))


def text_or(c: Column | str, default: str | None = None, max_len: int | None = None) -> Column:
    """Text with a default for NULL and empty, cut to a column's width."""
    out = falsy_to_null(c, text=True)
    if default is not None:
        out = F.coalesce(out, F.lit(default))
    return out if max_len is None else F.substring(out, 1, max_len)


def number_or(c: Column | str, default: float) -> Column:
    """Finite number with a default for missing and zero."""
    return F.coalesce(falsy_to_null(safe_double(c)), F.lit(float(default)))


def positive_or(c: Column | str, fallback: Column) -> Column:
    """The value where it is above zero, else the fallback."""
    c = _col(c)
    return F.when(c > 0, c).otherwise(fallback)


def in_or_all(c: Column | str, values: Iterable | None) -> Column:
    """Multi-select filter in which an empty selection means everything that is not NULL."""
    c = _col(c)
    chosen = list(values or [])
    return c.isin(chosen) if chosen else c.isNotNull()


def first_match(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """The label of the first rule that holds."""
    (cond, label), *rest = rules
    out = F.when(cond, F.lit(label))
    for cond, label in rest:
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def category_rank(c: Column | str, order: Sequence[str]) -> Column:
    """1-based position of a category in a given order, 0 when it is not listed."""
    return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in order]), _col(c)), F.lit(0).cast("bigint"))
