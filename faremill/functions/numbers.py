"""Money, ratios and casts.

A sum of doubles depends on the order in which partitions finish. Totals here run on two
64-bit integers per value, its whole part and what is behind the point in billionths: exact to
nine decimals, independent of order, and much faster than decimal arithmetic, since the
additions stay primitives in generated code. NaN, infinities and values or totals beyond 64
bits are errors (with Spark's ANSI casts, its default), never another number.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
DISTANCE = "decimal(18,3)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(col: Column | str) -> Column:
    return _col(col).cast(MONEY)


BILLION = 10**9


def exact_parts(col: Column | str) -> tuple[Column, Column]:
    """A value's whole part and the rest in billionths, both as 64-bit integers."""
    c = _col(col)
    whole = c.cast("bigint")
    return whole, F.rint((c - whole) * F.lit(BILLION)).cast("bigint")


def joined_parts(whole: Column | str, behind: Column | str) -> Column:
    """The sum of values given by their parts, as ``decimal(38,9)``."""
    billionth = F.lit(Decimal(1).scaleb(-9))
    sums = F.sum(whole).cast("decimal(28,0)"), F.sum(behind).cast("decimal(19,0)")
    return (sums[0] + sums[1] * billionth).cast("decimal(38,9)")


def exact_sum(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """Order-independent sum as ``decimal(38,9)``; NULL when there are no values.

    With a decimal ``dtype`` of at most 18 digits, eight of them behind the point, the part
    behind the point stays a decimal of eight digits, which Spark sums as a 64-bit integer.
    """
    c = _col(col)
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18 and dtype.scale <= 8:
        whole = c.cast("bigint")
        behind = (c - whole.cast(dtype)).cast(T.DecimalType(8, dtype.scale))
        return (F.sum(whole).cast("decimal(28,0)") + F.sum(behind)).cast("decimal(38,9)")
    return joined_parts(*exact_parts(c))


def total(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """``exact_sum`` as a double, rounded once."""
    return exact_sum(col, dtype).cast("double")


def total_or_zero(col: Column | str) -> Column:
    return F.coalesce(total(col), F.lit(0.0))


def average(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """Order-independent mean over the non-null values; NULL when there are none."""
    c = _col(col)
    return F.try_divide(total(c, dtype), F.count(c).cast("double"))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage, NULL when the whole is zero."""
    share = part.cast("double") * F.lit(100.0)
    return F.round(F.try_divide(share, F.nullif(whole.cast("double"), F.lit(0.0))), digits)


def safe_cast(col: Column | str, dtype: str) -> Column:
    """NULL instead of an error on text that is not of the type."""
    return _col(col).try_cast(dtype)
