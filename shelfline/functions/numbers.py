"""Exact decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for company totals; a quotient of two keeps 12 fractional digits.
WIDE = "decimal(22,4)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column, precision: int = 18, scale: int = 4) -> Column:
    return _col(c).cast(f"decimal({precision},{scale})")


def ratio(num: str | Column, den: str | Column, precision: int = 18, scale: int = 4,
          factor: int = 1) -> Column:
    """``num / den * factor`` rounded half-up; NULL when the divisor is 0 or NULL,
    or when the result does not fit."""
    n = _col(num).cast(WIDE) * F.lit(factor)
    quotient = F.try_divide(n, _col(den).cast(WIDE))
    return quotient.try_cast(f"decimal({precision},{scale})")


def pct(num: str | Column, den: str | Column, precision: int = 6, scale: int = 2) -> Column:
    """``num`` as a percentage of ``den``."""
    return ratio(num, den, precision, scale, factor=100)
