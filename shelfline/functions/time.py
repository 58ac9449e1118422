"""Calendar expressions. Every one takes an explicit date: nothing reads the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(value: str | dt.date | Column) -> Column:
    """A date literal."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def date_key(c: str | Column) -> Column:
    """YYYYMMDD as an integer."""
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def week_start(c: str | Column) -> Column:
    """Monday of the week."""
    return F.trunc(_col(c), "week")


def month_start(c: str | Column) -> Column:
    return F.trunc(_col(c), "month")


def month_label(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def months_back(as_of: str | dt.date | Column, n: int) -> Column:
    """First day of the month ``n`` months before ``as_of``."""
    return F.trunc(F.add_months(day(as_of), -n), "month")


def hours_between(start: str | Column, end: str | Column, precision: int = 6,
                  scale: int = 2) -> Column:
    """Elapsed hours from whole seconds; NULL when either end is missing."""
    seconds = F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))
    hours = seconds.cast("decimal(18,0)") / F.lit(3600).cast("decimal(4,0)")
    return hours.try_cast(f"decimal({precision},{scale})")
