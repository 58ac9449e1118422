"""Text-to-type conversions that yield NULL for dirt instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of an active or true flag in the raw feeds.
TRUE_WORDS = ("true", "1")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: str | Column) -> Column:
    return _col(c).try_cast("int")


def as_long(c: str | Column) -> Column:
    return _col(c).try_cast("bigint")


def as_decimal(c: str | Column, precision: int, scale: int) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")


def as_date(c: str | Column) -> Column:
    return _col(c).try_cast("date")


def as_timestamp(c: str | Column) -> Column:
    return _col(c).try_cast("timestamp")


def as_bool(c: str | Column) -> Column:
    return _col(c).try_cast("boolean")


def is_true_word(c: str | Column, extra: tuple[str, ...] = ()) -> Column:
    """TRUE when the text spells a true flag; unknown words are FALSE."""
    return F.lower(_col(c)).isin(*TRUE_WORDS, *extra)
