"""Deterministic keys.

Keys come from MD5 text digests, so any engine can reproduce them and 60 bits
keep collisions out of reach for billions of distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "∅"
SEPARATOR = "\x1f"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_text(*cols: str | Column) -> Column:
    """Join values into one text; NULL differs from '' and from a missing field."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_MARK)) for c in cols]
    return F.concat_ws(SEPARATOR, *parts)


def row_digest(*cols: str | Column) -> Column:
    """MD5 over the given columns, for change detection."""
    return F.md5(key_text(*cols))


def surrogate_key(*cols: str | Column) -> Column:
    """Non-negative 60-bit key over the given columns."""
    return F.conv(F.substring(row_digest(*cols), 1, 15), 16, 10).cast("bigint")
