"""Column expressions shared by all plans."""

from shelfline.functions.keys import row_digest, surrogate_key
from shelfline.functions.numbers import money, pct, ratio
from shelfline.functions.parse import as_bool, as_date, as_decimal, as_int, as_long, as_timestamp
from shelfline.functions.time import date_key, hours_between, month_label, month_start, week_start

__all__ = [
    "as_bool", "as_date", "as_decimal", "as_int", "as_long", "as_timestamp",
    "date_key", "hours_between", "money", "month_label", "month_start", "pct",
    "ratio", "row_digest", "surrogate_key", "week_start",
]
