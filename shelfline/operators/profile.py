"""Whole-table health measures: null rates, duplicates, freshness, movement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import pct


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: total rows and the NULL percentage of each column, in one scan."""
    columns = list(columns or df.columns)
    counts = [F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in columns]
    one = df.agg(F.count("*").alias("row_count"), *counts)
    return one.select("row_count", *[pct(f"_n_{c}", "row_count").alias(c) for c in columns])


def health_row(df: DataFrame, table: str, key: Sequence[str], columns: Sequence[str],
               null_limit_pct: float = 1.0) -> DataFrame:
    """Log row of a table: null rates as JSON, surplus rows per key, OK/WARN/FAIL.

    A duplicate key fails the table; a null rate above the limit warns.
    """
    by_key = df.groupBy(*key).agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in columns])
    one = by_key.agg(
        F.sum("_rows").alias("row_count"),
        F.sum(F.col("_rows") - 1).alias("duplicate_rows"),
        F.count_if(F.col("_rows") > 1).alias("duplicate_keys"),
        *[F.sum(f"_n_{c}").alias(f"_n_{c}") for c in columns])
    rates = {c: pct(f"_n_{c}", "row_count") for c in columns}
    worst = F.greatest(*rates.values()) if len(rates) > 1 else next(iter(rates.values()))
    status = (F.when(F.col("duplicate_rows") > 0, "FAIL")
              .when(worst > F.lit(null_limit_pct), "WARN").otherwise("OK"))
    return one.select(
        F.lit(table).alias("table_name"), "row_count", "duplicate_keys", "duplicate_rows",
        F.to_json(F.map_from_arrays(
            F.array(*[F.lit(c) for c in columns]),
            F.array(*[r.cast("string") for r in rates.values()]))).alias("null_rate_by_column"),
        status.alias("status"))


def freshness(df: DataFrame, table: str, stamp: str, as_of: str, limit_minutes: int) -> DataFrame:
    """One row: newest stamp, its age at ``as_of`` in minutes, and whether it breaches."""
    newest = df.agg(F.max(stamp).alias("newest"))
    age = ((F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("newest")) / 60)
    return newest.select(
        F.lit(table).alias("table_name"),
        F.date_format("newest", "yyyy-MM-dd HH:mm:ss").alias("newest"),
        F.floor(age).alias("age_minutes"),
        F.lit(limit_minutes).alias("limit_minutes"),
        F.coalesce(age > limit_minutes, F.lit(True)).alias("breached"))


def day_moves(daily: DataFrame, series: Sequence[str], date: str, measure: str,
              limit_pct: float = 20.0) -> DataFrame:
    """Relative move of a daily measure against the previous recorded day."""
    w = Window.partitionBy(*series).orderBy(date)
    moved = daily.withColumn("prior_value", F.lag(measure).over(w))
    moved = moved.withColumn("move_pct", pct(F.col(measure) - F.col("prior_value"), "prior_value", 18, 2))
    return moved.withColumn("is_breach", F.coalesce(F.abs("move_pct") > limit_pct, F.lit(False)))
