"""Distinct counts that roll up: per day the set of ids as bitmaps over dictionary codes, stored and merged at will.

A count of distinct ids cannot be added up over days or regions; a set can. Ids get dense codes
from a stored dictionary, in the order of their first day, so that a day's codes lie close
together; a day's set is a few bitmaps of 32,768 codes. Month, region, company and trailing
counts are then unions of stored sets: exact, and no fact is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.numbering import number_rows
from shelfline.session import settle
from shelfline.sources import sinks

MONTH = "state_month"


def coded(rows: DataFrame, root: str, ident: str, day: str) -> DataFrame:
    """``rows`` with the dictionary ``code`` of ``ident``; ids not seen before are added to the dictionary.

    Codes never change. NULL ids are not counted and are left out.
    """
    spark, path = rows.sparkSession, f"{root}/dictionary"
    first = rows.where(F.col(ident).isNotNull()).groupBy(F.col(ident).alias("id")).agg(F.min(day).alias("first_day"))
    last = 0
    if sinks.exists(spark, path):
        known = spark.read.schema("id string, code bigint").parquet(path)
        last = known.agg(F.max("code")).first()[0] or 0
        first = first.join(known.select("id"), "id", "left_anti")
    fresh = settle(number_rows(first, ["first_day", "id"], "code", last + 1).select("id", "code"), "codes")
    fresh.write.mode("append").parquet(path)
    codes = spark.read.schema("id string, code bigint").parquet(path).withColumnRenamed("id", "_id")
    return rows.join(codes, F.col(ident) == F.col("_id")).drop("_id")


def write_states(rows: DataFrame, root: str, ident: str, day: str, dims: Sequence[str]) -> int:
    """Store the day sets of ``rows``, which hold whole months; only those months are replaced. Returns the sets written."""
    with_code = coded(rows.select(ident, day, *dims), root, ident, day)
    states = with_code.groupBy(F.col(day).alias("state_day"), *dims, F.bitmap_bucket_number("code").alias("slice")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("ids"))
    return sinks.overwrite_partitions(states.withColumn(MONTH, F.date_format("state_day", "yyyy-MM")), f"{root}/days", [MONTH])


def read_states(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/days").withColumn(MONTH, F.col(MONTH).cast("string"))


def distinct_by(states: DataFrame, keys: Sequence[str], name: str = "distinct_ids") -> DataFrame:
    """Distinct ids per ``keys``: sets of a slice are united, with map-side unions, and the slices' sizes added."""
    united = states.groupBy(*keys, "slice").agg(F.bitmap_or_agg("ids").alias("ids"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).cast("bigint").alias(name))


def trailing_distinct(states: DataFrame, days: int = 30, keys: Sequence[str] = (), name: str = "distinct_ids") -> DataFrame:
    """Distinct ids of the ``days`` days up to each day that has any, per ``keys``.

    A day's set is united first, then counts for the ``days`` dates it belongs to: the work is
    days times slices, whatever the number of facts.
    """
    daily = settle(states.groupBy("state_day", *keys, "slice").agg(F.bitmap_or_agg("ids").alias("ids")), "day-sets")
    ahead = F.explode(F.sequence("state_day", F.date_add("state_day", days - 1)))
    spread = daily.select(*keys, "slice", "ids", ahead.alias("report_date"))
    present = daily.select(F.col("state_day").alias("report_date"), *keys).distinct()
    return distinct_by(spread.join(present, ["report_date", *keys], "left_semi"), ["report_date", *keys], name)
