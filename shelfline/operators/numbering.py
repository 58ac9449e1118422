"""Numbers for the rows of a frame in a given order, without bringing them to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.session import settle


def number_rows(df: DataFrame, order: Sequence[str], name: str, first: int = 0) -> DataFrame:
    """``df`` with the place of each row in ``order`` (nulls first), from ``first`` on.

    Rows are dealt and sorted by ranges of the order and stored; a range's first number is the
    count of the ranges before it, one number a range on the driver. Ties must not occur.
    """
    ranks = [F.asc_nulls_first(c) for c in order]
    stored = settle(df.repartitionByRange(*ranks).sortWithinPartitions(*ranks).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", 33)
    starts, total = [], first
    for r in sorted(stored.groupBy(part.alias("part")).count().collect()):
        starts.append((r["part"], total))
        total += r["count"]
    firsts = df.sparkSession.createDataFrame(starts, "_part bigint, _first bigint")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return stored.join(F.broadcast(firsts), part == F.col("_part")).withColumn(name, F.col("_first") + inside).drop("_at", "_part", "_first")
