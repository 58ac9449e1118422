"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import configure, settle, work_dir

__all__ = ["arrow_session", "documents", "fresh", "in_slices", "mixed", "numbered", "settle", "text_column", "work_dir"]

# Rows per Arrow batch: documents may be megabytes long, so few are in memory at once.
BATCH_ROWS = 256
BATCH_BYTES = 16 << 20
# Code points looked at in one vectorised step inside a task.
STEP_CHARS = 1 << 18


def arrow_session(spark: SparkSession) -> SparkSession:
    """The library's runtime settings, with Arrow batches sized for whole documents."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """One of the provided tables, whole."""
    return arrow_session(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet, whatever extra columns it carries."""
    taken, name = {c.lower() for c in df.columns}, f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_column(df: DataFrame, name: str = "text") -> Column:
    """The text, NULL as the empty string."""
    return F.coalesce(df[name], F.lit(""))


def in_slices(items: list, size: int) -> Iterable[list]:
    """Consecutive parts of a list."""
    for i in range(0, len(items), size):
        yield items[i : i + size]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift), vectorised."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(factor)
        x ^= x >> np.uint64(31)
    return x


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of an Arrow batch, NULL as the empty string."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its place from 0 in the given order, nulls first; no task sees more than one range of the rows.

    The rows are sorted range by range and stored with their place inside the range; only one count a range
    reaches the driver. The order must not leave ties.
    """
    spark = df.sparkSession
    ranks = [F.asc_nulls_first(c) for c in order]
    placed = settle(df.repartitionByRange(*ranks).sortWithinPartitions(*ranks).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", 33)
    counts, start, starts = placed.groupBy(part.alias("part")).count().collect(), 0, []
    for r in sorted(counts):
        starts.append((r["part"], start))
        start += r["count"]
    firsts = spark.createDataFrame(starts, "_part bigint, _first bigint")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(firsts), part == F.col("_part")).withColumn(name, F.col("_first") + inside).drop("_at", "_part", "_first")
