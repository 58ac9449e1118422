"""Which partitions of a table may hold a key: Bloom filters of 64-bit words, one set a partition, as a small table of bits.

A key of a partition is four bits of one word. The words lie beside the table, sorted, as one append-only folder a
write; a lookup reads the words of its own keys. Rows that leave a partition leave their bits: a partition
named in vain costs time only, a key that is stored is never missed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import settle

BITS_PER_KEY = 12
PROBES = 4


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}_keys"


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _mask(h: Column) -> Column:
    """Four bits of a word, out of the upper half of the hash."""
    bits = [F.shiftright(h, 32 + 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(PROBES)]
    one = F.lit(1).cast("bigint")
    out = F.call_function("shiftleft", one, bits[0])
    for b in bits[1:]:
        out = out.bitwiseOR(F.call_function("shiftleft", one, b))
    return out


def _word(h: Column, words: Column) -> Column:
    """The word of a filter of ``words`` words, a power of two."""
    return h.bitwiseAND(words - 1)


def add_keys(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], by: str) -> None:
    """Append the keys of ``rows`` to the index; call it before the rows are published, so that it never lags."""
    _words(rows, keys, by).write.mode("append").parquet(index_path(path))


def _words(rows: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """(part, words, word, bits): the filters of each partition among ``rows``, sized by its keys."""
    hashed = settle(rows.select(F.col(by).alias("part"), _hash(keys).alias("h")).where("h IS NOT NULL"), "keys")
    sizes = hashed.groupBy("part").agg(F.count("*").alias("n")).select(
        F.col("part").alias("of"), F.pow(F.lit(2.0), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") * BITS_PER_KEY / 64)))).cast("bigint").alias("words"))
    words = (hashed.join(sizes, F.col("part").eqNullSafe(F.col("of")))
             .select("part", "words", _word(F.col("h"), F.col("words")).alias("word"), _mask(F.col("h")).alias("mask"))
             .groupBy("part", "words", "word").agg(F.bit_or("mask").alias("bits")))
    return words.repartitionByRange("words", "word").sortWithinPartitions("words", "word")


def parts_that_may_hold(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Partition values (column ``by``) whose filter has a key of ``source``; no file of the table is opened."""
    index = spark.read.parquet(index_path(path))
    sizes = [r[0] for r in index.select("words").distinct().collect()]  # powers of two: a few dozen at most
    wanted = settle(source.select(_hash(keys).alias("h")).distinct().select(
        F.explode(F.array(*[F.lit(n).cast("bigint") for n in sizes])).alias("words"), "h").select(
        "words", _word(F.col("h"), F.col("words")).alias("word"), _mask(F.col("h")).alias("mask")).distinct(), "wanted")
    # The range of the words wanted prunes row groups before the join.
    ends = wanted.agg(F.min("word"), F.max("word")).first()
    if ends[0] is None:
        return index.select(F.col("part").alias(by)).limit(0)
    near = index.where(F.col("word").between(ends[0], ends[1]))
    hit = F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")
    return near.join(wanted, ["words", "word"]).where(hit).select(F.col("part").alias(by)).distinct()


def rebuild(spark: SparkSession, path: str, keys: Sequence[str], by: str) -> None:
    """The index anew from the table's key columns: for a table older than its index, or after many writes."""
    words = _words(spark.read.parquet(path), keys, by)
    words.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(index_path(path))
