"""One row per key, and duplicate marking that survives a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.session import settle

# So many hashes of repeated keys a task can hold beside its rows; a key of more rows is ranked in two steps.
FEW_KEYS = 1_000_000
HOT_ROWS = 10_000


def _sortable(df: DataFrame, skip: set[str]) -> list[Column]:
    """Ascending order over the remaining sortable columns: the tie-break."""
    return [
        F.col(f"`{f.name}`").asc()
        for f in df.schema.fields
        if f.name not in skip and f.dataType.typeName() not in ("map", "variant", "object")
    ]


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """Keep the newest row of every key, by ``latest_by`` descending.

    Remaining columns break ties, so reruns agree. ``row_number() = 1`` plans a
    window group limit ahead of the shuffle: every map task forwards one row per
    key, hence a hot key never piles up in one reducer.
    """
    order = [F.col(c).desc() for c in latest_by] + _sortable(df, {*keys, *latest_by})
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


def mark_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
                 flag: str = "_repeat", eligible: Column | None = None) -> DataFrame:
    """Flag every row of a key but its first; all rows are kept.

    Hashes of the keys are counted first, with map-side sums, and those seen twice are stored.
    While they are few, rows of any other hash, their key's only rows, pass without a shuffle or
    sort, and only the rest are ranked. When they are many, every row would be dealt by its hash
    just to find out, and repeated ones twice more to be ranked; all rows are then ranked in one
    deal, except those of hot hashes. Ranking is exact, so keys that share a hash do no harm.
    Rows outside ``eligible`` are never flagged and do not compete.
    ``df`` is read once for the count and once for each part.
    """
    open_rows = F.lit(True) if eligible is None else eligible
    hashed = F.xxhash64(*[F.col(k) for k in keys])
    counted = settle(df.where(open_rows).groupBy(hashed.alias("_twice")).agg(F.count("*").alias("_n"))
                     .where("_n > 1"), "repeated-keys")
    twice, many = counted.select("_twice"), counted.count() > FEW_KEYS
    if many:
        twice = settle(counted.where(F.col("_n") > HOT_ROWS).select("_twice"), "hot-keys")
        if twice.isEmpty():
            return _rank_once(df, keys, order, flag, open_rows)
    # The hash is computed where rows are dealt, never stored in them: random bytes do not compress.
    met = F.coalesce(open_rows, F.lit(False)) & (hashed == F.col("_twice"))
    rest = df.join(twice, met, "left_anti")
    rest = _rank_once(rest, keys, order, flag, open_rows) if many else rest.withColumn(flag, F.lit(False))
    ranked = _rank_repeats(df.join(twice, met, "left_semi"), keys, order, flag)
    return rest.unionByName(ranked)


def _rank_once(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None, flag: str, open_rows: Column) -> DataFrame:
    """Rank keys that are not hot in one window; rows that do not compete are each a group of their own."""
    order = [*(order or []), *_sortable(df, set(keys))]
    split = df.withColumn("_alone", F.when(~F.coalesce(open_rows, F.lit(False)), F.monotonically_increasing_id()))
    place = F.row_number().over(Window.partitionBy(*keys, "_alone").orderBy(*order))
    return split.withColumn(flag, place > 1).drop("_alone")


def _rank_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None, flag: str) -> DataFrame:
    """Two chained windows bound the work per task. The first ranks a key's rows inside each
    input partition; the second lets only those local winners compete per key, so its groups
    hold at most one row per input partition.
    """
    order = [*(order or []), *_sortable(df, set(keys))]
    split = df.withColumn("_part", F.spark_partition_id())
    local = Window.partitionBy(*keys, "_part").orderBy(*order)
    split = split.withColumn("_local", F.row_number().over(local))
    split = split.withColumn("_lane", F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_part")))
    final = Window.partitionBy(*keys, "_lane").orderBy(*order, F.col("_part"))
    split = split.withColumn("_final", F.row_number().over(final))
    first = (F.col("_local") == 1) & (F.col("_final") == 1)
    return split.withColumn(flag, ~first).drop("_part", "_local", "_lane", "_final")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")
