"""Keyed merges as pure functions: (target, source) -> new target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.dedup import latest_per_key


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; other rows stay.

    The anti join needs only the source keys, so Spark can broadcast them when a
    batch is small and leave the large target unshuffled.
    """
    kept = target.join(source.select(*keys), on=list(keys), how="left_anti")
    return source.unionByName(kept.select(*target.columns), allowMissingColumns=True)


def merge_columns(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  update: Sequence[str]) -> DataFrame:
    """Matched keys take only ``update`` from the source; unmatched source rows
    are inserted whole."""
    keys = list(keys)
    t = target.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_t"))
    s = source.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_s"))
    both = t.join(s, on=keys, how="full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        old, new = F.col("_t").getField(c), F.col("_s").getField(c)
        take_new = F.col("_t").isNull()
        if c in update:
            take_new = take_new | F.col("_s").isNotNull()
        out.append(F.when(take_new, new).otherwise(old).alias(c))
    return both.select(*out)


def append_unseen(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Immutable append: rows whose key is already stored are left out."""
    fresh = latest_per_key(source, [key], []).join(target.select(key), on=key, how="left_anti")
    return target.unionByName(fresh.select(*target.columns))
