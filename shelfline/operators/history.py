"""Version history of dimensions (type 2) and current slices (type 1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import row_digest, surrogate_key
from shelfline.operators.dedup import latest_per_key

HISTORY_COLUMNS = ("surrogate_key", "valid_from", "valid_to", "is_current", "row_digest")


def open_history(incoming: DataFrame, natural_key: str, tracked: Sequence[str],
                 effective: str) -> DataFrame:
    """First load: one open version per key, in half-open ``[valid_from, valid_to)`` form."""
    newest = latest_per_key(incoming, [natural_key], [effective])
    attributes = [c for c in incoming.columns if c not in (natural_key, effective)]
    return newest.select(
        natural_key,
        *attributes,
        surrogate_key(natural_key, F.col(effective).cast("date")).alias("surrogate_key"),
        F.col(effective).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        row_digest(*tracked).alias("row_digest"),
    )


def apply_history(state: DataFrame | None, incoming: DataFrame, natural_key: str,
                  tracked: Sequence[str], effective: str) -> DataFrame:
    """Merge one feed into the history and return the new history.

    A changed key closes its open version at the new start date and opens another.
    A change that is not newer than the open version corrects it in place, which
    keeps intervals free of gaps and overlaps. Unchanged keys stay as they are, so
    rerunning a feed changes nothing. Closed versions bypass the join.
    """
    fresh = open_history(incoming, natural_key, tracked, effective)
    if state is None:
        return fresh
    columns = state.columns
    rest = [c for c in columns if c != natural_key]
    closed = state.where("NOT is_current")
    now = state.where("is_current").select(natural_key, F.struct(*rest).alias("_now"))
    new = fresh.select(natural_key, F.struct(*rest).alias("_new"))
    both = now.join(new, on=natural_key, how="full_outer")
    old, nxt = F.col("_now"), F.col("_new")
    changed = old.isNotNull() & nxt.isNotNull() & (old["row_digest"] != nxt["row_digest"])
    later = nxt["valid_from"] > old["valid_from"]
    shut = old.withField("valid_to", nxt["valid_from"]).withField("is_current", F.lit(False))
    fixed = nxt.withField("valid_from", old["valid_from"]).withField("surrogate_key", old["surrogate_key"])
    versions = (
        F.when(old.isNull(), F.array(nxt))
        .when(changed & later, F.array(shut, nxt))
        .when(changed, F.array(fixed))
        .otherwise(F.array(old))
    )
    opened = both.select(natural_key, F.explode(versions).alias("_v")).select(natural_key, "_v.*")
    return closed.unionByName(opened.select(*columns))


def with_open_end(history: DataFrame, end: str = "9999-12-31") -> DataFrame:
    """Show open versions with a far end date instead of NULL."""
    return history.withColumn("valid_to", F.coalesce("valid_to", F.lit(end).cast("date")))


def current_slice(history: DataFrame) -> DataFrame:
    return history.where("is_current")


def version_faults(history: DataFrame, natural_key: str) -> DataFrame:
    """Keys that do not have exactly one current version."""
    return (history.groupBy(natural_key)
            .agg(F.count_if("is_current").alias("current_versions"))
            .where("current_versions <> 1"))
