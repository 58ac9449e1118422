"""Top-k, ranks against a prior period, streaks and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of a total order.

    Every task keeps its own ``n`` best rows, so only ``n`` rows per task travel.
    The optional rank numbers the ``n`` surviving rows.
    """
    best = df.orderBy(*order).limit(n)
    if rank is None:
        return best
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int,
                  rank: str = "rank", ties: bool = False) -> DataFrame:
    """Rows ranked at most ``k`` inside their group, limited before the shuffle."""
    fn = F.rank() if ties else F.row_number()
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, fn.over(w)).where(F.col(rank) <= k)


def rank_within(members: DataFrame, population: DataFrame, key: str, measure: str,
                rank: str) -> DataFrame:
    """Descending rank each member holds in a large population.

    ``members`` is a top-k result, so its (key, measure) list is a short constant.
    Each population row is compared with that list where it lies and only counts
    travel; the population is never sorted or gathered.
    """
    bar = members.where(F.col(measure).isNotNull()).agg(
        F.collect_list(F.struct(F.col(key).alias("k"), F.col(measure).alias("m"))).alias("bar")).scalar()
    beaten = F.filter(F.col("_bar"), lambda t: (F.col(measure) > t["m"])
                      | ((F.col(measure) == t["m"]) & (F.col(key) < t["k"])))
    counts = (population.where(F.col(measure).isNotNull())
              .withColumn("_bar", bar)
              .select(F.explode(beaten).alias("t"))
              .groupBy(F.col("t.k").alias(key))
              .agg(F.count("*").alias("_better")))
    ranked = members.join(counts, on=key, how="left")
    return ranked.withColumn(
        rank,
        F.when(F.col(measure).isNotNull(), F.coalesce("_better", F.lit(0)) + 1).cast("int"),
    ).drop("_better")


def with_streak(df: DataFrame, entity: Sequence[str], week: str, streak: str) -> DataFrame:
    """Length of the unbroken run of weeks each row belongs to, up to that row.

    Weeks of one run share ``week - 7 * position``; numbering inside that island
    gives the run length.
    """
    seen = Window.partitionBy(*entity).orderBy(week)
    island = F.expr(f"date_sub({week}, cast(7 * _pos as int))")
    run = Window.partitionBy(*entity, "_island").orderBy(week)
    return (df.withColumn("_pos", F.row_number().over(seen))
            .withColumn("_island", island)
            .withColumn(streak, F.row_number().over(run))
            .drop("_pos", "_island"))


def trailing(df: DataFrame, groups: Sequence[str], date: str, days: int,
             sums: dict[str, str]) -> DataFrame:
    """Calendar-trailing sums over daily rows: ``{output: input}``.

    The frame counts days, not rows, so missing days do not stretch it. Input is
    already one row per group and day, which bounds each window partition by the
    calendar.
    """
    pos = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*groups).orderBy(pos).rangeBetween(-(days - 1), 0)
    return df.withColumns({out: F.sum(src).over(w) for out, src in sums.items()})
