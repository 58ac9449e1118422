"""Joins on validity, overlap and cumulative quantity, without building pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def as_of_version(facts: DataFrame, versions: DataFrame, key: str, at: str, attributes: list[str]) -> DataFrame:
    """Left join each fact to the version valid on its date.

    Facts of one key and date share their answer, so only distinct (key, date) pairs are asked.
    They are laid among the versions' starts in the order of time, and the last version before
    each is carried to it: inside a month by a window, over months by one row a key and month.
    No version is listed more than once and no pair is built: as many rows as versions and
    dates asked. A version ends before ``valid_to``; NULL is an open end. Of versions that start
    on one day the one that ends last counts. Without a date or key there is no version.
    """
    version = F.struct(F.col("valid_from"), F.col("valid_to"), *[F.col(c) for c in attributes])
    none = F.lit(None)
    known = versions.where(F.col("valid_from").isNotNull()).select(
        F.col(key).alias("_k"), F.col("valid_from").alias("_t"), F.lit(0).alias("_turn"), version.alias("_version"))
    asked = facts.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(F.col(key).alias("_k"), F.col(at).alias("_t")).distinct().select(
        "_k", "_t", F.lit(1).alias("_turn"), none.cast(known.schema["_version"].dataType).alias("_version"))
    points = known.unionByName(asked).withColumn("_month", F.trunc("_t", "month"))
    # Of one day the version that ends last comes last.
    order = [F.col("_t"), F.col("_turn"), F.coalesce(F.col("_version.valid_to"), F.lit("9999-12-31").cast("date"))]
    upto = Window.partitionBy("_k", "_month").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = points.withColumn("_own", F.last("_version", ignorenulls=True).over(upto)).where("_turn = 1")
    earlier = Window.partitionBy("_k").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    months = points.groupBy("_k", "_month").agg(F.max_by("_version", F.when(F.col("_turn") == 0, F.struct(*order))).alias("_last"))
    carried = months.select("_k", "_month", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    found = inside.join(carried, ["_k", "_month"]).select("_k", "_t", F.coalesce("_own", "_before").alias("_v")).where(
        F.col("_v").isNotNull() & (F.col("_v.valid_to").isNull() | (F.col("_t") < F.col("_v.valid_to"))))
    return facts.join(found, (F.col(key) == F.col("_k")) & (F.col(at) == F.col("_t")), "left").select(
        *facts.columns, *[F.col(f"_v.{c}").alias(c) for c in ("valid_from", "valid_to", *attributes)])


def overlap_totals(spans: DataFrame, stops: DataFrame, on: str, ident: str, span: tuple[str, str],
                   stop: tuple[str, str], flag: Column, bucket_minutes: int = 60) -> DataFrame:
    """Per ``ident``: how many ``stops`` of the same ``on`` overlap its half-open span, the seconds
    of overlap, and the seconds of the stops that ``flag`` marks.

    No pair is built: the stopped time before any moment is a running total over the stops'
    ends, and a span's overlap is the difference of two of them. Totals run inside time buckets
    first; the buckets' own totals, one row each, carry over. Empty or reversed spans never
    overlap and are left out.
    """
    width = bucket_minutes * 60
    a, b = F.unix_timestamp(stop[0]), F.unix_timestamp(stop[1])
    none = F.lit(None).cast("string")

    def point(t: Column, turn: int, sign: int, who: Column = none) -> Column:
        return F.struct(t.alias("_t"), F.lit(turn).alias("_turn"), F.lit(sign).alias("_sign"), who.cast("string").alias("_who"))

    # At one moment a span's end is looked up before the stops there, its start after them.
    ends = stops.where(b > a).select(on, flag.alias("_flag"), F.explode(F.array(point(a, 1, 1), point(b, 1, -1))).alias("_p"))
    lo, hi = F.unix_timestamp(span[0]), F.unix_timestamp(span[1])
    asked = spans.where(hi > lo).select(on, F.lit(False).alias("_flag"), F.explode(F.array(
        point(hi, 0, 0, F.col(ident)), point(lo, 2, 0, F.col(ident)))).alias("_p"))
    points = ends.unionByName(asked).select(on, "_flag", "_p.*").withColumn("_bucket", F.floor(F.col("_t") / width))
    sign, t = F.col("_sign"), F.col("_t")
    marked = F.when(F.col("_flag"), sign).otherwise(0)
    parts = {"_begun": F.when(sign > 0, 1).otherwise(0), "_over": F.when(sign < 0, 1).otherwise(0),
             "_n": sign, "_m": sign * t, "_fn": marked, "_fm": marked * t}
    earlier = Window.partitionBy(on).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = points.groupBy(on, "_bucket").agg(*[F.sum(v).alias(k) for k, v in parts.items()]).select(
        on, "_bucket", *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"{k}0") for k in parts])
    inside = Window.partitionBy(on, "_bucket").orderBy("_t", "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = points.select("*", *[F.sum(v).over(inside).alias(k) for k, v in parts.items()]).where("_who IS NOT NULL")
    total = run.join(carried, [on, "_bucket"])
    upto = lambda k: F.col(k) + F.col(f"{k}0")
    is_end = F.col("_turn") == 0
    change = lambda value: F.sum(F.when(is_end, value).otherwise(-value))
    return (total.groupBy(F.col("_who").alias(ident)).agg(
        F.sum(F.when(is_end, upto("_begun")).otherwise(-upto("_over"))).alias("overlaps"),
        change(t * upto("_n") - upto("_m")).alias("seconds"),
        change(t * upto("_fn") - upto("_fm")).alias("flagged_seconds"))
        .where("overlaps > 0"))


def overlap_pairs(left: DataFrame, right: DataFrame, on: str, left_span: tuple[str, str],
                  right_span: tuple[str, str], bucket_minutes: int = 60) -> DataFrame:
    """Pairs of the same ``on`` whose half-open time spans overlap, with the
    overlap in seconds.

    Both sides are listed under each time bucket they touch and joined on
    (on, bucket). A pair sharing several buckets is kept only in the first shared
    one. Empty or reversed spans never overlap and are left out.
    """
    width = bucket_minutes * 60

    def spread(df: DataFrame, span: tuple[str, str], tag: str) -> DataFrame:
        lo, hi = F.unix_timestamp(span[0]), F.unix_timestamp(span[1])
        first = F.floor(lo / width)
        final = F.floor((hi - 1) / width)
        return (df.where(hi > lo)
                .withColumn(f"_lo_{tag}", lo).withColumn(f"_hi_{tag}", hi)
                .withColumn(f"_first_{tag}", first)
                .withColumn("_bucket", F.explode(F.sequence(first, final))))

    pairs = spread(left, left_span, "l").join(spread(right, right_span, "r"), on=[on, "_bucket"])
    common = F.least("_hi_l", "_hi_r") - F.greatest("_lo_l", "_lo_r")
    once = F.col("_bucket") == F.greatest("_first_l", "_first_r")
    return (pairs.withColumn("overlap_seconds", common)
            .where((common > 0) & once)
            .drop("_bucket", "_lo_l", "_hi_l", "_first_l", "_lo_r", "_hi_r", "_first_r"))


def allocate_in_order(given: DataFrame, taken: DataFrame, on: list[str], given_order: list[str], taken_order: list[str],
                      quantity: str, given_id: list[str], taken_id: list[str]) -> DataFrame:
    """First in, first out: which part of each ``given`` quantity meets which ``taken`` quantity of the same ``on``.

    Both sides lie end to end along one axis of cumulative quantity. All ends of either side cut
    the axis; each piece between two cuts belongs to one given and one taken row, the ones whose
    ends come next. So there are as many pieces as rows, and no pair is tried. Pieces
    beyond the shorter side belong to none. Rows without a positive quantity take no part.
    """
    def ends(df: DataFrame, order: list[str], ids: list[str], name: str, other: str, other_type) -> DataFrame:
        run = Window.partitionBy(*on).orderBy(*order, *ids).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        who = F.struct(*[F.col(c) for c in ids])
        placed = df.where(F.col(quantity) > 0).select(*on, F.sum(quantity).over(run).alias("_end"), who.alias(name))
        return placed.withColumn(other, F.lit(None).cast(other_type))

    kinds = {name: df.select(F.struct(*ids).alias(name)).schema[name].dataType for name, df, ids in (("_given", given, given_id), ("_taken", taken, taken_id))}
    cuts = ends(given, given_order, given_id, "_given", "_taken", kinds["_taken"]).unionByName(
        ends(taken, taken_order, taken_id, "_taken", "_given", kinds["_given"])).groupBy(*on, "_end").agg(
        F.first("_given", ignorenulls=True).alias("_given"), F.first("_taken", ignorenulls=True).alias("_taken"))
    along = Window.partitionBy(*on).orderBy("_end")
    ahead = along.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    pieces = cuts.select(*on, (F.col("_end") - F.coalesce(F.lag("_end").over(along), F.lit(0))).alias(quantity),
                         F.first("_given", ignorenulls=True).over(ahead).alias("_g"), F.first("_taken", ignorenulls=True).over(ahead).alias("_t"))
    return pieces.where("_g IS NOT NULL AND _t IS NOT NULL").select(*on, "_g.*", "_t.*", quantity)
