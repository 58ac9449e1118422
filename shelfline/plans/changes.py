"""What the conformed tables' merges touched, followed to the months of the reporting layer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import settle
from shelfline.sources import sinks

Months = set[tuple[int, int] | None]  # (year, month); None: rows without a date


@dataclass
class Span:
    """Months to rebuild: those listed, and all from ``since`` on."""

    months: Months
    since: dt.date | None = None

    def __bool__(self) -> bool:
        return bool(self.months or self.since)


def months_reached(days: Iterable[dt.date | None], back: int = 0, ahead: int | None = 0) -> Span:
    """Months between ``back`` (not above 0) and ``ahead`` days around each day; ``ahead`` None: all that follow."""
    out: Months = set()
    since = None
    for d in days:
        if d is None:
            out.add(None)
            continue
        first = d + dt.timedelta(days=back)
        if ahead is None:
            since = min(since or first, first).replace(day=1)
            continue
        last = (d + dt.timedelta(days=ahead)).replace(day=1)
        step = first.replace(day=1)
        while step <= last:
            out.add((step.year, step.month))
            step = (step + dt.timedelta(days=32)).replace(day=1)
    return Span(out, since)


def in_months(date: str | Column, span: Span) -> Column:
    """Whether a date lies in the months; on a partition column this prunes folders."""
    date = F.col(date) if isinstance(date, str) else date
    starts = [dt.date(*m, 1) for m in span.months if m is not None]
    hit = F.trunc(date, "month").isin(starts) if starts else F.lit(False)
    if None in span.months:
        hit = hit | date.isNull()
    return hit | (date >= F.lit(span.since)) if span.since else hit


def merged(*spans: Span) -> Span:
    """All months of several spans."""
    starts = [s.since for s in spans if s.since]
    return Span(set().union(*(s.months for s in spans)), min(starts, default=None))


class Changes:
    """Merges not yet followed into the reporting layer, per conformed table."""

    def __init__(self, spark: SparkSession, paths: dict[str, str]):
        self.spark, self.paths = spark, paths
        self.ids = {name: sinks.change_ids(spark, path) for name, path in paths.items()}
        self.days = {name: sinks.changed_days(spark, paths[name], ids) for name, ids in self.ids.items()}

    def done(self) -> None:
        """Forget the merges that were followed; what came meanwhile stays for the next run."""
        for name, ids in self.ids.items():
            sinks.forget_changes(self.spark, self.paths[name], ids)


def replace_months(df: DataFrame, path: str, by: str, span: Span) -> int:
    """Replace the stored rows of the months by those of ``df``; other partitions keep their files.

    ``by`` is the partition column, a date. A day without rows now loses its partition.
    """
    spark = df.sparkSession
    rows = settle(df, "months")
    gone = None
    if sinks.exists(spark, path):
        stored = spark.read.schema(rows.schema).parquet(path).select(by).distinct().where(in_months(by, span))
        gone = settle(stored.where(F.col(by).isNotNull()).join(rows.select(by).distinct(), by, "left_anti"), "gone")
    written = sinks.overwrite_partitions(rows, path, [by])
    if gone is not None:
        sinks.drop_partitions(spark, path, gone)
    return written


def receipts_of(returns: DataFrame, sales: DataFrame, days: Sequence[dt.date | None]) -> list[dt.date | None]:
    """Days of the receipts that the returns of the given days name."""
    if not days:
        return []
    hit = F.col("return_date").isin([d for d in days if d is not None])
    wanted = returns.where(hit | F.col("return_date").isNull() if None in days else hit).select("transaction_id").distinct()
    return [r[0] for r in sales.join(wanted, "transaction_id", "left_semi").select("transaction_date").distinct().collect()]
