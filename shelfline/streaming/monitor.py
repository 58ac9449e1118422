"""Breaches of a stream, seen in the metrics that its own micro-batches report: no batch query looks at its tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRICS = "shelfline_events"


def observed(events: DataFrame) -> DataFrame:
    """The stream with its rows, the rows without an id, the rows whose time does not parse and the latest time observed."""
    time = F.col("event_timestamp").try_cast("timestamp")
    return events.observe(METRICS, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("event_id").isNull()).alias("nameless"),
                          F.count_if(time.isNull()).alias("timeless"), F.max(time).alias("latest"))


@dataclass(frozen=True)
class Breach:
    """What a micro-batch reported: ``kind`` is REJECTS or STALE."""

    stream: str
    batch: int
    kind: str
    value: float
    limit: float


class Watch(StreamingQueryListener):
    """Collects breaches while streams run; ``spark.streams.addListener(watch)``.

    REJECTS: more than ``reject_pct`` percent of a micro-batch's rows have no id. STALE: the
    latest event of a micro-batch is more than ``stale_minutes`` before ``as_of`` (default: the
    time the micro-batch began).
    """

    def __init__(self, reject_pct: float = 2.0, stale_minutes: float = 15, as_of: dt.datetime | None = None):
        self.reject_pct, self.stale_minutes, self.as_of = reject_pct, stale_minutes, as_of
        self.found: list[Breach] = []
        self.rows = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(METRICS)
        if not seen or not seen["rows"]:
            return
        self.rows += seen["rows"]
        share = 100 * seen["nameless"] / seen["rows"]
        if share > self.reject_pct:
            self.found.append(Breach(str(progress.id), progress.batchId, "REJECTS", share, self.reject_pct))
        if seen["latest"] is not None:
            now = self.as_of or dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).replace(tzinfo=None)
            age = (now - seen["latest"]).total_seconds() / 60
            if age > self.stale_minutes:
                self.found.append(Breach(str(progress.id), progress.batchId, "STALE", age, self.stale_minutes))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
