"""Production event stream: incremental landing, batch assembly and live KPIs.

The transforms are the batch ones; only sources, triggers and sinks differ. Every
query runs with an available-now trigger and its own checkpoint, so a restart
resumes where the last committed micro-batch ended. What a micro-batch needs of the
past lies in keyed state on disk (RocksDB), never in stored events read again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfline.contracts import EVENT_SCHEMA
from shelfline.operators import quality as q
from shelfline.operators.dedup import latest_per_key
from shelfline.plans import conform, ingest, kpi_production
from shelfline.session import settle
from shelfline.sources import sinks

# Stored events are laid out by a hash of their batch, which compaction folds bucket by bucket.
BUCKET = "key_bucket"
BUCKETS = 64


def _by_changes(spark: SparkSession) -> SparkSession:
    """State checkpoints hold what a trigger changed, not the whole state."""
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def read_events(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA,
                files_per_trigger: int | None = None) -> DataFrame:
    """New NDJSON files of a landing folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def typed_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_timestamp", F.col("event_timestamp").try_cast("timestamp"))


def land(events: DataFrame, path: str, checkpoint: str, batch_id: str, source: str | Column,
         ingested_at: str | None = None) -> StreamingQuery:
    """Append raw events with lineage, partitioned by load date."""
    out = ingest.add_bronze_metadata(events, source, batch_id, ingested_at=ingested_at)
    return (out.writeStream.outputMode("append").format("parquet").partitionBy("ingestion_date")
            .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


KEYED = (q.not_null(["event_id"], rule_id="EVT-ID"),)


def keyed_events(micro: DataFrame, epoch: int, rejects: str, target: str, at: str | None = None) -> DataFrame:
    """Events that name their id; the others go to the reject log, a replayed epoch replacing its own entries."""
    tagged = settle(q.tag(micro, KEYED), "keyed")
    stamp = at or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    log = q.reject_log(tagged, KEYED, "iot_sensor_events", target, f"epoch-{epoch}", f"epoch-{epoch}", stamp)
    if not tagged.where(F.col(q.FAILED).isNotNull()).isEmpty():
        sinks.append_epoch(log, rejects, epoch)
    return q.clean_rows(tagged)


def append_unseen_events(events: DataFrame, root: str, checkpoint: str, delay: str = "7 days", rejects: str | None = None,
                         at: str | None = None) -> StreamingQuery:
    """Store every event id once at ``root``, however late its repeat comes.

    The clock is the latest event time seen. Events within ``delay`` of it pass a stream of
    their own whose keyed state drops repeats: the state outlives every event that can still
    be on time, and what is older than that is forgotten. An event behind the clock, or
    without a time that parses, is compared with the stored events of its own day alone (a
    repeat carries its event's time), so no trigger reads the history. Events without an id go
    to the reject log at ``rejects`` (default: ``root`` with ``_rejected``). A replayed epoch replaces its rows.
    """
    staged, clock = f"{root}_staged", f"{root}_clock"

    def apply(micro: DataFrame, epoch: int) -> None:
        spark = micro.sparkSession
        seen = None
        if epoch and sinks.exists(spark, f"{clock}/epoch={epoch - 1}"):
            seen = spark.read.parquet(f"{clock}/epoch={epoch - 1}").first()["seen"]
        time = F.col("event_timestamp").try_cast("timestamp")
        rows = settle(keyed_events(micro, epoch, rejects or f"{root}_rejected", "production_events", at).withColumn("event_date", time.cast("date")), "micro")
        latest = rows.agg(F.max(time)).first()[0]
        after = max((t for t in (seen, latest) if t is not None), default=None)
        spark.createDataFrame([(after,)], "seen timestamp").coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{clock}/epoch={epoch}")
        limit = F.lit(seen) - F.expr(f"INTERVAL {delay}") if seen is not None else F.lit(None)
        on_time = time.isNotNull() & F.coalesce(time >= limit, F.lit(seen is None))
        fresh = rows.where(on_time).withColumns({"clock": F.lit(after).cast("timestamp"), "epoch": F.lit(epoch).cast("bigint")})
        sinks.overwrite_partitions(fresh, staged, ["event_date", "epoch"])
        late = latest_per_key(rows.where(~on_time), ["event_id"], [])
        if not late.isEmpty():
            own = -1 - epoch  # late rows lie beside the stream's, under epochs of their own
            for path, other in ((root, F.col("epoch") != own), (staged, F.lit(True))):
                if sinks.exists(spark, path):
                    late = late.join(_of_days(spark.read.parquet(path).where(other), late).select("event_id"), "event_id", "left_anti")
            sinks.overwrite_partitions(late.withColumn("epoch", F.lit(own).cast("bigint")), root, ["event_date", "epoch"])

    def store(micro: DataFrame, epoch: int) -> None:
        if not micro.isEmpty():
            sinks.overwrite_partitions(micro.drop("clock").withColumn("epoch", F.lit(epoch).cast("bigint")), root, ["event_date", "epoch"])

    spark = _by_changes(events.sparkSession)
    events.writeStream.foreachBatch(apply).option("checkpointLocation", f"{checkpoint}/clock").trigger(availableNow=True).start().awaitTermination()
    schema = T.StructType([*events.schema.fields, T.StructField("clock", T.TimestampType()), T.StructField("event_date", T.DateType()),
                           T.StructField("epoch", T.LongType())])
    if not sinks.exists(spark, staged):  # nothing on time yet
        spark.createDataFrame([], schema).write.partitionBy("event_date", "epoch").parquet(staged)
    once = (spark.readStream.schema(schema).parquet(staged).withWatermark("clock", delay).dropDuplicatesWithinWatermark(["event_id"]))
    return once.writeStream.foreachBatch(store).option("checkpointLocation", f"{checkpoint}/unique").trigger(availableNow=True).start()


def _of_days(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored rows of the days that ``rows`` name: a list of days prunes the partitions before anything is read."""
    days = [r[0] for r in rows.select("event_date").distinct().collect()]
    found = F.col("event_date").isin([d for d in days if d is not None])
    return stored.where(found | F.col("event_date").isNull() if None in days else found)


def daily_stoppages(events: DataFrame) -> DataFrame:
    """Unplanned stoppages per line and day as tumbling windows.

    No watermark: the state is one counter per line and day, and a late event still counts.
    """
    down = typed_time(events).where("event_type = 'DOWNTIME_UNPLANNED'")
    return (down.groupBy(F.window("event_timestamp", "1 day").alias("w"), "production_line_id")
            .agg(F.count("*").alias("stoppages"))
            .select(F.to_date("w.start").alias("event_date"), "production_line_id", "stoppages"))


def keep_updates(rows: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Store changed aggregate rows per epoch, so open windows are visible at once."""

    def apply(micro: DataFrame, epoch: int) -> None:
        if not micro.isEmpty():
            sinks.append_epoch(micro, root, epoch)

    return (rows.writeStream.outputMode("update").foreachBatch(apply)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def store_events(events: DataFrame, raw_path: str, checkpoint: str, at: str | None = None) -> None:
    """Store new events by epoch, those without an id in the reject log beside; nothing stored is read.

    Returns when all available events are stored. A replayed micro-batch overwrites its own partitions.
    """

    def apply(micro: DataFrame, epoch: int) -> None:
        rows = keyed_events(micro, epoch, f"{raw_path}_rejected", "production_batches", at)
        sinks.overwrite_partitions(bucketed(rows, "batch_id").withColumn("epoch", F.lit(epoch)), raw_path, [BUCKET, "epoch"])

    (events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
     .awaitTermination())


def folded_batches(spark: SparkSession, schema: T.StructType, raw_path: str) -> DataFrame:
    """The stream of batches that newly stored events touch, each with all its events folded into keyed state.

    The state holds one folded row a batch and never expires: an end nine days after its
    start, or a check a year late, meets what the batch's other events left. Repeats change nothing.
    """
    stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField("epoch", T.IntegerType())])
    return conform.fold_batches(spark.readStream.schema(stored).parquet(raw_path))


def bucketed(rows: DataFrame, key: str) -> DataFrame:
    """Rows with the storage bucket of their key; NULL keys share one."""
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))


def compact_events(spark: SparkSession, root: str, before_epoch: int) -> int:
    """Fold all epochs below ``before_epoch`` into one, bucket by bucket; returns the rows rewritten.

    The folded rows are written first under the highest folded epoch; the emptied epochs go
    last, and readers drop what they would see twice in between by its event id.
    """
    old = spark.read.parquet(root).where(F.col("epoch") < before_epoch)
    into = old.agg(F.max("epoch")).first()[0]
    if into is None:
        return 0
    folded = settle(latest_per_key(old, ["event_id"], ["epoch"]).withColumn("epoch", F.lit(into)).repartition(BUCKET), "compact")
    rows = sinks.overwrite_partitions(folded, root, [BUCKET, "epoch"])
    sinks.drop_partitions(spark, root, old.where(F.col("epoch") != into).select(BUCKET, "epoch").distinct())
    return rows


def upsert_batches(events: DataFrame, raw_path: str, table_root: str, checkpoint: str) -> StreamingQuery:
    """Assemble batches as their events arrive; read the table with ``sinks.latest_rows``."""
    return _upsert_folded(events, raw_path, table_root, checkpoint, lambda batches: batches)


def upsert_yield(events: DataFrame, products: DataFrame, raw_path: str, kpi_root: str,
                 checkpoint: str) -> StreamingQuery:
    """Yield KPI of every batch a micro-batch touched, keyed by batch."""
    return _upsert_folded(events, raw_path, kpi_root, checkpoint, lambda batches: kpi_production.batch_yield(batches, products))


def _upsert_folded(events: DataFrame, raw_path: str, root: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    def apply(micro: DataFrame, epoch: int) -> None:
        if not micro.isEmpty():
            sinks.append_epoch(shape(conform.finish_batches(micro)), root, epoch)

    spark = _by_changes(events.sparkSession)
    store_events(events, raw_path, f"{checkpoint}/events")
    if not sinks.exists(spark, raw_path):  # nothing delivered yet
        bucketed(spark.createDataFrame([], events.schema), "batch_id").withColumn("epoch", F.lit(0)).write.partitionBy(BUCKET, "epoch").parquet(raw_path)
    return (folded_batches(spark, events.schema, raw_path).writeStream.outputMode("update").foreachBatch(apply)
            .option("checkpointLocation", f"{checkpoint}/folds").trigger(availableNow=True).start())


def upsert_shipments(updates: DataFrame, table_root: str, checkpoint: str) -> StreamingQuery:
    """Late delivery dates replace the stored shipment, by its id."""

    def apply(micro: DataFrame, epoch: int) -> None:
        if not micro.isEmpty():
            sinks.append_epoch(micro, table_root, epoch)

    return (updates.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def sequence_gaps(landed: DataFrame, line: str, number: str) -> DataFrame:
    """Missing sequence numbers per line, as the row after each gap.

    Numbers are compared inside ranges of the sequence first, so one busy line does
    not sort in a single task; only the ends of each range meet again.
    """
    width = 1_000_000
    ranged = landed.select(line, number, F.floor(F.col(number) / width).alias("_range"))
    inner = Window.partitionBy(line, "_range").orderBy(number)
    marked = ranged.withColumn("_before", F.lag(number).over(inner))
    edge = marked.groupBy(line, "_range").agg(F.max(number).alias("_last"))
    ends = edge.withColumn("_prior_last", F.lag("_last").over(Window.partitionBy(line).orderBy("_range"))).drop("_last")
    joined = marked.join(ends, [line, "_range"])
    before = F.coalesce("_before", "_prior_last")
    return (joined.withColumn("previous_no", before)
            .where(F.col(number) - F.col("previous_no") > 1)
            .select(line, F.col(number), "previous_no",
                    (F.col(number) - F.col("previous_no") - 1).alias("missing")))
