"""Structured Streaming over event files derived from the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.contracts import EVENT_COLUMNS
from shelfline.operators import profile
from shelfline.plans import ingest
from shelfline.queries.frames import EVENTS_NOW, Frames
from shelfline.queries.registry import query
from shelfline.session import work_dir
from shelfline.sources import sinks
from shelfline.streaming import events as st


def event_texts(f: Frames, where: str = "true") -> DataFrame:
    """Plant events as they arrive from the sensors: text only."""
    return ingest.align(f.plant_events.where(where), EVENT_COLUMNS)


class Landing:
    """Folders of one streaming run."""

    def __init__(self, f: Frames, label: str):
        self.spark, self.root = f.spark, work_dir(f.spark, label)
        self.drop = f"{self.root}/drop"

    def deliver(self, rows: DataFrame) -> None:
        rows.write.mode("append").json(self.drop)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stream(self) -> DataFrame:
        return st.read_events(self.spark, self.drop)


def _land(run: Landing) -> None:
    st.land(run.stream(), run.path("raw"), run.path("ckpt_raw"), "stream-1", "drop",
            ingested_at="2024-01-31 00:00:00").awaitTermination()


_BY_TYPE = "SELECT event_type, count(*) AS events FROM plant_events GROUP BY 1"


@query("str_01_event_microbatch", _BY_TYPE)
def event_microbatch(f: Frames):
    run = Landing(f, "micro")
    run.deliver(event_texts(f))
    _land(run)
    return f.spark.read.parquet(run.path("raw")).groupBy("event_type").agg(F.count("*").alias("events"))


@query("src_06_incremental_discovery", """
SELECT event_no % 2 = 0 AS first_drop, count(*) AS events FROM plant_events GROUP BY 1""")
def incremental_discovery(f: Frames):
    """Two deliveries, two triggers: every file is read exactly once."""
    run = Landing(f, "discover")
    for part in ("event_no % 2 = 0", "event_no % 2 <> 0"):
        run.deliver(event_texts(f, part))
        _land(run)
    number = F.substring("event_id", 4, 20).cast("bigint")
    return f.spark.read.parquet(run.path("raw")).groupBy((number % 2 == 0).alias("first_drop")).agg(F.count("*").alias("events"))


@query("str_02_resume_from_checkpoint", "SELECT count(*) AS events, count(DISTINCT event_id) AS distinct_events FROM plant_events")
def resume(f: Frames):
    run = Landing(f, "resume")
    run.deliver(event_texts(f, "event_no % 5 <> 0"))
    _land(run)
    _land(run)  # nothing new: a restart must not repeat rows
    run.deliver(event_texts(f, "event_no % 5 = 0"))
    _land(run)
    return f.spark.read.parquet(run.path("raw")).agg(
        F.count("*").alias("events"), F.count_distinct("event_id").alias("distinct_events"))


@query("str_03_raw_append_with_metadata", """
SELECT 'stream-1' AS _batch_id, 'drop' AS _source_file, DATE '2024-01-31' AS ingestion_date, count(*) AS events FROM plant_events""")
def raw_append(f: Frames):
    run = Landing(f, "append")
    run.deliver(event_texts(f))
    _land(run)
    return f.spark.read.parquet(run.path("raw")).groupBy("_batch_id", "_source_file", "ingestion_date").agg(F.count("*").alias("events"))


@query("str_04_event_dedup", _BY_TYPE)
def event_dedup(f: Frames):
    run = Landing(f, "dedup")
    texts = event_texts(f)
    late = "event_no % 7 = 0"  # first seen, and repeated, long after the rest
    for rows in (texts.where("event_type = 'QC_CHECK'").unionByName(event_texts(f, f"NOT ({late})")), texts):
        run.deliver(rows)
        st.append_unseen_events(run.stream(), run.path("unique"), run.path("ckpt")).awaitTermination()
    return f.spark.read.parquet(run.path("unique")).groupBy("event_type").agg(F.count("*").alias("events"))


_BATCH = ["batch_id", "production_line_id", "sku_id", "expected_output_cases", "actual_output_cases", "qc_status",
          "batch_date", "end_events", "yield_rate_pct", "qc_pass_flag"]


@query("str_05_batch_assembly", f"SELECT {', '.join(_BATCH)} FROM batches")
def batch_assembly(f: Frames):
    """Late ends and checks arrive in a second delivery; the table equals the batch plan."""
    run = Landing(f, "assembly")
    for part in ("event_no % 3 <> 0", "event_no % 3 = 0"):
        run.deliver(event_texts(f, part))
        st.upsert_batches(run.stream(), run.path("events"), run.path("batches"), run.path("ckpt")).awaitTermination()
    return sinks.latest_rows(f.spark, run.path("batches"), ["batch_id"]).select(*_BATCH)


_YIELD = ["batch_id", "production_line_id", "product_category", "yield_rate_pct", "qc_status", "yield_warn_flag", "yield_critical_flag"]


@query("str_06_yield_upsert", f"SELECT {', '.join(_YIELD)} FROM kpi_p01")
def yield_upsert(f: Frames):
    run = Landing(f, "yield")
    for part in ("event_no % 4 <> 1", "event_no % 4 = 1"):
        run.deliver(event_texts(f, part))
        st.upsert_yield(run.stream(), f.products, run.path("events"), run.path("yield"), run.path("ckpt")).awaitTermination()
    return sinks.latest_rows(f.spark, run.path("yield"), ["batch_id"]).select(*_YIELD)


@query("snk_09_microbatch_merge", "SELECT product_category, count(*) AS batches, count(*) FILTER (yield_warn_flag) AS warned FROM kpi_p01 GROUP BY 1")
def microbatch_merge(f: Frames):
    run = Landing(f, "merge")
    run.deliver(event_texts(f))
    st.upsert_yield(run.stream(), f.products, run.path("events"), run.path("yield"), run.path("ckpt")).awaitTermination()
    run.deliver(event_texts(f, "event_type = 'QC_CHECK'"))  # repeated checks change nothing
    st.upsert_yield(run.stream(), f.products, run.path("events"), run.path("yield"), run.path("ckpt")).awaitTermination()
    sinks.compact(f.spark, run.path("yield"), ["batch_id"], run.path("compact"))
    return sinks.read_current(f.spark, run.path("compact")).groupBy("product_category").agg(
        F.count("*").alias("batches"), F.count_if("yield_warn_flag").alias("warned"))


_SHIP_KEY = "shipment_id"


@query("str_07_late_delivery_update", """
SELECT channel, count(*) AS shipments, count(d) AS delivered FROM (SELECT channel, max(actual_delivery_date) AS d
FROM shipments GROUP BY shipment_id, channel) GROUP BY 1""")
def late_delivery(f: Frames):
    """Open shipments first, delivery dates in a later delivery."""
    run = Landing(f, "late")
    folded = f.shipments.groupBy("shipment_id", "channel").agg(F.max("actual_delivery_date").alias("actual_delivery_date"))
    opened = folded.withColumn("actual_delivery_date", F.lit(None).cast("date"))
    for rows in (opened, folded.where("actual_delivery_date IS NOT NULL")):
        rows.write.mode("append").parquet(run.drop)
        stream = f.spark.readStream.schema(folded.schema).parquet(run.drop)
        st.upsert_shipments(stream, run.path("table"), run.path("ckpt")).awaitTermination()
    return sinks.latest_rows(f.spark, run.path("table"), [_SHIP_KEY]).groupBy("channel").agg(
        F.count("*").alias("shipments"), F.count("actual_delivery_date").alias("delivered"))


@query("str_08_sequence_continuity", """
SELECT production_line_id, event_no, previous_no, event_no - previous_no - 1 AS missing FROM (
SELECT production_line_id, event_no, lag(event_no) OVER (PARTITION BY production_line_id ORDER BY event_no) AS previous_no FROM plant_events)
WHERE event_no - previous_no > 1""")
def sequence_continuity(f: Frames):
    return st.sequence_gaps(f.plant_events, "production_line_id", "event_no")


@query("str_09_empty_trigger", "SELECT count(*) AS events, 0 AS stored_by_empty_trigger FROM plant_events")
def empty_trigger(f: Frames):
    run = Landing(f, "empty")
    run.deliver(event_texts(f, "false"))
    st.upsert_batches(run.stream(), run.path("none"), run.path("nothing"), run.path("ckpt0")).awaitTermination()
    stored = int(sinks.exists(f.spark, run.path("nothing")))
    run.deliver(event_texts(f))
    _land(run)
    return f.spark.read.parquet(run.path("raw")).agg(F.count("*").alias("events")).withColumn(
        "stored_by_empty_trigger", F.lit(stored))


@query("str_10_windowed_stoppages", """
SELECT CAST(event_timestamp AS DATE) AS event_date, production_line_id, count(*) AS stoppages FROM plant_events
WHERE event_type = 'DOWNTIME_UNPLANNED' GROUP BY 1, 2""")
def windowed_stoppages(f: Frames):
    run = Landing(f, "window")
    for part in ("event_no % 5 <> 0", "event_no % 5 = 0"):  # the second delivery is days late
        run.deliver(event_texts(f, part))
        st.keep_updates(st.daily_stoppages(run.stream()), run.path("daily"), run.path("ckpt")).awaitTermination()
    return sinks.latest_rows(f.spark, run.path("daily"), ["event_date", "production_line_id"])


@query("str_11_freshness", f"""
SELECT table_name, breached FROM (
SELECT 'sales' AS table_name, (SELECT (epoch(TIMESTAMP '{EVENTS_NOW}') - epoch(max(transaction_date))) / 60 > 120 FROM sale_lines) AS breached UNION ALL
SELECT 'production', (SELECT (epoch(TIMESTAMP '{EVENTS_NOW}') - epoch(max(event_timestamp))) / 60 > 15 FROM plant_events))""")
def freshness(f: Frames):
    sales = profile.freshness(f.sale_lines.select(F.col("transaction_date").cast("timestamp").alias("t")), "sales", "t", EVENTS_NOW, 120)
    plant = profile.freshness(f.plant_events, "production", "event_timestamp", EVENTS_NOW, 15)
    return sales.unionByName(plant).select("table_name", "breached")
