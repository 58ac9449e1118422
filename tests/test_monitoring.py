"""Metrics observed on writes and streams: one action a table, breaches without a batch query, runs done again."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from shelfline import contracts as c
from shelfline.operators import quality as q
from shelfline.plans import gate
from shelfline.streaming import events as st
from shelfline.streaming import monitor


def test_a_run_done_again_replaces_its_log(spark, tmp_path):
    lake = c.lake_config(str(tmp_path / "src"), str(tmp_path / "lake"))
    silver = lake["tables"]["silver"]
    rows = spark.range(100).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), F.lit("x").alias("v"))
    shape = lambda df: df.withColumn("n", F.col("k") % 50)
    for _ in range(2):
        out = gate.admit(lake, rows, (q.not_null(["k"]),), shape, (q.in_range("n", 1, None, "error"),), "feed", "things", "2025-01-02 00:00:00", "r1")
        assert out.count() == 97
    gate.admit(lake, rows, (q.not_null(["k"]),), None, (), "feed", "things", "2025-01-03 00:00:00", "r2")
    runs = sorted((r.run_id, r.rows_read, r.rows_rejected) for r in spark.read.parquet(silver["pipeline_monitoring"]).collect())
    assert runs == [("r1", 100, 3), ("r2", 100, 1)]
    log = [r.pipeline_run_id for r in spark.read.parquet(silver["dq_rejected_records"]).collect()]
    assert sorted(log) == ["r1", "r1", "r1", "r2"]
    with pytest.raises(ValueError, match="DQ halt"):
        gate.admit(lake, rows.limit(8), (q.not_null(["k"]),), None, (), "feed", "things", "2025-01-03 00:00:00", "r3")


def test_a_streams_breach_appears_by_itself(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    rows = [{"event_id": f"e{i}", "event_timestamp": "2025-01-01 08:00:00"} for i in range(9)] + [{"event_timestamp": "2025-01-01 07:00:00"}]
    (tmp_path / "drop" / "0.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    watch = monitor.Watch(reject_pct=5, stale_minutes=15, as_of=dt.datetime(2025, 1, 1, 9, 0))
    spark.streams.addListener(watch)
    try:
        st.land(monitor.observed(st.read_events(spark, str(tmp_path / "drop"))), str(tmp_path / "raw"), str(tmp_path / "ck"), "b", "drop").awaitTermination()
        for _ in range(50):
            if watch.rows:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(watch)
    assert watch.rows == 10
    assert {(b.kind, round(b.value), b.limit) for b in watch.found} == {("REJECTS", 10, 5), ("STALE", 60, 15)}
