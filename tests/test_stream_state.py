"""Stream state instead of history: what a trigger reads, where late, repeated and nameless events end up, restarts."""

import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from shelfline import contracts as c
from shelfline.plans import conform
from shelfline.sources import files, sinks
from shelfline.streaming import events as st

NAMES = ("event_id", "batch_id", "event_type", "event_timestamp", "expected_output_cases", "actual_output_cases", "qc_status")


@pytest.fixture
def drop(tmp_path):
    def deliver(name, *rows):
        (tmp_path / "drop").mkdir(exist_ok=True)
        lines = "".join(json.dumps({k: v for k, v in zip(NAMES, r) if v is not None}) + "\n" for r in rows)
        (tmp_path / "drop" / f"{name}.json").write_text(lines)

    deliver.path = str(tmp_path / "drop")
    return deliver


def event(i, day, batch="b1", kind="QC_CHECK", status="PASS", expected=None, actual=None):
    return (i, batch, kind, f"2025-{day} 08:00:00" if day else "sometime", expected, actual, status)


def unique(spark, drop, tmp_path):
    st.append_unseen_events(st.read_events(spark, drop.path), str(tmp_path / "once"), str(tmp_path / "ckpt")).awaitTermination()
    return sorted((r.event_id, str(r.event_date)) for r in spark.read.parquet(str(tmp_path / "once")).select("event_id", "event_date").collect())


def test_unique_events(spark, drop, tmp_path):
    drop("0", event("a", "01-01"), event("a", "01-01"), event("b", "01-02"), event(None, "01-02"), event(None, "01-02", "b9"))
    assert unique(spark, drop, tmp_path) == [("a", "2025-01-01"), ("b", "2025-01-02")]
    # A month on: repeats on time, repeats far behind the clock, first sights far behind it, times that do not parse.
    drop("1", event("b", "01-02"), event("c", "02-10"), event("c", "02-10"))
    drop("2", event("a", "01-01"), event("c", "02-10"), event("d", "01-05"), event("d", "01-05"), event("e", None), event("e", None))
    want = [("a", "2025-01-01"), ("b", "2025-01-02"), ("c", "2025-02-10"), ("d", "2025-01-05"), ("e", "None")]
    assert unique(spark, drop, tmp_path) == want
    drop("3", event("d", "01-05"), event("e", None), event("a", "01-01"), event("c", "02-10"), event(None, None))
    assert unique(spark, drop, tmp_path) == want
    assert unique(spark, drop, tmp_path) == want  # a restart with nothing new
    log = spark.read.parquet(str(tmp_path / "once_rejected"))
    assert sorted(json.loads(r.raw_record_json)["batch_id"] for r in log.collect()) == ["b1", "b1", "b9"]
    assert {r.rule_id for r in log.collect()} == {"EVT-ID"}


def test_triggers_on_time_read_no_history(spark, drop, tmp_path):
    """With all stored days gone, on-time events and their repeats still end up once."""
    drop("0", *[event(f"old{i}", f"01-0{1 + i % 5}") for i in range(50)])
    unique(spark, drop, tmp_path)
    for folder in ("once", "once_staged"):
        for day in (tmp_path / folder).glob("event_date=*"):
            shutil.rmtree(day)
    drop("1", event("old4", "01-05"), event("new", "01-06"))
    assert unique(spark, drop, tmp_path) == [("new", "2025-01-06")]


def test_state_forgets_what_cannot_return(spark, drop, tmp_path):
    rows = []
    for k in range(6):
        drop(str(k), *[event(f"k{k}-{i}", f"{1 + k:02d}-10") for i in range(20)])
        stream = st.append_unseen_events(st.read_events(spark, drop.path), str(tmp_path / "once"), str(tmp_path / "ckpt"))
        stream.awaitTermination()
        rows.append(max(s["numRowsTotal"] for p in stream.recentProgress for s in p["stateOperators"]))
        assert max(p["numInputRows"] for p in stream.recentProgress) == 20
    assert max(rows) <= 60 and spark.read.parquet(str(tmp_path / "once")).count() == 120


COLS = ["batch_id", "batch_start_ts", "batch_date", "expected_output_cases", "actual_output_cases", "yield_rate_pct", "qc_status", "qc_pass_flag", "end_events"]


def test_batches_from_state_alone(spark, drop, tmp_path):
    """Start, end nine days on, a check a year on; stored events are deleted between the triggers."""
    raw, table, ckpt = (str(tmp_path / n) for n in ("raw", "table", "ckpt"))
    parts = [
        [event("s1", "01-01", kind="BATCH_START", expected="100"), event("s2", "01-01", "b2", "BATCH_START", expected="10"), event(None, "01-01", "b3", "BATCH_END", expected="5", actual="5")],
        [event("e1", "01-10", kind="BATCH_END", status="completed", expected="100", actual="95"), event("q1", "01-11")],
        [event("e1", "01-10", kind="BATCH_END", status="completed", expected="100", actual="95"), event("e2", "01-02", "b2", "BATCH_END", None, "10", "7"),
         event("e3", "01-03", "b2", "BATCH_END", None, "10", "9"), event("d1", "01-03", None, "DOWNTIME_PLANNED")],
        [event("q2", "12-31", status="FAIL")]]
    for k, part in enumerate(parts):
        drop(str(k), *part)
        for _ in range(2):  # the second run finds nothing new
            st.upsert_batches(st.read_events(spark, drop.path), raw, table, ckpt).awaitTermination()
        for bucket in (tmp_path / "raw").glob("key_bucket=*"):
            shutil.rmtree(bucket)
    got = sorted(map(str, sinks.latest_rows(spark, table, ["batch_id"]).select(COLS).collect()))
    once = files.read_ndjson(spark, drop.path, c.EVENT_SCHEMA).where("event_id IS NOT NULL").dropDuplicates(["event_id"])
    assert got == sorted(map(str, conform.conform_batches(once).select(COLS).collect())) and len(got) == 2
    assert sorted(r.batch_id for r in spark.read.parquet(f"{raw}_rejected").select(F.get_json_object("raw_record_json", "$.batch_id").alias("batch_id")).collect()) == ["b3"]


def test_folded_batches_are_the_batch_plan(spark):
    rows = [(f"e{i}", f"b{i % 7}", ("BATCH_START", "BATCH_END", "QC_CHECK")[i % 3], str(dt.datetime(2025, 1, 1) + dt.timedelta(hours=i)), "50", str(40 + i % 20),
             ("PASS", "FAIL", None, "completed")[i % 4]) for i in range(90)]
    events = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES)).withColumns({n: F.lit(None).cast("string") for n in ("production_line_id", "sku_id")})
    twice = events.unionByName(events)
    got = conform.finish_batches(conform.fold_batches(twice)).select(COLS)
    assert sorted(map(str, got.collect())) == sorted(map(str, conform.conform_batches(events).select(COLS).collect()))
