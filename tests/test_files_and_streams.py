import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfline import contracts as c
from shelfline.plans import conform, jobs
from shelfline.sources import files, sinks
from shelfline.streaming import events as st


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_malformed_lines_are_captured(spark, tmp_path):
    path = write(tmp_path / "w" / "a.csv", "a,b\n1,2\n3,4,5\n6,7\n")
    captured = files.read_csv_capturing(spark, path, ["a", "b"])
    assert files.well_formed(captured).count() == 2
    bad = files.malformed(captured).collect()
    assert [r.raw_line for r in bad] == ["3,4,5"] and bad[0]._source_file.endswith("a.csv")


def test_malformed_json_is_captured(spark, tmp_path):
    path = write(tmp_path / "w" / "a.json", '{"a":"1"}\n{"a":\n{"a":"2"}\n')
    captured = files.read_ndjson_capturing(spark, path, c.text_schema("a"))
    assert files.well_formed(captured).count() == 2 and files.malformed(captured).count() == 1


def test_header_mismatch_halts_and_keeps_data(spark, tmp_path):
    good, bad = write(tmp_path / "g" / "a.csv", "a,b\n1,2\n"), write(tmp_path / "b" / "a.csv", "a,z\n1,2\n")
    root = str(tmp_path / "table")
    sinks.write_next(files.read_csv(spark, good, ["a", "b"], strict_header=True), root)
    with pytest.raises(Exception):
        sinks.write_next(files.read_csv(spark, bad, ["a", "b"], strict_header=True), root)
    assert sinks.versions(spark, root) == [1] and sinks.read_current(spark, root).count() == 1


def test_columns_by_name(spark, tmp_path):
    path = write(tmp_path / "n" / "a.csv", "b,a\n2,1\n")
    assert files.read_csv_by_name(spark, path, ["a", "b", "c"]).first() == ("1", "2", None)


def test_empty_delivery_keeps_data(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.write_if_any(spark.range(3), path)
    assert not sinks.write_if_any(spark.range(0), path)
    assert spark.read.parquet(path).count() == 3


def test_partition_upsert_moves_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string, d date")
    d = dt.date
    sinks.upsert_partitions(spark, path, rows((1, "a", d(2025, 1, 1)), (2, "b", d(2025, 1, 2)), (3, "c", d(2025, 1, 3))), ["k"], "d")
    sinks.upsert_partitions(spark, path, rows((2, "B", d(2025, 1, 1)), (4, "x", d(2025, 1, 4))), ["k"], "d")
    got = sorted((r.k, r.v, r.d) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a", d(2025, 1, 1)), (2, "B", d(2025, 1, 1)), (3, "c", d(2025, 1, 3)), (4, "x", d(2025, 1, 4))]
    sinks.upsert_partitions(spark, path, rows((3, "Z", d(2025, 1, 3))), ["k"], "d", update=[])
    assert spark.read.parquet(path).where("k = 3").first().v == "c"


EVENTS = [
    ("e1", "b1", "BATCH_START", "2025-01-01 00:00:00", "100", None, None), ("e2", "b1", "BATCH_END", "2025-01-01 08:00:00", "100", "95", "completed"),
    ("e3", "b1", "QC_CHECK", "2025-01-01 09:00:00", None, None, "FAIL"), ("e4", "b2", "BATCH_START", "2025-01-01 01:00:00", "50", None, None),
    ("e5", "b2", "BATCH_END", "2025-01-01 07:00:00", "50", "50", "completed"), ("e6", "b2", "QC_CHECK", "2025-01-01 07:30:00", None, None, "PASS")]


def as_json(rows):
    names = ("event_id", "batch_id", "event_type", "event_timestamp", "expected_output_cases", "actual_output_cases", "qc_status")
    return "".join(json.dumps({k: v for k, v in zip(names, r) if v is not None}) + "\n" for r in rows)


def test_stream_equals_batch_with_late_events(spark, tmp_path):
    drop, raw, table, ckpt = (str(tmp_path / n) for n in ("drop", "raw", "table", "ckpt"))
    for i, part in enumerate((EVENTS[:1] + EVENTS[3:5], EVENTS[1:3] + EVENTS[4:])):
        write(tmp_path / "drop" / f"{i}.json", as_json(part))
        st.upsert_batches(st.read_events(spark, drop), raw, table, ckpt).awaitTermination()
    cols = ["batch_id", "yield_rate_pct", "qc_status", "batch_date", "end_events"]
    got = sorted(map(tuple, sinks.latest_rows(spark, table, ["batch_id"]).select(cols).collect()))
    everything = files.read_ndjson(spark, drop, c.EVENT_SCHEMA).dropDuplicates(["event_id"])
    want = sorted(map(tuple, conform.conform_batches(everything).select(cols).collect()))
    assert got == want and [g[2] for g in got] == ["FAIL", "PASS"]


def test_restart_adds_nothing(spark, tmp_path):
    write(tmp_path / "drop" / "0.json", as_json(EVENTS))
    for _ in range(2):
        st.land(st.read_events(spark, str(tmp_path / "drop")), str(tmp_path / "raw"), str(tmp_path / "ck"), "b", "drop").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw")).count() == len(EVENTS)


def test_sequence_gaps_cross_ranges(spark):
    numbers = [1, 2, 5, 999_999, 1_000_001, 1_000_002, 3_000_000]
    df = spark.createDataFrame([("L", n) for n in numbers], "line string, no bigint")
    got = sorted((r.no, r.previous_no, r.missing) for r in st.sequence_gaps(df, "line", "no").collect())
    assert got == [(b, a, b - a - 1) for a, b in zip(numbers, numbers[1:]) if b - a > 1]


def test_layers_end_to_end(spark, tmp_path):
    src = tmp_path / "src"
    write(src / "erp/products.csv", ",".join(c.LANDING["products"]) + "\ns1,Cola,Soft,Sub,3.50,1.50,330,365,2025-01-01,true\n")
    write(src / "erp/customers.csv", ",".join(c.LANDING["customers"]) + "\nr1,Shop,Grocery,West,Retail,CA,30,2025-01-01,ACTIVE\n")
    write(src / "erp/warehouses.csv", ",".join(c.LANDING["warehouses"]) + "\nw1,Main,West,100,Street,Boss\n")
    write(src / "erp/orders.csv", ",".join(c.LANDING["orders"]) + "\no1,r1,2025-03-01,2025-03-02,2025-03-05,done,7.00\n")
    write(src / "erp/order_lines.csv", ",".join(c.LANDING["order_lines"]) + "\nl1,o1,s1,2,3.50,0,7.00\n")
    write(src / "erp/inventory_daily.csv", ",".join(c.LANDING["inventory_daily"]) + "\n2025-03-01,w1,s1,300,400,70\n")
    write(src / "logistics/shipments.csv", ",".join(c.LANDING["shipments"]) + "\nh1,o1,w1,cr,2025-03-02,2025-03-05,2025-03-04,2,9.00,done\n")
    write(src / "pos/pos_transactions.json", json.dumps({"transaction_id": "t1", "store_id": "x", "customer_id": "r1", "timestamp": "2025-03-01T10:00:00",
          "items": [{"sku_id": "s1", "qty": "10", "price": "3.50", "discount": "0"}], "payment_method": "cash", "total": "35"}) + "\n")
    write(src / "production/batches.json", json.dumps({"batch_id": "b1", "sku_id": "s1", "production_line": "L1", "start_time": "2025-03-01T00:00:00",
          "end_time": "2025-03-01T08:00:00", "target_quantity": "100", "actual_quantity": "96", "status": "completed"}) + "\n")
    write(src / "production/quality_checks.json", json.dumps({"check_id": "q1", "batch_id": "b1", "result": "PASS", "timestamp": "2025-03-01T09:00:00"}) + "\n")
    write(src / "production/downtime_events.json", json.dumps({"event_id": "d1", "production_line": "L1", "start_time": "2025-03-01T07:00:00",
          "end_time": "2025-03-01T09:00:00", "category": "BREAKDOWN"}) + "\n")
    config = c.lake_config(str(src), str(tmp_path / "lake"))
    counts = jobs.run_all(spark, config, "load-1", "2025-03-02 06:00:00")
    assert counts["iot_sensor_events"] == 4 and counts["fact_sales"] == 1
    gold = config["tables"]["gold"]
    revenue = spark.read.parquet(gold["kpi_daily_revenue"]).first()
    assert (str(revenue.total_revenue), revenue.region, str(revenue.gross_margin_pct)) == ("35.00", "West", "57.14")
    made = spark.read.parquet(gold["kpi_prod_yield"]).first()
    assert (str(made.avg_yield_rate_pct), str(made.total_downtime_hours)) == ("96.00", "1.00")
    moved = spark.read.parquet(gold["kpi_fulfillment"]).first()
    assert (moved.channel, str(moved.on_time_delivery_pct)) == ("Retail", "100.00")
    # A second run of the conformed sales job changes no row count.
    jobs.run_sales(spark, config, "2025-03-03 06:00:00", "load-1", "load-1")
    sales = spark.read.parquet(config["tables"]["silver"]["sales_transactions"])
    assert sales.count() == 1 and sales.select(F.date_format("updated_at", "yyyy-MM-dd")).first()[0] == "2025-03-03"
    # Rebuilding only the current month leaves the same KPI rows.
    before = sorted(map(str, spark.read.parquet(gold["kpi_daily_revenue"]).collect()))
    jobs.run_gold(spark, config, since="2025-03-01")
    assert sorted(map(str, spark.read.parquet(gold["kpi_daily_revenue"]).collect())) == before


def test_stream_equals_batch_across_any_gap(spark, tmp_path):
    """A start nine days before its end, and a stamp that does not parse."""
    rows = [("e1", "b1", "BATCH_START", "2025-01-01 00:00:00", "100", None, None), ("e7", "b3", "BATCH_START", "sometime", "10", None, None),
            ("e2", "b1", "BATCH_END", "2025-01-10 08:00:00", "100", "95", "completed"), ("e8", "b3", "BATCH_END", "2025-01-10 09:00:00", "10", "10", "completed")]
    drop, raw, table, ckpt = (str(tmp_path / n) for n in ("drop", "raw", "table", "ckpt"))
    for i, part in enumerate((rows[:2], rows[2:])):
        write(tmp_path / "drop" / f"{i}.json", as_json(part))
        st.upsert_batches(st.read_events(spark, drop), raw, table, ckpt).awaitTermination()
    cols = ["batch_id", "batch_start_ts", "batch_date", "yield_rate_pct", "end_events"]
    got = sorted(map(str, sinks.latest_rows(spark, table, ["batch_id"]).select(cols).collect()))
    want = sorted(map(str, conform.conform_batches(files.read_ndjson(spark, drop, c.EVENT_SCHEMA)).select(cols).collect()))
    assert got == want and "2025, 1, 1" in got[0]
    before = sorted(map(str, spark.read.parquet(raw).drop("epoch").collect()))
    assert st.compact_events(spark, raw, 100) == 4
    assert sorted(map(str, spark.read.parquet(raw).drop("epoch").collect())) == before
    assert spark.read.parquet(raw).select("epoch").distinct().count() == 1


def test_late_events_are_stored_once(spark, tmp_path):
    drop, root, ckpt = (str(tmp_path / n) for n in ("drop", "once", "ckpt"))
    late = ("e0", "b0", "QC_CHECK", "2024-01-01 00:00:00", None, None, "PASS")
    for i, part in enumerate((EVENTS[:4], [late, EVENTS[0], EVENTS[0]] + EVENTS[4:])):
        write(tmp_path / "drop" / f"{i}.json", as_json(part))
        st.append_unseen_events(st.read_events(spark, drop), root, ckpt).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(root).select("event_id").collect()) == ["e0", "e1", "e2", "e3", "e4", "e5", "e6"]


def test_landed_ndjson_is_compressed(spark, sf_dir):
    from shelfline.queries.catalog import PLANS
    scanned = PLANS["src_02_ndjson_scan"](spark, sf_dir)
    assert scanned.count() > 0 and all(p.endswith(".json.gz") for p in scanned.inputFiles())
