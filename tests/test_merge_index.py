"""Merges by key index: which files are opened, rows that move, broken-off merges; months that follow from a change."""

import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from shelfline import contracts as c
from shelfline.plans import changes, jobs
from shelfline.sources import key_index, sinks

D = dt.date
FIRST = "DATE '2020-01-01'"


def table(spark, rows, parts):
    return spark.range(rows).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"),
                                    F.date_add(F.expr(FIRST), (F.col("id") % parts).cast("int")).alias("d"))


def test_a_merge_opens_only_partitions_that_may_hold_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert_partitions(spark, path, table(spark, 20_000, 1000).repartition(8, "d"), ["k"], "d")
    source = spark.createDataFrame([(k, "new", D(2020, 1, 1)) for k in range(5, 55, 5)], "k bigint, v string, d date")
    maybe = {str(r.d) for r in key_index.parts_that_may_hold(spark, path, source, ["k"], "d").collect()}
    held = {str(D(2020, 1, 1) + dt.timedelta(days=k % 1000)) for k in range(5, 55, 5)}
    assert held <= maybe and len(maybe) < 400
    opened = maybe | {"2020-01-01"}
    spoiled = 0
    for part in pathlib.Path(path).glob("d=*"):
        if part.name[2:] not in opened:
            for f in [*part.glob("*.parquet"), *part.glob(".*.crc")]:
                f.unlink() if f.suffix == ".crc" else f.write_bytes(b"not parquet")  # opening it would fail
            spoiled += 1
    assert spoiled > 600
    sinks.upsert_partitions(spark, path, source, ["k"], "d")
    got = spark.read.parquet(*[f"{path}/d={d}" for d in opened if (pathlib.Path(path) / f"d={d}").exists()])
    assert got.where("v = 'new'").count() == 10 and got.where("k IN (5, 10, 50)").count() == 3


def test_moves_nulls_and_an_old_table_without_index(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, 300, 30).write.partitionBy("d").parquet(path)  # written before there was an index
    moved = spark.createDataFrame([(7, "moved", D(2021, 5, 5)), (8, "gone", None), (900, "new", D(2020, 1, 3))], "k bigint, v string, d date")
    sinks.upsert_partitions(spark, path, moved, ["k"], "d")
    sinks.upsert_partitions(spark, path, spark.createDataFrame([(8, "back", D(2020, 1, 2))], "k bigint, v string, d date"), ["k"], "d")
    got = {r.k: (r.v, r.d) for r in spark.read.parquet(path).collect()}
    assert len(got) == 301 == spark.read.parquet(path).count()
    assert got[7] == ("moved", D(2021, 5, 5)) and got[8] == ("back", D(2020, 1, 2)) and got[900] == ("new", D(2020, 1, 3))


def test_a_merge_that_broke_off_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.upsert_partitions(spark, path, table(spark, 3, 3), ["k"], "d")
    move = spark.createDataFrame([(2, "moved", D(2020, 1, 1))], "k bigint, v string, d date")

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(sinks, "drop_partitions", stop)
        with pytest.raises(RuntimeError):
            sinks.upsert_partitions(spark, path, move, ["k"], "d")
    assert spark.read.parquet(path).where("k = 2").count() == 2  # between overwrite and delete
    sinks.upsert_partitions(spark, path, spark.createDataFrame([(9, "x", D(2020, 1, 9))], "k bigint, v string, d date"), ["k"], "d")
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(0, "v0"), (1, "v1"), (2, "moved"), (9, "x")]
    assert len(sinks.change_ids(spark, path)) == 3


def test_false_positives_only_cost_time(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.upsert_partitions(spark, path, table(spark, 60, 6), ["k"], "d")
    monkeypatch.setattr(key_index, "parts_that_may_hold", lambda spark, path, source, keys, by: spark.read.parquet(path).select(by).distinct())
    before = {p: p.stat().st_mtime_ns for p in pathlib.Path(path).glob("d=*/*.parquet")}
    sinks.upsert_partitions(spark, path, spark.createDataFrame([(3, "n", D(2020, 1, 4))], "k bigint, v string, d date"), ["k"], "d")
    after = {p: p.stat().st_mtime_ns for p in pathlib.Path(path).glob("d=*/*.parquet")}
    assert {p.parent.name for p in set(before) ^ set(after)} == {"d=2020-01-04"} and spark.read.parquet(path).count() == 60


def test_months_reached():
    span = changes.months_reached([D(2025, 3, 1), None], -6, 0)
    assert span.months == {(2025, 2), (2025, 3), None} and span.since is None
    assert changes.months_reached([D(2025, 3, 20), D(2024, 12, 2)], -6, None).since == D(2024, 11, 1)
    assert not changes.months_reached([]) and changes.months_reached([D(2025, 12, 31)], 0, 1).months == {(2025, 12), (2026, 1)}


def feed(root, name, header, *rows):
    path = root / "src" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(",".join(header) + "\n" + "".join(f"{r}\n" for r in rows))


def receipts(root, *rows):
    path = root / "src/pos/pos_transactions.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps({"transaction_id": t, "store_id": "x", "customer_id": "r1", "timestamp": f"{d}T10:00:00", "payment_method": "cash", "total": "1",
                                        "items": [{"sku_id": "s1", "qty": str(q), "price": "3.50", "discount": "0"}]}) + "\n" for t, d, q in rows))


def lines(root, name, *rows):
    path = root / "src/production" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def files_of(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in pathlib.Path(root).rglob("*.parquet")}


def test_a_late_row_changes_its_months_alone(spark, tmp_path):
    config = c.lake_config(str(tmp_path / "src"), str(tmp_path / "lake"))
    feed(tmp_path, "erp/products.csv", c.LANDING["products"], "s1,Cola,Soft,Sub,3.50,1.50,330,365,2024-01-01,true")
    feed(tmp_path, "erp/customers.csv", c.LANDING["customers"], "r1,Shop,Grocery,West,Retail,CA,30,2024-01-01,ACTIVE")
    feed(tmp_path, "erp/warehouses.csv", c.LANDING["warehouses"], "w1,Main,West,100,Street,Boss")
    feed(tmp_path, "erp/orders.csv", c.LANDING["orders"], "o1,r1,2025-03-01,2025-03-02,2025-03-05,done,7.00")
    feed(tmp_path, "erp/order_lines.csv", c.LANDING["order_lines"], "l1,o1,s1,2,3.50,0,7.00")
    feed(tmp_path, "erp/inventory_daily.csv", c.LANDING["inventory_daily"], "2025-03-01,w1,s1,300,400,70")
    feed(tmp_path, "logistics/shipments.csv", c.LANDING["shipments"], "h1,o1,w1,cr,2025-03-02,2025-03-05,2025-03-04,2,9.00,done")
    receipts(tmp_path, ("t1", "2025-03-01", 10), ("t2", "2024-06-10", 1), ("t3", "2024-01-15", 2))
    batch = {"sku_id": "s1", "production_line": "L1", "target_quantity": "100", "actual_quantity": "96", "status": "completed"}
    lines(tmp_path, "batches.json", {"batch_id": "b1", "start_time": "2025-03-01T00:00:00", "end_time": "2025-03-01T08:00:00", **batch})
    lines(tmp_path, "quality_checks.json", {"check_id": "q1", "batch_id": "b1", "result": "PASS", "timestamp": "2025-03-01T09:00:00"})
    lines(tmp_path, "downtime_events.json", {"event_id": "d1", "production_line": "L1", "start_time": "2025-03-01T07:00:00", "end_time": "2025-03-01T09:00:00", "category": "BREAKDOWN"})
    jobs.run_all(spark, config, "load-1", "2025-03-02 06:00:00")
    gold = config["tables"]["gold"]
    revenue = lambda: {str(r.report_date): str(r.total_revenue) for r in spark.read.parquet(gold["kpi_daily_revenue"]).collect()}
    assert revenue() == {"2025-03-01": "35.00", "2024-06-10": "3.50", "2024-01-15": "7.00"}
    before = files_of(tmp_path / "lake/gold")

    # A receipt of fourteen months ago and a return of last June's receipt arrive.
    receipts(tmp_path, ("t4", "2024-01-20", 3))
    feed(tmp_path, "erp/returns.csv", c.LANDING["returns"], "q1,t2,,r1,s1,1,3.50,2025-03-02,DAMAGED")
    from shelfline.plans import ingest

    ingest.ingest_pos_transactions(spark, config, "load-2")
    ingest.ingest_returns(spark, config, "load-2")
    jobs.run_sales(spark, config, "2025-03-03 06:00:00", "load-2", "load-2")
    jobs.run_returns(spark, config, "2025-03-03 06:00:00", "load-2", "load-2")
    jobs.run_changed(spark, config, "2025-03-03 06:00:00")
    after = files_of(tmp_path / "lake/gold")
    touched = {"/".join(p.split("/")[:-1]) for p, _ in set(before.items()) ^ set(after.items())}
    moved = {t for t in touched if not t.startswith("dim_")}
    of_the_day = ("sales_period_comparison", "inventory_stock_levels", "inventory_turnover", "inventory_dsi", "production_traceability", "customers_")
    dated = {t for t in moved if not any(f"kpi/{n}" in t for n in of_the_day)}
    assert dated == {
        "fact_sales/transaction_date=2024-01-15", "fact_sales/transaction_date=2024-01-20", "fact_sales_lines/transaction_date=2024-01-15",
        "fact_sales_lines/transaction_date=2024-01-20", "fact_sales_lines/transaction_date=2024-06-10", "kpi_daily_revenue/report_month=2024-01",
        "kpi/sales_daily_revenue/report_month=2024-01", "kpi/sales_daily_revenue/report_month=2024-06", "kpi/sales_gross_margin_sku/report_month=2024-01",
        "kpi/sales_gross_margin_sku/report_month=2024-06"} | {t for t in dated if t.startswith("kpi_inv_turnover/report_month=2024")}
    assert revenue()["2024-01-20"] == "10.50"
    fact = {r.transaction_id: r for r in spark.read.parquet(gold["fact_sales_lines"]).collect()}
    assert str(fact["t2"].return_amount) == "3.5000" and str(fact["t2"].net_revenue) == "0.0000" and fact["t1"].return_amount == 0
    assert fact["t1"].quantity_sold == 10 and fact["t1"].warehouse_key is None
    daily = {str(r.report_date): str(r.net_revenue) for r in spark.read.parquet(f"{gold['kpi']}/sales_daily_revenue").collect()}
    assert daily == {"2025-03-01": "35.0000", "2024-06-10": "0.0000", "2024-01-15": "7.0000", "2024-01-20": "10.5000"}
    assert all(not sinks.change_ids(spark, config["tables"]["silver"][t]) for t in jobs.FOLLOWED)

    # A receipt dated wrongly moves out of its month: the month it leaves loses its partitions.
    sales = spark.read.parquet(config["tables"]["silver"]["sales_transactions"]).where("transaction_id IN ('t3', 't4')")
    sinks.upsert_partitions(spark, config["tables"]["silver"]["sales_transactions"], sales.withColumn("transaction_date", F.lit(D(2024, 2, 1))), ["transaction_key"], "transaction_date")
    jobs.run_changed(spark, config, "2025-03-03 06:00:00")
    assert set(revenue()) == {"2025-03-01", "2024-06-10", "2024-02-01"}
    assert {str(r.transaction_date) for r in spark.read.parquet(gold["fact_sales"]).select("transaction_date").distinct().collect()} == set(revenue())
    assert not (tmp_path / "lake/gold/kpi/sales_daily_revenue/report_month=2024-01").exists()
