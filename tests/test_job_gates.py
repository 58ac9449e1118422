"""Feeds by header name, captured lines, empty feeds, quarantine and halts of the jobs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfline import contracts as c
from shelfline.plans import ingest, jobs
from shelfline.sources import sinks

TS = "2025-03-02 06:00:00"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def lake(tmp_path):
    return c.lake_config(str(tmp_path / "src"), str(tmp_path / "lake"))


def stock(tmp_path, *rows, header="sku_id,warehouse_id,quantity_on_order,snapshot_date,quantity_on_hand,reorder_point,note"):
    write(tmp_path / "src/erp/inventory_daily.csv", header + "\n" + "".join(f"{r}\n" for r in rows))


def test_columns_are_taken_by_name_and_bad_lines_are_kept(spark, tmp_path, lake):
    stock(tmp_path, "s1,w1,5,2025-01-01,10,4,x", "s2,w1,5,2025-01-01,20,4,x,surplus", "s3,w1")
    assert ingest.ingest_inventory(spark, lake, "b1") == 1
    row = spark.read.parquet(lake["tables"]["bronze"]["erp_inventory"]).first()
    assert (row.sku_id, row.snapshot_date, row.units_on_hand) == ("s1", "2025-01-01", "10")
    bad = spark.read.parquet(lake["tables"]["bronze"]["malformed_lines"]).collect()
    assert sorted(r.raw_line for r in bad) == ["s2,w1,5,2025-01-01,20,4,x,surplus", "s3,w1"]
    assert all(r._source_file.endswith("inventory_daily.csv") and r.feed == "inventory_daily" for r in bad)


def test_missing_column_halts_and_empty_feed_writes_nothing(spark, tmp_path, lake):
    stock(tmp_path, "s1,w1", header="sku_id,warehouse_id")
    with pytest.raises(ValueError, match="header lacks"):
        ingest.ingest_inventory(spark, lake, "b1")
    stock(tmp_path)
    assert ingest.ingest_inventory(spark, lake, "b2") == 0
    assert not sinks.exists(spark, lake["tables"]["bronze"]["erp_inventory"])


def test_clean_and_rejected_make_the_input(spark, tmp_path, lake):
    silver = lake["tables"]["silver"]
    write(tmp_path / "src/erp/products.csv", ",".join(c.LANDING["products"]) + "\n" + "".join(f"s{i},Cola,Soft,Sub,3.50,1.50,330,365,2025-01-01,true\n" for i in range(200)))
    ingest.ingest_products(spark, lake, "b1")
    assert jobs.run_products(spark, lake, TS, "b1") == 200
    stock(tmp_path, *[f"s{i},w1,0,2025-01-01,{-1 if i == 7 else 10},4,x" for i in range(150)])
    ingest.ingest_inventory(spark, lake, "b1")
    assert jobs.run_inventory(spark, lake, TS, "b1", "b1") == 149
    log = spark.read.parquet(silver["dq_rejected_records"]).where("target_table = 'inventory_stock'").collect()
    assert len(log) == 1 and json.loads(log[0].raw_record_json)["sku_id"] == "s7"
    runs = {r.target_table: (r.rows_read, r.rows_rejected, r.pipeline_status) for r in spark.read.parquet(silver["pipeline_monitoring"]).collect()}
    assert runs["inventory_stock"] == (150, 1, "PARTIAL") and runs["products"][2] == "COMPLETED"
    # Above the table's own limit of one percent nothing is published.
    stock(tmp_path, *[f"s{i},w1,0,2025-01-02,{-1 if i < 3 else 10},4,x" for i in range(150)])
    ingest.ingest_inventory(spark, lake, "b2")
    with pytest.raises(ValueError, match="DQ halt"):
        jobs.run_inventory(spark, lake, TS, "b2", "b2")
    assert spark.read.parquet(silver["inventory_stock"]).where("snapshot_date = '2025-01-02'").count() == 0


def test_receipts_invoices_and_returns(spark, tmp_path, lake):
    silver = lake["tables"]["silver"]
    item = {"sku_id": "s1", "qty": "2", "price": "3.50", "discount": "0"}
    write(tmp_path / "src/pos/pos_transactions.json", json.dumps({"transaction_id": "t1", "store_id": "x", "customer_id": "r1", "timestamp": "2025-03-01T10:00:00",
          "items": [item, item, {**item, "sku_id": "s2"}], "payment_method": "cash", "total": "21"}) + "\nnot json\n")
    write(tmp_path / "src/erp/orders.csv", ",".join(c.LANDING["orders"]) + "\no1,r1,2025-03-01,2025-03-02,2025-03-05,done,7.00\n")
    write(tmp_path / "src/erp/order_lines.csv", ",".join(c.LANDING["order_lines"]) + "\nl1,o1,s1,2,3.50,0,7.00\n")
    write(tmp_path / "src/erp/returns.csv", ",".join(c.LANDING["returns"]) + "\nq1,t1,,r1,s1,1,3.50,2025-03-02,DAMAGED\nq2,t9,,r1,s1,1,3.50,2025-03-02,OTHER\n")
    for feed in (ingest.ingest_pos_transactions, ingest.ingest_erp_sales, ingest.ingest_returns):
        feed(spark, lake, "b1")
    assert spark.read.parquet(lake["tables"]["bronze"]["malformed_lines"]).count() == 1
    assert jobs.run_sales(spark, lake, TS, "b1", "b1") == 3  # a product named twice is two lines
    jobs.run_erp_sales(spark, lake, TS, "b1", "b1")
    got = spark.read.parquet(silver["sales_transactions"]).groupBy("source").agg(F.count("*").alias("n"), F.sum("net_line_amount").alias("s")).collect()
    assert {r.source: (r.n, float(r.s)) for r in got} == {"POS": (3, 21.0), "ERP": (1, 7.0)}
    assert jobs.run_returns(spark, lake, TS, "b1", "b1") == 2
    assert {r.return_id: r.is_orphan for r in spark.read.parquet(silver["sales_returns"]).collect()} == {"q1": False, "q2": True}


def test_spend_of_a_period(spark, tmp_path, lake):
    write(tmp_path / "src/erp/customers.csv", ",".join(c.LANDING["customers"]) + "\nr1,Shop,Grocery,West,Retail,CA,30,2025-01-01,ACTIVE\n")
    ingest.ingest_customers(spark, lake, "b1")
    assert jobs.run_spend(spark, lake, TS, "b1", ("2025-03-01", "2025-03-31"), "b1") == 1
    assert spark.read.parquet(lake["tables"]["silver"]["sales_spend"]).first().period_start_date == dt.date(2025, 3, 1)


def test_merge_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).select(F.col("id").alias("k"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("d"))
    sinks.upsert_partitions(spark, path, rows, ["k"], "d")
    current, touched = spark.read.parquet(path), rows.where("k = 3").select(F.col("d").alias("_by")).distinct()
    plan = current.join(touched.where("_by IS NOT NULL"), F.col("d") == F.col("_by"), "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    late = spark.createDataFrame([(3, None), (200, None)], "k bigint, d date")
    sinks.upsert_partitions(spark, path, late, ["k"], "d")
    sinks.upsert_partitions(spark, path, spark.createDataFrame([(200, dt.date(2025, 2, 1))], "k bigint, d date"), ["k"], "d")
    got = {r.k: r.d for r in spark.read.parquet(path).collect()}
    assert len(got) == 101 and got[3] is None and got[200] == dt.date(2025, 2, 1)
