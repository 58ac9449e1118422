import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from shelfline.plans import conform, facts, ingest

POS = ("transaction_id string, retailer_id string, sku_id string, quantity string, unit_price string, "
       "transaction_timestamp string, channel string, _ingested_at timestamp, _batch_id string")
T1, T2 = dt.datetime(2025, 10, 1, 12), dt.datetime(2025, 10, 1, 13)


def pos(spark, *rows):
    return spark.createDataFrame(list(rows), POS)


def test_casts_and_amount(spark):
    row = conform.cast_and_validate_sales_transactions(
        pos(spark, ("t1", "r1", "s1", "3", "4.50", "2025-10-01T10:00:00", "Retail", T1, "b")), "2025-10-02 00:00:00").first()
    assert row.quantity_sold == 3 and row.unit_price == D("4.50") and row.transaction_date == dt.date(2025, 10, 1)
    assert row.net_line_amount == D("13.50") and row.created_at == dt.datetime(2025, 10, 2)


def test_dirt_becomes_null(spark):
    row = conform.cast_and_validate_sales_transactions(
        pos(spark, ("t1", "r1", "s1", "abc", "99999999999.99", "never", "Retail", T1, "b"))).first()
    assert row.quantity_sold is None and row.unit_price is None and row.transaction_date is None


def test_latest_record_wins(spark):
    df = pos(spark, ("t1", "r", "s", "2", "1.00", "2025-10-01T10:00:00", "Retail", T1, "b"),
             ("t1", "r", "s", "5", "1.00", "2025-10-01T10:00:00", "Retail", T2, "b"))
    assert [r.quantity for r in conform.deduplicate_transactions(df).collect()] == ["5"]


def test_latest_record_is_limited_before_the_shuffle(spark):
    df = conform.deduplicate_transactions(pos(spark, ("t1", "r", "s", "2", "1", "x", "Retail", T1, "b")))
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_sales_rules_reject(spark):
    good, bad = conform.conform_sales(pos(
        spark, ("t1", "r", "s", "3", "4.50", "2025-10-01T10:00:00", "Odd", T1, "b"),
        ("t2", "r", "s", "0", "4.50", "2025-10-01T10:00:00", "Retail", T1, "b"),
        ("t3", "r", "s", "1", "0", "2025-10-01T10:00:00", "Retail", T1, "b"),
        (None, "r", "s", "1", "1", "2025-10-01T10:00:00", "Retail", T1, "b")))
    assert [(r.transaction_id, r._dq_invalid_channel) for r in good.collect()] == [("t1", True)]
    assert bad.count() == 2


def test_inventory_value_and_supply(spark):
    df = spark.createDataFrame([(5000, 70, D("1.50")), (10, None, None)],
                               "units_on_hand int, units_in_transit int, standard_cost_per_unit decimal(10,2)")
    rows = conform.compute_days_of_supply(conform.compute_inventory_value(df)).collect()
    assert rows[0].inventory_value == D("7500.00") and rows[0].dsi_days == D("500.0")
    assert rows[1].inventory_value is None and rows[1].dsi_days == D("10.0")


def test_yield_rate(spark):
    df = spark.createDataFrame([(3000, 2900), (2000, 2000), (1000, 0), (0, 5), (None, 5)],
                               "expected_output_cases int, actual_output_cases int")
    assert [r.yield_rate_pct for r in conform.compute_yield_rate(df).collect()] == [
        D("96.67"), D("100.00"), D("0.00"), None, None]


def test_downtime_hours(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 8), dt.datetime(2025, 1, 1, 9, 30)), (dt.datetime(2025, 1, 1), None)],
                               "downtime_start_ts timestamp, downtime_end_ts timestamp")
    assert [r.downtime_hours for r in conform.compute_downtime_hours(df).collect()] == [D("1.50"), None]


def test_batch_verdict(spark):
    batches = spark.createDataFrame([("b1", "PENDING"), ("b2", "PASS"), ("b3", None), ("b4", "PASS")], "batch_id string, qc_status string")
    checks = spark.createDataFrame([("b1", "QC_CHECK", "PASS"), ("b1", "QC_CHECK", "PASS"), ("b4", "QC_CHECK", "FAIL")],
                                   "batch_id string, event_type string, qc_status string")
    out = {r.batch_id: (r.qc_status, r.qc_pass_flag) for r in conform.aggregate_batch_qc(batches, checks).collect()}
    assert out == {"b1": ("PASS", True), "b2": ("PASS", True), "b3": (None, None), "b4": ("FAIL", False)}


def test_on_time(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2025, 1, 5), d(2025, 1, 4)), (d(2025, 1, 5), d(2025, 1, 6)), (d(2025, 1, 5), None)],
                               "promised_delivery_date date, actual_delivery_date date")
    assert [r.on_time_flag for r in conform.compute_on_time_flag(df).collect()] == [True, False, False]


def test_reorder_points_take_latest(spark):
    df = spark.createDataFrame([("s", "w", dt.date(2025, 1, 1), 10), ("s", "w", dt.date(2025, 1, 2), 33)],
                               "sku_id string, warehouse_id string, snapshot_date date, reorder_point_units int")
    row = conform.reorder_points(df).first()
    assert (row.reorder_point_units, row.safety_stock_units) == (33, 6)


def test_reorder_points_break_ties_and_cost_no_join(spark):
    one, two = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    stock = spark.createDataFrame(
        [("s", "w", two, 40, 1), ("s", "w", two, 30, 1), ("s", "w", one, 5, 1), ("s", "x", two, None, 1), ("s", "x", two, 9, 1),
         ("s", "y", None, 7, 1), ("s", "y", one, 8, 1), ("s", "z", None, 6, 1), (None, "w", one, 11, 1), (None, "w", one, -2**31, 1)],
        "sku_id string, warehouse_id string, snapshot_date date, reorder_point_units int, units_on_hand int")
    points = conform.reorder_points(stock)
    assert points.columns == ["sku_id", "warehouse_id", "reorder_point_units", "safety_stock_units"]
    assert points.schema["reorder_point_units"].dataType.simpleString() == "int"
    assert {(r.sku_id, r.warehouse_id): r.reorder_point_units for r in points.collect()} == {
        ("s", "w"): 30, ("s", "x"): None, ("s", "y"): 8, ("s", "z"): 6, (None, "w"): -2**31}
    # The points are unique by key, so a total that reads none of them needs no join.
    days = spark.createDataFrame([(20250101, one)], "date_key int, full_date date")
    wide = stock.selectExpr("*", "0 AS inventory_value", "0 AS dsi_days")
    total = facts.compute_fact_inventory_snapshot(wide, points, days).groupBy("warehouse_id").agg({"units_on_hand": "sum"})
    plan = total._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "_rop" not in plan and "warehouse_id#" in plan and plan.count("Join ") <= 1


def test_pairing_takes_earliest_end(spark):
    t = lambda h: dt.datetime(2025, 1, 1, h)
    cols = ("event_id string, batch_id string, production_line_id string, event_type string, event_timestamp timestamp, "
            "sku_id string, expected_output_cases int, actual_output_cases int, qc_status string")
    df = spark.createDataFrame([("e1", "b", "L", "BATCH_START", t(1), "s", 10, None, None),
                                ("e3", "b", "L", "BATCH_END", t(5), "s", 10, 7, "completed"),
                                ("e2", "b", "L", "BATCH_END", t(4), "s", 10, 9, "completed")], cols)
    row = conform.pair_batches(df).first()
    assert (row.actual_output_cases, row.qc_status, row.end_events) == (9, "PENDING", 2)
    assert row.batch_date == dt.date(2025, 1, 1)


def test_raw_event_mapping(spark):
    batches = spark.createDataFrame([("B1", "s", "L", "2025-01-01T00:00:00", "2025-01-01T08:00:00", "100", "95", None, "done")],
                                    "batch_id string, sku_id string, production_line string, start_time string, end_time string, "
                                    "target_quantity string, actual_quantity string, yield_rate string, status string")
    got = {r.event_id: (r.event_type, r.actual_output_cases, r.qc_status) for r in ingest.batch_events(batches).collect()}
    assert got == {"B1_START": ("BATCH_START", None, None), "B1_END": ("BATCH_END", "95", "done")}
    stops = spark.createDataFrame([("d1", "L", "a", "b", "x", "CHANGEOVER"), ("d2", "L", "a", "b", "x", "BREAKDOWN")],
                                  "event_id string, production_line string, start_time string, end_time string, reason string, category string")
    kinds = {r.event_id: r.event_type for r in ingest.stoppage_events(stops).collect()}
    assert kinds == {"d1": "DOWNTIME_PLANNED", "d2": "DOWNTIME_UNPLANNED"}


def test_raw_metadata_is_text_plus_lineage(spark):
    out = ingest.add_bronze_metadata(spark.createDataFrame([(1, 2.5)], "a int, b double"), "f.csv", "b1", ingested_at="2025-01-02 03:00:00")
    assert [f.dataType.typeName() for f in out.schema.fields[:2]] == ["string", "string"]
    row = out.first()
    assert row._pipeline_run_id == "manual_2025-01-02" and row.ingestion_date == dt.date(2025, 1, 2)


def test_two_items_become_two_rows(spark):
    raw = spark.createDataFrame([("t1", "st", "c1", "2025-01-01T00:00:00", [("s1", "1", "2.00", "0"), ("s1", "3", "2.00", "0")], "cash", "8")],
                                "transaction_id string, store_id string, customer_id string, timestamp string, "
                                "items array<struct<sku_id:string,qty:string,price:string,discount:string>>, payment_method string, total string")
    rows = ingest.flatten_pos(raw).collect()
    assert [(r.line_no, r.sku_id, r.quantity) for r in rows] == [("1", "s1", "1"), ("2", "s1", "3")]


def test_products_keep_latest_and_parse_flags(spark):
    df = spark.createDataFrame([("s", "ml", "1.00", "2.00", "Active", "2024-01-01"), ("s", "500", "bad", "2.00", "0", "2025-01-01")],
                               "sku_id string, package_size_ml string, standard_cost_per_unit string, list_price string, "
                               "is_active string, record_effective_date string")
    row = conform.transform_products(df, "2025-01-01 00:00:00").first()
    assert (row.package_size_ml, row.standard_cost_per_unit, row.is_active) == (500, None, False)


def test_shipment_party_from_order(spark):
    ships = spark.createDataFrame([("h1", "o1", ""), ("h2", "o2", "r9")], "shipment_id string, order_id string, retailer_id string")
    orders = spark.createDataFrame([("o1", "r1"), ("o2", "r2")], "order_id string, retailer_id string")
    assert {r.shipment_id: r.retailer_id for r in conform.resolve_shipment_party(ships, orders).collect()} == {"h1": "r1", "h2": "r9"}


def test_order_full_only_when_all_lines_are(spark):
    df = spark.createDataFrame([("o1", 5, 5), ("o1", 5, 4), ("o2", 1, 1)], "order_id string, quantity_ordered int, quantity_shipped int")
    assert {r.order_id: r.is_fully_shipped for r in conform.order_fully_shipped(df).collect()} == {"o1": False, "o2": True}


def test_combined_sales_keep_origin(spark):
    a = spark.createDataFrame([("t",)], "transaction_id string")
    b = spark.createDataFrame([("o", 1)], "transaction_id string, line int")
    out = conform.combine_sales(a, b)
    assert {(r.transaction_id, r.source) for r in out.collect()} == {("t", "POS"), ("o", "ERP")}
