"""Raw and conformed jobs, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import contracts as c
from shelfline.functions import surrogate_key
from shelfline.operators import history
from shelfline.operators.dedup import latest_per_key
from shelfline.operators.intervals import as_of_version
from shelfline.plans import conform, dimensions, facts, ingest
from shelfline.queries import sqlframes as s
from shelfline.queries.frames import Frames
from shelfline.queries.registry import query

# --- landing records derived from the tables, with dirt -------------------------

s.FRAMES.update({
    "pos_receipts": """
SELECT 'TXN-' || l_orderkey AS transaction_id, 'ST-' || (o_custkey % 50) AS store_id,
       CASE WHEN o_orderkey % 97 <> 0 THEN 'RTL-' || o_custkey END AS retailer_id,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS transaction_timestamp,
       CASE WHEN l_partkey % 53 <> 0 THEN 'SKU-' || l_partkey END AS sku_id,
       CASE WHEN l_partkey % 41 = 0 THEN 'abc' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
       CASE WHEN l_partkey % 61 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS unit_price,
       CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS discount_pct
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "pos_raw": """
SELECT transaction_id, store_id, retailer_id, transaction_timestamp, 'card' AS payment_method, '2' AS transaction_total,
       x.line_no, CASE x.line_no WHEN '1' THEN sku_id ELSE 'SKU-BAG' END AS sku_id,
       CASE x.line_no WHEN '1' THEN quantity ELSE '1' END AS quantity, CASE x.line_no WHEN '1' THEN unit_price ELSE '1.00' END AS unit_price,
       CASE x.line_no WHEN '1' THEN discount_pct ELSE '0.00' END AS discount_pct, 'Retail' AS channel, '' AS region, '' AS state
FROM pos_receipts, (VALUES ('1'), ('2')) AS x(line_no)""",
    "pos_checked": """
SELECT * FROM pos_raw WHERE transaction_id IS NOT NULL AND retailer_id IS NOT NULL AND sku_id IS NOT NULL
AND unit_price IS NOT NULL""",
})


def receipts(f: Frames) -> DataFrame:
    """Nested point-of-sale receipts: every order line sells its article and a bag."""
    p = f.table("part").select("p_partkey", F.col("p_retailprice").cast("decimal(10,2)").alias("price"))
    k = F.col("l_partkey")
    article = F.struct(
        F.when(k % 53 != 0, F.concat(F.lit("SKU-"), "l_partkey")).alias("sku_id"),
        F.when(k % 41 == 0, "abc").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("qty"),
        F.when(k % 61 != 0, F.col("price").cast("string")).alias("price"),
        F.col("l_discount").cast("decimal(4,2)").cast("string").alias("discount"))
    bag = F.struct(F.lit("SKU-BAG").alias("sku_id"), F.lit("1").alias("qty"), F.lit("1.00").alias("price"),
                   F.lit("0.00").alias("discount"))
    return f.lines.join(p, k == F.col("p_partkey")).select(
        F.concat(F.lit("TXN-"), "l_orderkey").alias("transaction_id"),
        F.concat(F.lit("ST-"), F.col("o_custkey") % 50).alias("store_id"),
        F.when(F.col("o_orderkey") % 97 != 0, F.concat(F.lit("RTL-"), "o_custkey")).alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.array(article, bag).alias("items"), F.lit("card").alias("payment_method"), F.lit("2").alias("total"))


@query("brz_01_pos_ingest", "SELECT * FROM pos_checked")
def pos_ingest(f: Frames):
    return ingest.checked(ingest.flatten_pos(receipts(f)), "pos_transactions")


@query("prj_11_array_explode", "SELECT transaction_id, line_no, sku_id, quantity FROM pos_raw")
def array_explode(f: Frames):
    return ingest.flatten_pos(receipts(f)).select("transaction_id", "line_no", "sku_id", "quantity")


@query("prj_08_struct_access", """
SELECT sku_id, count(*) AS lines, count(quantity) AS with_quantity, count(unit_price) AS with_price FROM pos_raw GROUP BY 1""")
def struct_access(f: Frames):
    items = receipts(f).select(F.explode("items").alias("item"))
    return items.groupBy("item.sku_id").agg(
        F.count("*").alias("lines"), F.count("item.qty").alias("with_quantity"), F.count("item.price").alias("with_price"))


def order_headers(f: Frames) -> DataFrame:
    return f.table("orders").select(
        F.concat(F.lit("ORD-"), "o_orderkey").alias("order_id"), F.concat(F.lit("RTL-"), "o_custkey").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 3), "yyyy-MM-dd").alias("ship_date"),
        F.col("o_orderstatus").alias("status"))


def order_line_records(f: Frames) -> DataFrame:
    return f.table("lineitem").select(
        F.concat_ws("-", F.lit("OL"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("order_line_id"),
        F.concat(F.lit("ORD-"), "l_orderkey").alias("order_id"), F.concat(F.lit("SKU-"), "l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        F.when(F.col("l_partkey") % 37 != 0, F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("unit_price"),
        F.col("l_discount").cast("decimal(4,2)").cast("string").alias("discount_pct"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("line_total"))


s.FRAMES["erp_lines"] = """
SELECT 'OL-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS order_line_id,
       'ORD-' || l_orderkey AS order_id, 'SKU-' || l_partkey AS sku_id, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity_ordered,
       CASE WHEN l_partkey % 37 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS invoice_price,
       CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS discount_pct,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS line_total, 'RTL-' || o_custkey AS retailer_id,
       strftime(o_orderdate, '%Y-%m-%d') AS order_date, strftime(CAST(o_orderdate AS DATE) + 3, '%Y-%m-%d') AS ship_date,
       o_orderstatus AS order_status, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity_shipped,
       '' AS channel, '' AS region, '' AS state
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""


@query("brz_02_erp_sales_ingest", "SELECT *, invoice_price IS NULL AS _dq_null_invoice_price FROM erp_lines WHERE retailer_id IS NOT NULL")
def erp_sales_ingest(f: Frames):
    return ingest.checked(ingest.join_erp_sales(order_headers(f), order_line_records(f)), "erp_sales")


@query("jn_01_lines_to_headers", "SELECT order_line_id, order_id, sku_id, retailer_id, order_date FROM erp_lines")
def lines_to_headers(f: Frames):
    return ingest.join_erp_sales(order_headers(f), order_line_records(f)).select(
        "order_line_id", "order_id", "sku_id", "retailer_id", "order_date")


# --- production feeds ------------------------------------------------------------------

def batch_records(f: Frames) -> DataFrame:
    """Production batch records: every purchase event closes a batch."""
    return f.table("events").where("event_type = 'purchase'").select(
        F.concat(F.lit("B-"), "event_id").alias("batch_id"),
        F.concat(F.lit("SKU-"), F.col("event_id") % 200).alias("sku_id"),
        F.concat(F.lit("LINE-"), F.col("user_id") % 6).alias("production_line"),
        F.date_format(F.col("ts").cast("timestamp") - F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss").alias("start_time"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("end_time"),
        (F.lit(100) + F.col("event_id") % 50).cast("string").alias("target_quantity"),
        (F.lit(80) + F.col("event_id") % 45).cast("string").alias("actual_quantity"),
        F.lit(None).cast("string").alias("yield_rate"), F.lit("completed").alias("status"))


def check_records(f: Frames) -> DataFrame:
    return f.table("events").where("event_type = 'view'").select(
        F.concat(F.lit("QC-"), "event_id").alias("check_id"), F.concat(F.lit("B-"), F.floor(F.col("event_id") / 5) * 5).alias("batch_id"),
        F.when(F.col("event_id") % 10 == 0, "FAIL").otherwise("PASS").alias("result"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.concat(F.lit("OP-"), F.col("user_id") % 9).alias("inspector_id"))


def stoppage_records(f: Frames) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    kinds = F.array(*[F.lit(k) for k in ("PLANNED_MAINTENANCE", "CHANGEOVER", "BREAKDOWN")])
    return f.table("events").where("event_type IN ('error', 'click')").select(
        F.when(F.col("event_id") % 89 != 0, F.concat(F.lit("DT-"), "event_id")).alias("event_id"),
        F.concat(F.lit("LINE-"), F.col("user_id") % 6).alias("production_line"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("start_time"),
        F.date_format(ts + F.expr("interval 30 minutes"), "yyyy-MM-dd'T'HH:mm:ss").alias("end_time"),
        F.element_at(kinds, (F.col("event_id") % 3 + 1).cast("int")).alias("category"))


_NULLS = "CAST(NULL AS VARCHAR)"
_STAMP = "'%Y-%m-%dT%H:%M:%S'"
s.FRAMES.update({
    "raw_batch_events": f"""
SELECT 'B-' || event_id || x.suffix AS event_id, 'B-' || event_id AS batch_id, 'LINE-' || (user_id % 6) AS production_line_id,
       'BATCH' || x.suffix AS event_type,
       strftime(CASE x.suffix WHEN '_START' THEN ts - INTERVAL 1 HOUR ELSE ts END, {_STAMP}) AS event_timestamp,
       'SKU-' || (event_id % 200) AS sku_id, CAST(100 + event_id % 50 AS VARCHAR) AS expected_output_cases,
       CASE x.suffix WHEN '_END' THEN CAST(80 + event_id % 45 AS VARCHAR) END AS actual_output_cases,
       CASE x.suffix WHEN '_END' THEN 'completed' END AS qc_status, {_NULLS} AS downtime_start_ts, {_NULLS} AS downtime_end_ts,
       {_NULLS} AS sensor_temperature, {_NULLS} AS sensor_pressure, {_NULLS} AS operator_id
FROM events, (VALUES ('_START'), ('_END')) AS x(suffix) WHERE events.event_type = 'purchase'""",
    "raw_check_events": f"""
SELECT 'QC-' || event_id AS event_id, 'B-' || (event_id // 5 * 5) AS batch_id, {_NULLS} AS production_line_id,
       'QC_CHECK' AS event_type, strftime(ts, {_STAMP}) AS event_timestamp, {_NULLS} AS sku_id, {_NULLS} AS expected_output_cases,
       {_NULLS} AS actual_output_cases, CASE WHEN events.event_id % 10 = 0 THEN 'FAIL' ELSE 'PASS' END AS qc_status,
       {_NULLS} AS downtime_start_ts, {_NULLS} AS downtime_end_ts, {_NULLS} AS sensor_temperature, {_NULLS} AS sensor_pressure,
       'OP-' || (user_id % 9) AS operator_id FROM events WHERE events.event_type = 'view'""",
    "raw_stop_events": f"""
SELECT CASE WHEN events.event_id % 89 <> 0 THEN 'DT-' || event_id END AS event_id, {_NULLS} AS batch_id,
       'LINE-' || (user_id % 6) AS production_line_id,
       CASE WHEN events.event_id % 3 = 2 THEN 'DOWNTIME_UNPLANNED' ELSE 'DOWNTIME_PLANNED' END AS event_type,
       strftime(ts, {_STAMP}) AS event_timestamp, {_NULLS} AS sku_id, {_NULLS} AS expected_output_cases,
       {_NULLS} AS actual_output_cases, {_NULLS} AS qc_status, strftime(ts, {_STAMP}) AS downtime_start_ts,
       strftime(ts + INTERVAL 30 MINUTES, {_STAMP}) AS downtime_end_ts, {_NULLS} AS sensor_temperature,
       {_NULLS} AS sensor_pressure, {_NULLS} AS operator_id FROM events WHERE events.event_type IN ('error', 'click')""",
    "raw_event_stream": """
SELECT * FROM raw_batch_events UNION ALL SELECT * FROM raw_check_events UNION ALL SELECT * FROM raw_stop_events""",
})


@query("brz_03_batch_events", "SELECT * FROM raw_batch_events")
def raw_batches(f: Frames):
    return ingest.batch_events(batch_records(f))


@query("brz_04_check_events", "SELECT * FROM raw_check_events")
def raw_checks(f: Frames):
    return ingest.check_events(check_records(f))


@query("brz_05_stoppage_events", "SELECT * FROM raw_stop_events")
def raw_stoppages(f: Frames):
    return ingest.stoppage_events(stoppage_records(f))


def unified(f: Frames) -> DataFrame:
    return ingest.event_stream(batch_records(f), check_records(f), stoppage_records(f))


@query("brz_06_event_stream", "SELECT * FROM raw_event_stream WHERE event_id IS NOT NULL AND event_type IS NOT NULL")
def raw_stream(f: Frames):
    return ingest.checked(unified(f), "iot_sensor_events")


@query("prj_06_schema_align", """
SELECT count(*) AS rows, count(sensor_temperature) AS temperatures, count(operator_id) AS operators,
       count(batch_id) AS batches FROM raw_event_stream""")
def schema_align(f: Frames):
    return unified(f).agg(F.count("*").alias("rows"), F.count("sensor_temperature").alias("temperatures"),
                          F.count("operator_id").alias("operators"), F.count("batch_id").alias("batches"))


@query("prj_12_record_split", "SELECT event_id, batch_id, event_type, event_timestamp, actual_output_cases FROM raw_batch_events")
def record_split(f: Frames):
    return ingest.batch_events(batch_records(f)).select(
        "event_id", "batch_id", "event_type", "event_timestamp", "actual_output_cases")


@query("set_01_union_by_name", "SELECT event_type, count(*) AS events, count(batch_id) AS with_batch FROM raw_event_stream GROUP BY 1")
def union_by_name(f: Frames):
    narrow = ingest.stoppage_events(stoppage_records(f)).drop("batch_id", "sku_id")
    both = ingest.batch_events(batch_records(f)).unionByName(narrow, allowMissingColumns=True)
    both = both.unionByName(ingest.check_events(check_records(f)), allowMissingColumns=True)
    return both.groupBy("event_type").agg(F.count("*").alias("events"), F.count("batch_id").alias("with_batch"))


# --- inventory, master data, shipments ----------------------------------------------------

def stock_records(f: Frames) -> DataFrame:
    """Daily stock file with some missing keys."""
    k = F.substring("sku_id", 5, 20).cast("int")
    return f.stock.select(
        F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"),
        F.when(k % 71 != 0, F.col("warehouse_id")).alias("warehouse_id"), "sku_id",
        F.col("units_on_hand").cast("string").alias("quantity_on_hand"),
        F.col("reorder_point_units").cast("string").alias("reorder_point"),
        F.when(k % 67 == 0, "n/a").otherwise(F.col("units_in_transit").cast("string")).alias("quantity_on_order"))


s.FRAMES["raw_stock"] = """
SELECT * FROM (SELECT CASE WHEN CAST(substr(sku_id, 5) AS INTEGER) % 71 <> 0 THEN warehouse_id END AS warehouse_id, sku_id,
       CAST(units_on_hand AS VARCHAR) AS units_on_hand,
       CASE WHEN CAST(substr(sku_id, 5) AS INTEGER) % 67 = 0 THEN 'n/a' ELSE CAST(units_in_transit AS VARCHAR) END AS units_in_transit,
       '0' AS units_reserved, CAST(snapshot_date AS VARCHAR) AS snapshot_date,
       CAST(snapshot_date AS VARCHAR) || 'T00:00:00' AS snapshot_timestamp,
       CAST(reorder_point_units AS VARCHAR) AS reorder_point_units, CAST(NULL AS VARCHAR) AS standard_cost_per_unit FROM stock)
WHERE warehouse_id IS NOT NULL"""


@query("brz_07_inventory_ingest", "SELECT * FROM raw_stock")
def inventory_ingest(f: Frames):
    return ingest.checked(ingest.map_inventory(stock_records(f)), "erp_inventory")


def product_records(f: Frames) -> DataFrame:
    k = F.col("p_partkey")
    return f.table("part").select(
        F.concat(F.lit("SKU-"), "p_partkey").alias("sku_id"), F.col("p_name").alias("product_name"),
        F.when(k % 47 != 0, F.col("p_type")).alias("category"), F.col("p_brand").alias("sub_category"),
        F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("unit_price"),
        F.when(k % 59 == 0, "bad").otherwise((F.col("p_retailprice").cast("decimal(10,2)") - 100).cast("string")).alias("cost_price"),
        F.col("p_size").cast("string").alias("pack_size"), F.lit("365").alias("shelf_life_days"),
        F.when(k % 43 != 0, F.lit("2000-01-01")).alias("launch_date"),
        F.when(k % 4 == 0, "Active").when(k % 4 == 1, "TRUE").when(k % 4 == 2, "0").otherwise("retired").alias("status"))


s.FRAMES["raw_products"] = """
SELECT * FROM (SELECT 'SKU-' || p_partkey AS sku_id, p_name AS product_name, CASE WHEN p_partkey % 47 <> 0 THEN p_type END AS product_category,
       p_brand AS product_subcategory, '' AS brand, '' AS packaging_type, CAST(p_size AS VARCHAR) AS package_size_ml,
       CASE WHEN p_partkey % 59 = 0 THEN 'bad' ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) - 100 AS VARCHAR) END AS standard_cost_per_unit,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS list_price, '' AS price_tier,
       CASE p_partkey % 4 WHEN 0 THEN 'Active' WHEN 1 THEN 'TRUE' WHEN 2 THEN '0' ELSE 'retired' END AS is_active,
       CASE WHEN p_partkey % 43 <> 0 THEN '2000-01-01' ELSE '2001-07-15' END AS record_effective_date FROM part)
WHERE product_category IS NOT NULL"""


@query("brz_08_products_ingest", "SELECT * FROM raw_products")
def products_ingest(f: Frames):
    return ingest.checked(ingest.map_products(product_records(f), "2001-07-15"), "erp_products")


@query("brz_08_customers_ingest", """
SELECT retailer_id, retailer_name, CASE WHEN custkey % 29 <> 0 THEN retail_segment END AS retail_segment, channel, region, state, '' AS city,
       CAST(credit_terms_days AS VARCHAR) AS credit_terms_days, CAST(account_activation_date AS VARCHAR) AS account_activation_date,
       account_status, '0' AS trade_spend_usd, '0' AS broker_commission_usd, '0' AS field_sales_cost_usd,
       CAST(account_activation_date AS VARCHAR) AS record_effective_date, custkey % 29 = 0 AS _dq_null_retailer_name_retail_segment
FROM account_feed""")
def customers_ingest(f: Frames):
    raw = f.account_feed.select(
        F.col("retailer_id").alias("customer_id"), F.col("retailer_name").alias("name"),
        F.when(F.col("custkey") % 29 != 0, F.col("retail_segment")).alias("segment"), "region", "channel", "state",
        F.col("credit_terms_days").cast("string").alias("credit_terms_days"),
        F.col("account_activation_date").cast("string").alias("acquisition_date"), F.col("account_status").alias("status"))
    return ingest.checked(ingest.map_customers(raw), "erp_customers")


@query("brz_08_warehouses_ingest", """
SELECT warehouse_id, warehouse_name AS name, region, CAST(capacity_units AS VARCHAR) AS capacity_cases, state AS address,
       CAST(NULL AS VARCHAR) AS manager FROM warehouses""")
def warehouses_ingest(f: Frames):
    raw = f.warehouses.select("warehouse_id", F.col("warehouse_name").alias("name"), "region",
                              F.col("capacity_units").cast("string").alias("capacity_cases"),
                              F.col("state").alias("address"), F.lit(None).cast("string").alias("manager"))
    return ingest.checked(ingest.map_warehouses(raw), "erp_warehouses")


def shipment_records(f: Frames) -> DataFrame:
    """Carrier file: text, some missing promises, late copies of the same shipment."""
    k = F.col("l_partkey")
    ship = F.col("l_shipdate").cast("date")
    text = lambda d: F.date_format(d, "yyyy-MM-dd")
    return f.table("lineitem").select(
        F.concat_ws("-", F.lit("SHP"), "l_orderkey", "l_linenumber").alias("shipment_id"),
        F.concat(F.lit("ORD-"), "l_orderkey").alias("order_id"), F.concat(F.lit("WH-"), "l_suppkey").alias("warehouse_id"),
        F.concat(F.lit("CR-"), k % 7).alias("carrier"), text(ship).alias("ship_date"),
        F.when(k % 73 != 0, text(F.date_add(ship, 5))).alias("estimated_delivery"),
        F.when(k % 11 != 0, text(F.date_add(ship, ((k + F.col("l_suppkey")) % 9).cast("int")))).alias("actual_delivery"),
        F.when(k % 31 == 0, "?").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("cases_shipped"),
        F.when(k % 33 != 0, F.col("l_extendedprice").cast("decimal(10,2)").cast("string")).alias("freight_cost"),
        F.lit("done").alias("status"))


s.FRAMES["raw_shipments"] = """
SELECT *, logistics_cost_usd IS NULL AS _dq_null_logistics_cost_usd FROM (
SELECT 'SHP-' || l_orderkey || '-' || l_linenumber AS shipment_id, 'ORD-' || l_orderkey AS order_id, '' AS retailer_id,
       'WH-' || l_suppkey AS warehouse_id, '' AS route_id, 'CR-' || (l_partkey % 7) AS carrier_id,
       strftime(l_shipdate, '%Y-%m-%d') AS ship_date,
       CASE WHEN l_partkey % 73 <> 0 THEN strftime(CAST(l_shipdate AS DATE) + 5, '%Y-%m-%d') END AS promised_delivery_date,
       CASE WHEN l_partkey % 11 <> 0 THEN strftime(CAST(l_shipdate AS DATE) + CAST((l_partkey + l_suppkey) % 9 AS INTEGER), '%Y-%m-%d') END
         AS actual_delivery_date,
       CASE WHEN l_partkey % 31 = 0 THEN '?' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS cases_delivered,
       CASE WHEN l_partkey % 33 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) END AS logistics_cost_usd,
       '' AS channel, '' AS region, '' AS state, 'true' AS is_fully_shipped, '0' AS quantity_ordered,
       CASE WHEN l_partkey % 31 = 0 THEN '?' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity_shipped
FROM lineitem) WHERE promised_delivery_date IS NOT NULL"""


def landed_shipments(f: Frames) -> DataFrame:
    return ingest.checked(ingest.map_shipments(shipment_records(f)), "logistics_shipments")


@query("brz_09_shipments_ingest", "SELECT * FROM raw_shipments")
def shipments_ingest(f: Frames):
    return landed_shipments(f)


@query("prj_01_rename_map", "SELECT shipment_id, carrier_id, promised_delivery_date, actual_delivery_date, cases_delivered, logistics_cost_usd FROM raw_shipments")
def rename_map(f: Frames):
    return landed_shipments(f).select("shipment_id", "carrier_id", "promised_delivery_date", "actual_delivery_date",
                                      "cases_delivered", "logistics_cost_usd")


@query("prj_02_default_literals", """
SELECT retailer_id, route_id, channel, is_fully_shipped, quantity_ordered, count(*) AS rows FROM raw_shipments GROUP BY ALL""")
def default_literals(f: Frames):
    return landed_shipments(f).groupBy("retailer_id", "route_id", "channel", "is_fully_shipped", "quantity_ordered").agg(
        F.count("*").alias("rows"))


@query("brz_10_returns_ingest", """
SELECT return_id, transaction_id, CAST(NULL AS VARCHAR) AS order_id, CAST(NULL AS VARCHAR) AS retailer_id, sku_id,
       CAST(quantity_returned AS VARCHAR) AS quantity_returned, CAST(return_amount AS VARCHAR) AS return_amount,
       CAST(return_date AS VARCHAR) AS return_date, return_reason_code FROM returns""")
def returns_ingest(f: Frames):
    raw = f.returns.select("return_id", "transaction_id", F.lit(None).cast("string").alias("order_id"),
                           F.lit(None).cast("string").alias("retailer_id"), "sku_id",
                           *[F.col(x).cast("string").alias(x) for x in ("quantity_returned", "return_amount", "return_date")],
                           "return_reason_code")
    return ingest.checked(ingest.map_returns(raw), "erp_returns")


# --- conformed layer -------------------------------------------------------------------------

def landed_pos(f: Frames) -> DataFrame:
    """Landed sale lines with an ingestion time taken from the line itself."""
    lines = ingest.checked(ingest.flatten_pos(receipts(f)), "pos_transactions")
    at = F.timestamp_seconds(F.unix_timestamp(F.lit("2001-08-02 00:00:00").cast("timestamp")) + F.col("line_no").cast("bigint"))
    return lines.withColumns({"_ingested_at": at, "_batch_id": F.lit("load-1")})


_SALES_OUT = ["transaction_id", "sku_id", "retailer_id", "transaction_key", "quantity_sold", "unit_price",
              "net_line_amount", "transaction_date", "line_no", "_dq_invalid_channel"]

s.FRAMES["slv_sales"] = f"""
SELECT *, channel NOT IN ('Retail', 'Wholesale', 'DTC') AS _dq_invalid_channel FROM (
SELECT transaction_id, sku_id, retailer_id, {s.key('transaction_id', 'sku_id')} AS transaction_key,
       TRY_CAST(quantity AS INTEGER) AS quantity_sold, CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(unit_price AS DECIMAL(10,2)) * TRY_CAST(quantity AS INTEGER) AS DECIMAL(12,2)) AS net_line_amount,
       CAST(CAST(transaction_timestamp AS TIMESTAMP) AS DATE) AS transaction_date, line_no, channel
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id, sku_id ORDER BY CAST(line_no AS INTEGER) DESC, quantity, discount_pct) AS rn FROM pos_checked)
WHERE rn = 1) WHERE unit_price BETWEEN 0.01 AND 10000 AND quantity_sold >= 1"""


@query("slv_01_sales_transactions", f"SELECT {', '.join(_SALES_OUT)} FROM slv_sales")
def slv_sales(f: Frames):
    return conform.conform_sales(landed_pos(f), "2001-08-03 00:00:00")[0].select(*_SALES_OUT)


_RET = "return_id, transaction_id, sku_id, quantity_returned, return_amount, return_date, return_reason_code"
s.FRAMES["slv_returns"] = f"""
SELECT {_RET}, coalesce(return_reason_code NOT IN ('DAMAGED', 'EXPIRED', 'WRONG_ITEM', 'QUALITY', 'OTHER'), true)
         AS _dq_enum_return_reason_code,
       transaction_id NOT IN (SELECT transaction_id FROM sale_lines WHERE channel <> 'DTC') AS is_orphan,
       {s.key('return_id')} AS return_key
FROM (SELECT *, row_number() OVER (PARTITION BY return_id ORDER BY return_date DESC, transaction_id, sku_id,
             quantity_returned, return_amount, return_reason_code) AS rn FROM returns)
WHERE rn = 1 AND quantity_returned > 0 AND return_amount > 0"""


@query("slv_02_sales_returns", "SELECT * FROM slv_returns")
def slv_returns(f: Frames):
    return conform.conform_returns(f.returns, f.sale_lines.where("channel <> 'DTC'"))


@query("slv_03_sales_spend", "SELECT * FROM spend")
def slv_spend(f: Frames):
    return f.spend


_STOCK_OUT = ["stock_key", "warehouse_id", "sku_id", "snapshot_date", "units_on_hand", "units_in_transit",
              "units_reserved", "units_available", "reorder_point_units", "standard_cost_per_unit", "inventory_value", "dsi_days"]


def landed_stock(f: Frames) -> DataFrame:
    rows = ingest.checked(ingest.map_inventory(stock_records(f)), "erp_inventory")
    return rows.withColumns({"_ingested_at": F.lit("2001-08-02 00:00:00").cast("timestamp"), "_batch_id": F.lit("load-1")})


s.FRAMES["slv_stock"] = f"""
SELECT {s.key('warehouse_id', 'r.sku_id', 'snapshot_date')} AS stock_key, warehouse_id, r.sku_id, CAST(snapshot_date AS DATE) AS snapshot_date,
       oh AS units_on_hand, it AS units_in_transit, CAST(0 AS INTEGER) AS units_reserved, oh AS units_available,
       CAST(reorder_point_units AS INTEGER) AS reorder_point_units, p.standard_cost_per_unit,
       CAST(oh * p.standard_cost_per_unit AS DECIMAL(14,2)) AS inventory_value,
       {s.ratio('oh', f"greatest({s.ratio('it', '7', 10, 2)}, CAST(1 AS DECIMAL(10,2)))", 8, 1)} AS dsi_days
FROM (SELECT warehouse_id, sku_id, snapshot_date, CAST(units_on_hand AS INTEGER) AS oh, TRY_CAST(units_in_transit AS INTEGER) AS it,
             reorder_point_units FROM raw_stock) r JOIN products p ON r.sku_id = p.sku_id
WHERE oh >= 0 AND it >= 0"""


@query("slv_04_inventory_stock", f"SELECT {', '.join(_STOCK_OUT)} FROM slv_stock")
def slv_stock(f: Frames):
    return conform.conform_stock(landed_stock(f), f.products, "2001-08-03 00:00:00")[0].select(*_STOCK_OUT)


@query("slv_05_days_of_supply", f"""
SELECT sku_id, warehouse_id, snapshot_date, {s.ratio('units_on_hand', f"greatest({s.DAILY_PROXY}, CAST(1 AS DECIMAL(10,2)))", 8, 1)} AS dsi_days
FROM stock""")
def slv_supply(f: Frames):
    return conform.compute_days_of_supply(f.stock).select("sku_id", "warehouse_id", "snapshot_date", "dsi_days")


@query("slv_06_reorder_points", "SELECT * FROM reorder")
def slv_reorder(f: Frames):
    return f.reorder


@query("slv_07_production_batches", "SELECT * FROM batch_pairs")
def slv_batches(f: Frames):
    return conform.pair_batches(f.plant_events)


@query("slv_08_yield_rate", "SELECT batch_id, expected_output_cases, actual_output_cases, yield_rate_pct FROM batches")
def slv_yield(f: Frames):
    return f.batches.select("batch_id", "expected_output_cases", "actual_output_cases", "yield_rate_pct")


@query("slv_09_downtime_hours", "SELECT event_id, event_type, downtime_hours FROM prod_events")
def slv_downtime(f: Frames):
    return f.prod_events.select("event_id", "event_type", "downtime_hours")


@query("slv_10_batch_quality", "SELECT batch_id, qc_status, qc_pass_flag FROM batches")
def slv_quality(f: Frames):
    return f.batches.select("batch_id", "qc_status", "qc_pass_flag")


@query("slv_11_production_events", """
SELECT event_id, event_key, event_type, event_date, production_line_id, qc_status, downtime_hours FROM prod_events""")
def slv_events(f: Frames):
    return f.prod_events.select("event_id", "event_key", "event_type", "event_date", "production_line_id", "qc_status", "downtime_hours")


_SHIP_OUT = ["shipment_id", "shipment_key", "order_id", "warehouse_id", "ship_date", "promised_delivery_date",
             "actual_delivery_date", "cases_delivered", "logistics_cost_usd", "is_fully_shipped", "on_time_flag",
             "_dq_range_cases_delivered", "_dq_range_logistics_cost_usd"]


@query("slv_12_shipments", f"""
SELECT shipment_id, {s.key('shipment_id')} AS shipment_key, order_id, warehouse_id, CAST(ship_date AS DATE) AS ship_date,
       CAST(promised_delivery_date AS DATE) AS promised_delivery_date, CAST(actual_delivery_date AS DATE) AS actual_delivery_date,
       TRY_CAST(cases_delivered AS INTEGER) AS cases_delivered, CAST(logistics_cost_usd AS DECIMAL(10,2)) AS logistics_cost_usd,
       true AS is_fully_shipped, coalesce(actual_delivery_date <= promised_delivery_date, false) AS on_time_flag,
       coalesce(TRY_CAST(cases_delivered AS INTEGER) < 0, true) AS _dq_range_cases_delivered,
       coalesce(CAST(logistics_cost_usd AS DECIMAL(10,2)) < 0, true) AS _dq_range_logistics_cost_usd
FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY ship_date DESC, warehouse_id, carrier_id,
             promised_delivery_date, actual_delivery_date NULLS FIRST, cases_delivered, logistics_cost_usd NULLS FIRST) AS rn
      FROM raw_shipments) WHERE rn = 1""")
def slv_shipments(f: Frames):
    at = F.concat("ship_date", F.lit(" 00:00:00")).cast("timestamp")
    raw = landed_shipments(f).withColumns({"_ingested_at": at, "_batch_id": F.lit("load-1")})
    return conform.conform_shipments(raw, "2001-08-03 00:00:00")[0].select(*_SHIP_OUT)


@query("slv_13_order_full_shipment", """
SELECT order_id, bool_and(quantity_shipped >= quantity_ordered) AS is_fully_shipped, count(*) AS line_count
FROM shipments GROUP BY 1""")
def slv_full_orders(f: Frames):
    return conform.order_fully_shipped(f.shipments)


@query("slv_14_products_current", """
SELECT sku_id, product_name, product_category, TRY_CAST(package_size_ml AS INTEGER) AS package_size_ml,
       TRY_CAST(standard_cost_per_unit AS DECIMAL(10,2)) AS standard_cost_per_unit, CAST(list_price AS DECIMAL(10,2)) AS list_price,
       lower(is_active) IN ('true', '1', 'active') AS is_active, CAST(record_effective_date AS DATE) AS record_effective_date
FROM raw_products""")
def slv_products(f: Frames):
    older = product_records(f).withColumn("launch_date", F.lit("1999-01-01"))
    raw = ingest.checked(ingest.map_products(product_records(f).unionByName(older), "2001-07-15"), "erp_products")
    return conform.transform_products(raw, "2001-08-03 00:00:00").select(
        "sku_id", "product_name", "product_category", "package_size_ml", "standard_cost_per_unit", "list_price",
        "is_active", "record_effective_date")


_TRACKED = list(conform.TRACKED_ACCOUNT_COLUMNS)
_DIGEST = s.digest(*_TRACKED)
s.FRAMES["account_versions"] = f"""
SELECT retailer_id, retailer_name, retail_segment, channel, region, state, account_status, credit_terms_days,
       {s.key('retailer_id', 'valid_from')} AS surrogate_key, valid_from, valid_to, is_current, {_DIGEST} AS row_digest
FROM (
  SELECT *, DATE '1995-01-01' AS valid_from, CASE WHEN custkey % 10 = 0 THEN DATE '1999-01-01' END AS valid_to,
         custkey % 10 <> 0 AS is_current FROM account_feed
  UNION ALL
  SELECT *, DATE '1999-01-01', NULL, true FROM account_changes WHERE custkey % 10 = 0)"""


def _feed(df: DataFrame) -> DataFrame:
    return df.select("retailer_id", *_TRACKED, "record_effective_date")


def _versions(f: Frames) -> DataFrame:
    first = history.apply_history(None, _feed(f.account_feed), "retailer_id", _TRACKED, "record_effective_date")
    return history.apply_history(first, _feed(f.account_changes), "retailer_id", _TRACKED, "record_effective_date")


@query("slv_15_customers_versions", "SELECT * FROM account_versions WHERE is_current")
def slv_customers(f: Frames):
    return history.current_slice(_versions(f))


@query("slv_16_version_history", "SELECT * FROM account_versions")
def slv_history(f: Frames):
    return _versions(f)


@query("slv_17_product_versions", f"""
SELECT sku_id, product_name, list_price, {s.key('sku_id', 'valid_from')} AS surrogate_key, valid_from, valid_to, is_current,
       {s.digest('product_name', 'list_price')} AS row_digest
FROM (SELECT sku_id, product_name, list_price, DATE '1998-01-01' AS valid_from,
             CASE WHEN package_size_ml % 2 = 0 THEN DATE '2000-01-01' END AS valid_to, package_size_ml % 2 <> 0 AS is_current FROM products
      UNION ALL
      SELECT sku_id, product_name, CAST(list_price + 5 AS DECIMAL(10,2)), DATE '2000-01-01', NULL, true FROM products
      WHERE package_size_ml % 2 = 0)""")
def slv_product_history(f: Frames):
    base = f.products.select("sku_id", "product_name", "list_price", "package_size_ml")
    first = base.withColumn("effective", F.lit("1998-01-01").cast("date"))
    raised = (first.where("package_size_ml % 2 = 0")
              .withColumn("list_price", (F.col("list_price") + 5).cast("decimal(10,2)"))
              .withColumn("effective", F.lit("2000-01-01").cast("date")))
    args = ("sku_id", ["product_name", "list_price"], "effective")
    state = history.apply_history(None, first.drop("package_size_ml"), *args)
    return history.apply_history(state, raised.drop("package_size_ml"), *args)


@query("slv_18_warehouses", "SELECT * FROM warehouses")
def slv_warehouses(f: Frames):
    twice = f.warehouses.unionByName(f.warehouses)
    return conform.transform_warehouses(twice, "2001-08-03 00:00:00").drop("created_at", "updated_at", "_source_batch_id")


# --- dimensions and facts ------------------------------------------------------------------------

s.FRAMES["calendar_days"] = """
SELECT CAST(d AS DATE) AS full_date FROM (SELECT unnest(generate_series(
  (SELECT date_trunc('year', min(o_orderdate)) FROM orders),
  (SELECT date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM orders), INTERVAL 1 DAY)) AS d)"""
s.FRAMES["dim_calendar"] = """
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date, dayname(full_date) AS day_name,
       CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, CAST(isodow(full_date) AS INTEGER) AS iso_day_of_week,
       CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
       CAST(month(full_date) AS INTEGER) AS month_number, monthname(full_date) AS month_name,
       CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(year(full_date) AS INTEGER) AS year,
       isodow(full_date) >= 6 AS is_weekend,
       strftime(full_date, '%m-%d') IN ('01-01', '07-04', '11-11', '12-25') AS is_holiday,
       CASE strftime(full_date, '%m-%d') WHEN '01-01' THEN 'New Year''s Day' WHEN '07-04' THEN 'Independence Day'
            WHEN '11-11' THEN 'Veterans Day' WHEN '12-25' THEN 'Christmas Day' END AS holiday_name,
       CAST(year(full_date) + CASE WHEN month(full_date) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
       'FQ' || ((month(full_date) + 2) % 12 // 3 + 1) AS fiscal_quarter,
       (year(full_date) + CASE WHEN month(full_date) >= 10 THEN 1 ELSE 0 END) || '-FQ' || ((month(full_date) + 2) % 12 // 3 + 1) AS fiscal_period,
       CAST(day(last_day(full_date)) AS INTEGER) AS days_in_month, full_date = last_day(full_date) AS is_month_end,
       full_date = last_day(full_date) AND month(full_date) % 3 = 0 AS is_quarter_end,
       strftime(full_date, '%m-%d') = '12-31' AS is_year_end
FROM calendar_days"""


@query("dim_01_date", "SELECT * FROM dim_calendar")
def dim_date(f: Frames):
    return f.order_days


@query("src_04_date_spine", "SELECT full_date, date_key FROM dim_calendar")
def date_spine(f: Frames):
    return f.order_days.select("full_date", "date_key")


@query("dim_02_product", f"""
SELECT {s.key('sku_id')} AS product_key, sku_id, product_name, product_category, brand, price_tier, standard_cost_per_unit,
       list_price FROM products""")
def dim_product(f: Frames):
    return dimensions.product_dimension(f.products)


@query("dim_03_customer", """
SELECT surrogate_key AS customer_key, retailer_id, retailer_name, retail_segment, channel, region, account_status
FROM customers WHERE is_current""")
def dim_customer(f: Frames):
    return dimensions.customer_dimension(f.account_history)


@query("dim_04_warehouse", f"SELECT {s.key('warehouse_id')} AS warehouse_key, * FROM warehouses")
def dim_warehouse(f: Frames):
    return dimensions.warehouse_dimension(f.warehouses)


@query("dim_05_region", f"""
SELECT {s.key('region')} AS region_key, upper(region) AS region_id, region AS region_name,
       string_agg(DISTINCT state, ',' ORDER BY state) AS states_included, region || ' Territory' AS sales_territory
FROM account_feed GROUP BY region""")
def dim_region(f: Frames):
    return dimensions.region_dimension(f.account_feed)


@query("dim_06_channel", f"""
SELECT DISTINCT {s.key('channel')} AS channel_key, upper(channel) AS channel_id, channel AS channel_name,
       CASE WHEN channel = 'DTC' THEN 'Direct' ELSE 'Indirect' END AS channel_type FROM account_feed""")
def dim_channel(f: Frames):
    return dimensions.channel_dimension(f.account_feed)


@query("fct_01_sales", "SELECT * FROM fact_sales")
def fct_sales(f: Frames):
    return f.fact_sales


@query("fct_01_sales_full", f"""
SELECT {s.key('transaction_id', 'l.sku_id')} AS transaction_key, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
       {s.key('l.sku_id')} AS product_key, c.surrogate_key AS customer_key, {s.key('l.channel')} AS channel_key,
       {s.key('l.region')} AS region_key, transaction_date, l.sku_id, l.retailer_id, units_sold, gross_sales_amount, return_amount,
       net_revenue, CAST(p.standard_cost_per_unit * units_sold AS DECIMAL(18,4)) AS cogs,
       CAST(net_revenue - p.standard_cost_per_unit * units_sold AS DECIMAL(18,4)) AS gross_margin_amount,
       {s.pct('net_revenue - p.standard_cost_per_unit * units_sold', 'net_revenue', 18, 4)} AS gross_margin_pct
FROM net_lines l JOIN products p ON l.sku_id = p.sku_id
LEFT JOIN customers c ON l.retailer_id = c.retailer_id AND c.is_current""")
def fct_sales_full(f: Frames):
    return facts.fact_sales_full(f.sales, f.returns, f.products, f.account_history)


@query("fct_01_sales_lines", f"""
WITH l AS (SELECT *, {s.key('transaction_id', 'line_no', 'sku_id')} AS transaction_key FROM sales),
r AS (SELECT transaction_id, sku_id, CAST(sum(return_amount) AS DECIMAL(18,4)) AS amount FROM returns GROUP BY ALL),
f AS (SELECT min(transaction_key) AS transaction_key, any_value(amount) AS amount
      FROM l JOIN r ON l.transaction_id = r.transaction_id AND l.sku_id = r.sku_id GROUP BY l.transaction_id, l.sku_id),
w AS (SELECT replace(order_id, 'ORD-', 'TXN-') AS transaction_id, min(warehouse_id) AS warehouse FROM shipments GROUP BY 1),
m AS (SELECT l.*, w.warehouse, c.surrogate_key AS customer_key, CAST(l.unit_price * l.quantity_sold AS DECIMAL(18,4)) AS gross,
             coalesce(f.amount, CAST(0 AS DECIMAL(18,4))) AS returned, CAST(p.standard_cost_per_unit * l.quantity_sold AS DECIMAL(18,4)) AS cost
      FROM l LEFT JOIN f ON l.transaction_key = f.transaction_key LEFT JOIN w ON l.transaction_id = w.transaction_id
      JOIN products p ON l.sku_id = p.sku_id LEFT JOIN customers c ON l.retailer_id = c.retailer_id AND c.is_current)
SELECT transaction_key, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key, {s.key('sku_id')} AS product_key, customer_key,
       CASE WHEN warehouse IS NOT NULL THEN {s.key('warehouse')} END AS warehouse_key, {s.key('channel')} AS channel_key,
       {s.key('region')} AS region_key, transaction_date, transaction_id, sku_id, retailer_id, quantity_sold, unit_price,
       gross AS gross_sales_amount, returned AS return_amount, CAST(gross - returned AS DECIMAL(18,4)) AS net_revenue, cost AS cogs,
       CAST(gross - returned - cost AS DECIMAL(18,4)) AS gross_margin_amount, {s.pct('gross - returned - cost', 'gross - returned', 18, 4)} AS gross_margin_pct
FROM m""")
def fct_sales_lines(f: Frames):
    """The sale fact of one row a line, with returns, warehouse and all keys."""
    lines = f.sales.withColumn("transaction_key", surrogate_key("transaction_id", "line_no", "sku_id"))
    sent = f.shipments.withColumn("order_id", F.replace("order_id", F.lit("ORD-"), F.lit("TXN-")))
    return facts.sales_line_fact(lines, f.returns, sent, f.products, f.account_history, "2001-07-15 00:00:00").drop("last_updated_ts")


@query("fct_02_inventory_snapshot", "SELECT * FROM fact_inventory")
def fct_inventory(f: Frames):
    return f.fact_inventory


@query("fct_03_production_batch", "SELECT * FROM fact_batch")
def fct_batch(f: Frames):
    return f.fact_batch


@query("fct_04_shipment", "SELECT * FROM fact_shipment")
def fct_shipment(f: Frames):
    return f.fact_shipment


@query("jn_21_as_of_version", """
SELECT l.transaction_id, l.line_no, l.sku_id, l.warehouse_id, l.transaction_date, h.version_cost,
       CAST(h.version_cost * l.quantity_sold AS DECIMAL(14,2)) AS historical_cogs
FROM sale_lines l LEFT JOIN cost_history h ON l.sku_id = h.sku_id AND l.transaction_date >= h.valid_from
 AND (h.valid_to IS NULL OR l.transaction_date < h.valid_to)""")
def as_of_cost(f: Frames):
    joined = as_of_version(f.sale_lines, f.cost_history, "sku_id", "transaction_date", ["version_cost"])
    return joined.select("transaction_id", "line_no", "sku_id", "warehouse_id", "transaction_date", "version_cost",
                         (F.col("version_cost") * F.col("quantity_sold")).cast("decimal(14,2)").alias("historical_cogs"))


@query("jn_22_interval_attribution", """
SELECT batch_id, count(*) AS stoppages, CAST(sum(overlap_seconds) AS BIGINT) AS downtime_seconds,
       CAST(coalesce(sum(overlap_seconds) FILTER (event_type = 'DOWNTIME_UNPLANNED'), 0) AS BIGINT) AS unplanned_seconds
FROM stop_overlaps GROUP BY 1""")
def interval_attribution(f: Frames):
    return facts.attribute_downtime(f.batches, f.prod_events)
