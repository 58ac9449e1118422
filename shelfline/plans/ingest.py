"""Raw layer: landing records mapped to canonical text columns, nothing typed.

The mapping functions are pure; the ``ingest_*`` jobs read a feed, apply its
rules and append once, counting rows with the metrics of that write.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import contracts as c
from shelfline.operators import quality as q
from shelfline.plans.gate import admit
from shelfline.session import settle
from shelfline.sources import files, sinks

# Stoppage categories that count as planned.
PLANNED = ("PLANNED_MAINTENANCE", "CHANGEOVER")


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in df.columns])


def add_bronze_metadata(df: DataFrame, source_path: str | Column, batch_id: str,
                        pipeline_run_id: str | None = None, ingested_at: str | None = None) -> DataFrame:
    """Text columns plus lineage. ``source_path`` may be a column such as the file path."""
    source = source_path if isinstance(source_path, Column) else F.lit(source_path)
    at = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    day = F.to_date(at)
    run = F.lit(pipeline_run_id) if pipeline_run_id else F.concat(F.lit("manual_"), day.cast("string"))
    data = [F.col(f"`{n}`").cast("string").alias(n) for n in df.columns if n != "_source_file"]
    return df.select(
        *data, at.alias("_ingested_at"), source.alias("_source_file"), F.lit(batch_id).alias("_batch_id"),
        run.alias("_pipeline_run_id"), day.alias("ingestion_date"))


def align(df: DataFrame, columns: tuple[str, ...] = c.EVENT_COLUMNS) -> DataFrame:
    """Exactly the given text columns: missing ones NULL, extra ones dropped."""
    have = set(df.columns)
    return df.select(*[F.col(n).cast("string").alias(n) if n in have else _text(None).alias(n) for n in columns])


# --- sales -------------------------------------------------------------------

def flatten_pos(raw: DataFrame) -> DataFrame:
    """One row per line item, keeping its position; receipts without items vanish."""
    return raw.select("*", F.posexplode("items").alias("_pos", "item")).select(
        "transaction_id", "store_id", F.col("customer_id").alias("retailer_id"),
        F.col("timestamp").alias("transaction_timestamp"), "payment_method",
        F.col("total").cast("string").alias("transaction_total"),
        (F.col("_pos") + 1).cast("string").alias("line_no"),
        F.col("item.sku_id").cast("string").alias("sku_id"), F.col("item.qty").cast("string").alias("quantity"),
        F.col("item.price").cast("string").alias("unit_price"),
        F.col("item.discount").cast("string").alias("discount_pct"),
        _text("Retail").alias("channel"), _text("").alias("region"), _text("").alias("state"))


def join_erp_sales(orders: DataFrame, order_lines: DataFrame) -> DataFrame:
    """Every order line with its header; the ordered quantity stands in for the shipped one."""
    head = orders.select("order_id", F.col("customer_id").alias("retailer_id"), "order_date", "ship_date",
                         F.col("status").alias("order_status"))
    lines = order_lines.select("order_line_id", "order_id", "sku_id", F.col("quantity").alias("quantity_ordered"),
                               F.col("unit_price").alias("invoice_price"), "discount_pct", "line_total")
    return lines.join(head, "order_id", "left").select(
        "*", F.col("quantity_ordered").alias("quantity_shipped"), _text("").alias("channel"),
        _text("").alias("region"), _text("").alias("state"))


def map_returns(raw: DataFrame) -> DataFrame:
    return raw.select(*c.LANDING["returns"])


# --- production ----------------------------------------------------------------

def batch_events(raw: DataFrame) -> DataFrame:
    """A start and an end event per batch record, from one scan."""
    none = _text(None)
    start = F.struct(F.lit("_START").alias("suffix"), F.lit("BATCH_START").alias("event_type"),
                     F.col("start_time").cast("string").alias("at"), none.alias("made"), none.alias("state"))
    end = F.struct(F.lit("_END").alias("suffix"), F.lit("BATCH_END").alias("event_type"),
                   F.col("end_time").cast("string").alias("at"),
                   F.col("actual_quantity").cast("string").alias("made"), F.col("status").cast("string").alias("state"))
    return align(raw.select("batch_id", "production_line", "sku_id", "target_quantity",
                            F.explode(F.array(start, end)).alias("e")).select(
        F.concat("batch_id", "e.suffix").alias("event_id"), "batch_id",
        F.col("production_line").alias("production_line_id"), "e.event_type",
        F.col("e.at").alias("event_timestamp"), "sku_id",
        F.col("target_quantity").alias("expected_output_cases"),
        F.col("e.made").alias("actual_output_cases"), F.col("e.state").alias("qc_status")))


def check_events(raw: DataFrame) -> DataFrame:
    return align(raw.select(
        F.col("check_id").alias("event_id"), "batch_id", F.lit("QC_CHECK").alias("event_type"),
        F.col("timestamp").alias("event_timestamp"), F.col("result").alias("qc_status"),
        F.col("inspector_id").alias("operator_id")))


def stoppage_events(raw: DataFrame) -> DataFrame:
    kind = F.when(F.col("category").isin(*PLANNED), "DOWNTIME_PLANNED").otherwise("DOWNTIME_UNPLANNED")
    return align(raw.select(
        "event_id", F.col("production_line").alias("production_line_id"), kind.alias("event_type"),
        F.col("start_time").alias("event_timestamp"), F.col("start_time").alias("downtime_start_ts"),
        F.col("end_time").alias("downtime_end_ts")))


def event_stream(batches: DataFrame, checks: DataFrame, stoppages: DataFrame) -> DataFrame:
    """All production events in one shape."""
    return batch_events(batches).unionByName(check_events(checks)).unionByName(stoppage_events(stoppages))


# --- inventory, master data, distribution ------------------------------------------

def map_inventory(raw: DataFrame) -> DataFrame:
    return raw.select(
        "warehouse_id", "sku_id", F.col("quantity_on_hand").alias("units_on_hand"),
        F.col("quantity_on_order").alias("units_in_transit"), _text("0").alias("units_reserved"), "snapshot_date",
        F.concat("snapshot_date", F.lit("T00:00:00")).alias("snapshot_timestamp"),
        F.col("reorder_point").alias("reorder_point_units"), _text(None).alias("standard_cost_per_unit"))


def map_products(raw: DataFrame, today: str) -> DataFrame:
    return raw.select(
        "sku_id", "product_name", F.col("category").alias("product_category"),
        F.col("sub_category").alias("product_subcategory"), _text("").alias("brand"),
        _text("").alias("packaging_type"), F.col("pack_size").alias("package_size_ml"),
        F.col("cost_price").alias("standard_cost_per_unit"), F.col("unit_price").alias("list_price"),
        _text("").alias("price_tier"), F.col("status").alias("is_active"),
        F.coalesce("launch_date", F.lit(today)).alias("record_effective_date"))


def map_customers(raw: DataFrame) -> DataFrame:
    zero = _text("0")
    return raw.select(
        F.col("customer_id").alias("retailer_id"), F.col("name").alias("retailer_name"),
        F.col("segment").alias("retail_segment"), "channel", "region", "state", _text("").alias("city"),
        "credit_terms_days", F.col("acquisition_date").alias("account_activation_date"),
        F.col("status").alias("account_status"), zero.alias("trade_spend_usd"),
        zero.alias("broker_commission_usd"), zero.alias("field_sales_cost_usd"),
        F.col("acquisition_date").alias("record_effective_date"))


def map_warehouses(raw: DataFrame) -> DataFrame:
    return raw


def map_shipments(raw: DataFrame) -> DataFrame:
    blank = _text("")
    return raw.select(
        "shipment_id", "order_id", blank.alias("retailer_id"), "warehouse_id", blank.alias("route_id"),
        F.col("carrier").alias("carrier_id"), "ship_date",
        F.col("estimated_delivery").alias("promised_delivery_date"),
        F.col("actual_delivery").alias("actual_delivery_date"), F.col("cases_shipped").alias("cases_delivered"),
        F.col("freight_cost").alias("logistics_cost_usd"), blank.alias("channel"), blank.alias("region"),
        blank.alias("state"), _text("true").alias("is_fully_shipped"), _text("0").alias("quantity_ordered"),
        F.col("cases_shipped").alias("quantity_shipped"))


# --- rules of the raw layer -----------------------------------------------------------

RAW_RULES: dict[str, tuple[q.Rule, ...]] = {
    "pos_transactions": (q.not_null(["transaction_id", "retailer_id", "sku_id"]), q.not_null(["unit_price"])),
    "erp_sales": (q.not_null(["order_id", "sku_id", "retailer_id"]), q.not_null(["invoice_price"], "warning")),
    "erp_returns": (q.not_null(["return_id"]),),
    "iot_sensor_events": (q.not_null(["event_id", "event_type"]),),
    "erp_inventory": (q.not_null(["warehouse_id", "sku_id", "units_on_hand", "snapshot_date"]),),
    "erp_products": (q.not_null(["sku_id", "product_category"]), q.not_null(["standard_cost_per_unit"])),
    "erp_customers": (q.not_null(["retailer_id"]), q.not_null(["retailer_name", "retail_segment"], "warning")),
    "erp_warehouses": (q.not_null(["warehouse_id"]),),
    "logistics_shipments": (q.not_null(["shipment_id", "order_id", "warehouse_id"]),
                            q.not_null(["promised_delivery_date"]),
                            q.not_null(["logistics_cost_usd"], "warning")),
}


def checked(df: DataFrame, feed: str) -> DataFrame:
    """Rows that pass the raw rules of a feed."""
    return q.clean_rows(q.tag(df, RAW_RULES[feed]))


# --- jobs -----------------------------------------------------------------------------

def _path(config: dict, source: str, name: str) -> str:
    return f"{config['sources'][source]['base_path']}/{name}"


def _land(mapped: DataFrame, config: dict, feed: str, source_path: str | Column, batch_id: str, run_ts: str | None = None) -> int:
    """Admit the rows of a feed and append them; returns the rows written, 0 for an empty feed."""
    at = run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    clean = admit(config, mapped, RAW_RULES[feed], None, (), str(source_path), feed, at, batch_id)
    if clean.isEmpty():
        return 0
    return sinks.append_raw(add_bronze_metadata(clean, source_path, batch_id, ingested_at=run_ts), config["tables"]["bronze"][feed])


def _keep_malformed(captured: DataFrame, config: dict, feed: str, batch_id: str, line: str) -> None:
    bad = captured.where(F.col(c.CORRUPT).isNotNull()).select(
        F.lit(feed).alias("feed"), F.lit(batch_id).alias("batch_id"), "_source_file", F.col(line).alias("raw_line"),
        F.lit("MALFORMED_RECORD").alias("reason"))
    if not bad.isEmpty():
        sinks.append_rejects(bad, config["tables"]["bronze"]["malformed_lines"])


def _csv(spark: SparkSession, config: dict, source: str, name: str, batch_id: str) -> DataFrame:
    """Well-formed rows of a delivered CSV by header name; the other lines are stored with file and reason."""
    captured = settle(files.read_feed_csv(spark, _path(config, source, f"{name}.csv"), c.LANDING[name]), f"feed-{name}")
    _keep_malformed(captured, config, name, batch_id, c.CORRUPT)
    return captured.where(F.col(c.CORRUPT).isNull()).select(*c.LANDING[name])


def _json(spark: SparkSession, config: dict, source: str, name: str, schema: T.StructType, batch_id: str) -> DataFrame:
    """Well-formed objects of a delivered NDJSON file; the other lines are stored with file and reason."""
    captured = settle(files.read_ndjson_capturing(spark, _path(config, source, f"{name}.json"), schema), f"feed-{name}")
    _keep_malformed(captured, config, name, batch_id, "_line")
    return files.well_formed(captured).drop("_source_file")


def ingest_pos_transactions(spark: SparkSession, config: dict, batch_id: str) -> int:
    raw = _json(spark, config, "pos", "pos_transactions", c.POS_SCHEMA, batch_id)
    return _land(flatten_pos(raw), config, "pos_transactions", _path(config, "pos", "pos_transactions.json"), batch_id)


def ingest_erp_sales(spark: SparkSession, config: dict, batch_id: str) -> int:
    joined = join_erp_sales(_csv(spark, config, "erp", "orders", batch_id), _csv(spark, config, "erp", "order_lines", batch_id))
    return _land(joined, config, "erp_sales", _path(config, "erp", "orders.csv"), batch_id)


def _production(spark: SparkSession, config: dict, name: str, batch_id: str) -> DataFrame:
    return _json(spark, config, "production", name, c.text_schema(*c.LANDING[name]), batch_id)


def ingest_batches(spark: SparkSession, config: dict, batch_id: str) -> DataFrame:
    return batch_events(_production(spark, config, "batches", batch_id))


def ingest_quality_checks(spark: SparkSession, config: dict, batch_id: str) -> DataFrame:
    return check_events(_production(spark, config, "quality_checks", batch_id))


def ingest_downtime_events(spark: SparkSession, config: dict, batch_id: str) -> DataFrame:
    return stoppage_events(_production(spark, config, "downtime_events", batch_id))


def ingest_production(spark: SparkSession, config: dict, batch_id: str) -> int:
    events = (ingest_batches(spark, config, batch_id)
              .unionByName(ingest_quality_checks(spark, config, batch_id))
              .unionByName(ingest_downtime_events(spark, config, batch_id)))
    return _land(events, config, "iot_sensor_events", _path(config, "production", "batches.json"), batch_id)


def _ingest_csv(spark: SparkSession, config: dict, source: str, name: str, feed: str, mapping, batch_id: str) -> int:
    mapped = mapping(_csv(spark, config, source, name, batch_id))
    return _land(mapped, config, feed, _path(config, source, f"{name}.csv"), batch_id)


def ingest_returns(spark: SparkSession, config: dict, batch_id: str) -> int:
    return _ingest_csv(spark, config, "erp", "returns", "erp_returns", map_returns, batch_id)


def ingest_inventory(spark: SparkSession, config: dict, batch_id: str) -> int:
    return _ingest_csv(spark, config, "erp", "inventory_daily", "erp_inventory", map_inventory, batch_id)


def ingest_products(spark: SparkSession, config: dict, batch_id: str, today: str | None = None) -> int:
    day = today or dt.date.today().isoformat()
    return _ingest_csv(spark, config, "erp", "products", "erp_products", lambda raw: map_products(raw, day), batch_id)


def ingest_customers(spark: SparkSession, config: dict, batch_id: str) -> int:
    return _ingest_csv(spark, config, "erp", "customers", "erp_customers", map_customers, batch_id)


def ingest_warehouses(spark: SparkSession, config: dict, batch_id: str) -> int:
    return _ingest_csv(spark, config, "erp", "warehouses", "erp_warehouses", map_warehouses, batch_id)


def ingest_shipments(spark: SparkSession, config: dict, batch_id: str) -> int:
    return _ingest_csv(spark, config, "logistics", "shipments", "logistics_shipments", map_shipments, batch_id)
