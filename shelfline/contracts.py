"""Landing schemas, source contracts and event schema, as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from shelfline.operators import quality as q

CORRUPT = "_corrupt_record"


def text_schema(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# Column names of the landing files.
LANDING = {
    "products": ("sku_id", "product_name", "category", "sub_category", "unit_price", "cost_price",
                 "pack_size", "shelf_life_days", "launch_date", "status"),
    "customers": ("customer_id", "name", "segment", "region", "channel", "state", "credit_terms_days",
                  "acquisition_date", "status"),
    "warehouses": ("warehouse_id", "name", "region", "capacity_cases", "address", "manager"),
    "orders": ("order_id", "customer_id", "order_date", "ship_date", "delivery_date", "status", "total_amount"),
    "order_lines": ("order_line_id", "order_id", "sku_id", "quantity", "unit_price", "discount_pct", "line_total"),
    "inventory_daily": ("snapshot_date", "warehouse_id", "sku_id", "quantity_on_hand", "reorder_point",
                        "quantity_on_order"),
    "shipments": ("shipment_id", "order_id", "warehouse_id", "carrier", "ship_date", "estimated_delivery",
                  "actual_delivery", "cases_shipped", "freight_cost", "status"),
    "returns": ("return_id", "transaction_id", "order_id", "retailer_id", "sku_id", "quantity_returned",
                "return_amount", "return_date", "return_reason_code"),
    "batches": ("batch_id", "sku_id", "production_line", "start_time", "end_time", "target_quantity",
                "actual_quantity", "yield_rate", "status"),
    "quality_checks": ("check_id", "batch_id", "check_type", "value", "min_threshold", "max_threshold",
                       "result", "timestamp", "inspector_id"),
    "downtime_events": ("event_id", "production_line", "start_time", "end_time", "reason", "category"),
}

POS_SCHEMA = T.StructType([
    *text_schema("transaction_id", "store_id", "customer_id", "timestamp").fields,
    T.StructField("items", T.ArrayType(text_schema("sku_id", "qty", "price", "discount"))),
    *text_schema("payment_method", "total").fields,
])

# The unified production event columns.
EVENT_COLUMNS = (
    "event_id", "batch_id", "production_line_id", "event_type", "event_timestamp", "sku_id",
    "expected_output_cases", "actual_output_cases", "qc_status", "downtime_start_ts",
    "downtime_end_ts", "sensor_temperature", "sensor_pressure", "operator_id",
)
EVENT_SCHEMA = text_schema(*EVENT_COLUMNS)

METADATA_COLUMNS = ("_ingested_at", "_source_file", "_batch_id", "_pipeline_run_id", "ingestion_date")

# Text formats shared by the contracts.
DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
STAMP = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}"
DECIMAL4 = "^[0-9]+([.][0-9]{1,4})?$"
NUMERIC = "^[0-9]+([.][0-9]+)?$"
SIGNED = "^-?[0-9]+([.][0-9]+)?$"
WHOLE = "^[0-9]+$"
WHOLE_OR_EMPTY = "^[0-9]*$"
SIGNED_WHOLE = "^-?[0-9]+$"
POSITIVE = "^[1-9][0-9]*$"
STATE = "^[A-Z]{2}$"
SKU = "^SKU-[A-Z0-9-]+$"
RETAILER = "^RTL-[A-Z0-9]+$"

# Closed lists of the contracts.
CHANNELS = ("Retail", "Wholesale", "DTC")
REGIONS = ("Northeast", "Southeast", "Midwest", "Southwest", "West")
SEGMENTS = ("Grocery", "Convenience", "Club", "Foodservice", "Drug", "Mass")
ACCOUNT_STATES = ("ACTIVE", "INACTIVE", "SUSPENDED")
CATEGORIES = ("Carbonated Soft Drinks", "Flavored Water", "Energy Drinks", "Juice Blends")
PACKAGING = ("Can", "Bottle", "Carton", "Keg")
TIERS = ("Economy", "Standard", "Premium")
FLAGS = ("true", "false", "TRUE", "FALSE", "1", "0")
REASONS = ("DAMAGED", "EXPIRED", "WRONG_ITEM", "QUALITY", "OTHER")
EVENT_TYPES = ("BATCH_START", "BATCH_END", "QC_CHECK", "DOWNTIME_UNPLANNED", "DOWNTIME_PLANNED")
QC_STATES = ("PASS", "FAIL", "PENDING")


@dataclass(frozen=True)
class Field:
    """Contract of one text column. ``required_if`` is a SQL condition."""

    name: str
    required: bool = False
    pattern: str | None = None
    allowed: tuple[str, ...] | None = None
    required_if: str | None = None


def _must(name: str, pattern: str | None = None, allowed: tuple[str, ...] | None = None) -> Field:
    return Field(name, True, pattern, allowed)


def _may(name: str, pattern: str | None = None, allowed: tuple[str, ...] | None = None,
         required_if: str | None = None) -> Field:
    return Field(name, False, pattern, allowed, required_if)


# The source contracts. Columns not listed are allowed.
CONTRACTS: dict[str, tuple[Field, ...]] = {
    "pos_transactions": (
        _must("transaction_id"), _must("retailer_id", RETAILER), _must("sku_id", SKU),
        _must("quantity", POSITIVE), _must("unit_price", DECIMAL4), _must("transaction_timestamp", STAMP),
        _must("channel", allowed=CHANNELS), _may("region", allowed=REGIONS), _may("state", STATE)),
    "erp_sales": (
        _must("order_id"), _must("order_line_id"), _must("retailer_id"), _must("sku_id"),
        _must("quantity_ordered", POSITIVE), _may("quantity_shipped", WHOLE), _must("invoice_price", DECIMAL4),
        _must("order_date", DATE), _may("ship_date", DATE), _must("channel", allowed=CHANNELS),
        _may("region", allowed=REGIONS), _may("state", STATE)),
    "erp_returns": (
        _must("return_id"), _must("retailer_id"), _must("sku_id"), _must("quantity_returned", POSITIVE),
        _must("return_amount", DECIMAL4), _must("return_date", DATE),
        _must("return_reason_code", allowed=REASONS)),
    "erp_inventory": (
        _must("warehouse_id"), _must("sku_id"), _must("units_on_hand", WHOLE),
        _may("units_in_transit", WHOLE_OR_EMPTY), _may("units_reserved", WHOLE_OR_EMPTY),
        _must("snapshot_date", DATE), _may("snapshot_timestamp", STAMP),
        _may("reorder_point_units", POSITIVE), _may("standard_cost_per_unit", DECIMAL4)),
    "iot_sensor_events": (
        _must("event_id"), _must("batch_id"), _must("production_line_id"),
        _must("event_type", allowed=EVENT_TYPES), _must("event_timestamp", STAMP),
        _may("expected_output_cases", POSITIVE), _may("actual_output_cases", WHOLE),
        _may("qc_status", allowed=QC_STATES),
        _may("downtime_start_ts", STAMP, required_if="event_type = 'DOWNTIME_UNPLANNED'"),
        _may("downtime_end_ts", STAMP), _may("sensor_temperature", SIGNED), _may("sensor_pressure", NUMERIC)),
    "logistics_shipments": (
        _must("shipment_id"), _must("order_id"), _must("retailer_id"), _must("warehouse_id"),
        _must("route_id"), _must("ship_date", DATE), _must("promised_delivery_date", DATE),
        _may("actual_delivery_date", DATE), _may("cases_delivered", WHOLE), _may("logistics_cost_usd", DECIMAL4),
        _must("channel", allowed=CHANNELS), _may("region", allowed=REGIONS), _may("state", STATE),
        _may("is_fully_shipped", allowed=FLAGS), _may("quantity_ordered", POSITIVE),
        _may("quantity_shipped", WHOLE)),
    "erp_customers": (
        _must("retailer_id"), _must("retailer_name"), _must("retail_segment", allowed=SEGMENTS),
        _must("channel", allowed=CHANNELS), _must("region", allowed=REGIONS), _must("state", STATE),
        _may("credit_terms_days", WHOLE), _may("account_activation_date", DATE),
        _must("account_status", allowed=ACCOUNT_STATES), _may("trade_spend_usd", DECIMAL4),
        _may("broker_commission_usd", DECIMAL4), _may("field_sales_cost_usd", DECIMAL4),
        _must("record_effective_date", DATE)),
    "erp_products": (
        _must("sku_id", SKU), _must("product_name"), _must("product_category", allowed=CATEGORIES),
        _must("brand"), _must("packaging_type", allowed=PACKAGING), _may("package_size_ml", POSITIVE),
        _must("standard_cost_per_unit", DECIMAL4), _must("list_price", DECIMAL4),
        _must("price_tier", allowed=TIERS), _must("is_active", allowed=FLAGS),
        _must("record_effective_date", DATE)),
}


def contract_rules(fields: tuple[Field, ...], severity: str = "error") -> list[q.Rule]:
    """Compile a contract: presence first, then lists and formats, then conditions."""
    rules: list[q.Rule] = []
    for f in fields:
        if f.required:
            rules.append(q.custom(f"coalesce(`{f.name}` = '', true)", f"missing_{f.name}", severity,
                                  [f.name], kind="required"))
    for f in fields:
        if f.allowed:
            rules.append(q.one_of(f.name, f.allowed, severity, optional=True))
        if f.pattern:
            rules.append(q.matches(f.name, f.pattern, severity, optional=True))
    for f in fields:
        if f.required_if:
            rules.append(q.custom(f"({f.required_if}) AND coalesce(`{f.name}` = '', true)",
                                  f"missing_{f.name}_when_required", severity, [f.name], kind="conditional"))
    return rules


def lake_config(source_root: str, lake_root: str) -> dict:
    """Where feeds are read from and tables are written to."""
    feeds = {"erp": "erp", "pos": "pos", "production": "production", "logistics": "logistics"}
    raw = ("pos_transactions", "erp_sales", "erp_returns", "erp_inventory", "iot_sensor_events",
           "logistics_shipments", "erp_customers", "erp_products", "erp_warehouses", "malformed_lines")
    conformed = ("sales_transactions", "sales_returns", "sales_spend", "inventory_stock",
                 "ref_reorder_points", "production_batches", "production_events", "shipments",
                 "customers", "products", "warehouses", "dq_rejected_records", "pipeline_monitoring")
    gold = ("dim_date", "dim_product", "dim_customer", "dim_warehouse", "dim_region", "dim_channel", "fact_sales", "fact_inventory",
            "fact_production", "fact_shipment", "kpi_daily_revenue", "kpi_inv_turnover", "kpi_prod_yield",
            "kpi_fulfillment", "fact_sales_lines", "kpi")
    return {
        "sources": {k: {"base_path": f"{source_root}/{v}"} for k, v in feeds.items()},
        "tables": {
            "bronze": {t: f"{lake_root}/raw/{t}" for t in raw},
            "silver": {t: f"{lake_root}/conformed/{t}" for t in conformed},
            "gold": {t: f"{lake_root}/gold/{t}" for t in gold},
        },
        "thresholds": {"dq_fail_rate_pct": 5.0},
    }


# Largest rejected share in percent before a load halts.
HALT_LIMITS = {
    "sales_transactions": 5.0,
    "inventory_stock": 1.0,
    "production_batches": 2.0,
    "shipments": 2.0,
    "customers": 0.5,
    "products": 0.5,
    "kpi": 0.0,
}
