"""Conformed layer: typed, deduplicated, validated entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import (
    as_bool, as_date, as_decimal, as_int, as_timestamp, hours_between, pct, ratio, surrogate_key,
)
from shelfline.functions.parse import is_true_word
from shelfline.operators import quality as q
from shelfline.operators.dedup import latest_per_key

# Channels and event types accepted by the conformed layer.
CHANNELS = ("Retail", "Wholesale", "DTC")
BATCH_EVENTS = ("BATCH_START", "BATCH_END")
OTHER_EVENTS = ("QC_CHECK", "DOWNTIME_UNPLANNED", "DOWNTIME_PLANNED")
QC_STATES = ("PASS", "FAIL", "PENDING")
REASON_CODES = ("DAMAGED", "EXPIRED", "WRONG_ITEM", "QUALITY", "OTHER")


def stamp(df: DataFrame, run_ts: str | Column | None, batch: str | Column | None = None) -> DataFrame:
    """Audit columns. The run time is a parameter; without one the clock is used."""
    now = F.current_timestamp() if run_ts is None else (
        F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts)
    if batch is None:
        batch = F.col("_batch_id") if "_batch_id" in df.columns else F.lit(None).cast("string")
    elif isinstance(batch, str):
        batch = F.lit(batch)
    return df.withColumns({"created_at": now, "updated_at": now, "_source_batch_id": batch})


# --- sales -----------------------------------------------------------------

def line_amount() -> Column:
    return (F.col("unit_price") * F.col("quantity_sold")).try_cast("decimal(12,2)")


def cast_and_validate_sales_transactions(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Type the raw text columns of sale lines; dirt becomes NULL."""
    typed = df.withColumns({
        "quantity_sold": as_int("quantity"),
        "unit_price": as_decimal("unit_price", 10, 2),
        "transaction_timestamp": as_timestamp("transaction_timestamp"),
        "transaction_date": as_timestamp("transaction_timestamp").cast("date"),
        "transaction_key": surrogate_key("transaction_id", "sku_id"),
    })
    return stamp(typed.withColumn("net_line_amount", line_amount()), run_ts)


def deduplicate_transactions(df: DataFrame) -> DataFrame:
    """Latest ingested row per (transaction, sku)."""
    return latest_per_key(df, ["transaction_id", "sku_id"], ["_ingested_at"])


def compute_net_line_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("net_line_amount", line_amount())


SALES_INPUT_RULES = (q.not_null(["transaction_id", "retailer_id", "sku_id"]),)
SALES_OUTPUT_RULES = (
    q.not_null(["transaction_id", "transaction_date"]),
    q.in_range("unit_price", 0.01, 10000, "error"),
    q.in_range("quantity_sold", 1, None, "error"),
    q.custom("channel NOT IN ('Retail','Wholesale','DTC') AND channel IS NOT NULL",
             "_dq_invalid_channel", columns=["channel"]),
)


def shape_sales(present: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Typed sale lines, the latest of each position of a receipt.

    Unlike ``deduplicate_transactions``, a product named twice on a receipt stays two lines.
    """
    typed = cast_and_validate_sales_transactions(present, run_ts).withColumn(
        "transaction_key", surrogate_key("transaction_id", "line_no", "sku_id"))
    return compute_net_line_amount(latest_per_key(typed, ["transaction_id", "line_no", "sku_id"], ["_ingested_at"]))


def erp_sale_lines(raw: DataFrame) -> DataFrame:
    """Invoice lines in the shape of raw sale lines; the order line is the position."""
    return raw.select(
        F.col("order_id").alias("transaction_id"), F.col("order_line_id").alias("line_no"), "retailer_id", "sku_id",
        F.col("quantity_shipped").alias("quantity"), F.col("invoice_price").alias("unit_price"), "discount_pct",
        F.col("order_date").alias("transaction_timestamp"), F.when(F.col("channel") != "", F.col("channel")).alias("channel"),
        "region", "state", "_ingested_at", "_batch_id")


def conform_sales(raw: DataFrame, run_ts: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw sale lines to (valid conformed rows, rejected conformed rows)."""
    present = q.clean_rows(q.tag(raw, SALES_INPUT_RULES))
    typed = compute_net_line_amount(deduplicate_transactions(
        cast_and_validate_sales_transactions(present, run_ts)))
    tagged = q.tag(typed, SALES_OUTPUT_RULES)
    return q.clean_rows(tagged), q.rejected_rows(tagged, SALES_OUTPUT_RULES)


def combine_sales(pos: DataFrame, erp: DataFrame) -> DataFrame:
    """Point-of-sale and invoice lines in one table with their origin."""
    return (pos.withColumn("source", F.lit("POS"))
            .unionByName(erp.withColumn("source", F.lit("ERP")), allowMissingColumns=True))


RETURN_RULES = (
    q.not_null(["return_id"]),
    q.custom("quantity_returned IS NULL OR quantity_returned <= 0", "bad_quantity", "error"),
    q.custom("return_amount IS NULL OR return_amount <= 0", "bad_amount", "error"),
    q.not_null(["return_date"]),
    q.one_of("return_reason_code", REASON_CODES, "warning"),
)


def cast_returns(raw: DataFrame) -> DataFrame:
    """Type the raw text columns of returns, the latest row of each."""
    typed = raw.withColumns({
        "quantity_returned": as_int("quantity_returned"), "return_amount": as_decimal("return_amount", 14, 2),
        "return_date": as_date("return_date")})
    return latest_per_key(typed, ["return_id"], ["return_date"])


def conform_returns(typed: DataFrame, sales: DataFrame) -> DataFrame:
    """Latest valid row per return, with reason and orphan flags."""
    newest = latest_per_key(typed, ["return_id"], ["return_date"])
    return link_returns(q.clean_rows(q.tag(newest, RETURN_RULES)), sales)


def link_returns(valid: DataFrame, sales: DataFrame) -> DataFrame:
    """Valid returns with their key and whether their receipt is unknown."""
    known = sales.select("transaction_id").distinct().withColumn("_known", F.lit(True))
    return (valid.join(known, "transaction_id", "left")
            .withColumn("is_orphan", F.col("transaction_id").isNotNull() & F.col("_known").isNull())
            .withColumn("return_key", surrogate_key("return_id"))
            .drop("_known"))


SPEND_RULES = (
    q.not_null(["retailer_id"]),
    q.custom("trade_spend_usd < 0 OR broker_commission_usd < 0 OR field_sales_cost_usd < 0",
             "negative_spend", "error"),
    q.custom("period_end_date <= period_start_date", "bad_period", "error"),
)


def total_spend(feed: DataFrame) -> DataFrame:
    """The three parts of spend added up, with the key."""
    total = (F.col("trade_spend_usd") + F.col("broker_commission_usd")
             + F.col("field_sales_cost_usd")).cast("decimal(14,4)")
    return feed.withColumns({
        "total_acquisition_cost_usd": total,
        "spend_key": surrogate_key("retailer_id", "period_start_date"),
    })


def conform_spend(feed: DataFrame) -> DataFrame:
    """Valid spend per retailer and period."""
    return q.clean_rows(q.tag(total_spend(feed), SPEND_RULES))


# --- inventory -------------------------------------------------------------

def cast_inventory_columns(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    ints = ("units_on_hand", "units_in_transit", "units_reserved", "reorder_point_units")
    return stamp(df.withColumns({
        **{c: as_int(c) for c in ints},
        "standard_cost_per_unit": as_decimal("standard_cost_per_unit", 10, 2),
        "snapshot_date": as_date("snapshot_date"),
        "snapshot_timestamp": as_timestamp("snapshot_timestamp"),
    }), run_ts)


def compute_inventory_value(df: DataFrame) -> DataFrame:
    return df.withColumn("inventory_value", (
        F.col("units_on_hand") * F.col("standard_cost_per_unit")).try_cast("decimal(14,2)"))


def compute_days_of_supply(df: DataFrame) -> DataFrame:
    """Stock divided by a weekly replenishment proxy with a floor of one unit a day."""
    daily = F.coalesce(ratio("units_in_transit", F.lit(7), 10, 2), F.lit(1).cast("decimal(10,2)"))
    floor = F.greatest(daily, F.lit(1).cast("decimal(10,2)"))
    return df.withColumn("dsi_days", ratio("units_on_hand", floor, 8, 1))


def fill_cost(df: DataFrame, products: DataFrame) -> DataFrame:
    """Use the product's standard cost where the stock feed has none."""
    known = products.select("sku_id", F.col("standard_cost_per_unit").alias("_cost"))
    return (df.join(known, "sku_id", "left")
            .withColumn("standard_cost_per_unit", F.coalesce("standard_cost_per_unit", "_cost"))
            .drop("_cost"))


STOCK_INPUT_RULES = (q.not_null(["warehouse_id", "sku_id", "units_on_hand", "snapshot_date"]),)
STOCK_OUTPUT_RULES = (
    q.in_range("units_on_hand", 0, None, "error"),
    q.in_range("units_in_transit", 0, None, "error"),
    q.in_range("standard_cost_per_unit", 0.01, None, "warning"),
)


def shape_stock(present: DataFrame, products: DataFrame | None = None, run_ts: str | None = None) -> DataFrame:
    """Typed and valued stock, the latest row of each position and day."""
    newest = latest_per_key(present, ["warehouse_id", "sku_id", "snapshot_date"], ["_ingested_at"])
    typed = cast_inventory_columns(newest, run_ts)
    if products is not None:
        typed = fill_cost(typed, products)
    return compute_days_of_supply(compute_inventory_value(typed)).withColumns({
        "units_available": F.col("units_on_hand") - F.coalesce("units_reserved", F.lit(0)),
        "stock_key": surrogate_key("warehouse_id", "sku_id", "snapshot_date"),
    })


def conform_stock(raw: DataFrame, products: DataFrame | None = None,
                  run_ts: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw snapshots to (valid stock, rejected stock)."""
    tagged = q.tag(shape_stock(q.clean_rows(q.tag(raw, STOCK_INPUT_RULES)), products, run_ts), STOCK_OUTPUT_RULES)
    return q.clean_rows(tagged), q.rejected_rows(tagged, STOCK_OUTPUT_RULES)


def reorder_points(stock: DataFrame) -> DataFrame:
    """Reorder point of the latest snapshot per (sku, warehouse), of equal dates the least; a fifth is safety stock.

    One aggregate by the key: Spark knows the key to be unique, and leaves out a join to it where no column of it is read.
    """
    points = F.col("reorder_point_units")
    # Of one date a missing point counts as the least, as in an ascending sort.
    order = F.struct("snapshot_date", points.isNull(), -points.cast("bigint"))
    newest = stock.groupBy("sku_id", "warehouse_id").agg(F.max_by(points, order).alias("reorder_point_units"))
    fifth = points.cast("decimal(12,0)") * F.lit("0.2").cast("decimal(2,1)")
    return newest.withColumn("safety_stock_units", fifth.cast("int"))


# --- production ------------------------------------------------------------

def compute_yield_rate(df: DataFrame) -> DataFrame:
    """Actual over expected in percent; NULL without a positive expectation."""
    rate = pct("actual_output_cases", "expected_output_cases", 5, 2)
    return df.withColumn("yield_rate_pct", F.when(F.col("expected_output_cases") > 0, rate))


def compute_downtime_hours(df: DataFrame) -> DataFrame:
    return df.withColumn("downtime_hours", hours_between("downtime_start_ts", "downtime_end_ts"))


def aggregate_batch_qc(df_batches: DataFrame, df_events: DataFrame) -> DataFrame:
    """Batch verdict: PASS iff no failed check; without checks the own status decides."""
    verdict = df_events.where("event_type = 'QC_CHECK'").groupBy("batch_id").agg(_checks_passed().alias("_ok"))
    return _judged(df_batches.join(verdict, "batch_id", "left"))


def _checks_passed() -> Column:
    """Whether no check failed; NULL without a check."""
    is_check = F.col("event_type") == "QC_CHECK"
    return F.bool_and(F.when(is_check, ~F.coalesce(F.col("qc_status") == "FAIL", F.lit(False))))


def _judged(batches: DataFrame) -> DataFrame:
    own = F.when(F.col("qc_status") == "PASS", True).when(F.col("qc_status") == "FAIL", False)
    return (batches.withColumn("qc_pass_flag", F.coalesce("_ok", own))
            .withColumn("qc_status", F.when(F.col("_ok"), "PASS").when(~F.col("_ok"), "FAIL")
                        .otherwise(F.col("qc_status")))
            .drop("_ok"))


def _fold(end_events: Column) -> list[Column]:
    is_end = F.col("event_type") == "BATCH_END"
    is_start = F.col("event_type") == "BATCH_START"
    when = F.struct("event_timestamp", "event_id")
    end = F.struct("production_line_id", "sku_id", "expected_output_cases", "actual_output_cases",
                   "qc_status", F.col("event_timestamp").alias("batch_end_ts"))
    return [F.min_by(F.when(is_end, end), F.when(is_end, when)).alias("_end"),
            F.min(F.when(is_start, F.col("event_timestamp"))).alias("batch_start_ts"), end_events.alias("end_events")]


def pair_batches(events: DataFrame) -> DataFrame:
    """One row per finished batch, folding its start and end events in one aggregate.

    Of several end events the earliest counts; the count of all end events stays
    visible in ``end_events``. No self join, and partial aggregation reduces a hot
    batch before the shuffle.
    """
    count = F.count_if(F.col("event_type") == "BATCH_END")
    return _paired(events.where(F.col("event_type").isin(*BATCH_EVENTS)).groupBy("batch_id").agg(*_fold(count)))


def _paired(folded: DataFrame) -> DataFrame:
    kept = [c for c in folded.columns if c not in ("batch_id", "_end", "batch_start_ts", "end_events")]
    out = folded.where("end_events > 0 AND batch_id IS NOT NULL").select(
        "batch_id", "_end.*", "batch_start_ts", "end_events", *kept)
    status = F.col("qc_status")
    return out.withColumns({
        "batch_date": as_timestamp("batch_start_ts").cast("date"),
        "batch_key": surrogate_key("batch_id"),
        # Source states such as "completed" are not a verdict.
        "qc_status": F.when(status.isNull() | status.isin(*QC_STATES), status).otherwise("PENDING"),
    })


def fold_batches(events: DataFrame) -> DataFrame:
    """All that a batch's events say of it, one row a batch: usable as the state of a stream.

    Every part is a minimum, a set or a conjunction, so a repeated event changes nothing and
    events may come in any order.
    """
    ends = F.collect_set(F.when(F.col("event_type") == "BATCH_END", F.col("event_id")))
    folded = events.where("batch_id IS NOT NULL AND event_id IS NOT NULL").groupBy("batch_id").agg(
        *_fold(F.size(ends).cast("bigint")), _checks_passed().alias("_ok"))
    return folded


def finish_batches(folded: DataFrame) -> DataFrame:
    """Finished batches out of ``fold_batches``, equal to ``conform_batches`` of the same events."""
    tagged = q.tag(_typed_batches(_paired(folded)), BATCH_RULES[2:])
    return _judged(q.clean_rows(tagged))


BATCH_RULES = (
    q.not_null(["batch_id"]),
    q.unique(["batch_id"]),
    q.in_range("expected_output_cases", 1, None, "error"),
    q.in_range("yield_rate_pct", 0, 110, "warning"),
)


def conform_events(events: DataFrame) -> DataFrame:
    """Quality checks and stoppages, typed, with stoppage hours."""
    typed = events.where(F.col("event_type").isin(*OTHER_EVENTS)).withColumns({
        "event_timestamp": as_timestamp("event_timestamp"),
        "event_date": as_timestamp("event_timestamp").cast("date"),
        "downtime_start_ts": as_timestamp("downtime_start_ts"),
        "downtime_end_ts": as_timestamp("downtime_end_ts"),
        "event_key": surrogate_key("event_id"),
    })
    for sensor in ("sensor_temperature", "sensor_pressure"):
        if sensor in typed.columns:
            typed = typed.withColumn(sensor, as_decimal(sensor, 6, 2))
    return compute_downtime_hours(typed)


def shape_batches(events: DataFrame) -> DataFrame:
    """Typed finished batches with their yield, still to be checked."""
    return _typed_batches(pair_batches(events))


def _typed_batches(paired: DataFrame) -> DataFrame:
    return compute_yield_rate(paired.withColumns({
        "expected_output_cases": as_int("expected_output_cases"),
        "actual_output_cases": as_int("actual_output_cases"),
        "batch_start_ts": as_timestamp("batch_start_ts"),
        "batch_end_ts": as_timestamp("batch_end_ts"),
    }))


def conform_batches(events: DataFrame) -> DataFrame:
    """Finished batches with yield and quality verdict."""
    # pair_batches yields unique, non-null batch ids: only the row rules remain.
    tagged = q.tag(shape_batches(events), BATCH_RULES[2:])
    return aggregate_batch_qc(q.clean_rows(tagged), events)


# --- distribution ----------------------------------------------------------

def cast_shipment_columns(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    return stamp(df.withColumns({
        **{c: as_date(c) for c in ("ship_date", "promised_delivery_date", "actual_delivery_date")},
        **{c: as_int(c) for c in ("cases_delivered", "quantity_ordered", "quantity_shipped")},
        "logistics_cost_usd": as_decimal("logistics_cost_usd", 10, 2),
        "is_fully_shipped": as_bool("is_fully_shipped"),
    }), run_ts)


def compute_on_time_flag(df: DataFrame) -> DataFrame:
    """An undelivered shipment is not on time."""
    return df.withColumn("on_time_flag", F.coalesce(
        F.col("actual_delivery_date") <= F.col("promised_delivery_date"), F.lit(False)))


SHIPMENT_INPUT_RULES = (q.not_null(["shipment_id", "order_id", "warehouse_id"]),)
SHIPMENT_OUTPUT_RULES = (
    q.not_null(["shipment_id", "promised_delivery_date"]),
    q.in_range("cases_delivered", 0, None, "warning"),
    q.in_range("logistics_cost_usd", 0, None, "warning"),
)


def shape_shipments(present: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Typed shipments, the latest row of each."""
    newest = latest_per_key(present, ["shipment_id"], ["_ingested_at"])
    return compute_on_time_flag(cast_shipment_columns(newest, run_ts)).withColumn("shipment_key", surrogate_key("shipment_id"))


def conform_shipments(raw: DataFrame, run_ts: str | None = None) -> tuple[DataFrame, DataFrame]:
    tagged = q.tag(shape_shipments(q.clean_rows(q.tag(raw, SHIPMENT_INPUT_RULES)), run_ts), SHIPMENT_OUTPUT_RULES)
    return q.clean_rows(tagged), q.rejected_rows(tagged, SHIPMENT_OUTPUT_RULES)


def resolve_shipment_party(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    """Fill the retailer of a shipment from its order.

    ``orders`` may hold many lines per order: only the orders shipped here are kept
    and folded to one row each, so the join never multiplies shipments.
    """
    wanted = shipments.select("order_id").distinct()
    header = (orders.join(wanted, "order_id", "left_semi").groupBy("order_id")
              .agg(F.min("retailer_id").alias("_buyer")))
    return (shipments.join(header, "order_id", "left")
            .withColumn("retailer_id", F.coalesce(
                F.when(F.col("retailer_id") != "", F.col("retailer_id")), "_buyer")).drop("_buyer"))


def order_fully_shipped(lines: DataFrame) -> DataFrame:
    """Orders whose every line shipped at least what was ordered."""
    return lines.groupBy("order_id").agg(
        F.bool_and(F.col("quantity_shipped") >= F.col("quantity_ordered")).alias("is_fully_shipped"),
        F.count("*").alias("line_count"))


# --- master data -----------------------------------------------------------

def transform_products(df: DataFrame, run_ts: str | None = None,
                       active_words: tuple[str, ...] = ("active",)) -> DataFrame:
    """Current product per sku, typed."""
    typed = df.withColumns({
        "package_size_ml": as_int("package_size_ml"),
        "standard_cost_per_unit": as_decimal("standard_cost_per_unit", 10, 2),
        "list_price": as_decimal("list_price", 10, 2),
        "is_active": F.coalesce(is_true_word("is_active", active_words), F.lit(False)),
        "record_effective_date": as_date("record_effective_date"),
    })
    return stamp(latest_per_key(typed, ["sku_id"], ["record_effective_date"]), run_ts)


def transform_customers(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Typed account feed, ready for the version history."""
    spend = ("trade_spend_usd", "broker_commission_usd", "field_sales_cost_usd")
    return stamp(df.withColumns({
        "credit_terms_days": as_int("credit_terms_days"),
        "account_activation_date": as_date("account_activation_date"),
        "record_effective_date": as_date("record_effective_date"),
        **{c: as_decimal(c, 12, 2) for c in spend if c in df.columns},
    }), run_ts)


def transform_warehouses(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    latest = ["_ingested_at"] if "_ingested_at" in df.columns else []
    return stamp(latest_per_key(df, ["warehouse_id"], latest), run_ts)


TRACKED_ACCOUNT_COLUMNS = ("retailer_name", "retail_segment", "channel", "region", "state",
                           "account_status", "credit_terms_days")
