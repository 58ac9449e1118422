"""Star-schema facts. Left joins keep every fact row.

Only the date dimension is broadcast: one row per calendar day bounds it.
Products, accounts and reorder points grow with the business, so their join
strategy is left to measured sizes and adaptive skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import pct, surrogate_key
from shelfline.operators.intervals import overlap_totals

DOWNTIME = ("DOWNTIME_UNPLANNED", "DOWNTIME_PLANNED")


def with_date_key(df: DataFrame, date: str, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select(F.col("date_key").cast("int"), F.col("full_date").alias("_day"))
    return df.join(F.broadcast(days), F.col(date) == F.col("_day"), "left").drop("_day")


def current_customer_keys(customers: DataFrame) -> DataFrame:
    return customers.where("is_current").select(
        "retailer_id", F.col("surrogate_key").alias("customer_key"))


def compute_fact_sales(df_txn: DataFrame, df_products: DataFrame, df_customers: DataFrame,
                       df_dim_date: DataFrame) -> DataFrame:
    """Revenue, cost and margin per sale line."""
    cost = df_products.select("sku_id", F.col("standard_cost_per_unit").alias("_cost"),
                              surrogate_key("sku_id").alias("product_key"))
    qty = F.col("quantity_sold")
    df = (with_date_key(df_txn, "transaction_date", df_dim_date)
          .join(cost, "sku_id", "left")
          .join(current_customer_keys(df_customers), "retailer_id", "left")
          .withColumn("net_revenue", (F.col("unit_price") * qty).cast("decimal(14,2)"))
          .withColumn("cogs", (F.coalesce(F.col("_cost"), F.lit(0).cast("decimal(10,2)")) * qty)
                      .cast("decimal(14,2)")))
    keep = [c for c in ("warehouse_id", "transaction_id", "channel", "region") if c in df.columns]
    warehouse = [surrogate_key("warehouse_id").alias("warehouse_key")] if "warehouse_id" in keep else []
    return df.select(
        "transaction_key", "date_key", "product_key", "customer_key", *warehouse, "quantity_sold",
        "unit_price", "net_revenue", F.lit(0).cast("decimal(10,2)").alias("return_amount"), "cogs",
        (F.col("net_revenue") - F.col("cogs")).cast("decimal(14,2)").alias("gross_margin_amount"),
        "transaction_date", "sku_id", "retailer_id", *keep)


def net_sale_lines(sales: DataFrame, returns: DataFrame, dims: list[str]) -> DataFrame:
    """Gross, returned and net amounts per (transaction, sku).

    Both sides are reduced to that grain first: the join is one to one, so neither
    repeated lines nor repeated returns multiply money. ``dims`` are attributes that
    are constant within a transaction: rows dealt by (transaction, sku) lie right for
    the sums and for the join, so sales move once.
    """
    line = (F.col("unit_price") * F.col("quantity_sold")).cast("decimal(14,2)")
    s = sales.repartition("transaction_id", "sku_id").groupBy("transaction_id", "sku_id", *dims).agg(
        F.sum(line).cast("decimal(18,4)").alias("gross_sales_amount"),
        F.sum("quantity_sold").alias("units_sold"))
    r = returns.groupBy("transaction_id", "sku_id").agg(
        F.sum("return_amount").cast("decimal(18,4)").alias("return_amount"))
    return s.join(r, ["transaction_id", "sku_id"], "left").withColumn(
        "return_amount", F.coalesce("return_amount", F.lit(0).cast("decimal(18,4)"))).withColumn(
        "net_revenue", (F.col("gross_sales_amount") - F.col("return_amount")).cast("decimal(18,4)"))


def fact_sales_full(sales: DataFrame, returns: DataFrame, products: DataFrame,
                    history: DataFrame) -> DataFrame:
    """Sale fact with real returns, all dimension keys and the margin share."""
    lines = net_sale_lines(sales, returns, ["transaction_date", "retailer_id", "channel", "region"])
    cost = products.select("sku_id", F.col("standard_cost_per_unit").alias("_cost"))
    who = history.where("is_current").select(
        "retailer_id", surrogate_key("retailer_id", "valid_from").alias("customer_key"))
    out = (lines.join(cost, "sku_id", "left").join(who, "retailer_id", "left")
           .withColumn("cogs", (F.coalesce("_cost", F.lit(0).cast("decimal(10,2)"))
                                * F.col("units_sold")).cast("decimal(18,4)"))
           .withColumn("gross_margin_amount", (F.col("net_revenue") - F.col("cogs")).cast("decimal(18,4)")))
    return out.select(
        surrogate_key("transaction_id", "sku_id").alias("transaction_key"),
        F.date_format("transaction_date", "yyyyMMdd").cast("int").alias("date_key"),
        surrogate_key("sku_id").alias("product_key"), "customer_key",
        surrogate_key("channel").alias("channel_key"), surrogate_key("region").alias("region_key"),
        "transaction_date", "sku_id", "retailer_id", "units_sold", "gross_sales_amount",
        "return_amount", "net_revenue", "cogs", "gross_margin_amount",
        pct("gross_margin_amount", "net_revenue", 18, 4).alias("gross_margin_pct"))


def sales_line_fact(sales: DataFrame, returns: DataFrame, shipments: DataFrame, products: DataFrame, customers: DataFrame,
                    run_ts: str) -> DataFrame:
    """Sale fact of one row a line: real returns, all dimension keys, the warehouse that shipped it, the margin share.

    Returns name a receipt and a product; their sum stands at that product's first line of the
    receipt, so no money is counted twice. Receipts name no warehouse; the lines of an order
    take the least of the warehouses that shipped it.
    """
    money = "decimal(18,4)"
    returned = returns.groupBy("transaction_id", "sku_id").agg(F.sum("return_amount").cast(money).alias("_amount"))
    first = (sales.select("transaction_id", "sku_id", "transaction_key").join(returned, ["transaction_id", "sku_id"])
             .groupBy("transaction_id", "sku_id").agg(F.min("transaction_key").alias("transaction_key"), F.first("_amount").alias("return_amount"))
             .select("transaction_key", "return_amount"))
    shipped = (shipments.where("order_id IS NOT NULL").groupBy(F.col("order_id").alias("transaction_id"))
               .agg(F.min("warehouse_id").alias("_warehouse")))
    cost = products.select("sku_id", F.col("standard_cost_per_unit").alias("_cost"))
    who = customers.where("is_current").select("retailer_id", surrogate_key("retailer_id", "valid_from").alias("customer_key"))
    none, qty = F.lit(0).cast(money), F.col("quantity_sold")
    lines = (sales.join(first, "transaction_key", "left").join(shipped, "transaction_id", "left")
             .join(cost, "sku_id", "left").join(who, "retailer_id", "left")
             .withColumns({"gross_sales_amount": (F.col("unit_price") * qty).cast(money), "return_amount": F.coalesce("return_amount", none),
                           "cogs": (F.coalesce("_cost", F.lit(0).cast("decimal(10,2)")) * qty).cast(money)})
             .withColumn("net_revenue", (F.col("gross_sales_amount") - F.col("return_amount")).cast(money))
             .withColumn("gross_margin_amount", (F.col("net_revenue") - F.col("cogs")).cast(money)))
    return lines.select(
        "transaction_key", F.date_format("transaction_date", "yyyyMMdd").cast("int").alias("date_key"),
        surrogate_key("sku_id").alias("product_key"), "customer_key",
        F.when(F.col("_warehouse").isNotNull(), surrogate_key("_warehouse")).alias("warehouse_key"),
        surrogate_key("channel").alias("channel_key"), surrogate_key("region").alias("region_key"),
        "transaction_date", "transaction_id", "sku_id", "retailer_id", "quantity_sold", "unit_price", "gross_sales_amount", "return_amount",
        "net_revenue", "cogs", "gross_margin_amount", pct("gross_margin_amount", "net_revenue", 18, 4).alias("gross_margin_pct"),
        F.lit(run_ts).cast("timestamp").alias("last_updated_ts"))


def compute_fact_inventory_snapshot(df_stock: DataFrame, df_rop: DataFrame,
                                    df_dim_date: DataFrame) -> DataFrame:
    """Stock per (sku, warehouse, day) with its reorder alert."""
    points = df_rop.select("sku_id", "warehouse_id", F.col("reorder_point_units").alias("_rop"))
    # The stock feed's own value gives way to the maintained reorder table.
    stock = df_stock.drop("reorder_point_units", "reorder_alert_flag")
    rop = F.coalesce("_rop", F.lit(0)).cast("int")
    df = with_date_key(stock.join(points, ["sku_id", "warehouse_id"], "left"), "snapshot_date", df_dim_date)
    return df.select(
        surrogate_key("sku_id", "warehouse_id", "snapshot_date").alias("snapshot_key"),
        "date_key", surrogate_key("sku_id").alias("product_key"),
        surrogate_key("warehouse_id").alias("warehouse_key"), "units_on_hand", "inventory_value",
        rop.alias("reorder_point_units"), (F.col("units_on_hand") <= rop).alias("reorder_alert_flag"),
        "dsi_days", "snapshot_date", "sku_id", "warehouse_id")


def compute_fact_production_batch(df_batches: DataFrame, df_events: DataFrame,
                                  df_dim_date: DataFrame) -> DataFrame:
    """Batch fact with the hours of the stoppages recorded against the batch, planned and unplanned."""
    none = F.lit(0).cast("decimal(8,2)")
    kind = lambda name: F.sum(F.when(F.col("event_type") == name, F.col("downtime_hours"))).cast("decimal(8,2)")
    lost = (df_events.where(F.col("event_type").isin(*DOWNTIME) & F.col("batch_id").isNotNull())
            .groupBy("batch_id").agg(F.sum("downtime_hours").cast("decimal(8,2)").alias("_lost"),
                                     kind("DOWNTIME_PLANNED").alias("_planned"), kind("DOWNTIME_UNPLANNED").alias("_unplanned")))
    joined = with_date_key(df_batches.join(lost, "batch_id", "left"), "batch_date", df_dim_date)
    return joined.select(
        "batch_key", "date_key", surrogate_key("sku_id").alias("product_key"),
        F.lit(None).cast("bigint").alias("warehouse_key"), "batch_id", "production_line_id",
        F.col("expected_output_cases").cast("int").alias("expected_output_units"),
        F.col("actual_output_cases").cast("int").alias("actual_output_units"),
        "yield_rate_pct", "qc_pass_flag", "qc_status",
        F.coalesce("_lost", none).alias("downtime_hours"), F.coalesce("_planned", none).alias("planned_downtime_hours"),
        F.coalesce("_unplanned", none).alias("unplanned_downtime_hours"), "batch_date")


def attribute_downtime(df_batches: DataFrame, df_events: DataFrame) -> DataFrame:
    """Seconds of line stoppages that overlap each batch, all and unplanned.

    Stoppages name a line, not a batch, so they are matched by time, through running totals.
    """
    spans = df_batches.select("batch_id", "production_line_id", "batch_start_ts", "batch_end_ts")
    stops = (df_events.where(F.col("event_type").isin(*DOWNTIME))
             .select("production_line_id", "event_type", "downtime_start_ts", "downtime_end_ts"))
    return overlap_totals(spans, stops, "production_line_id", "batch_id", ("batch_start_ts", "batch_end_ts"),
                          ("downtime_start_ts", "downtime_end_ts"), F.col("event_type") == "DOWNTIME_UNPLANNED").select(
        "batch_id", F.col("overlaps").alias("stoppages"), F.col("seconds").alias("downtime_seconds"),
        F.col("flagged_seconds").alias("unplanned_seconds"))


def booked_hours(attributed: DataFrame) -> DataFrame:
    """Attributed seconds as one planned and one unplanned entry of hours per batch."""
    hours = lambda s: (s.cast("decimal(18,0)") / F.lit(3600).cast("decimal(4,0)")).cast("decimal(20,10)")
    planned = F.col("downtime_seconds") - F.col("unplanned_seconds")
    entry = lambda kind, s: F.struct(F.lit(kind).alias("event_type"), hours(s).alias("downtime_hours"))
    return attributed.select("batch_id", F.explode(F.array(
        entry("DOWNTIME_PLANNED", planned), entry("DOWNTIME_UNPLANNED", F.col("unplanned_seconds")))).alias("e")).select("batch_id", "e.*")


def compute_fact_shipment(df_ship: DataFrame, df_customers: DataFrame,
                          df_dim_date: DataFrame) -> DataFrame:
    """Shipment fact with its dimension keys."""
    df = (with_date_key(df_ship, "ship_date", df_dim_date)
          .join(current_customer_keys(df_customers), "retailer_id", "left"))
    return df.select(
        "shipment_key", "date_key", "customer_key",
        surrogate_key("warehouse_id").alias("warehouse_key"),
        surrogate_key("channel").alias("channel_key"), surrogate_key("region").alias("region_key"),
        "shipment_id", "route_id", "promised_delivery_date", "actual_delivery_date", "on_time_flag",
        "cases_delivered", "logistics_cost_usd", "is_fully_shipped", "ship_date")
