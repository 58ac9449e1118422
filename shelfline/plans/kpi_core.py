"""The four standing KPI tables over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import month_label, pct, ratio, surrogate_key


def _current_accounts(customers: DataFrame) -> DataFrame:
    return customers.where("is_current").select(
        F.col("surrogate_key").alias("customer_key"), "region", "channel")


def compute_kpi_daily_revenue(df_fact: DataFrame, df_products: DataFrame,
                              df_customers: DataFrame) -> DataFrame:
    """Revenue, cost and margin by (day, category, region, channel)."""
    category = (df_products.select(surrogate_key("sku_id").alias("product_key"), "product_category")
                .groupBy("product_key").agg(F.max("product_category").alias("product_category")))
    facts = df_fact.select("transaction_date", "product_key", "customer_key", "transaction_key",
                           "net_revenue", "cogs", "gross_margin_amount", "quantity_sold")
    total = lambda c: F.sum(c).cast("decimal(16,2)")
    kpi = (facts.join(category, "product_key", "left")
           .join(_current_accounts(df_customers), "customer_key", "left")
           .groupBy(F.col("transaction_date").alias("report_date"), "product_category", "region", "channel")
           .agg(total("net_revenue").alias("total_revenue"), total("cogs").alias("total_cogs"),
                total("gross_margin_amount").alias("total_gross_margin"),
                F.sum("quantity_sold").alias("units_sold"),
                F.count_distinct("transaction_key").alias("transaction_count")))
    margin = pct("total_gross_margin", "total_revenue")
    return kpi.withColumn("gross_margin_pct", F.when(F.col("total_revenue") > 0, margin)
                          .otherwise(F.lit(0).cast("decimal(6,2)")))


def compute_kpi_fulfillment_rate(df_ship: DataFrame, df_customers: DataFrame) -> DataFrame:
    """Delivery and fulfilment counts by (ship date, channel, region)."""
    kpi = (df_ship.join(_current_accounts(df_customers), "customer_key", "left")
           .groupBy(F.col("ship_date").alias("report_date"), "channel", "region")
           .agg(F.count("*").alias("total_shipments"),
                F.count_if("on_time_flag").alias("on_time_count"),
                F.count_if("is_fully_shipped").alias("fully_shipped_count"),
                F.sum("cases_delivered").alias("total_cases_delivered"),
                F.sum("logistics_cost_usd").cast("decimal(14,2)").alias("total_logistics_cost"),
                F.count("logistics_cost_usd").alias("_priced")))
    return kpi.withColumns({
        "avg_logistics_cost_per_shipment": ratio("total_logistics_cost", "_priced", 10, 2),
        "on_time_delivery_pct": pct("on_time_count", "total_shipments"),
        "fulfillment_rate_pct": pct("fully_shipped_count", "total_shipments"),
    }).drop("_priced")


def compute_kpi_inventory_turnover(df_inventory: DataFrame, df_sales: DataFrame) -> DataFrame:
    """Stock value against cost of goods sold by (warehouse, month)."""
    held = (df_inventory.groupBy("warehouse_key", month_label("snapshot_date").alias("report_month"))
            .agg(F.sum("inventory_value").alias("_value"), F.count("inventory_value").alias("_n"),
                 F.sum("units_on_hand").alias("total_units_on_hand")))
    sold = (df_sales.groupBy("warehouse_key", month_label("transaction_date").alias("report_month"))
            .agg(F.sum("cogs").cast("decimal(16,2)").alias("total_cogs")))
    joined = (held.withColumn("avg_inventory_value", ratio("_value", "_n", 16, 2))
              .join(sold, ["warehouse_key", "report_month"], "left"))
    rate = ratio("total_cogs", "avg_inventory_value", 8, 2)
    out = joined.withColumn("inventory_turnover_rate", F.when(F.col("avg_inventory_value") > 0, rate))
    days = ratio(F.lit(365), "inventory_turnover_rate", 8, 1)
    return out.withColumn(
        "days_inventory_outstanding", F.when(F.col("inventory_turnover_rate") > 0, days)).drop("_value", "_n")


def compute_kpi_production_yield(df_fact: DataFrame) -> DataFrame:
    """Yield, quality and downtime by (batch date, line)."""
    kpi = (df_fact.groupBy(F.col("batch_date").alias("report_date"), "production_line_id")
           .agg(F.count("*").alias("batch_count"),
                F.sum("yield_rate_pct").alias("_y"), F.count("yield_rate_pct").alias("_n"),
                F.min("yield_rate_pct").cast("decimal(6,2)").alias("min_yield_rate_pct"),
                F.max("yield_rate_pct").cast("decimal(6,2)").alias("max_yield_rate_pct"),
                F.sum("expected_output_units").alias("total_expected_units"),
                F.sum("actual_output_units").alias("total_actual_units"),
                F.sum("downtime_hours").cast("decimal(10,2)").alias("total_downtime_hours"),
                F.sum(F.col("qc_pass_flag").cast("int")).alias("_passed")))
    return kpi.withColumns({
        "avg_yield_rate_pct": ratio("_y", "_n", 6, 2),
        "qc_pass_rate_pct": pct("_passed", "batch_count"),
        "overall_yield_pct": F.when(F.col("total_expected_units") > 0,
                                    pct("total_actual_units", "total_expected_units")),
    }).drop("_y", "_n", "_passed")
