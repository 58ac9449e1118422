"""Inventory KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import ratio, surrogate_key
from shelfline.functions.time import day, week_start


def stock_levels(stock: DataFrame, reorder: DataFrame, products: DataFrame, as_of: str) -> DataFrame:
    """Stock position of one day with reorder and stock-out flags."""
    r = reorder.select("sku_id", "warehouse_id", "reorder_point_units")
    p = products.select("sku_id", "product_name", "product_category")
    today = stock.where(F.col("snapshot_date") == day(as_of)).select(
        "sku_id", "warehouse_id", "snapshot_date", "units_on_hand", "inventory_value")
    return (today.join(r, ["sku_id", "warehouse_id"]).join(p, "sku_id").withColumns({
        "stock_level_key": surrogate_key("snapshot_date", "sku_id", "warehouse_id"),
        "deficit_units": F.col("reorder_point_units") - F.col("units_on_hand"),
        "reorder_alert_flag": F.col("units_on_hand") <= F.col("reorder_point_units"),
        "stockout_flag": F.col("units_on_hand") == 0,
    }))


def _sold_where_stocked(sales: DataFrame, stock: DataFrame, as_of: str, days: int) -> DataFrame:
    """Units sold per (sku, warehouse) over the trailing window.

    The window is ``days`` before ``as_of`` up to ``as_of``, both days included. A sale
    counts for every warehouse that stocked the sku that day. Sales are summed per
    (sku, day) before the join, so a hot sku contributes one row per day.
    """
    first, last = F.date_sub(day(as_of), days), day(as_of)
    sold = (sales.where(F.col("transaction_date").between(first, last))
            .groupBy("sku_id", F.col("transaction_date").alias("snapshot_date"))
            .agg(F.sum("quantity_sold").alias("units")))
    held = stock.where(F.col("snapshot_date").between(first, last)).select("sku_id", "warehouse_id", "snapshot_date")
    return (sold.join(held, ["sku_id", "snapshot_date"])
            .groupBy("sku_id", "warehouse_id").agg(F.sum("units").alias("units")))


def turnover_30d(sales: DataFrame, stock: DataFrame, products: DataFrame, as_of: str,
                 days: int = 30, low: float = 0.5) -> DataFrame:
    """Cost of goods sold against average stock value per warehouse."""
    cost = products.select("sku_id", "standard_cost_per_unit")
    cogs = (_sold_where_stocked(sales, stock, as_of, days).join(cost, "sku_id").groupBy("warehouse_id")
            .agg(F.sum(F.col("standard_cost_per_unit") * F.col("units")).cast("decimal(18,4)").alias("cogs_30d")))
    value = (stock.where(F.col("snapshot_date").between(F.date_sub(day(as_of), days), day(as_of))).groupBy("warehouse_id")
             .agg(F.sum("inventory_value").alias("_v"), F.count("inventory_value").alias("_n")))
    kpi = cogs.join(value, "warehouse_id").withColumns({
        "week_start_date": week_start(day(as_of)),
        "avg_inventory_value_30d": ratio("_v", "_n", 18, 4),
    })
    rate = lambda factor: ratio("cogs_30d", "avg_inventory_value_30d", 18, 4, factor)
    kpi = kpi.withColumns({"inventory_turnover_rate": rate(1), "annualized_turnover": rate(12)})
    return kpi.withColumn("turnover_alert_flag",
                          F.coalesce(F.col("inventory_turnover_rate") < low, F.lit(False))).drop("_v", "_n")


def days_sales_of_inventory(sales: DataFrame, stock: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Days until today's stock is sold at the trailing pace, per (sku, warehouse)."""
    pace = _sold_where_stocked(sales, stock, as_of, days)
    today = stock.where(F.col("snapshot_date") == day(as_of)).select("sku_id", "warehouse_id", "units_on_hand")
    kpi = today.join(pace, ["sku_id", "warehouse_id"], "left").withColumns({
        "report_date": day(as_of),
        "avg_daily_sales_units": ratio("units", F.lit(days), 18, 4),
        "dsi_days": ratio(F.col("units_on_hand") * days, "units", 18, 2),
    }).drop("units")
    dsi = F.col("dsi_days")
    return kpi.withColumns({
        "dsi_warn_flag": F.coalesce((dsi < 10) | (dsi > 60), F.lit(False)),
        "dsi_critical_flag": F.coalesce(dsi < 7, F.lit(False)),
    })


def reorder_alerts(fact_inventory: DataFrame, as_of: str) -> DataFrame:
    """Positions at or below their reorder point on the newest snapshot day up to ``as_of``."""
    newest = fact_inventory.where(F.col("snapshot_date") <= day(as_of)).agg(F.max("snapshot_date")).scalar()
    return fact_inventory.where(F.col("snapshot_date") == newest).where("reorder_alert_flag")
