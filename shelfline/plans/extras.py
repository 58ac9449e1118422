"""Further analyses named by the product text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import pct, ratio
from shelfline.functions.time import day, week_start
from shelfline.operators.dedup import latest_per_key
from shelfline.operators.intervals import allocate_in_order
from shelfline.operators.ranking import top_per_group
from shelfline.plans.facts import net_sale_lines


def top_skus(sales: DataFrame, returns: DataFrame, k: int = 5) -> DataFrame:
    """Best skus by net revenue of every (week, region, channel)."""
    lines = net_sale_lines(sales, returns, ["transaction_date", "region", "channel"])
    weekly = lines.groupBy(week_start("transaction_date").alias("week_start_date"), "region", "channel", "sku_id").agg(
        F.sum("net_revenue").cast("decimal(18,4)").alias("net_revenue"))
    return top_per_group(weekly, ["week_start_date", "region", "channel"],
                         [F.desc("net_revenue"), F.asc("sku_id")], k, "sku_rank")


def stockout_forecast(sales: DataFrame, stock: DataFrame, as_of: str, days: int = 7,
                      alert_days: int = 7) -> DataFrame:
    """Days until the newest stock runs out at the trailing sales pace."""
    today = day(as_of)
    d = F.col("transaction_date")
    pace = (sales.where((d > F.date_sub(today, days)) & (d <= today)).groupBy("sku_id", "warehouse_id")
            .agg(F.sum("quantity_sold").alias("units_sold")))
    held = latest_per_key(
        stock.where(F.col("snapshot_date") <= today).select("sku_id", "warehouse_id", "snapshot_date", "units_on_hand"),
        ["sku_id", "warehouse_id"], ["snapshot_date"])
    out = held.join(pace, ["sku_id", "warehouse_id"]).withColumn(
        "days_to_stockout", ratio(F.col("units_on_hand") * days, "units_sold", 18, 1))
    return out.withColumn("stockout_alert", F.coalesce(F.col("days_to_stockout") < alert_days, F.lit(False)))


def yield_anomalies(kpi_yield: DataFrame, history_days: int = 14, trend_days: int = 21) -> DataFrame:
    """Daily line yield against the line's own past, and its trend.

    Basis points keep the arithmetic in integers: outside two standard deviations
    of the preceding days, or a falling regression line over three weeks.
    """
    base = kpi_yield.where("report_date IS NOT NULL AND total_expected_units > 0").select(
        "production_line_id", "report_date",
        F.expr("total_actual_units * 10000 div total_expected_units").alias("yield_bp"),
        F.datediff("report_date", F.lit("1970-01-01").cast("date")).cast("bigint").alias("_x"))
    line = Window.partitionBy("production_line_id").orderBy("_x")
    past, trend = line.rangeBetween(-history_days, -1), line.rangeBetween(-(trend_days - 1), 0)
    y, x = F.col("yield_bp"), F.col("_x")
    s = base.withColumns({
        "_n": F.count(y).over(past), "_s": F.sum(y).over(past), "_q": F.sum(y * y).over(past),
        "_tn": F.count(y).over(trend), "_tx": F.sum(x).over(trend), "_ty": F.sum(y).over(trend),
        "_txy": F.sum(x * y).over(trend), "_txx": F.sum(x * x).over(trend)})
    gap = F.col("_n") * y - F.col("_s")
    spread = F.col("_n") * F.col("_q") - F.col("_s") * F.col("_s")
    rise = F.col("_tn") * F.col("_txy") - F.col("_tx") * F.col("_ty")
    run = F.col("_tn") * F.col("_txx") - F.col("_tx") * F.col("_tx")
    return s.select(
        "production_line_id", "report_date", "yield_bp", F.col("_n").alias("history_days"),
        F.coalesce((F.col("_n") >= 5) & (gap * gap * (F.col("_n") - 1) > F.lit(4) * F.col("_n") * spread),
                   F.lit(False)).alias("is_outlier"),
        ratio(rise, run, 18, 4).alias("slope_bp_per_day"),
        F.coalesce((F.col("_tn") >= 15) & (rise < 0), F.lit(False)).alias("is_declining"))


def batch_to_shelf(batches: DataFrame, shipments: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales of a batch's sku by the retailers that received the batch, from the first
    delivery on.

    What a retailer sold of a product from a day on is a running total over its days; deliveries
    look theirs up by day, so neither batches nor sale days multiply.
    """
    sent = (shipments.where("batch_id IS NOT NULL").groupBy("batch_id", "retailer_id")
            .agg(F.min("ship_date").alias("first_ship"), F.count("*").alias("shipments")))
    reach = batches.select("batch_id", "sku_id").join(sent, "batch_id")
    sold = sales.groupBy("retailer_id", "sku_id", F.col("transaction_date").alias("first_ship")).agg(
        F.count("*").alias("lines"), F.sum("quantity_sold").alias("units"))
    asked = reach.select("retailer_id", "sku_id", "first_ship").distinct().select(
        "*", F.lit(0).cast("bigint").alias("lines"), F.lit(0).cast("bigint").alias("units"))
    on = Window.partitionBy("retailer_id", "sku_id").orderBy(F.desc("first_ship")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_day = (sold.unionByName(asked).groupBy("retailer_id", "sku_id", "first_ship").agg(F.sum("lines").alias("l"), F.sum("units").alias("u"))
                .select("retailer_id", "sku_id", "first_ship", F.sum("l").over(on).alias("_l"), F.sum("u").over(on).alias("_u")))
    return reach.join(from_day, ["retailer_id", "sku_id", "first_ship"], "left").groupBy("batch_id").agg(
        F.sum("shipments").alias("shipments"), F.count("*").alias("retailers"),
        F.coalesce(F.sum("_l"), F.lit(0)).alias("shelf_lines"),
        F.coalesce(F.sum("_u"), F.lit(0)).alias("shelf_units"))


def shelf_allocation(batches: DataFrame, shipments: DataFrame, sales: DataFrame) -> DataFrame:
    """How many of a batch's delivered units were sold, first in first out per retailer and product, and between which days."""
    sent = (shipments.where("batch_id IS NOT NULL").join(batches.select("batch_id", "sku_id"), "batch_id")
            .groupBy("retailer_id", "sku_id", "batch_id", "ship_date").agg(F.sum("cases_delivered").alias("units")))
    sold = sales.groupBy("retailer_id", "sku_id", "transaction_date").agg(F.sum("quantity_sold").alias("units"))
    met = allocate_in_order(sent, sold, ["retailer_id", "sku_id"], ["ship_date"], ["transaction_date"], "units",
                            ["batch_id", "ship_date"], ["transaction_date"])
    return met.groupBy("batch_id").agg(
        F.sum("units").cast("bigint").alias("units_sold"), F.count_distinct("retailer_id").alias("retailers"),
        F.min("transaction_date").alias("first_sold"), F.max("transaction_date").alias("last_sold"))


def revenue_waterfall(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Gross to net per channel: gross, discounts, returns, net."""
    gross = F.col("unit_price") * F.col("quantity_sold")
    per = sales.groupBy("transaction_id", "sku_id", "channel").agg(
        F.sum(gross).cast("decimal(18,4)").alias("g"),
        F.sum((gross * F.col("discount_pct") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,4)"))
        .cast("decimal(18,4)").alias("d"))
    back = returns.groupBy("transaction_id", "sku_id").agg(F.sum("return_amount").cast("decimal(18,4)").alias("r"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(18,4)")
    steps = per.join(back, ["transaction_id", "sku_id"], "left").groupBy("channel").agg(
        total("g").alias("gross_revenue"), total("d").alias("discounts"), total("r").alias("returned"))
    return steps.withColumn("net_revenue", (F.col("gross_revenue") - F.col("discounts") - F.col("returned"))
                            .cast("decimal(18,4)"))


def same_week_last_year(sales: DataFrame) -> DataFrame:
    """Weekly revenue against the same ISO week one year before.

    Weekly totals are few, so the lag runs over one row per year and week.
    """
    weekly = sales.groupBy(F.expr("extract(YEAROFWEEK FROM transaction_date)").alias("iso_year"),
                           F.weekofyear("transaction_date").alias("iso_week")).agg(
        F.sum(F.col("unit_price") * F.col("quantity_sold")).cast("decimal(18,2)").alias("revenue"))
    w = Window.partitionBy("iso_week").orderBy("iso_year").rangeBetween(-1, -1)
    return (weekly.withColumn("revenue_last_year", F.max("revenue").over(w))
            .withColumn("change_pct", pct(F.col("revenue") - F.col("revenue_last_year"), "revenue_last_year", 18, 2)))


def morning_brief(company_daily: DataFrame, rolling_otd: DataFrame, positions: DataFrame,
                  kpi_yield: DataFrame, top_accounts: DataFrame, as_of: str, production_as_of: str) -> DataFrame:
    """Five numbers in one row, each a one-row aggregate of its own table."""
    today = day(as_of)
    revenue = company_daily.where(F.col("report_date") == F.date_sub(today, 1)).agg(
        F.coalesce(F.sum("net_revenue"), F.lit(0)).cast("decimal(18,2)").alias("revenue_yesterday"))
    otd = rolling_otd.where(F.col("ship_date") <= today).agg(F.max_by("otd_7d_pct", "ship_date")).scalar()
    alerts = positions.agg(F.count("*")).scalar()
    plant = kpi_yield.where(F.col("report_date") <= day(production_as_of))
    newest = plant.groupBy("report_date").agg(
        pct(F.sum("total_actual_units"), F.sum("total_expected_units")).alias("y"))
    return revenue.select(
        "revenue_yesterday", otd.alias("on_time_7d_pct"), alerts.alias("open_reorder_alerts"),
        newest.agg(F.max_by("y", "report_date")).scalar().alias("latest_yield_pct"),
        top_accounts.agg(F.min_by("retailer_id", "revenue_rank")).scalar().alias("top_retailer_id"))
