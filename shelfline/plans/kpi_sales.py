"""Revenue KPIs. All dates derive from the explicit ``as_of``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import pct, surrogate_key, week_start
from shelfline.functions.time import day
from shelfline.plans.facts import net_sale_lines

GRAIN = ("product_category", "region", "channel")


def daily_revenue(sales: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """Gross, returned and net revenue by (day, category, region, channel)."""
    lines = net_sale_lines(sales, returns, ["transaction_date", "region", "channel"])
    category = products.select("sku_id", "product_category")
    kpi = (lines.join(category, "sku_id")
           .groupBy(F.col("transaction_date").alias("report_date"), *GRAIN)
           .agg(F.sum("gross_sales_amount").cast("decimal(18,4)").alias("gross_sales_amount"),
                F.sum("return_amount").cast("decimal(18,4)").alias("return_amount"),
                F.sum("net_revenue").cast("decimal(18,4)").alias("net_revenue"),
                F.count_distinct("transaction_id").alias("transaction_count"),
                F.sum("units_sold").alias("units_sold")))
    return kpi.withColumn("revenue_key", surrogate_key("report_date", *GRAIN))


def period_comparison(daily: DataFrame, as_of: str) -> DataFrame:
    """Month-to-date and year-to-date revenue against the same window one month and
    one year before, in one scan.

    Every combination that sold in any of the windows gets a row.
    """
    d, today = F.col("report_date"), day(as_of)
    windows = {
        "current_month_revenue": (F.trunc(today, "month"), today),
        "prior_month_revenue": (F.add_months(F.trunc(today, "month"), -1), F.add_months(today, -1)),
        "current_ytd_revenue": (F.trunc(today, "year"), today),
        "prior_ytd_revenue": (F.add_months(F.trunc(today, "year"), -12), F.add_months(today, -12)),
    }
    # A month-to-date reaching back from early January also lies after this date.
    since = F.add_months(F.trunc(today, "year"), -12)
    zero = F.lit(0).cast("decimal(18,4)")
    sums = [F.coalesce(F.sum(F.when(d.between(lo, hi), F.col("net_revenue"))), zero)
            .cast("decimal(18,4)").alias(name) for name, (lo, hi) in windows.items()]
    hit = F.lit(False)
    for lo, hi in windows.values():
        hit = hit | d.between(lo, hi)
    kpi = daily.where(d.between(since, today)).where(hit).groupBy(*GRAIN).agg(*sums)
    change = lambda a, b: pct(F.col(a) - F.col(b), b, 18, 4)
    return kpi.withColumns({
        "comparison_month": F.date_format(today, "yyyy-MM"),
        "mom_pct_change": change("current_month_revenue", "prior_month_revenue"),
        "yoy_pct_change": change("current_ytd_revenue", "prior_ytd_revenue"),
        "data_as_of": today,
    })


def weekly_margin(sales: DataFrame, returns: DataFrame, products: DataFrame, as_of: str,
                  low_pct: float = 30) -> DataFrame:
    """Margin per (week, sku) of sales up to ``as_of``, with an alert below ``low_pct``."""
    lines = net_sale_lines(sales.where(F.col("transaction_date") <= day(as_of)), returns, ["transaction_date"])
    # Weekly sums first: the product join then sees one row per sku and week.
    weekly = lines.groupBy(week_start("transaction_date").alias("week_start_date"), "sku_id").agg(
        F.sum("net_revenue").cast("decimal(18,4)").alias("net_revenue"),
        F.sum("units_sold").alias("units_sold"))
    p = products.select("sku_id", "product_category", "product_name", "standard_cost_per_unit")
    kpi = weekly.join(p, "sku_id").withColumn(
        "cogs", (F.col("standard_cost_per_unit") * F.col("units_sold")).cast("decimal(18,4)"))
    kpi = kpi.withColumn("gross_margin_amount", (F.col("net_revenue") - F.col("cogs")).cast("decimal(18,4)"))
    kpi = kpi.withColumn("gross_margin_pct", pct("gross_margin_amount", "net_revenue", 18, 4))
    return kpi.drop("standard_cost_per_unit").withColumns({
        "margin_key": surrogate_key("week_start_date", "sku_id"),
        "margin_alert_flag": F.coalesce(F.col("gross_margin_pct") < low_pct, F.lit(False)),
        "is_partial_week": F.col("week_start_date") == week_start(day(as_of)),
    })


def company_daily(daily: DataFrame) -> DataFrame:
    """Company-wide revenue per day."""
    return daily.groupBy("report_date").agg(F.sum("net_revenue").cast("decimal(18,4)").alias("net_revenue"))


def company_comparison(comparison: DataFrame) -> DataFrame:
    """Company-wide month and year changes from the detailed comparison."""
    names = ("current_month_revenue", "prior_month_revenue", "current_ytd_revenue", "prior_ytd_revenue")
    one = comparison.agg(*[F.sum(n).cast("decimal(18,4)").alias(n) for n in names])
    return one.withColumns({
        "mom_pct_change": pct(F.col("current_month_revenue") - F.col("prior_month_revenue"), "prior_month_revenue", 18, 4),
        "yoy_pct_change": pct(F.col("current_ytd_revenue") - F.col("prior_ytd_revenue"), "prior_ytd_revenue", 18, 4),
    })


def revenue_rollup(daily: DataFrame) -> DataFrame:
    """Monthly revenue by region and channel with subtotals; ``level`` tells which."""
    base = daily.withColumn("report_month", F.date_format("report_date", "yyyy-MM"))
    return base.groupingSets(
        [["report_month", "region", "channel"], ["report_month", "region"], ["report_month"], []],
        "report_month", "region", "channel").agg(
        F.grouping_id("report_month", "region", "channel").cast("int").alias("level"),
        F.sum("net_revenue").cast("decimal(18,4)").alias("net_revenue"),
        F.sum("units_sold").alias("units_sold"))


def twelve_month_trend(daily: DataFrame, months: int = 12) -> DataFrame:
    """Net revenue per month and over the trailing months, per channel."""
    monthly = daily.groupBy("channel", F.trunc("report_date", "month").alias("month")).agg(
        F.sum("net_revenue").cast("decimal(18,4)").alias("net_revenue"))
    position = F.year("month") * 12 + F.month("month")
    w = Window.partitionBy("channel").orderBy(position).rangeBetween(-(months - 1), 0)
    return monthly.withColumn("trailing_revenue", F.sum("net_revenue").over(w).cast("decimal(18,4)"))
