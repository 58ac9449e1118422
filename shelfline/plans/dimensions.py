"""Shared dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import date_key, surrogate_key

# Fixed values: (month, day) of the fixed-date holidays.
HOLIDAYS = ((1, 1), (7, 4), (11, 11), (12, 25))
# Sales regions and their codes.
REGION_CODES = (("Northeast", "NE"), ("Southeast", "SE"), ("Midwest", "MW"), ("Southwest", "SW"), ("West", "W"))
HOLIDAY_NAMES = ("New Year's Day", "Independence Day", "Veterans Day", "Christmas Day")


def calendar(days: DataFrame, date: str = "full_date", fiscal_start_month: int = 10) -> DataFrame:
    """Date attributes for a frame of dates.

    ``day_of_week`` counts from Sunday = 1, ``iso_day_of_week`` from Monday = 1.
    The fiscal year carries the number of the year it ends in.
    """
    d = F.col(date)
    month, dom = F.month(d), F.dayofmonth(d)
    offset = (month - fiscal_start_month + 12) % 12
    fiscal_quarter = F.concat(F.lit("FQ"), (F.floor(offset / 3) + 1).cast("string"))
    fiscal_year = F.year(d) if fiscal_start_month == 1 else (
        F.year(d) + (month >= fiscal_start_month).cast("int"))
    names: Column = F.lit(None).cast("string")
    for (m, n), name in zip(HOLIDAYS, HOLIDAY_NAMES):
        names = F.when((month == m) & (dom == n), name).otherwise(names)
    month_end = F.last_day(d)
    return days.select(d.alias("full_date")).select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.date_format("full_date", "EEEE").alias("day_name"),
        F.dayofweek("full_date").alias("day_of_week"),
        (F.weekday("full_date") + 1).alias("iso_day_of_week"),
        dom.alias("day_of_month"),
        F.weekofyear("full_date").alias("week_of_year"),
        month.alias("month_number"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.quarter("full_date").alias("quarter"),
        F.year("full_date").alias("year"),
        (F.weekday("full_date") >= 5).alias("is_weekend"),
        names.isNotNull().alias("is_holiday"),
        names.alias("holiday_name"),
        fiscal_year.cast("int").alias("fiscal_year"),
        fiscal_quarter.alias("fiscal_quarter"),
        F.concat_ws("-", fiscal_year.cast("string"), fiscal_quarter).alias("fiscal_period"),
        F.dayofmonth(month_end).alias("days_in_month"),
        (d == month_end).alias("is_month_end"),
        ((d == month_end) & (month % 3 == 0)).alias("is_quarter_end"),
        ((month == 12) & (dom == 31)).alias("is_year_end"),
    )


def generate_date_dimension(spark: SparkSession, start_year: int, end_year: int,
                            fiscal_start_month: int = 10) -> DataFrame:
    """Calendar of whole years."""
    span = F.sequence(F.lit(f"{start_year}-01-01").cast("date"), F.lit(f"{end_year}-12-31").cast("date"))
    days = spark.range(1).select(F.explode(span).alias("full_date"))
    return calendar(days, fiscal_start_month=fiscal_start_month)


def calendar_of(df: DataFrame, date: str) -> DataFrame:
    """Calendar of the whole years that a date column spans."""
    ends = df.agg(F.min(date).alias("a"), F.max(date).alias("b"))
    span = F.sequence(F.trunc("a", "year"), F.date_sub(F.add_months(F.trunc("b", "year"), 12), 1))
    return calendar(ends.select(F.explode(span).alias("full_date")))


def calendar_over(dated: list[tuple[DataFrame, str]]) -> DataFrame:
    """Calendar of the whole years that any of the (frame, date column) pairs spans."""
    ends = None
    for df, date in dated:
        own = df.agg(F.min(date).alias("a"), F.max(date).alias("b"))
        both = own.select(F.explode(F.array("a", "b")).alias("day")).where("day IS NOT NULL")
        ends = both if ends is None else ends.unionByName(both)
    return calendar_of(ends, "day")


def product_dimension(products: DataFrame) -> DataFrame:
    return products.select(
        surrogate_key("sku_id").alias("product_key"), "sku_id", "product_name", "product_category",
        "brand", "price_tier", "standard_cost_per_unit", "list_price")


def customer_dimension(history: DataFrame) -> DataFrame:
    return history.where("is_current").select(
        surrogate_key("retailer_id", "valid_from").alias("customer_key"), "retailer_id",
        "retailer_name", "retail_segment", "channel", "region", "account_status")


def warehouse_dimension(warehouses: DataFrame) -> DataFrame:
    return warehouses.select(
        surrogate_key("warehouse_id").alias("warehouse_key"), "warehouse_id", "warehouse_name",
        "region", "state", "warehouse_type", "capacity_units")


def region_code(region: str) -> Column:
    """The sales region's short code; any other region is its own name in capitals."""
    code = F.upper(region)
    for name, short in REGION_CODES:
        code = F.when(F.col(region) == name, short).otherwise(code)
    return code


def region_dimension(members: DataFrame) -> DataFrame:
    """One row per region with its states, from (region, state) pairs.

    Pairs are reduced first, so the list holds distinct states only.
    """
    pairs = members.select("region", "state").where("region IS NOT NULL").distinct()
    return pairs.groupBy("region").agg(
        F.array_join(F.sort_array(F.collect_set("state")), ",").alias("states_included")).select(
        surrogate_key("region").alias("region_key"),
        region_code("region").alias("region_id"),
        F.col("region").alias("region_name"), "states_included",
        F.concat(F.col("region"), F.lit(" Territory")).alias("sales_territory"))


def channel_dimension(members: DataFrame) -> DataFrame:
    """One row per channel; direct-to-consumer is the only direct one."""
    return members.select("channel").where("channel IS NOT NULL").distinct().select(
        surrogate_key("channel").alias("channel_key"),
        F.upper("channel").alias("channel_id"), F.col("channel").alias("channel_name"),
        F.when(F.col("channel") == "DTC", "Direct").otherwise("Indirect").alias("channel_type"))
