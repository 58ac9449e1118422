"""Distribution KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import pct, ratio, week_start
from shelfline.operators.ranking import top_per_group, trailing, with_streak

ON_TIME = "actual_delivery_date <= promised_delivery_date"


def _flag(condition):
    return F.coalesce(condition, F.lit(False))


def on_time_delivery(shipments: DataFrame) -> DataFrame:
    """Share delivered by the promised date among delivered shipments."""
    kpi = (shipments.where("actual_delivery_date IS NOT NULL").groupBy("ship_date", "channel", "region")
           .agg(F.count("shipment_id").alias("total_shipments"),
                F.count_if(F.expr(ON_TIME)).alias("on_time_shipments"))
           .withColumn("otd_pct", pct("on_time_shipments", "total_shipments")))
    return kpi.withColumns({"otd_warn_flag": _flag(F.col("otd_pct") < 90),
                            "otd_critical_flag": _flag(F.col("otd_pct") < 80)})


def order_fulfillment(shipments: DataFrame) -> DataFrame:
    """Fully shipped orders among distinct orders by (ship date, channel).

    Shipments are folded to their order first, so the rate cannot exceed 100 %.
    """
    orders = shipments.groupBy("ship_date", "channel", "order_id").agg(
        F.bool_and("is_fully_shipped").alias("_full"))
    kpi = (orders.groupBy("ship_date", "channel")
           .agg(F.count("*").alias("total_orders"), F.count_if("_full").alias("fully_shipped_orders"))
           .withColumn("fulfillment_rate_pct", pct("fully_shipped_orders", "total_orders")))
    return kpi.withColumns({"fulfillment_warn_flag": _flag(F.col("fulfillment_rate_pct") < 95),
                            "fulfillment_critical_flag": _flag(F.col("fulfillment_rate_pct") < 90)})


def cost_per_case(shipments: DataFrame) -> DataFrame:
    """Logistics cost per delivered case by (week, region, route, channel)."""
    kpi = (shipments.groupBy(week_start("ship_date").alias("week_start_date"), "region", "route_id", "channel")
           .agg(F.sum("logistics_cost_usd").cast("decimal(18,2)").alias("total_logistics_cost"),
                F.sum("cases_delivered").alias("total_cases_delivered"))
           .withColumn("cost_per_case", ratio("total_logistics_cost", "total_cases_delivered", 18, 4)))
    return kpi.withColumns({"cost_warn_flag": _flag(F.col("cost_per_case") > 5),
                            "cost_critical_flag": _flag(F.col("cost_per_case") > 6)})


def worst_routes(shipments: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` worst (route, region) pairs of every week and how many weeks in a
    row each has been among them."""
    weekly = (shipments.where("actual_delivery_date IS NOT NULL")
              .groupBy(week_start("ship_date").alias("week_start_date"), "route_id", "region")
              .agg(F.count("shipment_id").alias("total_shipments"),
                   F.count_if(F.expr(ON_TIME)).alias("on_time_shipments"),
                   F.sum("logistics_cost_usd").alias("_cost"), F.sum("cases_delivered").alias("_cases"))
              .withColumns({"route_otd_pct": pct("on_time_shipments", "total_shipments", 18, 6),
                            "route_cost_per_case": ratio("_cost", "_cases", 18, 4)}).drop("_cost", "_cases"))
    order = [F.col("route_otd_pct").asc(), F.col("route_cost_per_case").desc()]
    worst = top_per_group(weekly, ["week_start_date"], order, k, "worst_route_rank", ties=True)
    run = with_streak(worst, ["route_id", "region"], "week_start_date", "consecutive_weeks_in_worst10")
    return run.withColumns({
        "route_warn_flag": F.col("route_otd_pct") < 80,
        "route_critical_flag": (F.col("route_otd_pct") < 70) | (F.col("consecutive_weeks_in_worst10") >= 3),
    })


def rolling_on_time(otd: DataFrame, days: int = 7) -> DataFrame:
    """Company on-time share over trailing days, from daily numerators and denominators."""
    daily = otd.groupBy("ship_date").agg(F.sum("total_shipments").alias("total_shipments"),
                                         F.sum("on_time_shipments").alias("on_time_shipments"))
    # One row per calendar day remains, so the unpartitioned frame stays tiny.
    rolled = trailing(daily.withColumn("_all", F.lit(1)), ["_all"], "ship_date", days,
                      {"total_7d": "total_shipments", "on_time_7d": "on_time_shipments"})
    return rolled.drop("_all").withColumn("otd_7d_pct", pct("on_time_7d", "total_7d"))


def rolling_fulfillment(fulfillment: DataFrame, days: int = 7) -> DataFrame:
    """Company fulfilment over trailing days, from daily numerators and denominators."""
    daily = fulfillment.groupBy("ship_date").agg(F.sum("total_orders").alias("total_orders"),
                                                 F.sum("fully_shipped_orders").alias("fully_shipped_orders"))
    rolled = trailing(daily.withColumn("_all", F.lit(1)), ["_all"], "ship_date", days,
                      {"orders_7d": "total_orders", "full_7d": "fully_shipped_orders"})
    return rolled.drop("_all").withColumn("fulfillment_7d_pct", pct("full_7d", "orders_7d"))
