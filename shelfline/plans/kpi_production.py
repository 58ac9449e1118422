"""Production KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import pct, surrogate_key
from shelfline.functions.time import hours_between
from shelfline.operators.ranking import trailing
from shelfline.session import settle


def _below(column: str, limit: float):
    return F.coalesce(F.col(column) < limit, F.lit(False))


def batch_yield(batches: DataFrame, products: DataFrame) -> DataFrame:
    """Yield per batch with its alert flags."""
    category = products.select("sku_id", "product_category")
    return batches.join(category, "sku_id").select(
        surrogate_key("batch_id").alias("yield_key"), "batch_date", "batch_id", "production_line_id",
        "sku_id", "product_category", "expected_output_cases", "actual_output_cases",
        "yield_rate_pct", "qc_status", _below("yield_rate_pct", 92).alias("yield_warn_flag"),
        _below("yield_rate_pct", 85).alias("yield_critical_flag"))


def quality_rate(batches: DataFrame, products: DataFrame) -> DataFrame:
    """Share of passed batches by (day, line, category); batches without a state are left out."""
    category = products.select("sku_id", "product_category")
    kpi = (batches.where("qc_status IS NOT NULL").join(category, "sku_id")
           .groupBy(F.col("batch_date").alias("report_date"), "production_line_id", "product_category")
           .agg(F.count("batch_id").alias("total_batches"),
                F.count_if(F.col("qc_status") == "PASS").alias("passed_batches"))
           .withColumn("qc_pass_rate_pct", pct("passed_batches", "total_batches")))
    return kpi.withColumns({"qc_warn_flag": _below("qc_pass_rate_pct", 96),
                            "qc_critical_flag": _below("qc_pass_rate_pct", 90)})


def unplanned_downtime(events: DataFrame) -> DataFrame:
    """Unplanned stoppage count and hours by (day, line)."""
    seconds = F.unix_timestamp("downtime_end_ts") - F.unix_timestamp("downtime_start_ts")
    kpi = (events.where("event_type = 'DOWNTIME_UNPLANNED'")
           .groupBy(F.col("event_timestamp").cast("date").alias("event_date"), "production_line_id")
           .agg(F.count("event_id").alias("total_downtime_events"),
                (F.sum(seconds).cast("decimal(18,0)") / F.lit(3600).cast("decimal(4,0)"))
                .cast("decimal(10,2)").alias("downtime_hours")))
    return kpi.withColumns({"downtime_warn_flag": F.col("downtime_hours") > 2,
                            "downtime_critical_flag": F.col("downtime_hours") > 6})


def traceability(batches: DataFrame, shipments: DataFrame, accounts: DataFrame, as_of: str,
                 wait_hours: int = 48) -> DataFrame:
    """Batch to shipment to retailer, one row per finished batch and shipment.

    The percentage is the share of batches with at least one complete chain: a
    one-row aggregate read back as a scalar, not a window over the whole table.
    ``eligible`` marks passed batches older than the waiting time.
    """
    done = batches.where("batch_end_ts IS NOT NULL").select("batch_id", "batch_end_ts", "qc_status")
    ship = shipments.where("batch_id IS NOT NULL").select("batch_id", "shipment_id", "retailer_id")
    known = accounts.select("retailer_id").distinct().withColumn("_known", F.lit(True))
    # Matched and unmatched batches are joined apart: an inner join can be split on
    # either side when one batch has a large share of the shipments.
    matched = ship.join(done, "batch_id")
    waiting = done.join(ship.select("batch_id").distinct(), "batch_id", "left_anti")
    both = matched.unionByName(waiting, allowMissingColumns=True)
    chain = both.join(known, "retailer_id", "left").withColumn(
        "is_fully_traceable", F.col("shipment_id").isNotNull() & F.col("_known").isNotNull()).drop("_known")
    chain = settle(chain, "trace-chain")
    share = (chain.groupBy("batch_id").agg(F.bool_or("is_fully_traceable").alias("ok"))
             .agg(F.count("*").alias("n"), F.count_if("ok").alias("k"))
             .select(pct("k", "n"))).scalar()
    age = hours_between("batch_end_ts", F.lit(as_of).cast("timestamp"), 18, 2)
    return chain.select(
        "batch_id", "shipment_id", "retailer_id", "is_fully_traceable",
        F.coalesce((F.col("qc_status") == "PASS") & (age > wait_hours), F.lit(False)).alias("eligible"),
        share.alias("traceability_pct"), F.coalesce(share < 98, F.lit(False)).alias("trace_warn_flag"))


def quality_trend(quality: DataFrame, days: int = 30) -> DataFrame:
    """Pass rate per line over trailing days, from daily counts."""
    daily = quality.where("report_date IS NOT NULL").groupBy("production_line_id", "report_date").agg(
        F.sum("total_batches").alias("total_batches"), F.sum("passed_batches").alias("passed_batches"))
    rolled = trailing(daily, ["production_line_id"], "report_date", days,
                      {"batches_30d": "total_batches", "passed_30d": "passed_batches"})
    return rolled.withColumn("qc_pass_30d_pct", pct("passed_30d", "batches_30d"))
