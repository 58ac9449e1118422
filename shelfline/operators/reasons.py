"""Named reason codes and table-level warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import pct
from shelfline.functions.time import day

# Reason codes of the acceptance criteria.
INVALID_STOCK_LEVEL = "INVALID_STOCK_LEVEL"
YIELD_EXCEEDS_EXPECTED = "YIELD_EXCEEDS_EXPECTED"
INVALID_QC_STATUS = "INVALID_QC_STATUS"
DELIVERY_DATE_MISSING = "DELIVERY_DATE_MISSING"
INVALID_LOGISTICS_COST = "INVALID_LOGISTICS_COST"


def stock_reason() -> Column:
    return F.when(F.col("units_on_hand") < 0, INVALID_STOCK_LEVEL)


def batch_reason() -> Column:
    status = F.col("qc_status")
    return (F.when(F.col("yield_rate_pct") > 110, YIELD_EXCEEDS_EXPECTED)
            .when(status.isNotNull() & ~status.isin("PASS", "FAIL", "PENDING"), INVALID_QC_STATUS))


def shipment_reason(as_of: str, wait_days: int = 30) -> Column:
    overdue = F.col("actual_delivery_date").isNull() & (F.col("ship_date") < F.date_sub(day(as_of), wait_days))
    cost = F.col("logistics_cost_usd")
    return F.when(overdue, DELIVERY_DATE_MISSING).when(cost.isNull() | (cost < 0), INVALID_LOGISTICS_COST)


def zero_spend_periods(spend: DataFrame, limit_pct: float = 20.0) -> DataFrame:
    """Periods whose spend is zero in total, or zero on too many rows."""
    zero = F.coalesce(F.col("total_acquisition_cost_usd"), F.lit(0)) == 0
    per = spend.groupBy("period_start_date").agg(
        F.count("*").alias("row_count"), F.count_if(zero).alias("zero_rows"),
        F.coalesce(F.sum("total_acquisition_cost_usd"), F.lit(0)).cast("decimal(18,4)").alias("total_spend"))
    per = per.withColumn("zero_pct", pct("zero_rows", "row_count"))
    return per.where((F.col("total_spend") == 0) | (F.col("zero_pct") > limit_pct))


def monitoring_row(counts: DataFrame, run_id: str, pipeline: str, source: str, target: str,
                   started: str, completed: str, limit_pct: float) -> DataFrame:
    """Run summary from a one-row frame with ``rows_read`` and ``rows_rejected``."""
    rate = pct("rows_rejected", "rows_read", 7, 4)
    over = F.coalesce(rate > limit_pct, F.lit(False))
    return counts.select(
        F.lit(run_id).alias("run_id"), F.lit(pipeline).alias("pipeline_name"), F.lit(source).alias("source_table"),
        F.lit(target).alias("target_table"), F.lit(started).cast("timestamp").alias("run_timestamp"),
        F.lit(completed).cast("timestamp").alias("completed_timestamp"), "rows_read",
        (F.col("rows_read") - F.col("rows_rejected")).alias("rows_written"), "rows_rejected",
        rate.alias("rejection_rate_pct"),
        F.when(over, "FAILED").when(F.col("rows_rejected") > 0, "PARTIAL").otherwise("COMPLETED").alias("pipeline_status"),
        (F.col("rows_rejected") > 0).alias("alert_triggered"))
