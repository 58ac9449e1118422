"""Threshold alerts: limits are data, evaluation is one projection per KPI."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limit:
    """Warn and critical predicates of one measure; ``table`` names the KPI frame."""

    kpi: str
    table: str
    scope: tuple[str, ...]
    measure: str
    warn: str
    critical: str


# The alert limits of the KPI registry.
LIMITS = (
    Limit("KPI-S01", "company_daily", ("report_date",), "net_revenue",
          "net_revenue < 2000000", "net_revenue < 1500000"),
    Limit("KPI-S02", "category_comparison", ("product_category",), "mom_pct_change",
          "mom_pct_change < -5", "false"),
    Limit("KPI-S02-COMPANY", "company_comparison", (), "mom_pct_change",
          "false", "mom_pct_change < -15"),
    Limit("KPI-S03", "company_comparison", (), "yoy_pct_change",
          "yoy_pct_change < 5", "yoy_pct_change < 0"),
    Limit("KPI-S04", "kpi_s04", ("week_start_date", "sku_id"), "gross_margin_pct",
          "gross_margin_pct < 30", "gross_margin_pct < 20"),
    Limit("KPI-S04-COMPANY", "company_margin", ("week_start_date",), "gross_margin_pct",
          "false", "gross_margin_pct < 35"),
    Limit("KPI-I01", "kpi_i01", ("sku_id", "warehouse_id"), "units_on_hand",
          "reorder_alert_flag", "stockout_flag"),
    Limit("KPI-I02", "kpi_i02", ("warehouse_id",), "inventory_turnover_rate",
          "inventory_turnover_rate < 0.5", "inventory_turnover_rate < 0.3"),
    Limit("KPI-I03", "kpi_i03", ("sku_id", "warehouse_id"), "dsi_days",
          "dsi_days < 10 OR dsi_days > 60", "dsi_days < 7"),
    Limit("KPI-I04", "reorder_count", (), "open_alerts",
          "open_alerts >= 1", "open_alerts >= 5 OR stockouts > 0"),
    Limit("KPI-P01", "kpi_p01", ("batch_id",), "yield_rate_pct",
          "yield_rate_pct < 92", "yield_rate_pct < 85"),
    Limit("KPI-P02", "kpi_p02", ("report_date", "production_line_id", "product_category"), "qc_pass_rate_pct",
          "qc_pass_rate_pct < 96", "qc_pass_rate_pct < 90"),
    Limit("KPI-P03", "kpi_p03", ("event_date", "production_line_id"), "downtime_hours",
          "downtime_hours > 2", "downtime_hours > 6"),
    Limit("KPI-P04", "trace_share", (), "traceability_pct",
          "traceability_pct < 98", "traceability_pct < 95"),
    Limit("KPI-D01", "kpi_d01", ("ship_date", "channel", "region"), "otd_pct", "otd_pct < 90", "false"),
    Limit("KPI-D01-COMPANY", "rolling_otd", ("ship_date",), "otd_7d_pct", "false", "otd_7d_pct < 80"),
    Limit("KPI-D02", "kpi_d02", ("ship_date", "channel"), "fulfillment_rate_pct",
          "fulfillment_rate_pct < 95", "fulfillment_rate_pct < 90"),
    Limit("KPI-D02-COMPANY", "rolling_fulfillment", ("ship_date",), "fulfillment_7d_pct",
          "false", "fulfillment_7d_pct < 90"),
    Limit("KPI-D03", "kpi_d03", ("week_start_date", "region", "route_id", "channel"), "cost_per_case",
          "cost_per_case > 5", "cost_per_case > 6"),
    Limit("KPI-D03-COMPANY", "company_cost", ("week_start_date",), "cost_per_case",
          "false", "cost_per_case > 5.5"),
    Limit("KPI-D04", "kpi_d04", ("week_start_date", "route_id", "region"), "route_otd_pct",
          "route_otd_pct < 80", "route_otd_pct < 70 OR consecutive_weeks_in_worst10 >= 3"),
    Limit("KPI-C01", "kpi_c04", ("period_month",), "top1_revenue_pct",
          "top5_concentration_pct > 30", "top1_revenue_pct > 15"),
    Limit("KPI-C02", "kpi_c02", ("retail_segment", "region"), "cac_usd", "cac_usd > 3000", "cac_usd > 5000"),
    Limit("KPI-C02-COMPANY", "company_cac", (), "cac_usd", "false", "cac_usd > 4000"),
    Limit("KPI-C03", "kpi_c03", ("region", "retail_segment"), "retention_rate_pct",
          "retention_rate_pct < 85", "retention_rate_pct < 75"),
    Limit("KPI-C03-COMPANY", "company_retention", (), "retention_rate_pct",
          "false", "retention_rate_pct < 75"),
    Limit("KPI-C04", "kpi_c04", ("period_month",), "top5_concentration_pct",
          "top5_concentration_pct > 30", "top5_concentration_pct > 40 OR top1_revenue_pct > 15"),
)


def _alert(limit: Limit) -> Column:
    """The alert of one limit on a KPI row; NULL when the row keeps it."""
    level = F.when(F.expr(limit.critical), "CRITICAL").when(F.expr(limit.warn), "WARN")
    scope = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("∅")) for c in limit.scope]) \
        if limit.scope else F.lit("company")
    return F.when(level.isNotNull(), F.struct(
        F.lit(limit.kpi).alias("kpi"), scope.alias("scope"), F.col(limit.measure).cast("decimal(18,4)").alias("measure_value"), level.alias("severity")))


def evaluate(limits: Sequence[Limit], kpi: DataFrame) -> DataFrame:
    """Alert rows (kpi, scope, measure, severity) of all limits on one KPI frame, which is read once."""
    found = F.array_compact(F.array(*[_alert(x) for x in limits]))
    return kpi.select(F.explode(found).alias("_a")).select("_a.*")


def raise_alerts(tables: dict[str, DataFrame], limits: tuple[Limit, ...] = LIMITS) -> DataFrame:
    """Alerts of every limit whose table is present; limits of one table share its scan."""
    by_table: dict[str, list[Limit]] = {}
    for x in limits:
        if x.table in tables:
            by_table.setdefault(x.table, []).append(x)
    return reduce(DataFrame.unionByName, [evaluate(some, tables[t]) for t, some in by_table.items()])


def alert_summary(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("kpi", "severity").agg(
        F.count("*").alias("alerts"), F.min("measure_value").alias("lowest"),
        F.max("measure_value").alias("highest"))
