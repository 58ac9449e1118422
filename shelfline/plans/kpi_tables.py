"""The specification's KPI tables: built from conformed tables, stored by month, rebuilt from a month on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.time import day
from shelfline.plans import kpi_accounts, kpi_delivery, kpi_production, kpi_sales, kpi_stock
from shelfline.plans.changes import in_months, months_reached
from shelfline.session import settle
from shelfline.sources import sinks

MONTH = "report_month"


@dataclass(frozen=True)
class KpiTable:
    """How a table is built from the named inputs, and the date that places its rows (None: the day of the run).

    ``reach`` tells which of a table's dates a changed day of its inputs can alter: so many days
    before it up to so many days after it (None: any later date). Tables that describe the
    day of the run have none: they are written by every run and keep what earlier runs saw.
    """

    family: str
    build: Callable
    date: str | None
    reads: tuple[str, ...] = ()
    reach: tuple[int, int | None] | None = None


# ``i`` holds the inputs by name, ``t`` the day of the run.
KPI_TABLES = {
    "sales_daily_revenue": KpiTable("sales", lambda i, t: kpi_sales.daily_revenue(i["sales"], i["returns"], i["products"]), "report_date", ("sales",), (0, 0)),
    "sales_period_comparison": KpiTable("sales", lambda i, t: kpi_sales.period_comparison(
        kpi_sales.daily_revenue(i["sales"], i["returns"], i["products"]), t), "data_as_of"),
    "sales_gross_margin_sku": KpiTable("sales", lambda i, t: kpi_sales.weekly_margin(i["sales"], i["returns"], i["products"], t), "week_start_date", ("sales",), (-6, 0)),
    "inventory_stock_levels": KpiTable("inventory", lambda i, t: kpi_stock.stock_levels(i["stock"], i["reorder"], i["products"], t), "snapshot_date"),
    "inventory_turnover": KpiTable("inventory", lambda i, t: kpi_stock.turnover_30d(i["sales"], i["stock"], i["products"], t), "week_start_date"),
    "inventory_dsi": KpiTable("inventory", lambda i, t: kpi_stock.days_sales_of_inventory(i["sales"], i["stock"], t), "report_date"),
    "production_yield": KpiTable("production", lambda i, t: kpi_production.batch_yield(i["batches"], i["products"]), "batch_date", ("batches",), (0, 0)),
    "production_quality_rate": KpiTable("production", lambda i, t: kpi_production.quality_rate(i["batches"], i["products"]), "report_date", ("batches",), (0, 0)),
    "production_downtime": KpiTable("production", lambda i, t: kpi_production.unplanned_downtime(i["events"]), "event_date", ("events",), (0, 0)),
    "production_traceability": KpiTable("production", lambda i, t: kpi_production.traceability(
        i["batches"], i["shipments"], i["accounts"], f"{t} 00:00:00"), None),
    "distribution_otd": KpiTable("distribution", lambda i, t: kpi_delivery.on_time_delivery(i["shipments"]), "ship_date", ("shipments",), (0, 0)),
    "distribution_fulfillment": KpiTable("distribution", lambda i, t: kpi_delivery.order_fulfillment(i["shipments"]), "ship_date", ("shipments",), (0, 0)),
    "distribution_cost_per_case": KpiTable("distribution", lambda i, t: kpi_delivery.cost_per_case(i["shipments"]), "week_start_date", ("shipments",), (-6, 0)),
    "distribution_worst_routes": KpiTable("distribution", lambda i, t: kpi_delivery.worst_routes(i["shipments"]), "week_start_date", ("shipments",), (-6, None)),
    "customers_top_retailers": KpiTable("customers", lambda i, t: kpi_accounts.top_retailers(i["sales"], i["returns"], i["accounts"], t), None),
    "customers_cac": KpiTable("customers", lambda i, t: kpi_accounts.acquisition_cost(i["accounts"], i["spend"], t), None),
    "customers_retention": KpiTable("customers", lambda i, t: kpi_accounts.retention(i["sales"], i["accounts"], t), None),
    "customers_concentration_risk": KpiTable("customers", lambda i, t: kpi_accounts.concentration(i["sales"], i["returns"], t), None),
}


def write_kpi_tables(inputs: dict[str, DataFrame], root: str, as_of: str, since: str | None = None,
                     families: tuple[str, ...] | None = None, changed: dict[str, list[dt.date]] | None = None) -> dict[str, int]:
    """Write the tables, one partition a month; returns the rows written of each.

    Only the months computed are replaced, so a rerun changes nothing; a month left without a
    row loses its partition. With ``since`` the months before that day's month are neither
    computed nor touched: the date is a grouping key of the table, so the filter reaches the
    inputs. ``changed`` names the days that changed in each input: then only the months that
    such a day can alter are computed, and other tables are left alone.
    """
    out = {}
    for name, table in KPI_TABLES.items():
        if families and table.family not in families:
            continue
        path, span = f"{root}/{name}", None
        if changed is not None and table.reach:
            span = months_reached([d for i in table.reads for d in changed.get(i, [])], *table.reach)
            if not span:
                continue
        rows = table.build(inputs, as_of)
        placed = F.col(table.date) if table.date else day(as_of)
        if since and table.date:
            rows = rows.where(F.col(table.date) >= F.trunc(F.lit(since).cast("date"), "month"))
        if span:
            rows = rows.where(in_months(table.date, span))
        rows = settle(rows.withColumn(MONTH, F.date_format(placed, "yyyy-MM")), f"kpi-{name}")
        gone = None
        if table.reach and sinks.exists(rows.sparkSession, path):
            stored = rows.sparkSession.read.schema(rows.schema).parquet(path).select(MONTH).distinct()
            if span:
                stored = stored.where(in_months(F.to_date(MONTH, "yyyy-MM"), span))
            elif since:
                stored = stored.where(F.col(MONTH) >= since[:7])
            gone = settle(stored.join(rows.select(MONTH).distinct(), MONTH, "left_anti"), "gone")
        out[name] = sinks.overwrite_partitions(rows, path, [MONTH])
        if gone is not None:
            sinks.drop_partitions(rows.sparkSession, path, gone)
    return out


def read_kpi_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")
