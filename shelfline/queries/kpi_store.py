"""The stored KPI tables, written by the job and read back, one query a family."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.plans import kpi_tables
from shelfline.queries import sqlframes as s
from shelfline.queries.frames import AS_OF, Frames
from shelfline.queries.registry import query
from shelfline.session import work_dir

# Stored table, its check frame, the date that places a row.
_TABLES = {
    "sales": (("sales_daily_revenue", "kpi_s01", "report_date"), ("sales_period_comparison", "kpi_s02", s.AS_OF),
              ("sales_gross_margin_sku", "kpi_s04", "week_start_date")),
    "inventory": (("inventory_stock_levels", "kpi_i01", "snapshot_date"), ("inventory_turnover", "kpi_i02", "week_start_date"),
                  ("inventory_dsi", "kpi_i03", "report_date")),
    "production": (("production_yield", "kpi_p01", "batch_date"), ("production_quality_rate", "kpi_p02", "report_date"),
                   ("production_downtime", "kpi_p03", "event_date"), ("production_traceability", "kpi_p04", s.AS_OF)),
    "distribution": (("distribution_otd", "kpi_d01", "ship_date"), ("distribution_fulfillment", "kpi_d02", "ship_date"),
                     ("distribution_cost_per_case", "kpi_d03", "week_start_date"), ("distribution_worst_routes", "kpi_d04", "week_start_date")),
    "customers": (("customers_top_retailers", "kpi_c01", s.AS_OF), ("customers_cac", "kpi_c02", s.AS_OF),
                  ("customers_retention", "kpi_c03", s.AS_OF), ("customers_concentration_risk", "kpi_c04", s.AS_OF)),
}

# Measures whose totals a month's rows are held against.
_MEASURES = {
    "sales_daily_revenue": ("gross_sales_amount", "return_amount", "net_revenue", "transaction_count", "units_sold"),
    "sales_period_comparison": ("current_month_revenue", "prior_month_revenue", "current_ytd_revenue", "prior_ytd_revenue", "mom_pct_change"),
    "sales_gross_margin_sku": ("net_revenue", "units_sold", "cogs", "gross_margin_amount", "gross_margin_pct"),
    "inventory_stock_levels": ("units_on_hand", "inventory_value", "reorder_point_units", "deficit_units"),
    "inventory_turnover": ("cogs_30d", "avg_inventory_value_30d", "inventory_turnover_rate", "annualized_turnover"),
    "inventory_dsi": ("units_on_hand", "avg_daily_sales_units", "dsi_days"),
    "production_yield": ("expected_output_cases", "actual_output_cases", "yield_rate_pct"),
    "production_quality_rate": ("total_batches", "passed_batches", "qc_pass_rate_pct"),
    "production_downtime": ("downtime_hours",),
    "production_traceability": ("traceability_pct",),
    "distribution_otd": ("total_shipments", "on_time_shipments", "otd_pct"),
    "distribution_fulfillment": ("total_orders", "fully_shipped_orders", "fulfillment_rate_pct"),
    "distribution_cost_per_case": ("total_logistics_cost", "total_cases_delivered", "cost_per_case"),
    "distribution_worst_routes": ("total_shipments", "route_otd_pct", "route_cost_per_case"),
    "customers_top_retailers": ("retailer_net_revenue", "pct_of_total_revenue", "revenue_rank", "prior_period_rank"),
    "customers_cac": ("new_accounts_count", "total_acquisition_spend", "cac_usd"),
    "customers_retention": ("prior_period_active_count", "retained_count", "churned_count", "retention_rate_pct"),
    "customers_concentration_risk": ("top5_net_revenue", "total_net_revenue", "top5_concentration_pct", "top1_revenue_pct"),
}


def _measured(name: str) -> str:
    """Sum of all measures of a table, in either dialect."""
    return " + ".join(f"coalesce(sum(CAST({m} AS DECIMAL(18,4))), 0)" for m in _MEASURES[name])


def inputs(f: Frames) -> dict[str, DataFrame]:
    """What the KPI tables are built from."""
    return {"sales": f.sales, "returns": f.returns, "products": f.products, "stock": f.stock, "reorder": f.reorder, "batches": f.batches,
            "events": f.prod_events, "shipments": f.shipments, "accounts": f.accounts, "spend": f.spend}


# Inputs that several tables of a family read, each twice, and the columns they read: stored once, not derived every time.
_SHARED = {
    "sales": {"sales": ("transaction_id", "sku_id", "transaction_date", "region", "channel", "unit_price", "quantity_sold"),
              "returns": ("transaction_id", "sku_id", "return_amount")},
    "inventory": {"stock": ("sku_id", "warehouse_id", "snapshot_date", "units_on_hand", "reorder_point_units", "inventory_value"),
                  "sales": ("sku_id", "transaction_date", "quantity_sold")},
    "distribution": {"shipments": ("shipment_id", "order_id", "channel", "region", "route_id", "ship_date", "promised_delivery_date",
                                   "actual_delivery_date", "is_fully_shipped", "cases_delivered", "logistics_cost_usd")},
}


def _family(f: Frames, family: str) -> DataFrame:
    """Written whole, then rebuilt from the last month on: the second write must change no row and no total of the measures."""
    f.share(**_SHARED.get(family, {}))
    root = work_dir(f.spark, f"kpi-{family}")
    for since in (None, AS_OF):
        kpi_tables.write_kpi_tables(inputs(f), root, AS_OF, since, (family,))
    parts = [kpi_tables.read_kpi_table(f.spark, root, name).groupBy(kpi_tables.MONTH).agg(
        F.count("*").alias("rows"), F.expr(_measured(name)).cast("decimal(30,4)").alias("measures")).select(
        F.lit(name).alias("table_name"), F.col(kpi_tables.MONTH).cast("string").alias(kpi_tables.MONTH), "rows", "measures") for name, _, _ in _TABLES[family]]
    return reduce(DataFrame.unionByName, parts)


for _name, _rows in _TABLES.items():
    query(f"kpi_tables_{_name}", " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, strftime({d}, '%Y-%m') AS report_month, count(*) AS rows, "
        f"CAST({_measured(t)} AS DECIMAL(30,4)) AS measures FROM {k} GROUP BY 2" for t, k, d in _rows))(
        lambda f, _name=_name: _family(f, _name))
