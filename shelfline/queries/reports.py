"""Report datasets."""

from __future__ import annotations

from shelfline.plans import dimensions, reports
from shelfline.queries import sqlframes as s
from shelfline.queries.frames import AS_OF, EVENTS_AS_OF, Frames
from shelfline.queries.registry import ORACLES, PLANS, query

WINDOW = f"BETWEEN {s.AS_OF} - 30 AND {s.AS_OF}"

s.FRAMES["newest_positions"] = f"""
SELECT * FROM fact_inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM fact_inventory WHERE snapshot_date <= {s.AS_OF})"""


@query("rpt_01_revenue_by_category", f"""
SELECT report_date, product_category, CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue,
       CAST(sum(total_gross_margin) AS DECIMAL(18,2)) AS total_gross_margin,
       {s.ratio('sum(gross_margin_pct)', 'count(gross_margin_pct)', 10, 6)} AS avg_margin_pct,
       CAST(sum(units_sold) AS BIGINT) AS units_sold, CAST(sum(transaction_count) AS BIGINT) AS transaction_count
FROM kc_revenue WHERE report_date {WINDOW} AND product_category IS NOT NULL
GROUP BY 1, 2 ORDER BY report_date DESC, total_revenue DESC""")
def revenue_by_category(f: Frames):
    return reports.revenue_by_category(f.kc_revenue, AS_OF)


@query("rpt_02_revenue_by_region", f"""
SELECT report_date, region, CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue,
       CAST(sum(total_gross_margin) AS DECIMAL(18,2)) AS total_gross_margin, CAST(sum(units_sold) AS BIGINT) AS units_sold
FROM kc_revenue WHERE report_date {WINDOW} AND region IS NOT NULL AND region <> ''
GROUP BY 1, 2 ORDER BY report_date DESC, region""")
def revenue_by_region(f: Frames):
    return reports.revenue_by_region(f.kc_revenue, AS_OF)


@query("rpt_03_turnover_by_warehouse", """
SELECT report_month, warehouse_key, avg_inventory_value, total_cogs, inventory_turnover_rate,
       days_inventory_outstanding, total_units_on_hand FROM kc_turnover WHERE report_month BETWEEN '2001-04' AND '2001-07'""")
def turnover_by_warehouse(f: Frames):
    return reports.turnover_by_warehouse(f.kc_turnover, AS_OF)


@query("rpt_04_yield_by_line", """
SELECT report_date, production_line_id, batch_count, avg_yield_rate_pct, min_yield_rate_pct, max_yield_rate_pct,
       overall_yield_pct, qc_pass_rate_pct, total_downtime_hours, total_expected_units, total_actual_units
FROM kc_yield WHERE report_date BETWEEN DATE '2024-01-30' - 30 AND DATE '2024-01-30'""")
def yield_by_line(f: Frames):
    return reports.yield_by_line(f.kc_yield, EVENTS_AS_OF)


@query("rpt_05_fulfillment_by_channel", f"""
SELECT report_date, channel, region, total_shipments, on_time_count, fully_shipped_count, on_time_delivery_pct,
       fulfillment_rate_pct, total_cases_delivered, total_logistics_cost, avg_logistics_cost_per_shipment
FROM kc_fulfillment WHERE report_date {WINDOW} AND channel IS NOT NULL AND channel <> ''""")
def fulfillment_by_channel(f: Frames):
    return reports.fulfillment_by_channel(f.kc_fulfillment, AS_OF)


@query("rpt_06_margin_by_sku", f"""
SELECT *, {s.pct('total_gross_margin', 'total_revenue', 18, 2)} AS gross_margin_pct FROM (
SELECT p.sku_id, p.product_name, p.product_category, p.price_tier, CAST(sum(net_revenue) AS DECIMAL(18,2)) AS total_revenue,
       CAST(sum(cogs) AS DECIMAL(18,2)) AS total_cogs, CAST(sum(gross_margin_amount) AS DECIMAL(18,2)) AS total_gross_margin,
       CAST(sum(quantity_sold) AS BIGINT) AS units_sold
FROM fact_sales f JOIN products p ON f.sku_id = p.sku_id WHERE transaction_date {WINDOW} GROUP BY 1, 2, 3, 4)
ORDER BY total_gross_margin DESC, sku_id LIMIT 20""")
def margin_by_sku(f: Frames):
    return reports.margin_by_sku(f.fact_sales, f.products, AS_OF)


@query("rpt_07_reorder_status", f"""
SELECT snapshot_date, warehouse_key, product_key, units_on_hand, reorder_point_units, inventory_value, dsi_days,
       reorder_alert_flag, CASE WHEN units_on_hand = 0 THEN 'OUT_OF_STOCK' WHEN reorder_alert_flag THEN 'REORDER_REQUIRED'
       ELSE 'OK' END AS stock_status
FROM fact_inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM fact_inventory WHERE snapshot_date <= {s.AS_OF})""")
def reorder_status(f: Frames):
    return reports.reorder_status(f.fact_inventory, AS_OF)


@query("rpt_08_month_cards", f"""
SELECT CAST((SELECT coalesce(sum(total_revenue), 0) FROM kc_revenue
        WHERE report_date BETWEEN DATE '2001-07-01' AND {s.AS_OF}) AS DECIMAL(18,2)) AS revenue_mtd,
  (SELECT {s.ratio('sum(inventory_turnover_rate)', 'count(inventory_turnover_rate)', 18, 2)} FROM kc_turnover
   WHERE report_month = '2001-07') AS avg_inventory_turnover,
  (SELECT {s.ratio('sum(avg_yield_rate_pct)', 'count(avg_yield_rate_pct)', 18, 1)} FROM kc_yield
   WHERE report_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30') AS avg_yield_rate_pct,
  (SELECT {s.ratio('sum(fulfillment_rate_pct)', 'count(fulfillment_rate_pct)', 18, 1)} FROM kc_fulfillment
   WHERE report_date BETWEEN DATE '2001-07-01' AND {s.AS_OF}) AS avg_on_time_pct""")
def month_cards(f: Frames):
    f.share("lines")
    return reports.month_cards(f.kc_revenue, f.kc_turnover, f.kc_yield, f.kc_fulfillment, AS_OF, EVENTS_AS_OF)


@query("rpt_09_top_customers", f"""
SELECT retailer_name, retail_segment, c.region, c.channel, CAST(sum(net_revenue) AS DECIMAL(18,2)) AS total_revenue,
       count(DISTINCT transaction_key) AS transaction_count,
       {s.ratio('sum(net_revenue)', 'count(net_revenue)', 18, 2)} AS avg_transaction_value
FROM fact_sales f JOIN customers c ON f.customer_key = c.surrogate_key AND c.is_current
WHERE transaction_date {WINDOW} GROUP BY 1, 2, 3, 4 ORDER BY total_revenue DESC, 1, 2, 3, 4 LIMIT 10""")
def top_customers(f: Frames):
    return reports.top_customers(f.fact_sales, f.customers, AS_OF)


@query("rpt_10_inventory_heatmap", f"""
SELECT warehouse_name, w.region AS warehouse_region, product_category, CAST(sum(units_on_hand) AS BIGINT) AS total_units,
       CAST(sum(units_on_hand * standard_cost_per_unit) AS DECIMAL(18,2)) AS inventory_value,
       {s.ratio('sum(dsi_days)', 'count(dsi_days)', 18, 1)} AS avg_days_of_supply
FROM newest_positions n JOIN warehouses w ON n.warehouse_id = w.warehouse_id JOIN products p ON n.sku_id = p.sku_id
GROUP BY 1, 2, 3""")
def inventory_heatmap(f: Frames):
    return reports.inventory_heatmap(f.fact_inventory, dimensions.warehouse_dimension(f.warehouses),
                                     dimensions.product_dimension(f.products), AS_OF)


@query("rpt_11_days_of_supply", f"""
SELECT warehouse_name, {s.ratio('sum(dsi_days)', 'count(dsi_days)', 18, 1)} AS avg_days_of_supply,
       min(dsi_days) AS min_days_of_supply, max(dsi_days) AS max_days_of_supply,
       count(*) FILTER (dsi_days < 7) AS low_stock_skus
FROM newest_positions n JOIN warehouses w ON n.warehouse_id = w.warehouse_id GROUP BY 1""")
def days_of_supply(f: Frames):
    return reports.days_of_supply(f.fact_inventory, dimensions.warehouse_dimension(f.warehouses), AS_OF)


# Narrower datasets of the same reports.
_DATASETS = {
    "rpt_01_dataset": ("rpt_01_revenue_by_category", ["report_date", "product_category", "total_revenue", "total_gross_margin", "units_sold"]),
    "rpt_02_dataset": ("rpt_02_revenue_by_region", ["report_date", "region", "total_revenue", "units_sold"]),
    "rpt_04_dataset": ("rpt_04_yield_by_line", ["report_date", "production_line_id", "batch_count", "avg_yield_rate_pct",
                                                 "min_yield_rate_pct", "max_yield_rate_pct", "qc_pass_rate_pct", "total_downtime_hours"]),
    "rpt_05_dataset": ("rpt_05_fulfillment_by_channel", ["report_date", "channel", "region", "total_shipments",
                                                          "on_time_delivery_pct", "fulfillment_rate_pct", "total_cases_delivered"]),
}
for _key, (_base, _columns) in _DATASETS.items():
    query(_key, f"SELECT {', '.join(_columns)} FROM ({ORACLES[_base]})")(
        lambda f, _base=_base, _columns=_columns: PLANS[_base](f.spark, f.dir).select(*_columns))
