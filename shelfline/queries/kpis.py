"""KPI tables, alerts and further analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions import pct, ratio
from shelfline.functions.time import week_start
from shelfline.plans import alerts, extras, kpi_delivery, kpi_production, kpi_sales, kpi_stock, reports
from shelfline.queries import sqlframes as s
from shelfline.queries.frames import AS_OF, EVENTS_AS_OF, Frames
from shelfline.queries.registry import query

_FRAME_QUERIES = {
    "kc_01_daily_revenue": "kc_revenue",
    "kc_02_fulfillment_rate": "kc_fulfillment",
    "kc_03_inventory_turnover": "kc_turnover",
    "kc_04_production_yield": "kc_yield",
    "kpi_s01_daily_revenue": "kpi_s01",
    "kpi_s04_weekly_margin": "kpi_s04",
    "kpi_i01_stock_level": "kpi_i01",
    "kpi_i02_turnover_30d": "kpi_i02",
    "kpi_i03_days_of_inventory": "kpi_i03",
    "kpi_p01_batch_yield": "kpi_p01",
    "kpi_p02_quality_rate": "kpi_p02",
    "kpi_p03_unplanned_downtime": "kpi_p03",
    "kpi_p04_traceability": "kpi_p04",
    "kpi_d01_on_time_delivery": "kpi_d01",
    "kpi_d02_order_fulfillment": "kpi_d02",
    "kpi_d03_cost_per_case": "kpi_d03",
    "kpi_d04_worst_routes": "kpi_d04",
    "kpi_c01_top_retailers": "kpi_c01",
    "kpi_c02_acquisition_cost": "kpi_c02",
    "kpi_c03_retention": "kpi_c03",
    "kpi_c04_concentration": "kpi_c04",
}
for _key, _frame in _FRAME_QUERIES.items():
    query(_key, f"SELECT * FROM {_frame}")(lambda f, _frame=_frame: getattr(f, _frame))


@query("kpi_s02_month_over_month", """
SELECT comparison_month, product_category, region, channel, current_month_revenue, prior_month_revenue,
       mom_pct_change, data_as_of FROM kpi_s02""")
def month_over_month(f: Frames):
    return f.kpi_s02.select("comparison_month", *kpi_sales.GRAIN, "current_month_revenue",
                            "prior_month_revenue", "mom_pct_change", "data_as_of")


@query("kpi_s03_year_over_year", """
SELECT product_category, region, channel, current_ytd_revenue, prior_ytd_revenue, yoy_pct_change, data_as_of
FROM kpi_s02""")
def year_over_year(f: Frames):
    return f.kpi_s02.select(*kpi_sales.GRAIN, "current_ytd_revenue", "prior_ytd_revenue",
                            "yoy_pct_change", "data_as_of")


@query("kpi_i04_reorder_alert", f"""
SELECT * FROM fact_inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM fact_inventory WHERE snapshot_date <= {s.AS_OF})
AND reorder_alert_flag""")
def reorder_alert(f: Frames):
    return kpi_stock.reorder_alerts(f.fact_inventory, AS_OF)


# --- company-wide helpers used by the alert limits ---------------------------

s.FRAMES.update({
    "company_daily": "SELECT report_date, CAST(sum(net_revenue) AS DECIMAL(18,4)) AS net_revenue FROM kpi_s01 GROUP BY 1",
    "category_comparison": f"""
SELECT product_category, {s.pct('c - p', 'p', 18, 4)} AS mom_pct_change FROM (
SELECT product_category, sum(current_month_revenue) AS c, sum(prior_month_revenue) AS p FROM kpi_s02 GROUP BY 1)""",
    "company_comparison": f"""
SELECT {s.pct('c - p', 'p', 18, 4)} AS mom_pct_change, {s.pct('y - q', 'q', 18, 4)} AS yoy_pct_change FROM (
SELECT sum(current_month_revenue) AS c, sum(prior_month_revenue) AS p, sum(current_ytd_revenue) AS y,
       sum(prior_ytd_revenue) AS q FROM kpi_s02)""",
    "company_margin": f"""
SELECT week_start_date, {s.pct('sum(gross_margin_amount)', 'sum(net_revenue)', 18, 4)} AS gross_margin_pct
FROM kpi_s04 GROUP BY 1""",
    "reorder_count": f"""
SELECT count(*) FILTER (reorder_alert_flag) AS open_alerts, count(*) FILTER (units_on_hand = 0) AS stockouts
FROM fact_inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM fact_inventory WHERE snapshot_date <= {s.AS_OF})""",
    "trace_share": "SELECT max(traceability_pct) AS traceability_pct FROM kpi_p04",
    "rolling_otd": f"""
SELECT *, {s.pct('on_time_7d', 'total_7d')} AS otd_7d_pct FROM (
SELECT ship_date, total_shipments, on_time_shipments,
       CAST(sum(total_shipments) OVER w AS BIGINT) AS total_7d, CAST(sum(on_time_shipments) OVER w AS BIGINT) AS on_time_7d
FROM (SELECT ship_date, CAST(sum(total_shipments) AS BIGINT) AS total_shipments,
             CAST(sum(on_time_shipments) AS BIGINT) AS on_time_shipments FROM kpi_d01 GROUP BY 1)
WINDOW w AS (ORDER BY ship_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW))""",
    "company_cost": f"""
SELECT week_start_date, {s.ratio('sum(total_logistics_cost)', 'sum(total_cases_delivered)', 18, 4)} AS cost_per_case
FROM kpi_d03 GROUP BY 1""",
    "rolling_fulfillment": f"""
SELECT *, {s.pct('full_7d', 'orders_7d')} AS fulfillment_7d_pct FROM (
SELECT ship_date, total_orders, fully_shipped_orders,
       CAST(sum(total_orders) OVER w AS BIGINT) AS orders_7d, CAST(sum(fully_shipped_orders) OVER w AS BIGINT) AS full_7d
FROM (SELECT ship_date, CAST(sum(total_orders) AS BIGINT) AS total_orders,
             CAST(sum(fully_shipped_orders) AS BIGINT) AS fully_shipped_orders FROM kpi_d02 GROUP BY 1)
WINDOW w AS (ORDER BY ship_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW))""",
    "company_retention": f"""
SELECT {s.pct('sum(retained_count)', 'sum(prior_period_active_count)')} AS retention_rate_pct FROM kpi_c03""",
    "company_cac": f"""
SELECT {s.ratio('sum(total_acquisition_spend)', 'sum(new_accounts_count)', 18, 4)} AS cac_usd FROM kpi_c02""",
})


def alert_tables(f: Frames) -> dict:
    """Every frame the limits refer to. The conformed tables are stored first, so that all KPIs
    read those; so are the KPI tables that several limits read."""
    f.share("lines", "sale_lines", "sales", "shipments", "returns", "stock", "batches", "kpi_s01", "kpi_s04", "kpi_d01", "kpi_d02", "kpi_d03", "fact_inventory")
    newest = f.fact_inventory.where(F.col("snapshot_date") == reports.newest_day(f.fact_inventory, "snapshot_date", AS_OF))
    category = f.kpi_s02.groupBy("product_category").agg(
        F.sum("current_month_revenue").alias("c"), F.sum("prior_month_revenue").alias("p"))
    plain = ("kpi_s04", "kpi_i01", "kpi_i02", "kpi_i03", "kpi_p01", "kpi_p02", "kpi_p03", "kpi_d01",
             "kpi_d02", "kpi_d03", "kpi_d04", "kpi_c02", "kpi_c03", "kpi_c04")
    return {
        **{t: getattr(f, t) for t in plain},
        "company_daily": kpi_sales.company_daily(f.kpi_s01),
        "category_comparison": category.withColumn("mom_pct_change", pct(F.col("c") - F.col("p"), "p", 18, 4)),
        "company_comparison": kpi_sales.company_comparison(f.kpi_s02),
        "company_margin": f.kpi_s04.groupBy("week_start_date").agg(
            pct(F.sum("gross_margin_amount"), F.sum("net_revenue"), 18, 4).alias("gross_margin_pct")),
        "reorder_count": newest.agg(F.count_if("reorder_alert_flag").alias("open_alerts"),
                                    F.count_if(F.col("units_on_hand") == 0).alias("stockouts")),
        "trace_share": f.kpi_p04.agg(F.max("traceability_pct").alias("traceability_pct")),
        "rolling_otd": kpi_delivery.rolling_on_time(f.kpi_d01),
        "rolling_fulfillment": kpi_delivery.rolling_fulfillment(f.kpi_d02),
        "company_retention": f.kpi_c03.agg(
            pct(F.sum("retained_count"), F.sum("prior_period_active_count")).alias("retention_rate_pct")),
        "company_cost": f.kpi_d03.groupBy("week_start_date").agg(
            kpi_ratio("total_logistics_cost", "total_cases_delivered").alias("cost_per_case")),
        "company_cac": f.kpi_c02.agg(
            kpi_ratio("total_acquisition_spend", "new_accounts_count").alias("cac_usd")),
    }


def kpi_ratio(a: str, b: str):
    return ratio(F.sum(a), F.sum(b), 18, 4)


def _alert_sql() -> str:
    parts = []
    for x in alerts.LIMITS:
        scope = ("concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '∅')" for c in x.scope) + ")"
                 if x.scope else "'company'")
        parts.append(f"""SELECT '{x.kpi}' AS kpi, {scope} AS scope, CAST({x.measure} AS DECIMAL(18,4)) AS measure_value,
  CASE WHEN {x.critical} THEN 'CRITICAL' WHEN {x.warn} THEN 'WARN' END AS severity FROM {x.table}""")
    return "\nUNION ALL\n".join(parts)


s.FRAMES["alert_rows"] = f"SELECT * FROM (\n{_alert_sql()}\n) WHERE severity IS NOT NULL"


@query("alr_01_threshold_alerts", """
SELECT kpi, severity, count(*) AS alerts, min(measure_value) AS lowest, max(measure_value) AS highest
FROM alert_rows GROUP BY 1, 2""")
def threshold_alerts(f: Frames):
    return alerts.alert_summary(alerts.raise_alerts(alert_tables(f)))


@query("agg_13_rollups", """
SELECT report_month, region, channel, CAST(grouping_id(report_month, region, channel) AS INTEGER) AS level,
       CAST(sum(net_revenue) AS DECIMAL(18,4)) AS net_revenue, CAST(sum(units_sold) AS BIGINT) AS units_sold
FROM (SELECT *, strftime(report_date, '%Y-%m') AS report_month FROM kpi_s01)
GROUP BY GROUPING SETS ((report_month, region, channel), (report_month, region), (report_month), ())""")
def rollups(f: Frames):
    return kpi_sales.revenue_rollup(f.kpi_s01)


@query("win_10_trailing_on_time", "SELECT * FROM rolling_otd")
def trailing_on_time(f: Frames):
    return kpi_delivery.rolling_on_time(f.kpi_d01)


@query("win_10_trailing_fulfillment", "SELECT * FROM rolling_fulfillment")
def trailing_fulfillment(f: Frames):
    return kpi_delivery.rolling_fulfillment(f.kpi_d02)


@query("win_10_trailing_quality", f"""
SELECT *, {s.pct('passed_30d', 'batches_30d')} AS qc_pass_30d_pct FROM (
SELECT production_line_id, report_date, total_batches, passed_batches,
       CAST(sum(total_batches) OVER w AS BIGINT) AS batches_30d, CAST(sum(passed_batches) OVER w AS BIGINT) AS passed_30d
FROM (SELECT production_line_id, report_date, CAST(sum(total_batches) AS BIGINT) AS total_batches,
             CAST(sum(passed_batches) AS BIGINT) AS passed_batches FROM kpi_p02 WHERE report_date IS NOT NULL GROUP BY 1, 2)
WINDOW w AS (PARTITION BY production_line_id ORDER BY report_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW))""")
def trailing_quality(f: Frames):
    return kpi_production.quality_trend(f.kpi_p02)


@query("win_10_trailing_months", """
SELECT channel, month, net_revenue, CAST(sum(net_revenue) OVER (PARTITION BY channel ORDER BY year(month) * 12 + month(month)
       RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS DECIMAL(18,4)) AS trailing_revenue
FROM (SELECT channel, CAST(date_trunc('month', report_date) AS DATE) AS month, CAST(sum(net_revenue) AS DECIMAL(18,4)) AS net_revenue
      FROM kpi_s01 GROUP BY 1, 2)""")
def trailing_months(f: Frames):
    return kpi_sales.twelve_month_trend(f.kpi_s01)


@query("ext_01_top_skus", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY week_start_date, region, channel
               ORDER BY net_revenue DESC, sku_id) AS sku_rank
FROM (SELECT CAST(date_trunc('week', transaction_date) AS DATE) AS week_start_date, region, channel, sku_id,
             CAST(sum(net_revenue) AS DECIMAL(18,4)) AS net_revenue FROM net_lines GROUP BY 1, 2, 3, 4)) WHERE sku_rank <= 5""")
def top_skus(f: Frames):
    return extras.top_skus(f.sales, f.returns)


@query("ext_02_stockout_forecast", f"""
SELECT *, coalesce(days_to_stockout < 7, false) AS stockout_alert FROM (
SELECT h.sku_id, h.warehouse_id, h.snapshot_date, h.units_on_hand, p.units_sold,
       {s.ratio('h.units_on_hand * 7', 'p.units_sold', 18, 1)} AS days_to_stockout
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku_id, warehouse_id ORDER BY snapshot_date DESC) AS rn
      FROM stock WHERE snapshot_date <= {s.AS_OF}) WHERE rn = 1) h
JOIN (SELECT sku_id, warehouse_id, CAST(sum(quantity_sold) AS BIGINT) AS units_sold FROM sale_lines
      WHERE transaction_date > {s.AS_OF} - 7 AND transaction_date <= {s.AS_OF} GROUP BY 1, 2) p
  ON h.sku_id = p.sku_id AND h.warehouse_id = p.warehouse_id)""")
def stockout_forecast(f: Frames):
    return extras.stockout_forecast(f.sale_lines, f.stock, AS_OF)


@query("ext_03_yield_anomaly", f"""
SELECT production_line_id, report_date, yield_bp, n AS history_days,
       coalesce(n >= 5 AND (n * yield_bp - s) * (n * yield_bp - s) * (n - 1) > 4 * n * (n * q - s * s), false) AS is_outlier,
       {s.ratio('tn * txy - tx * ty', 'tn * txx - tx * tx', 18, 4)} AS slope_bp_per_day,
       coalesce(tn >= 15 AND tn * txy - tx * ty < 0, false) AS is_declining
FROM (SELECT *, count(yield_bp) OVER p AS n, sum(yield_bp) OVER p AS s, sum(yield_bp * yield_bp) OVER p AS q,
             count(yield_bp) OVER t AS tn, sum(x) OVER t AS tx, sum(yield_bp) OVER t AS ty,
             sum(x * yield_bp) OVER t AS txy, sum(x * x) OVER t AS txx
      FROM (SELECT production_line_id, report_date, total_actual_units * 10000 // total_expected_units AS yield_bp,
                   CAST(report_date - DATE '1970-01-01' AS BIGINT) AS x FROM kc_yield
            WHERE report_date IS NOT NULL AND total_expected_units > 0)
      WINDOW p AS (PARTITION BY production_line_id ORDER BY x RANGE BETWEEN 14 PRECEDING AND 1 PRECEDING),
             t AS (PARTITION BY production_line_id ORDER BY x RANGE BETWEEN 20 PRECEDING AND CURRENT ROW))""")
def yield_anomaly(f: Frames):
    return extras.yield_anomalies(f.kc_yield)


@query("ext_04_batch_to_shelf", """
SELECT batch_id, CAST(sum(shipments) AS BIGINT) AS shipments, count(*) AS retailers,
       CAST(coalesce(sum(l), 0) AS BIGINT) AS shelf_lines, CAST(coalesce(sum(u), 0) AS BIGINT) AS shelf_units
FROM (SELECT r.batch_id, r.retailer_id, r.shipments, count(s.sku_id) AS l, sum(s.quantity_sold) AS u
      FROM (SELECT b.batch_id, b.sku_id, h.retailer_id, min(h.ship_date) AS first_ship, count(*) AS shipments
            FROM batches b JOIN shipments h ON b.batch_id = h.batch_id GROUP BY 1, 2, 3) r
      LEFT JOIN sale_lines s ON s.retailer_id = r.retailer_id AND s.sku_id = r.sku_id AND s.transaction_date >= r.first_ship
      GROUP BY 1, 2, 3) GROUP BY 1""")
def batch_to_shelf(f: Frames):
    return extras.batch_to_shelf(f.batches, f.shipments, f.sale_lines)


@query("ext_04_shelf_allocation", """
WITH g AS (SELECT *, sum(units) OVER (PARTITION BY retailer_id, sku_id ORDER BY ship_date, batch_id ROWS UNBOUNDED PRECEDING) AS hi
           FROM (SELECT h.retailer_id, b.sku_id, b.batch_id, h.ship_date, sum(h.cases_delivered) AS units
                 FROM batches b JOIN shipments h ON b.batch_id = h.batch_id GROUP BY ALL) WHERE units > 0),
t AS (SELECT *, sum(units) OVER (PARTITION BY retailer_id, sku_id ORDER BY transaction_date ROWS UNBOUNDED PRECEDING) AS hi
      FROM (SELECT retailer_id, sku_id, transaction_date, sum(quantity_sold) AS units FROM sale_lines GROUP BY ALL) WHERE units > 0)
SELECT batch_id, CAST(sum(least(g.hi, t.hi) - greatest(g.hi - g.units, t.hi - t.units)) AS BIGINT) AS units_sold,
       count(DISTINCT g.retailer_id) AS retailers, min(transaction_date) AS first_sold, max(transaction_date) AS last_sold
FROM g JOIN t ON g.retailer_id = t.retailer_id AND g.sku_id = t.sku_id AND least(g.hi, t.hi) > greatest(g.hi - g.units, t.hi - t.units)
GROUP BY 1""")
def shelf_allocation(f: Frames):
    return extras.shelf_allocation(f.batches, f.shipments, f.sale_lines)


@query("ext_05_revenue_waterfall", """
SELECT *, CAST(gross_revenue - discounts - returned AS DECIMAL(18,4)) AS net_revenue FROM (
SELECT channel, CAST(sum(g) AS DECIMAL(18,4)) AS gross_revenue, CAST(sum(d) AS DECIMAL(18,4)) AS discounts,
       CAST(coalesce(sum(r), 0) AS DECIMAL(18,4)) AS returned
FROM (SELECT transaction_id, sku_id, channel, sum(unit_price * quantity_sold) AS g,
             sum(CAST(unit_price * quantity_sold * discount_pct * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4))) AS d
      FROM sale_lines GROUP BY 1, 2, 3) p
LEFT JOIN (SELECT transaction_id, sku_id, sum(return_amount) AS r FROM returns GROUP BY 1, 2) b
  ON p.transaction_id = b.transaction_id AND p.sku_id = b.sku_id GROUP BY 1)""")
def revenue_waterfall(f: Frames):
    return extras.revenue_waterfall(f.sale_lines, f.returns)


@query("ext_06_same_week_last_year", f"""
WITH w AS (SELECT CAST(isoyear(transaction_date) AS INTEGER) AS iso_year, CAST(weekofyear(transaction_date) AS INTEGER) AS iso_week,
       CAST(sum(unit_price * quantity_sold) AS DECIMAL(18,2)) AS revenue FROM sale_lines GROUP BY 1, 2)
SELECT a.*, b.revenue AS revenue_last_year, {s.pct('a.revenue - b.revenue', 'b.revenue', 18, 2)} AS change_pct
FROM w a LEFT JOIN w b ON a.iso_week = b.iso_week AND a.iso_year = b.iso_year + 1""")
def same_week_last_year(f: Frames):
    return extras.same_week_last_year(f.sale_lines)


@query("ext_07_morning_brief", f"""
SELECT (SELECT CAST(coalesce(sum(net_revenue), 0) AS DECIMAL(18,2)) FROM company_daily WHERE report_date = {s.AS_OF} - 1) AS revenue_yesterday,
  (SELECT otd_7d_pct FROM rolling_otd WHERE ship_date <= {s.AS_OF} ORDER BY ship_date DESC LIMIT 1) AS on_time_7d_pct,
  (SELECT open_alerts FROM reorder_count) AS open_reorder_alerts,
  (SELECT {s.pct('sum(total_actual_units)', 'sum(total_expected_units)')} FROM kc_yield
   WHERE report_date <= DATE '2024-01-30' GROUP BY report_date ORDER BY report_date DESC LIMIT 1) AS latest_yield_pct,
  (SELECT retailer_id FROM kpi_c01 ORDER BY revenue_rank LIMIT 1) AS top_retailer_id""")
def morning_brief(f: Frames):
    f.share("lines")
    return extras.morning_brief(
        kpi_sales.company_daily(f.kpi_s01), kpi_delivery.rolling_on_time(f.kpi_d01),
        kpi_stock.reorder_alerts(f.fact_inventory, AS_OF), f.kc_yield, f.kpi_c01, AS_OF, EVENTS_AS_OF)
