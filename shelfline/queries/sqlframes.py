"""The same domain frames as oracle common table expressions."""

from __future__ import annotations

SEP = "chr(31)"


def key(*exprs: str) -> str:
    """60-bit MD5 key, equal to the Spark expression."""
    parts = ", ".join(f"coalesce(cast({e} AS VARCHAR), '∅')" for e in exprs)
    return f"(('0x' || substr(md5(concat_ws({SEP}, {parts})), 1, 15))::BIGINT)"


def digest(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(cast({e} AS VARCHAR), '∅')" for e in exprs)
    return f"md5(concat_ws({SEP}, {parts}))"


def ratio(num: str, den: str, precision: int = 18, scale: int = 4, factor: int = 1) -> str:
    """num / den * factor, half-up, in integer arithmetic; NULL on a zero divisor."""
    n = f"(CAST(CAST(({num}) AS DECIMAL(28,4)) * 10000 AS HUGEINT) * {factor} * {10 ** scale})"
    d = f"NULLIF(CAST(CAST(({den}) AS DECIMAL(28,4)) * 10000 AS HUGEINT), 0)"
    q = f"((2 * abs({n}) + abs({d})) // (2 * abs({d})))"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    unit = f"CAST(0.{'0' * (scale - 1)}1 AS DECIMAL({scale + 1},{scale}))" if scale else "1"
    return f"CAST(CAST({sign} * {q} AS DECIMAL({min(38 - scale - 1, 24)},0)) * {unit} AS DECIMAL({precision},{scale}))"


def pct(num: str, den: str, precision: int = 6, scale: int = 2) -> str:
    return ratio(num, den, precision, scale, 100)


def monday(expr: str) -> str:
    return f"CAST(date_trunc('week', {expr}) AS DATE)"


def month(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


CHANNEL = "CASE {k} % 3 WHEN 0 THEN 'Retail' WHEN 1 THEN 'Wholesale' ELSE 'DTC' END"

FRAMES: dict[str, str] = {
    "products": """
SELECT 'SKU-' || p_partkey AS sku_id, p_name AS product_name, p_type AS product_category, p_brand AS brand,
       p_size AS package_size_ml, CAST(p_retailprice AS DECIMAL(10,2)) AS list_price,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(50 + p_partkey % 40 AS DECIMAL(4,0))
            * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS standard_cost_per_unit,
       CASE p_partkey % 3 WHEN 0 THEN 'Economy' WHEN 1 THEN 'Standard' ELSE 'Premium' END AS price_tier
FROM part""",
    "account_feed": f"""
SELECT 'RTL-' || c_custkey AS retailer_id, c_name AS retailer_name, c_mktsegment AS retail_segment,
       {CHANNEL.format(k='c_custkey')} AS channel, r_name AS region, n_name AS state,
       CAST([15, 30, 45, 60, 90][c_custkey % 5 + 1] AS INTEGER) AS credit_terms_days,
       CAST(DATE '1995-01-01' + CAST(c_custkey * 7 % 2400 AS INTEGER) AS DATE) AS account_activation_date,
       CASE WHEN c_custkey % 20 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS account_status,
       DATE '1995-01-01' AS record_effective_date, c_custkey AS custkey
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "account_changes": """
SELECT * REPLACE (CASE WHEN custkey % 10 = 0 THEN 'KEY-ACCOUNT' ELSE retail_segment END AS retail_segment,
                  DATE '1999-01-01' AS record_effective_date)
FROM account_feed WHERE custkey % 10 <= 1""",
    "accounts": """
SELECT * REPLACE (CASE WHEN custkey % 10 = 0 THEN 'KEY-ACCOUNT' ELSE retail_segment END AS retail_segment)
FROM account_feed""",
    "account_history": """
SELECT retailer_id, retailer_name, channel, region, account_status, retail_segment,
       DATE '1995-01-01' AS valid_from,
       CASE WHEN custkey % 10 = 0 THEN DATE '1999-01-01' END AS valid_to, custkey % 10 <> 0 AS is_current
FROM account_feed
UNION ALL
SELECT retailer_id, retailer_name, channel, region, account_status, 'KEY-ACCOUNT', DATE '1999-01-01', NULL, TRUE
FROM account_feed WHERE custkey % 10 = 0""",
    "cost_history": """
SELECT sku_id, CAST(standard_cost_per_unit * CAST(100 + y - 1995 AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2))
       AS DECIMAL(10,2)) AS version_cost, make_date(y, 1, 1) AS valid_from,
       CASE WHEN y < 2001 THEN make_date(y + 1, 1, 1) END AS valid_to
FROM products, range(1995, 2002) AS r(y)""",
    "warehouses": """
SELECT 'WH-' || s_suppkey AS warehouse_id, s_name AS warehouse_name, r_name AS region, n_name AS state,
       CASE s_suppkey % 3 WHEN 0 THEN 'Distribution Center' WHEN 1 THEN 'Production Facility'
            ELSE 'Cold Storage' END AS warehouse_type,
       CAST(1000 + s_suppkey * 37 % 9000 AS INTEGER) AS capacity_units
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "sale_lines": f"""
SELECT 'TXN-' || l_orderkey AS transaction_id, l_linenumber AS line_no, 'SKU-' || l_partkey AS sku_id,
       'RTL-' || o_custkey AS retailer_id, 'WH-' || l_suppkey AS warehouse_id,
       CAST(l_quantity AS INTEGER) AS quantity_sold, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
       CAST(o_orderdate AS DATE) AS transaction_date, {CHANNEL.format(k='o_custkey')} AS channel,
       CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_pct
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "sales": """
SELECT s.*, a.region FROM sale_lines s JOIN accounts a ON s.retailer_id = a.retailer_id""",
    "returns": """
SELECT 'RET-' || l_orderkey || '-' || l_linenumber AS return_id, 'TXN-' || l_orderkey AS transaction_id,
       'SKU-' || l_partkey AS sku_id, CAST(l_linenumber % 3 + 1 AS INTEGER) AS quantity_returned,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(14,2)) AS return_amount,
       CAST(CAST(l_shipdate AS DATE) + 10 AS DATE) AS return_date,
       ['DAMAGED', 'EXPIRED', 'WRONG_ITEM', 'QUALITY', 'OTHER', 'UNKNOWN'][l_linenumber % 6 + 1] AS return_reason_code
FROM lineitem WHERE l_returnflag = 'R'""",
    "shipments": f"""
SELECT s.*, a.region FROM (
SELECT 'SHP-' || l_orderkey || '-' || l_linenumber AS shipment_id, 'ORD-' || l_orderkey AS order_id,
       'RTL-' || o_custkey AS retailer_id, 'WH-' || l_suppkey AS warehouse_id,
       'RT-' || (l_suppkey % 40) AS route_id, {CHANNEL.format(k='o_custkey')} AS channel,
       CAST(l_shipdate AS DATE) AS ship_date, CAST(CAST(l_shipdate AS DATE) + 5 AS DATE) AS promised_delivery_date,
       CASE WHEN l_partkey % 11 <> 0 THEN
         CAST(CAST(l_shipdate AS DATE) + CAST((l_partkey + l_suppkey) % 9 AS INTEGER) AS DATE) END AS actual_delivery_date,
       CAST(l_quantity AS INTEGER) AS cases_delivered,
       CAST(CAST(l_quantity AS DECIMAL(8,0)) * (CAST(3 AS DECIMAL(4,2))
            + CAST(l_suppkey % 17 AS DECIMAL(3,0)) * CAST(0.25 AS DECIMAL(3,2))) AS DECIMAL(10,2)) AS logistics_cost_usd,
       l_linestatus = 'F' AS is_fully_shipped, CAST(l_quantity AS INTEGER) AS quantity_ordered,
       CAST(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE l_quantity - 1 END AS INTEGER) AS quantity_shipped,
       CASE WHEN l_orderkey % 50 <> 0 THEN 'B-' || (l_orderkey % 2000) END AS batch_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey) s
JOIN accounts a ON s.retailer_id = a.retailer_id""",
    "stock": """
SELECT m.*, p.standard_cost_per_unit,
       CAST(m.units_on_hand * p.standard_cost_per_unit AS DECIMAL(14,2)) AS inventory_value
FROM (
SELECT 'SKU-' || p AS sku_id, 'WH-' || s AS warehouse_id, d AS snapshot_date,
       CAST((p * 31 + s * 17 + (d - DATE '1995-01-01') * 7) % 500 AS INTEGER) AS units_on_hand,
       CAST((p + s * 3 + (d - DATE '1995-01-01')) % 100 AS INTEGER) AS units_in_transit,
       CAST((p + (d - DATE '1995-01-01')) % 20 AS INTEGER) AS units_reserved,
       CAST(50 + (p + s) % 200 AS INTEGER) AS reorder_point_units
FROM (SELECT DISTINCT l_partkey AS p, l_suppkey AS s, CAST(o_orderdate AS DATE) AS d
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)) m
JOIN products p ON m.sku_id = p.sku_id""",
    "plant_events": """
SELECT 'EV-' || event_id AS event_id,
       CASE WHEN event_type NOT IN ('error', 'click') THEN 'B-' || (event_id // 5) END AS batch_id,
       'LINE-' || (user_id % 6) AS production_line_id,
       CASE event_type WHEN 'signup' THEN 'BATCH_START' WHEN 'purchase' THEN 'BATCH_END' WHEN 'view' THEN 'QC_CHECK'
            WHEN 'error' THEN 'DOWNTIME_UNPLANNED' ELSE 'DOWNTIME_PLANNED' END AS event_type,
       date_trunc('second', ts) AS event_timestamp,
       CASE WHEN event_type NOT IN ('error', 'click') THEN 'SKU-' || (event_id // 5 % 200) END AS sku_id,
       CASE WHEN event_type IN ('signup', 'purchase') THEN CAST(100 + event_id // 5 % 50 AS INTEGER) END AS expected_output_cases,
       CASE WHEN event_type = 'purchase' THEN
            CAST((100 + event_id // 5 % 50) * (80 + event_id % 25) // 100 AS INTEGER) END AS actual_output_cases,
       CASE WHEN event_type = 'view' THEN CASE WHEN event_id % 10 = 0 THEN 'FAIL' ELSE 'PASS' END
            WHEN event_type = 'purchase' THEN 'PENDING' END AS qc_status,
       CASE WHEN event_type IN ('error', 'click') THEN date_trunc('second', ts) END AS downtime_start_ts,
       CASE WHEN event_type IN ('error', 'click') THEN
            date_trunc('second', ts) + to_seconds(CAST(floor(value * 60) AS INTEGER)) END AS downtime_end_ts,
       event_id AS event_no
FROM events""",
}

DAILY_PROXY = ratio("units_in_transit", "7", 10, 2)

FRAMES.update({
    "prod_events": f"""
SELECT event_id, batch_id, production_line_id, event_type, event_timestamp, sku_id, expected_output_cases,
       actual_output_cases, qc_status, downtime_start_ts, downtime_end_ts, event_no,
       CAST(event_timestamp AS DATE) AS event_date, {key('event_id')} AS event_key,
       {ratio("epoch(downtime_end_ts) - epoch(downtime_start_ts)", "3600", 6, 2)} AS downtime_hours
FROM plant_events WHERE event_type IN ('QC_CHECK', 'DOWNTIME_UNPLANNED', 'DOWNTIME_PLANNED')""",
    "batch_pairs": f"""
SELECT e.batch_id, e.production_line_id, e.sku_id, e.expected_output_cases, e.actual_output_cases, e.qc_status,
       e.event_timestamp AS batch_end_ts, s.batch_start_ts, e.end_events,
       CAST(s.batch_start_ts AS DATE) AS batch_date, {key('e.batch_id')} AS batch_key
FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY event_timestamp, event_id) AS rn,
             count(*) OVER (PARTITION BY batch_id) AS end_events
      FROM plant_events WHERE event_type = 'BATCH_END' AND batch_id IS NOT NULL) e
LEFT JOIN (SELECT batch_id, min(event_timestamp) AS batch_start_ts FROM plant_events
           WHERE event_type = 'BATCH_START' GROUP BY batch_id) s ON e.batch_id = s.batch_id
WHERE e.rn = 1""",
    "batches": f"""
SELECT *, coalesce(yield_rate_pct NOT BETWEEN 0 AND 110, true) AS _dq_range_yield_rate_pct FROM (
SELECT p.batch_id, production_line_id, sku_id, expected_output_cases, actual_output_cases,
       CASE WHEN qc.ok IS NULL THEN p.qc_status WHEN qc.ok THEN 'PASS' ELSE 'FAIL' END AS qc_status,
       batch_end_ts, batch_start_ts, end_events, batch_date, batch_key,
       CASE WHEN expected_output_cases > 0 THEN
       {pct('actual_output_cases', 'expected_output_cases', 5, 2)} END AS yield_rate_pct,
       coalesce(qc.ok, CASE p.qc_status WHEN 'PASS' THEN true WHEN 'FAIL' THEN false END) AS qc_pass_flag
FROM batch_pairs p LEFT JOIN (
  SELECT batch_id, bool_and(qc_status IS DISTINCT FROM 'FAIL') AS ok FROM plant_events
  WHERE event_type = 'QC_CHECK' GROUP BY batch_id) qc ON p.batch_id = qc.batch_id
WHERE expected_output_cases >= 1)""",
    "reorder": """
SELECT sku_id, warehouse_id, reorder_point_units,
       CAST(trunc(reorder_point_units * CAST(0.2 AS DECIMAL(2,1))) AS INTEGER) AS safety_stock_units
FROM (SELECT *, row_number() OVER (PARTITION BY sku_id, warehouse_id
             ORDER BY snapshot_date DESC, reorder_point_units) AS rn FROM stock) WHERE rn = 1""",
    "spend": f"""
SELECT retailer_id, retail_segment, region, trade_spend_usd, broker_commission_usd, field_sales_cost_usd,
       period_start_date, period_end_date,
       CAST(trade_spend_usd + broker_commission_usd + field_sales_cost_usd AS DECIMAL(14,4)) AS total_acquisition_cost_usd,
       {key('retailer_id', 'period_start_date')} AS spend_key
FROM (SELECT retailer_id, retail_segment, region, CAST(custkey % 50 * 100 AS DECIMAL(14,4)) AS trade_spend_usd,
             CAST(custkey % 20 * 50 AS DECIMAL(14,4)) AS broker_commission_usd,
             CAST(custkey % 10 * 75 AS DECIMAL(14,4)) AS field_sales_cost_usd,
             {month('account_activation_date')} AS period_start_date,
             last_day(account_activation_date) AS period_end_date FROM account_feed)""",
    "customers": f"""
SELECT *, {key('retailer_id', 'valid_from')} AS surrogate_key FROM account_history""",
    "fact_sales": f"""
SELECT {key('transaction_id', 'line_no', 'l.sku_id')} AS transaction_key,
       CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key, {key('l.sku_id')} AS product_key,
       c.surrogate_key AS customer_key, {key('warehouse_id')} AS warehouse_key, quantity_sold, unit_price,
       CAST(unit_price * quantity_sold AS DECIMAL(14,2)) AS net_revenue,
       CAST(0 AS DECIMAL(10,2)) AS return_amount,
       CAST(p.standard_cost_per_unit * quantity_sold AS DECIMAL(14,2)) AS cogs,
       CAST(unit_price * quantity_sold - p.standard_cost_per_unit * quantity_sold AS DECIMAL(14,2)) AS gross_margin_amount,
       transaction_date, l.sku_id, l.retailer_id, warehouse_id, transaction_id, l.channel
FROM sale_lines l LEFT JOIN products p ON l.sku_id = p.sku_id
LEFT JOIN customers c ON l.retailer_id = c.retailer_id AND c.is_current""",
    "fact_inventory": f"""
SELECT {key('s.sku_id', 's.warehouse_id', 'snapshot_date')} AS snapshot_key,
       CAST(strftime(snapshot_date, '%Y%m%d') AS INTEGER) AS date_key, {key('s.sku_id')} AS product_key,
       {key('s.warehouse_id')} AS warehouse_key, units_on_hand, inventory_value,
       coalesce(r.reorder_point_units, 0) AS reorder_point_units,
       units_on_hand <= coalesce(r.reorder_point_units, 0) AS reorder_alert_flag,
       {ratio('units_on_hand', f'greatest({DAILY_PROXY}, CAST(1 AS DECIMAL(10,2)))', 8, 1)} AS dsi_days,
       snapshot_date, s.sku_id, s.warehouse_id
FROM stock s LEFT JOIN reorder r ON s.sku_id = r.sku_id AND s.warehouse_id = r.warehouse_id""",
    "stop_overlaps": """
SELECT b.batch_id, e.event_type,
       CAST(epoch(least(batch_end_ts, downtime_end_ts)) - epoch(greatest(batch_start_ts, downtime_start_ts)) AS BIGINT)
         AS overlap_seconds
FROM batches b JOIN prod_events e ON b.production_line_id = e.production_line_id
 AND e.event_type LIKE 'DOWNTIME%' AND downtime_start_ts < batch_end_ts AND batch_start_ts < downtime_end_ts
 AND batch_start_ts < batch_end_ts AND downtime_start_ts < downtime_end_ts""",
    "fact_batch": f"""
SELECT batch_key, CAST(strftime(batch_date, '%Y%m%d') AS INTEGER) AS date_key, {key('sku_id')} AS product_key,
       CAST(NULL AS BIGINT) AS warehouse_key, b.batch_id, production_line_id,
       expected_output_cases AS expected_output_units, actual_output_cases AS actual_output_units,
       yield_rate_pct, qc_pass_flag, qc_status,
       coalesce({ratio('o.s', '3600', 8, 2)}, CAST(0 AS DECIMAL(8,2))) AS downtime_hours,
       coalesce({ratio('o.p', '3600', 8, 2)}, CAST(0 AS DECIMAL(8,2))) AS planned_downtime_hours,
       coalesce({ratio('o.u', '3600', 8, 2)}, CAST(0 AS DECIMAL(8,2))) AS unplanned_downtime_hours, batch_date
FROM batches b LEFT JOIN (SELECT batch_id, sum(overlap_seconds) AS s,
    coalesce(sum(overlap_seconds) FILTER (event_type = 'DOWNTIME_PLANNED'), 0) AS p,
    coalesce(sum(overlap_seconds) FILTER (event_type = 'DOWNTIME_UNPLANNED'), 0) AS u FROM stop_overlaps GROUP BY batch_id) o
  ON b.batch_id = o.batch_id""",
    "fact_shipment": f"""
SELECT {key('shipment_id')} AS shipment_key, CAST(strftime(ship_date, '%Y%m%d') AS INTEGER) AS date_key,
       c.surrogate_key AS customer_key, {key('warehouse_id')} AS warehouse_key, {key('s.channel')} AS channel_key,
       {key('s.region')} AS region_key, shipment_id, route_id, promised_delivery_date, actual_delivery_date,
       coalesce(actual_delivery_date <= promised_delivery_date, false) AS on_time_flag, cases_delivered,
       logistics_cost_usd, is_fully_shipped, ship_date
FROM shipments s LEFT JOIN customers c ON s.retailer_id = c.retailer_id AND c.is_current""",
    "kc_revenue": f"""
SELECT *, CASE WHEN total_revenue > 0 THEN {pct('total_gross_margin', 'total_revenue')}
               ELSE CAST(0 AS DECIMAL(6,2)) END AS gross_margin_pct
FROM (SELECT transaction_date AS report_date, product_category, c.region, c.channel,
             CAST(sum(net_revenue) AS DECIMAL(16,2)) AS total_revenue, CAST(sum(cogs) AS DECIMAL(16,2)) AS total_cogs,
             CAST(sum(gross_margin_amount) AS DECIMAL(16,2)) AS total_gross_margin,
             CAST(sum(quantity_sold) AS BIGINT) AS units_sold, count(DISTINCT transaction_key) AS transaction_count
      FROM fact_sales f LEFT JOIN products p ON f.sku_id = p.sku_id
      LEFT JOIN customers c ON f.customer_key = c.surrogate_key AND c.is_current GROUP BY ALL)""",
    "kc_fulfillment": f"""
SELECT * EXCLUDE (priced), {ratio('total_logistics_cost', 'priced', 10, 2)} AS avg_logistics_cost_per_shipment,
       {pct('on_time_count', 'total_shipments')} AS on_time_delivery_pct,
       {pct('fully_shipped_count', 'total_shipments')} AS fulfillment_rate_pct
FROM (SELECT ship_date AS report_date, channel, region, count(*) AS total_shipments,
             count(*) FILTER (on_time_flag) AS on_time_count, count(*) FILTER (is_fully_shipped) AS fully_shipped_count,
             CAST(sum(cases_delivered) AS BIGINT) AS total_cases_delivered,
             CAST(sum(logistics_cost_usd) AS DECIMAL(14,2)) AS total_logistics_cost, count(logistics_cost_usd) AS priced
      FROM fact_shipment f LEFT JOIN customers c ON f.customer_key = c.surrogate_key AND c.is_current GROUP BY ALL)""",
    "kc_turnover": f"""
SELECT *, CASE WHEN inventory_turnover_rate > 0 THEN {ratio('365', 'inventory_turnover_rate', 8, 1)} END
          AS days_inventory_outstanding
FROM (SELECT i.warehouse_key, i.report_month, avg_inventory_value, total_units_on_hand, total_cogs,
             CASE WHEN avg_inventory_value > 0 THEN {ratio('total_cogs', 'avg_inventory_value', 8, 2)} END
               AS inventory_turnover_rate
      FROM (SELECT warehouse_key, strftime(snapshot_date, '%Y-%m') AS report_month,
                   {ratio('sum(inventory_value)', 'count(inventory_value)', 16, 2)} AS avg_inventory_value,
                   CAST(sum(units_on_hand) AS BIGINT) AS total_units_on_hand FROM fact_inventory GROUP BY 1, 2) i
      LEFT JOIN (SELECT warehouse_key, strftime(transaction_date, '%Y-%m') AS report_month,
                        CAST(sum(cogs) AS DECIMAL(16,2)) AS total_cogs FROM fact_sales GROUP BY 1, 2) c
        ON i.warehouse_key = c.warehouse_key AND i.report_month = c.report_month)""",
    "kc_yield": f"""
SELECT report_date, production_line_id, batch_count, min_yield_rate_pct, max_yield_rate_pct, total_expected_units,
       total_actual_units, total_downtime_hours, {ratio('y', 'n', 6, 2)} AS avg_yield_rate_pct,
       {pct('passed', 'batch_count')} AS qc_pass_rate_pct,
       CASE WHEN total_expected_units > 0 THEN {pct('total_actual_units', 'total_expected_units')} END AS overall_yield_pct
FROM (SELECT batch_date AS report_date, production_line_id, count(*) AS batch_count, sum(yield_rate_pct) AS y,
             count(yield_rate_pct) AS n, CAST(min(yield_rate_pct) AS DECIMAL(6,2)) AS min_yield_rate_pct,
             CAST(max(yield_rate_pct) AS DECIMAL(6,2)) AS max_yield_rate_pct,
             CAST(sum(expected_output_units) AS BIGINT) AS total_expected_units,
             CAST(sum(actual_output_units) AS BIGINT) AS total_actual_units,
             CAST(sum(downtime_hours) AS DECIMAL(10,2)) AS total_downtime_hours,
             sum(CAST(qc_pass_flag AS INTEGER)) AS passed
      FROM fact_batch GROUP BY 1, 2)""",
})


def _flag(condition: str) -> str:
    return f"coalesce({condition}, false)"


AS_OF = "DATE '2001-07-15'"
WEEK0 = "DATE '2001-07-09'"   # Monday of the week of AS_OF

FRAMES.update({
    "net_lines": """
SELECT s.*, coalesce(r.return_amount, CAST(0 AS DECIMAL(18,4))) AS return_amount,
       CAST(s.gross_sales_amount - coalesce(r.return_amount, 0) AS DECIMAL(18,4)) AS net_revenue
FROM (SELECT transaction_id, sku_id, transaction_date, retailer_id, region, channel,
             CAST(sum(unit_price * quantity_sold) AS DECIMAL(18,4)) AS gross_sales_amount,
             CAST(sum(quantity_sold) AS BIGINT) AS units_sold FROM sales GROUP BY ALL) s
LEFT JOIN (SELECT transaction_id, sku_id, CAST(sum(return_amount) AS DECIMAL(18,4)) AS return_amount
           FROM returns GROUP BY ALL) r ON s.transaction_id = r.transaction_id AND s.sku_id = r.sku_id""",
    "kpi_s01": f"""
SELECT *, {key('report_date', 'product_category', 'region', 'channel')} AS revenue_key FROM (
SELECT transaction_date AS report_date, product_category, region, channel,
       CAST(sum(gross_sales_amount) AS DECIMAL(18,4)) AS gross_sales_amount,
       CAST(sum(return_amount) AS DECIMAL(18,4)) AS return_amount, CAST(sum(net_revenue) AS DECIMAL(18,4)) AS net_revenue,
       count(DISTINCT transaction_id) AS transaction_count, CAST(sum(units_sold) AS BIGINT) AS units_sold
FROM net_lines l JOIN products p ON l.sku_id = p.sku_id GROUP BY ALL)""",
    "kpi_s02": f"""
SELECT *, '2001-07' AS comparison_month,
       {pct('current_month_revenue - prior_month_revenue', 'prior_month_revenue', 18, 4)} AS mom_pct_change,
       {pct('current_ytd_revenue - prior_ytd_revenue', 'prior_ytd_revenue', 18, 4)} AS yoy_pct_change,
       {AS_OF} AS data_as_of
FROM (SELECT product_category, region, channel,
  CAST(coalesce(sum(net_revenue) FILTER (report_date BETWEEN DATE '2001-07-01' AND {AS_OF}), 0) AS DECIMAL(18,4)) AS current_month_revenue,
  CAST(coalesce(sum(net_revenue) FILTER (report_date BETWEEN DATE '2001-06-01' AND DATE '2001-06-15'), 0) AS DECIMAL(18,4)) AS prior_month_revenue,
  CAST(coalesce(sum(net_revenue) FILTER (report_date BETWEEN DATE '2001-01-01' AND {AS_OF}), 0) AS DECIMAL(18,4)) AS current_ytd_revenue,
  CAST(coalesce(sum(net_revenue) FILTER (report_date BETWEEN DATE '2000-01-01' AND DATE '2000-07-15'), 0) AS DECIMAL(18,4)) AS prior_ytd_revenue
FROM kpi_s01 WHERE report_date BETWEEN DATE '2001-01-01' AND {AS_OF}
   OR report_date BETWEEN DATE '2000-01-01' AND DATE '2000-07-15' GROUP BY 1, 2, 3)""",
    "kpi_s04": f"""
SELECT *, {_flag('gross_margin_pct < 30')} AS margin_alert_flag, week_start_date = {WEEK0} AS is_partial_week,
       {key('week_start_date', 'sku_id')} AS margin_key
FROM (SELECT *, {pct('gross_margin_amount', 'net_revenue', 18, 4)} AS gross_margin_pct FROM (
  SELECT *, CAST(net_revenue - cogs AS DECIMAL(18,4)) AS gross_margin_amount FROM (
    SELECT {monday('transaction_date')} AS week_start_date, l.sku_id, product_category, product_name,
           CAST(sum(net_revenue) AS DECIMAL(18,4)) AS net_revenue, CAST(sum(units_sold) AS BIGINT) AS units_sold,
           CAST(sum(standard_cost_per_unit * units_sold) AS DECIMAL(18,4)) AS cogs
    FROM net_lines l JOIN products p ON l.sku_id = p.sku_id WHERE transaction_date <= {AS_OF} GROUP BY ALL)))""",
    "kpi_i01": f"""
SELECT s.sku_id, s.warehouse_id, snapshot_date, units_on_hand, inventory_value, r.reorder_point_units, product_name,
       product_category, {key('snapshot_date', 's.sku_id', 's.warehouse_id')} AS stock_level_key,
       r.reorder_point_units - units_on_hand AS deficit_units, units_on_hand <= r.reorder_point_units AS reorder_alert_flag,
       units_on_hand = 0 AS stockout_flag
FROM stock s JOIN reorder r ON s.sku_id = r.sku_id AND s.warehouse_id = r.warehouse_id
JOIN products p ON s.sku_id = p.sku_id WHERE snapshot_date = {AS_OF}""",
    "sold_where_stocked": f"""
SELECT s.sku_id, k.warehouse_id, sum(s.quantity_sold) AS units FROM sale_lines s
JOIN stock k ON s.sku_id = k.sku_id AND s.transaction_date = k.snapshot_date
WHERE s.transaction_date BETWEEN {AS_OF} - 30 AND {AS_OF} GROUP BY 1, 2""",
    "kpi_i02": f"""
SELECT *, {_flag('inventory_turnover_rate < 0.5')} AS turnover_alert_flag FROM (
SELECT *, {ratio('cogs_30d', 'avg_inventory_value_30d', 18, 4)} AS inventory_turnover_rate,
       {ratio('cogs_30d', 'avg_inventory_value_30d', 18, 4, 12)} AS annualized_turnover FROM (
SELECT warehouse_id, cogs_30d, {WEEK0} AS week_start_date, {ratio('v', 'n', 18, 4)} AS avg_inventory_value_30d
FROM (SELECT u.warehouse_id, CAST(sum(p.standard_cost_per_unit * u.units) AS DECIMAL(18,4)) AS cogs_30d
      FROM sold_where_stocked u JOIN products p ON u.sku_id = p.sku_id GROUP BY 1) c
JOIN (SELECT warehouse_id, CAST(sum(inventory_value) AS DECIMAL(24,2)) AS v, count(inventory_value) AS n FROM stock
      WHERE snapshot_date BETWEEN {AS_OF} - 30 AND {AS_OF} GROUP BY 1) a USING (warehouse_id)))""",
    "kpi_i03": f"""
SELECT *, {_flag('dsi_days < 10 OR dsi_days > 60')} AS dsi_warn_flag, {_flag('dsi_days < 7')} AS dsi_critical_flag
FROM (SELECT k.sku_id, k.warehouse_id, units_on_hand, {AS_OF} AS report_date,
             {ratio('u.units', '30', 18, 4)} AS avg_daily_sales_units,
             {ratio('units_on_hand * 30', 'u.units', 18, 2)} AS dsi_days
      FROM stock k LEFT JOIN sold_where_stocked u ON k.sku_id = u.sku_id AND k.warehouse_id = u.warehouse_id
      WHERE snapshot_date = {AS_OF})""",
    "kpi_p01": f"""
SELECT {key('batch_id')} AS yield_key, batch_date, batch_id, production_line_id, b.sku_id, product_category,
       expected_output_cases, actual_output_cases, yield_rate_pct, qc_status,
       {_flag('yield_rate_pct < 92')} AS yield_warn_flag, {_flag('yield_rate_pct < 85')} AS yield_critical_flag
FROM batches b JOIN products p ON b.sku_id = p.sku_id""",
    "kpi_p02": f"""
SELECT *, {_flag('qc_pass_rate_pct < 96')} AS qc_warn_flag, {_flag('qc_pass_rate_pct < 90')} AS qc_critical_flag
FROM (SELECT *, {pct('passed_batches', 'total_batches')} AS qc_pass_rate_pct FROM (
  SELECT batch_date AS report_date, production_line_id, product_category, count(*) AS total_batches,
         count(*) FILTER (qc_status = 'PASS') AS passed_batches
  FROM batches b JOIN products p ON b.sku_id = p.sku_id WHERE qc_status IS NOT NULL GROUP BY 1, 2, 3))""",
    "kpi_p03": f"""
SELECT *, downtime_hours > 2 AS downtime_warn_flag, downtime_hours > 6 AS downtime_critical_flag FROM (
SELECT event_date, production_line_id, count(event_id) AS total_downtime_events,
       {ratio('sum(epoch(downtime_end_ts) - epoch(downtime_start_ts))', '3600', 10, 2)} AS downtime_hours
FROM prod_events WHERE event_type = 'DOWNTIME_UNPLANNED' GROUP BY 1, 2)""",
    "trace_chain": f"""
SELECT b.batch_id, s.shipment_id, s.retailer_id, s.shipment_id IS NOT NULL AND a.retailer_id IS NOT NULL AS is_fully_traceable,
       coalesce(b.qc_status = 'PASS' AND {ratio("epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(batch_end_ts)", '3600', 18, 2)} > 48, false) AS eligible
FROM batches b LEFT JOIN (SELECT * FROM shipments WHERE batch_id IS NOT NULL) s ON b.batch_id = s.batch_id
LEFT JOIN accounts a ON s.retailer_id = a.retailer_id""",
    "kpi_p04": f"""
SELECT c.*, t.p AS traceability_pct, {_flag('t.p < 98')} AS trace_warn_flag FROM trace_chain c,
 (SELECT {pct('count(*) FILTER (ok)', 'count(*)')} AS p
  FROM (SELECT batch_id, bool_or(is_fully_traceable) AS ok FROM trace_chain GROUP BY 1)) t""",
    "kpi_d01": f"""
SELECT *, {_flag('otd_pct < 90')} AS otd_warn_flag, {_flag('otd_pct < 80')} AS otd_critical_flag FROM (
SELECT *, {pct('on_time_shipments', 'total_shipments')} AS otd_pct FROM (
SELECT ship_date, channel, region, count(shipment_id) AS total_shipments,
       count(*) FILTER (actual_delivery_date <= promised_delivery_date) AS on_time_shipments
FROM shipments WHERE actual_delivery_date IS NOT NULL GROUP BY 1, 2, 3))""",
    "kpi_d02": f"""
SELECT *, {_flag('fulfillment_rate_pct < 95')} AS fulfillment_warn_flag,
       {_flag('fulfillment_rate_pct < 90')} AS fulfillment_critical_flag FROM (
SELECT *, {pct('fully_shipped_orders', 'total_orders')} AS fulfillment_rate_pct FROM (
SELECT ship_date, channel, count(*) AS total_orders, count(*) FILTER (f) AS fully_shipped_orders
FROM (SELECT ship_date, channel, order_id, bool_and(is_fully_shipped) AS f FROM shipments GROUP BY 1, 2, 3) GROUP BY 1, 2))""",
    "kpi_d03": f"""
SELECT *, {_flag('cost_per_case > 5')} AS cost_warn_flag, {_flag('cost_per_case > 6')} AS cost_critical_flag FROM (
SELECT *, {ratio('total_logistics_cost', 'total_cases_delivered', 18, 4)} AS cost_per_case FROM (
SELECT {monday('ship_date')} AS week_start_date, region, route_id, channel,
       CAST(sum(logistics_cost_usd) AS DECIMAL(18,2)) AS total_logistics_cost,
       CAST(sum(cases_delivered) AS BIGINT) AS total_cases_delivered FROM shipments GROUP BY 1, 2, 3, 4))""",
    "route_weeks": f"""
SELECT {monday('ship_date')} AS week_start_date, route_id, region, count(shipment_id) AS total_shipments,
       count(*) FILTER (actual_delivery_date <= promised_delivery_date) AS on_time_shipments,
       {pct('count(*) FILTER (actual_delivery_date <= promised_delivery_date)', 'count(shipment_id)', 18, 6)} AS route_otd_pct,
       {ratio('sum(logistics_cost_usd)', 'sum(cases_delivered)', 18, 4)} AS route_cost_per_case
FROM shipments WHERE actual_delivery_date IS NOT NULL GROUP BY 1, 2, 3""",
    "kpi_d04": """
SELECT *, route_otd_pct < 80 AS route_warn_flag,
       route_otd_pct < 70 OR consecutive_weeks_in_worst10 >= 3 AS route_critical_flag
FROM (SELECT * EXCLUDE (island), row_number() OVER (PARTITION BY route_id, region, island ORDER BY week_start_date)
             AS consecutive_weeks_in_worst10
      FROM (SELECT *, week_start_date - CAST(7 * row_number() OVER (PARTITION BY route_id, region ORDER BY week_start_date) AS INTEGER) AS island
            FROM (SELECT *, rank() OVER (PARTITION BY week_start_date ORDER BY route_otd_pct, route_cost_per_case DESC)
                         AS worst_route_rank FROM route_weeks) WHERE worst_route_rank <= 10))""",
    "kpi_c01": f"""
SELECT {WEEK0} - 7 AS period_start_date, {WEEK0} - 1 AS period_end_date, retailer_id, retailer_name, region, retail_segment,
       retailer_net_revenue, {pct('retailer_net_revenue', 'total', 18, 4)} AS pct_of_total_revenue, revenue_rank,
       prior_period_rank, prior_period_rank - revenue_rank AS rank_movement
FROM (SELECT *, row_number() OVER (ORDER BY retailer_net_revenue DESC NULLS LAST, retailer_id) AS revenue_rank,
             CASE WHEN prior_revenue IS NOT NULL THEN
               row_number() OVER (ORDER BY prior_revenue DESC NULLS LAST, retailer_id) END AS prior_period_rank,
             sum(retailer_net_revenue) OVER () AS total
      FROM (SELECT a.retailer_id, a.retailer_name, a.region, a.retail_segment,
                   CAST(sum(net_revenue) FILTER (transaction_date >= {WEEK0} - 7) AS DECIMAL(18,4)) AS retailer_net_revenue,
                   CAST(sum(net_revenue) FILTER (transaction_date < {WEEK0} - 7) AS DECIMAL(18,4)) AS prior_revenue
            FROM net_lines l JOIN accounts a ON l.retailer_id = a.retailer_id
            WHERE transaction_date >= {WEEK0} - 14 AND transaction_date < {WEEK0} GROUP BY 1, 2, 3, 4))
WHERE revenue_rank <= 20 AND retailer_net_revenue IS NOT NULL""",
    "kpi_c02": f"""
SELECT *, '2001-06' AS period_month, DATE '2001-06-01' AS period_start_date, DATE '2001-06-30' AS period_end_date,
       {_flag('cac_usd > 3000')} AS cac_warn_flag, {_flag('cac_usd > 5000')} AS cac_critical_flag FROM (
SELECT *, {ratio('total_acquisition_spend', 'new_accounts_count', 18, 4)} AS cac_usd FROM (
SELECT a.retail_segment, a.region, count(DISTINCT a.retailer_id) AS new_accounts_count,
       CAST(coalesce(sum(s.paid), 0) AS DECIMAL(18,4)) AS total_acquisition_spend
FROM accounts a LEFT JOIN (SELECT retailer_id, sum(total_acquisition_cost_usd) AS paid FROM spend
     WHERE date_trunc('month', period_start_date) = DATE '2001-06-01' GROUP BY 1) s ON a.retailer_id = s.retailer_id
WHERE date_trunc('month', account_activation_date) = DATE '2001-06-01' GROUP BY 1, 2))""",
    "kpi_c03": f"""
SELECT *, {_flag('retention_rate_pct < 85')} AS retention_warn_flag, {_flag('retention_rate_pct < 75')} AS retention_critical_flag
FROM (SELECT *, '2001-06' AS period_month, prior_period_active_count - retained_count AS churned_count,
             {pct('retained_count', 'prior_period_active_count')} AS retention_rate_pct FROM (
  SELECT a.region, a.retail_segment, count(*) AS prior_period_active_count, count(c.retailer_id) AS retained_count
  FROM (SELECT DISTINCT retailer_id FROM sale_lines WHERE date_trunc('month', transaction_date) = DATE '2001-05-01') p
  JOIN accounts a ON p.retailer_id = a.retailer_id
  LEFT JOIN (SELECT DISTINCT retailer_id FROM sale_lines WHERE date_trunc('month', transaction_date) = DATE '2001-06-01') c
    ON p.retailer_id = c.retailer_id GROUP BY 1, 2))""",
    "kpi_c04": f"""
SELECT *, {_flag('top5_concentration_pct > 30')} AS concentration_warn_flag,
       {_flag('top5_concentration_pct > 40 OR top1_revenue_pct > 15')} AS concentration_critical_flag
FROM (SELECT '2001-06' AS period_month, total AS total_net_revenue, top5 AS top5_net_revenue, top1 AS top1_retailer_id,
             {pct('top5', 'total')} AS top5_concentration_pct, {pct('top1_net', 'total')} AS top1_revenue_pct
      FROM (SELECT CAST(sum(net) AS DECIMAL(18,4)) AS total, CAST(sum(net) FILTER (rn <= 5) AS DECIMAL(18,4)) AS top5,
                   max(retailer_id) FILTER (rn = 1) AS top1, max(net) FILTER (rn = 1) AS top1_net
            FROM (SELECT *, row_number() OVER (ORDER BY net DESC, retailer_id) AS rn FROM (
                  SELECT retailer_id, CAST(sum(net_revenue) AS DECIMAL(18,4)) AS net FROM net_lines
                  WHERE transaction_date BETWEEN DATE '2001-06-01' AND DATE '2001-06-30' GROUP BY 1))))""",
})
