"""Data-quality operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import contracts as c
from shelfline import rules as catalog_rules
from shelfline.functions import pct
from shelfline.operators import history, profile, reasons
from shelfline.operators import quality as q
from shelfline.plans import ingest
from shelfline.queries import sqlframes as s
from shelfline.queries.frames import AS_OF, EVENTS_NOW, Frames
from shelfline.queries.layers import batch_records, check_records, receipts, stoppage_records
from shelfline.queries.registry import query
from shelfline.session import settle

A = s.AS_OF


def pos(f: Frames) -> DataFrame:
    return ingest.flatten_pos(receipts(f))


def split_counts(df: DataFrame, rules: list[q.Rule]) -> DataFrame:
    """Rows per rejection reason; clean rows count under 'clean'."""
    tagged = q.tag(df, rules)
    # try_element_at stays NULL for a NULL position; element_at is planned as non-null under ANSI.
    reason = F.try_element_at(F.array(*[F.lit(r.reason) for r in rules]), F.col(q.FAILED) + 1)
    return tagged.groupBy(F.coalesce(reason, F.lit("clean")).alias("outcome")).agg(F.count("*").alias("rows"))


@query("dq_01_not_null", """
SELECT CASE WHEN transaction_id IS NULL OR retailer_id IS NULL OR sku_id IS NULL THEN 'null_in_columns:transaction_id,retailer_id,sku_id'
            WHEN unit_price IS NULL THEN 'null_in_columns:unit_price' ELSE 'clean' END AS outcome, count(*) AS rows FROM pos_raw GROUP BY 1""")
def not_null(f: Frames):
    return split_counts(pos(f), [q.not_null(["transaction_id", "retailer_id", "sku_id"]), q.not_null(["unit_price"])])


@query("dq_01_not_null_warning", """
SELECT (retailer_id IS NULL OR sku_id IS NULL) AS _dq_null_flag, count(*) AS rows FROM pos_raw GROUP BY 1""")
def not_null_warning(f: Frames):
    tagged = q.tag(pos(f), [q.not_null(["retailer_id", "sku_id"], "warning", "_dq_null_flag")])
    return q.clean_rows(tagged).groupBy("_dq_null_flag").agg(F.count("*").alias("rows"))


_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "quantity"]
_LINES = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem"


def _order_lines(f: Frames) -> DataFrame:
    return f.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                      F.col("l_quantity").cast("int").alias("quantity"))


@query("dq_02_unique", f"""
SELECT * EXCLUDE (rn), 'duplicate_key:l_orderkey,l_linenumber' AS _dq_failure_reason FROM (SELECT *, row_number() OVER (
PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, quantity) AS rn FROM ({_LINES})) WHERE rn > 1""")
def unique(f: Frames):
    rules = [q.unique(["l_orderkey", "l_linenumber"])]
    return q.rejected_rows(q.tag(_order_lines(f), rules), rules)


@query("dq_03_range", """
SELECT CASE WHEN p IS NULL OR p < 905 OR p > 1050 THEN 'out_of_range:p[905,1050]' ELSE 'clean' END AS outcome, count(*) AS rows FROM
(SELECT TRY_CAST(unit_price AS DECIMAL(10,2)) AS p FROM pos_raw) GROUP BY 1""")
def range_rule(f: Frames):
    priced = pos(f).select(F.col("unit_price").try_cast("decimal(10,2)").alias("p"))
    return split_counts(priced, [q.in_range("p", 905, 1050, "error")])


@query("dq_04_referential", """
SELECT CASE WHEN sku_id IS NOT NULL AND sku_id NOT IN (SELECT sku_id FROM products WHERE price_tier <> 'Premium')
       THEN 'referential_integrity:sku_id' ELSE 'clean' END AS outcome, count(*) AS rows FROM pos_raw GROUP BY 1""")
def referential(f: Frames):
    return split_counts(pos(f), [q.referential("sku_id", f.products.where("price_tier <> 'Premium'"), "error")])


@query("dq_05_custom", """
SELECT CASE WHEN coalesce(TRY_CAST(quantity AS INTEGER) > 45, false) THEN 'custom_check_failed:big_line' ELSE 'clean' END AS outcome, count(*) AS rows
FROM pos_raw GROUP BY 1""")
def custom(f: Frames):
    return split_counts(pos(f), [q.custom("try_cast(quantity AS int) > 45", "big_line", "error")])


@query("dq_06_format", """
SELECT CASE WHEN NOT coalesce(regexp_matches(quantity, '^[0-9]+$'), false) THEN 'bad_format:quantity'
            WHEN NOT coalesce(regexp_matches(unit_price, '^[0-9]+([.][0-9]+)?$'), false) THEN 'bad_format:unit_price'
            WHEN store_id NOT IN ('ST-1', 'ST-2', 'ST-3') THEN 'not_in_list:store_id' ELSE 'clean' END AS outcome, count(*) AS rows
FROM pos_raw GROUP BY 1""")
def format_rule(f: Frames):
    return split_counts(pos(f), [q.matches("quantity", c.WHOLE), q.matches("unit_price", c.NUMERIC),
                                 q.one_of("store_id", ["ST-1", "ST-2", "ST-3"])])


def _events(f: Frames) -> DataFrame:
    stops = stoppage_records(f).withColumn("start_time", F.when(~F.col("end_time").like("%:00"), F.col("start_time")))
    return ingest.event_stream(batch_records(f), check_records(f), stops)


s.FRAMES["holey_events"] = """
SELECT * REPLACE (CASE WHEN event_type LIKE 'DOWNTIME%' AND downtime_end_ts LIKE '%:00' THEN NULL ELSE downtime_start_ts END AS downtime_start_ts,
                  CASE WHEN event_type LIKE 'DOWNTIME%' AND downtime_end_ts LIKE '%:00' THEN NULL ELSE event_timestamp END AS event_timestamp)
FROM raw_event_stream"""


@query("dq_07_conditional_requirement", """
SELECT CASE WHEN event_type = 'DOWNTIME_UNPLANNED' AND downtime_start_ts IS NULL THEN 'custom_check_failed:missing_start' ELSE 'clean' END AS outcome,
       count(*) AS rows FROM holey_events GROUP BY 1""")
def conditional(f: Frames):
    return split_counts(_events(f), [q.custom("event_type = 'DOWNTIME_UNPLANNED' AND downtime_start_ts IS NULL",
                                              "missing_start", "error")])


RULES = [
    {"type": "not_null", "columns": ["retailer_id", "sku_id"], "severity": "error"},
    {"type": "custom", "condition_expr": "try_cast(quantity AS int) IS NULL", "flag_col": "bad_quantity", "severity": "error"},
    {"type": "range", "column": "price", "min_val": 905, "max_val": 1050, "severity": "warning"},
    {"type": "unique", "columns": ["transaction_id", "sku_id"], "severity": "error"},
    {"type": "magic", "severity": "error"},
    {"type": "range", "column": "price", "min_val": 0.01, "severity": "error"},
]


def _rule_input(f: Frames) -> DataFrame:
    """Receipt lines of the rule list, stored: its uniqueness rule reads them three times."""
    return settle(pos(f).select("transaction_id", "line_no", "retailer_id", "sku_id", "quantity",
                                F.col("unit_price").try_cast("decimal(10,2)").alias("price")), "rule-input")


s.FRAMES["rule_steps"] = """
SELECT *, CASE WHEN f1 THEN 0 WHEN f2 THEN 1 WHEN rn > 1 THEN 3 WHEN price IS NULL OR price < 0.01 THEN 5 END AS failed FROM (
SELECT *, row_number() OVER (PARTITION BY transaction_id, sku_id, f1 OR f2 ORDER BY line_no, retailer_id, quantity, price NULLS FIRST) AS rn FROM (
SELECT transaction_id, line_no, retailer_id, sku_id, quantity, TRY_CAST(unit_price AS DECIMAL(10,2)) AS price,
       retailer_id IS NULL OR sku_id IS NULL AS f1, TRY_CAST(quantity AS INTEGER) IS NULL AS f2 FROM pos_raw))"""


@query("dq_08_rule_list", """
SELECT * FROM (VALUES (0, 'not_null', 'error', (SELECT count(*) FROM rule_steps WHERE failed = 0), 'applied'),
 (1, 'custom', 'error', (SELECT count(*) FROM rule_steps WHERE failed = 1), 'applied'),
 (2, 'range', 'warning', (SELECT count(*) FROM rule_steps WHERE (price IS NULL OR price < 905 OR price > 1050) AND coalesce(failed, 9) > 2), 'applied'),
 (3, 'unique', 'error', (SELECT count(*) FROM rule_steps WHERE failed = 3), 'applied'),
 (4, 'unknown', 'warning', CAST(0 AS BIGINT), 'skipped'),
 (5, 'range', 'error', (SELECT count(*) FROM rule_steps WHERE failed = 5), 'applied')) AS t(rule_no, rule_type, severity, failed_count, status)""")
def rule_list(f: Frames):
    compiled = [q.from_dict(r) for r in RULES]
    return q.rule_report(q.tag(_rule_input(f), compiled), compiled)


@query("dq_08_quarantine", """
SELECT transaction_id, line_no, sku_id, CASE failed WHEN 0 THEN 'null_in_columns:retailer_id,sku_id' WHEN 1 THEN 'custom_check_failed:bad_quantity'
       WHEN 3 THEN 'duplicate_key:transaction_id,sku_id' ELSE 'out_of_range:price[0.01,None]' END AS _dq_failure_reason
FROM rule_steps WHERE failed IS NOT NULL""")
def quarantine(f: Frames):
    compiled = [q.from_dict(r) for r in RULES]
    return q.rejected_rows(q.tag(_rule_input(f), compiled), compiled).select("transaction_id", "line_no", "sku_id", q.REASON)


@query("dq_09_halt_threshold", f"""
SELECT count(*) AS total, count(*) FILTER (failed IS NOT NULL) AS rejected, {s.pct('count(*) FILTER (failed IS NOT NULL)', 'count(*)', 18, 4)} AS rejected_pct,
       {s.pct('count(*) FILTER (failed IS NOT NULL)', 'count(*)', 18, 4)} > 5 AS halts FROM rule_steps""")
def halt_threshold(f: Frames):
    compiled = [q.from_dict(r) for r in RULES]
    one = q.tag(_rule_input(f), compiled).agg(F.count("*").alias("total"), F.count(q.FAILED).alias("rejected"))
    one = one.withColumn("rejected_pct", pct("rejected", "total", 18, 4))
    return one.withColumn("halts", F.col("rejected_pct") > c.HALT_LIMITS["sales_transactions"])


@query("dq_10_computed_column", """
SELECT CASE WHEN inventory_value IS NOT NULL AND inventory_value <> units_on_hand * standard_cost_per_unit THEN 'violates:value' ELSE 'clean' END AS outcome,
       count(*) AS rows FROM (SELECT units_on_hand, standard_cost_per_unit, inventory_value + CASE WHEN units_on_hand % 9 = 0 THEN 1 ELSE 0 END AS inventory_value FROM stock)
GROUP BY 1""")
def computed_column(f: Frames):
    bent = f.stock.withColumn("inventory_value", F.col("inventory_value") + F.when(F.col("units_on_hand") % 9 == 0, 1).otherwise(0))
    return split_counts(bent, [q.holds("inventory_value = units_on_hand * standard_cost_per_unit", "inventory_value", rule_id="value")])


@query("dq_11_cross_column", """
SELECT CASE WHEN ship < ordered THEN 'violates:ship_after_order' ELSE 'clean' END AS outcome, count(*) AS rows FROM
(SELECT CAST(l_shipdate AS DATE) AS ship, CAST(o_orderdate AS DATE) AS ordered FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1""")
def cross_column(f: Frames):
    dates = f.lines.select(F.col("l_shipdate").cast("date").alias("ship"), F.col("o_orderdate").cast("date").alias("ordered"))
    return split_counts(dates, [q.holds("ship >= ordered", "ship", rule_id="ship_after_order")])


@query("dq_12_one_current_version", """
SELECT retailer_id, CAST(count(*) FILTER (is_current) AS BIGINT) AS current_versions FROM
(SELECT retailer_id, is_current AND retail_segment <> 'KEY-ACCOUNT' AS is_current FROM account_history) GROUP BY 1 HAVING count(*) FILTER (is_current) <> 1""")
def one_current(f: Frames):
    bent = f.account_history.withColumn("is_current", F.col("is_current") & (F.col("retail_segment") != "KEY-ACCOUNT"))
    return history.version_faults(bent, "retailer_id")


@query("dq_13_timeliness", f"""
SELECT * FROM (SELECT 'plant_events' AS table_name, strftime(max(event_timestamp), '%Y-%m-%d %H:%M:%S') AS newest,
  CAST(floor((epoch(TIMESTAMP '{EVENTS_NOW}') - epoch(max(event_timestamp))) / 60) AS BIGINT) AS age_minutes, 15 AS limit_minutes,
  (epoch(TIMESTAMP '{EVENTS_NOW}') - epoch(max(event_timestamp))) / 60 > 15 AS breached FROM plant_events)""")
def timeliness(f: Frames):
    return profile.freshness(f.plant_events, "plant_events", "event_timestamp", EVENTS_NOW, 15)


@query("dq_14_grain_uniqueness", "SELECT count(*) AS repeated_grains FROM (SELECT 1 FROM kpi_s01 GROUP BY report_date, product_category, region, channel HAVING count(*) > 1)")
def grain_uniqueness(f: Frames):
    return profile_repeats(f.kpi_s01, ["report_date", "product_category", "region", "channel"])


def profile_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    from shelfline.operators.dedup import repeated_keys
    return repeated_keys(df, keys).agg(F.count("*").alias("repeated_grains"))


@query("dq_15_coverage", """
SELECT DISTINCT sku_id, warehouse_id FROM stock s WHERE NOT EXISTS (SELECT 1 FROM reorder r WHERE r.sku_id = s.sku_id
AND r.warehouse_id = s.warehouse_id AND r.reorder_point_units > 60)""")
def coverage(f: Frames):
    points = f.reorder.where("reorder_point_units > 60")
    return f.stock.select("sku_id", "warehouse_id").distinct().join(
        points.select("sku_id", "warehouse_id"), ["sku_id", "warehouse_id"], "left_anti")


@query("dq_16_reject_log", f"""
SELECT 'raw_pos' AS source_table, 'sales_transactions' AS target_table, 'load-1' AS batch_id, rule_id, rule_type, 'BLOCKER' AS severity, column_name,
       rejection_reason, count(*) AS entries FROM (
SELECT CASE failed WHEN 0 THEN 'sales_transactions-0' WHEN 1 THEN 'sales_transactions-1' WHEN 3 THEN 'sales_transactions-3' ELSE 'sales_transactions-5' END AS rule_id,
       CASE failed WHEN 0 THEN 'NOT_NULL' WHEN 1 THEN 'CUSTOM' WHEN 3 THEN 'UNIQUE' ELSE 'RANGE' END AS rule_type,
       CASE failed WHEN 0 THEN 'retailer_id,sku_id' WHEN 1 THEN '' WHEN 3 THEN 'transaction_id,sku_id' ELSE 'price' END AS column_name,
       CASE failed WHEN 0 THEN 'null_in_columns:retailer_id,sku_id' WHEN 1 THEN 'custom_check_failed:bad_quantity'
            WHEN 3 THEN 'duplicate_key:transaction_id,sku_id' ELSE 'out_of_range:price[0.01,None]' END AS rejection_reason
FROM rule_steps WHERE failed IS NOT NULL) GROUP BY ALL""")
def reject_log(f: Frames):
    compiled = [q.from_dict(r) for r in RULES]
    log = q.reject_log(q.tag(_rule_input(f), compiled), compiled, "raw_pos", "sales_transactions", "load-1", "run-1",
                       "2001-08-02 00:00:00")
    return log.groupBy("source_table", "target_table", "batch_id", "rule_id", "rule_type", "severity", "column_name",
                       "rejection_reason").agg(F.count("raw_record_json").alias("entries"))


@query("dq_17_monitoring_row", f"""
SELECT 'run-1' AS run_id, 'sales' AS pipeline_name, count(*) AS rows_read, count(*) FILTER (failed IS NULL) AS rows_written,
       count(failed) AS rows_rejected, {s.pct('count(failed)', 'count(*)', 7, 4)} AS rejection_rate_pct,
       CASE WHEN {s.pct('count(failed)', 'count(*)', 7, 4)} > 50 THEN 'FAILED' WHEN count(failed) > 0 THEN 'PARTIAL' ELSE 'COMPLETED' END AS pipeline_status,
       count(failed) > 0 AS alert_triggered FROM rule_steps""")
def monitoring(f: Frames):
    compiled = [q.from_dict(r) for r in RULES]
    counts = q.tag(_rule_input(f), compiled).agg(F.count("*").alias("rows_read"), F.count(q.FAILED).alias("rows_rejected"))
    return reasons.monitoring_row(counts, "run-1", "sales", "raw", "conformed", "2001-08-02 00:00:00",
                                  "2001-08-02 00:05:00", 50).drop("source_table", "target_table", "run_timestamp", "completed_timestamp")


@query("dq_18_health_log", f"""
SELECT 'pos_raw' AS table_name, CAST(sum(n) AS BIGINT) AS row_count, count(*) FILTER (n > 1) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
       '{{"retailer_id":"' || {s.pct('sum(r)', 'sum(n)')} || '","unit_price":"' || {s.pct('sum(p)', 'sum(n)')} || '"}}' AS null_rate_by_column,
       CASE WHEN sum(n - 1) > 0 THEN 'FAIL' WHEN greatest({s.pct('sum(r)', 'sum(n)')}, {s.pct('sum(p)', 'sum(n)')}) > 1 THEN 'WARN' ELSE 'OK' END AS status
FROM (SELECT transaction_id, sku_id, count(*) AS n, count(*) - count(retailer_id) AS r, count(*) - count(unit_price) AS p FROM pos_raw GROUP BY 1, 2)""")
def health_log(f: Frames):
    return profile.health_row(pos(f), "pos_raw", ["transaction_id", "sku_id"], ["retailer_id", "unit_price"])


@query("dq_19_reason_codes", f"""
SELECT reason, count(*) AS rows FROM (
SELECT CASE WHEN actual_delivery_date IS NULL AND ship_date < {A} - 30 THEN 'DELIVERY_DATE_MISSING'
            WHEN cost IS NULL OR cost < 0 THEN 'INVALID_LOGISTICS_COST' END AS reason
FROM (SELECT *, CASE WHEN cases_delivered = 7 THEN -logistics_cost_usd ELSE logistics_cost_usd END AS cost FROM shipments)
UNION ALL SELECT CASE WHEN units_on_hand - 3 < 0 THEN 'INVALID_STOCK_LEVEL' END FROM stock
UNION ALL SELECT CASE WHEN yield_rate_pct + 10 > 110 THEN 'YIELD_EXCEEDS_EXPECTED' WHEN qc_status NOT IN ('PASS', 'FAIL', 'PENDING') THEN 'INVALID_QC_STATUS' END
FROM batches) GROUP BY 1""")
def reason_codes(f: Frames):
    bent = f.shipments.withColumn("logistics_cost_usd", F.when(F.col("cases_delivered") == 7, -F.col("logistics_cost_usd"))
                                  .otherwise(F.col("logistics_cost_usd")))
    parts = [
        bent.select(reasons.shipment_reason(AS_OF).alias("reason")),
        f.stock.withColumn("units_on_hand", F.col("units_on_hand") - 3).select(reasons.stock_reason().alias("reason")),
        f.batches.withColumn("yield_rate_pct", F.col("yield_rate_pct") + 10).select(reasons.batch_reason().alias("reason"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("reason").agg(F.count("*").alias("rows"))


@query("dq_20_two_levels", """
SELECT CASE WHEN y < 0 THEN 'BLOCKER' WHEN y > 105 THEN 'WARN' ELSE 'OK' END AS level, count(*) AS rows
FROM (SELECT yield_rate_pct * 3 - 180 AS y FROM batches WHERE yield_rate_pct IS NOT NULL) GROUP BY 1""")
def two_levels(f: Frames):
    y = f.batches.where("yield_rate_pct IS NOT NULL").select((F.col("yield_rate_pct") * 3 - 180).alias("y"))
    rules = [q.holds("y >= 0", "y", "error", "below_zero"), q.holds("y <= 105", "y", "warning", "above_limit")]
    tagged = q.tag(y, rules)
    level = F.when(F.col(q.FAILED).isNotNull(), "BLOCKER").when(F.col(rules[1].flag), "WARN").otherwise("OK")
    return tagged.groupBy(level.alias("level")).agg(F.count("*").alias("rows"))


@query("dq_21_zero_spend", f"""
SELECT * FROM (SELECT period_start_date, count(*) AS row_count, count(*) FILTER (t = 0) AS zero_rows, CAST(sum(t) AS DECIMAL(18,4)) AS total_spend,
       {s.pct('count(*) FILTER (t = 0)', 'count(*)')} AS zero_pct
FROM (SELECT period_start_date, CASE WHEN month(period_start_date) = 3 OR CAST(substr(retailer_id, 5) AS INTEGER) % 4 = 0 THEN 0
      ELSE total_acquisition_cost_usd END AS t FROM spend) GROUP BY 1) WHERE total_spend = 0 OR zero_pct > 20""")
def zero_spend(f: Frames):
    nothing = (F.month("period_start_date") == 3) | (F.substring("retailer_id", 5, 20).cast("int") % 4 == 0)
    bent = f.spend.withColumn("total_acquisition_cost_usd", F.when(nothing, F.lit(0).cast("decimal(14,4)"))
                              .otherwise(F.col("total_acquisition_cost_usd")))
    return reasons.zero_spend_periods(bent)


@query("dq_22_day_over_day", f"""
SELECT *, coalesce(abs(move_pct) > 20, false) AS is_breach FROM (
SELECT *, {s.pct('net_revenue - prior_value', 'prior_value', 18, 2)} AS move_pct FROM (
SELECT channel, report_date, net_revenue, lag(net_revenue) OVER (PARTITION BY channel ORDER BY report_date) AS prior_value FROM
(SELECT channel, report_date, CAST(sum(net_revenue) AS DECIMAL(18,4)) AS net_revenue FROM kpi_s01 GROUP BY 1, 2)))""")
def day_over_day(f: Frames):
    daily = f.kpi_s01.groupBy("channel", "report_date").agg(F.sum("net_revenue").cast("decimal(18,4)").alias("net_revenue"))
    return profile.day_moves(daily, ["channel"], "report_date", "net_revenue")


@query("src_05_source_contract", """
SELECT reason, count(*) AS rows FROM (SELECT CASE
 WHEN coalesce(retailer_id = '', true) THEN 'custom_check_failed:missing_retailer_id' WHEN coalesce(sku_id = '', true) THEN 'custom_check_failed:missing_sku_id'
 WHEN coalesce(quantity = '', true) THEN 'custom_check_failed:missing_quantity' WHEN coalesce(unit_price = '', true) THEN 'custom_check_failed:missing_unit_price'
 WHEN NOT regexp_matches(quantity, '^[1-9][0-9]*$') THEN 'bad_format:quantity'
 WHEN region NOT IN ('Northeast', 'Southeast', 'Midwest', 'Southwest', 'West') THEN 'not_in_list:region' ELSE 'clean' END AS reason FROM pos_raw) GROUP BY 1""")
def source_contract(f: Frames):
    return split_counts(pos(f), c.contract_rules(c.CONTRACTS["pos_transactions"])).withColumnRenamed("outcome", "reason")


# --- the rule catalog on whole tables -------------------------------------------------------


def catalog_counts(df: DataFrame, table: str, as_of: str, refs: dict | None = None) -> DataFrame:
    rules = catalog_rules.rules_for(table, df.columns, as_of, refs)
    one = q.failure_counts(q.tag(df, rules), rules)
    entries = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"),
                                 F.col(f"rule_{i}").alias("failures")) for i, r in enumerate(rules)])
    return one.select(F.explode(entries).alias("e")).select("e.*")


@query("dq_catalog_raw_sales", """
SELECT 'BRZ-SALES-POS-' || n AS rule_id, sev AS severity, c AS failures FROM (
SELECT count(*) FILTER (transaction_id IS NULL) AS a, count(*) FILTER (x = 2) AS b, count(*) FILTER (x = 3) AS c3, count(*) FILTER (x = 4) AS d,
       count(*) FILTER (x = 5) AS e FROM (SELECT transaction_id, CASE WHEN retailer_id IS NULL THEN 2 WHEN sku_id IS NULL THEN 3 WHEN unit_price IS NULL THEN 4
       WHEN NOT regexp_matches(quantity, '^[0-9]+$') THEN 5 END AS x FROM pos_raw)) t,
LATERAL (VALUES ('001', 'error', a), ('002', 'error', b), ('003', 'error', c3), ('004', 'error', d), ('005', 'error', e),
                ('006', 'warning', CAST(0 AS BIGINT)), ('007', 'warning', CAST(0 AS BIGINT))) AS v(n, sev, c)""")
def catalog_raw_sales(f: Frames):
    return catalog_counts(pos(f), "pos_transactions_raw", "2001-08-02 00:00:00")


@query("dq_catalog_shipments", """
WITH t AS (SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY retailer_id, order_id, warehouse_id, route_id, channel, ship_date,
  promised_delivery_date, actual_delivery_date NULLS FIRST, cases_delivered, logistics_cost_usd, is_fully_shipped, quantity_ordered,
  quantity_shipped, batch_id NULLS FIRST, region) AS rn FROM shipments)
SELECT 'SLV-DIST-SHIP-' || v.n AS rule_id, v.sev AS severity, v.c AS failures FROM (SELECT count(*) FILTER (rn > 1) AS dup,
  count(*) FILTER (rn = 1 AND retailer_id NOT IN (SELECT retailer_id FROM accounts WHERE account_status = 'ACTIVE')) AS unknown FROM t) x,
LATERAL (VALUES ('001', 'error', CAST(0 AS BIGINT)), ('002', 'error', dup), ('003', 'error', CAST(0 AS BIGINT)), ('004', 'error', CAST(0 AS BIGINT)),
 ('005', 'error', CAST(0 AS BIGINT)), ('006', 'error', CAST(0 AS BIGINT)), ('007', 'error', CAST(0 AS BIGINT)), ('008', 'error', CAST(0 AS BIGINT)),
 ('009', 'warning', unknown)) AS v(n, sev, c)""")
def catalog_shipments(f: Frames):
    active = f.accounts.where("account_status = 'ACTIVE'").select("retailer_id")
    return catalog_counts(f.shipments, "shipments", "2001-08-02 00:00:00", {"customers": active})


@query("dq_catalog_daily_revenue", """
SELECT * FROM (VALUES ('GLD-SALES-REV-001', 'error', CAST(0 AS BIGINT)), ('GLD-SALES-REV-002', 'error', (SELECT count(*) FROM kpi_s01 WHERE net_revenue < 0)),
 ('GLD-SALES-REV-003', 'error', (SELECT count(*) FROM kpi_s01 WHERE net_revenue >= 0 AND report_date < DATE '2001-07-01')),
 ('GLD-SALES-REV-004', 'error', CAST(0 AS BIGINT))) AS t(rule_id, severity, failures)""")
def catalog_daily_revenue(f: Frames):
    stamped = f.kpi_s01.withColumn("last_updated_ts", F.when(
        F.col("report_date") >= F.lit("2001-07-01").cast("date"), F.lit("2001-07-15 06:00:00").cast("timestamp"))
        .otherwise(F.lit("2001-07-15 01:00:00").cast("timestamp")))
    return catalog_counts(stamped, "sales_daily_revenue", "2001-07-15 06:30:00")


@query("dq_catalog_account_versions", """
SELECT * FROM (VALUES ('SLV-CUST-001', 'error', CAST(0 AS BIGINT)), ('SLV-CUST-002', 'error', CAST(0 AS BIGINT)), ('SLV-CUST-003', 'error', CAST(0 AS BIGINT)),
 ('SLV-CUST-004', 'error', CAST(0 AS BIGINT)), ('SLV-CUST-006', 'warning', CAST(0 AS BIGINT)),
 ('SLV-CUST-007', 'warning', (SELECT count(*) FROM account_feed WHERE account_activation_date > DATE '2000-01-01'))) AS t(rule_id, severity, failures)""")
def catalog_account_versions(f: Frames):
    versions = f.account_feed.withColumns({"valid_from": F.col("record_effective_date"), "valid_to": F.lit(None).cast("date")})
    return catalog_counts(versions, "customers", "2000-01-01 00:00:00")


# --- the catalog on planted dirt: every rule fires -------------------------------------------

# Rows are made dirty by a number from their key, one fault a row; class 2 of shipments comes twice.
_CLASSES = 40


@query("dq_catalog_dirty_shipments", f"""
WITH t AS (SELECT shipment_id, retailer_id, CAST(split_part(shipment_id, '-', 2) AS BIGINT) % {_CLASSES} AS j FROM shipments),
u AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE j = 2),
n AS (SELECT j, count(DISTINCT shipment_id) AS ids FROM u WHERE j <> 1 GROUP BY j)
SELECT 'SLV-DIST-SHIP-001' AS rule_id, 'error' AS severity, (SELECT count(*) FROM u WHERE j = 1) AS failures UNION ALL
SELECT 'SLV-DIST-SHIP-002', 'error', (SELECT count(*) - count(DISTINCT shipment_id) FROM u WHERE j <> 1) UNION ALL
SELECT 'SLV-DIST-SHIP-00' || j, 'error', ids FROM n WHERE j BETWEEN 3 AND 8 UNION ALL
SELECT 'SLV-DIST-SHIP-009', 'warning', (SELECT count(DISTINCT shipment_id) FROM u WHERE j NOT IN (1, 3, 4, 5, 6, 7, 8)
  AND retailer_id NOT IN (SELECT retailer_id FROM accounts WHERE account_status = 'ACTIVE'))""")
def catalog_dirty_shipments(f: Frames):
    j = F.split_part("shipment_id", F.lit("-"), F.lit(2)).cast("bigint") % _CLASSES
    rows = f.shipments.withColumn("_j", j)
    rows = rows.unionByName(rows.where("_j = 2"))
    fault = lambda n, bad, column: F.when(F.col("_j") == n, bad).otherwise(F.col(column))
    before = F.date_sub("ship_date", 1)
    dirty = rows.withColumns({
        "shipment_id": fault(1, F.lit(None), "shipment_id"), "promised_delivery_date": fault(3, before, "promised_delivery_date"),
        "logistics_cost_usd": fault(4, F.lit(-1).cast("decimal(10,2)"), "logistics_cost_usd"),
        "cases_delivered": fault(5, F.lit(-1), "cases_delivered"), "channel": fault(6, F.lit("Other"), "channel"),
        "actual_delivery_date": fault(7, before, "actual_delivery_date"), "quantity_ordered": fault(8, F.lit(0), "quantity_ordered")}).drop("_j")
    active = f.accounts.where("account_status = 'ACTIVE'").select("retailer_id")
    return catalog_counts(dirty, "shipments", "2001-08-02 00:00:00", {"customers": active})


@query("dq_catalog_dirty_accounts", f"""
WITH t AS (SELECT custkey % {_CLASSES} AS j, account_activation_date AS d FROM account_feed)
SELECT 'SLV-CUST-00' || j AS rule_id, CASE j WHEN 6 THEN 'warning' ELSE 'error' END AS severity, count(*) AS failures
FROM t WHERE j IN (1, 2, 3, 4, 6) GROUP BY j UNION ALL
SELECT 'SLV-CUST-007', 'warning', (SELECT count(*) FROM t WHERE j NOT IN (1, 2, 3, 4) AND d > DATE '2000-01-01')""")
def catalog_dirty_accounts(f: Frames):
    j = F.col("custkey") % _CLASSES
    fault = lambda n, bad, column: F.when(j == n, bad).otherwise(F.col(column))
    dirty = f.account_feed.withColumn("valid_from", F.col("record_effective_date")).withColumns({
        "retailer_id": fault(1, F.lit(None), "retailer_id"), "retailer_name": fault(2, F.lit(None), "retailer_name"),
        "account_status": fault(3, F.lit("GONE"), "account_status"), "valid_to": F.when(j == 4, F.col("valid_from")),
        "credit_terms_days": fault(6, F.lit(7), "credit_terms_days")})
    return catalog_counts(dirty, "customers", "2000-01-01 00:00:00")
