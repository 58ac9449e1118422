"""Projections, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.functions import (
    as_bool, as_date, as_decimal, as_int, as_timestamp, date_key, hours_between, month_label, month_start,
    pct, ratio, row_digest, surrogate_key, week_start,
)
from shelfline.functions.parse import is_true_word
from shelfline.functions.time import day, months_back
from shelfline.operators import profile, ranking
from shelfline.operators.dedup import latest_per_key, mark_repeats, repeated_keys
from shelfline.operators.upsert import append_unseen, merge_columns, merge_upsert
from shelfline.plans import ingest
from shelfline.plans.facts import net_sale_lines
from shelfline.queries import sqlframes as s
from shelfline.queries.frames import AS_OF, Frames
from shelfline.queries.registry import query
from shelfline.sources import sinks

A = s.AS_OF

# --- scans and sinks that are pure functions --------------------------------------


@query("src_03_table_scan", "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1")
def table_scan(f: Frames):
    return f.table("orders").groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


def _positions(f: Frames):
    """Stock without its value: (sku, warehouse, day, units)."""
    return f.stock.select("sku_id", "warehouse_id", "snapshot_date", "units_on_hand", "units_in_transit")


def _updates(f: Frames):
    """Corrections: every seventh unit count is raised, and one new key per correction."""
    changed = _positions(f).where("units_on_hand % 7 = 0")
    fixed = changed.withColumn("units_on_hand", F.col("units_on_hand") + 1000).withColumn("units_in_transit", F.lit(0))
    return fixed.unionByName(fixed.withColumn("warehouse_id", F.concat(F.lit("NEW-"), "warehouse_id")))


_POS = "SELECT sku_id, warehouse_id, snapshot_date, units_on_hand, units_in_transit FROM stock"
s.FRAMES["stock_updates"] = """
SELECT sku_id, warehouse_id, snapshot_date, units_on_hand + 1000 AS units_on_hand, CAST(0 AS INTEGER) AS units_in_transit
FROM stock WHERE units_on_hand % 7 = 0
UNION ALL
SELECT sku_id, 'NEW-' || warehouse_id, snapshot_date, units_on_hand + 1000, CAST(0 AS INTEGER) FROM stock WHERE units_on_hand % 7 = 0"""
_KEYS = ["sku_id", "warehouse_id", "snapshot_date"]


@query("snk_03_upsert_all_columns", f"SELECT * FROM stock_updates UNION ALL {_POS} WHERE units_on_hand % 7 <> 0")
def upsert_all(f: Frames):
    return merge_upsert(_positions(f), _updates(f), _KEYS)


@query("snk_04_upsert_named_columns", f"""
SELECT t.sku_id, t.warehouse_id, t.snapshot_date, t.units_on_hand + CASE WHEN t.units_on_hand % 7 = 0 THEN 1000 ELSE 0 END AS units_on_hand,
       t.units_in_transit FROM ({_POS}) t
UNION ALL SELECT * FROM stock_updates WHERE warehouse_id LIKE 'NEW-%'""")
def upsert_named(f: Frames):
    return merge_columns(_positions(f), _updates(f), _KEYS, ["units_on_hand"])


@query("snk_10_immutable_append", """
SELECT event_type, count(*) AS events, min(event_no) AS first_no, max(event_no) AS last_no FROM plant_events GROUP BY 1""")
def immutable_append(f: Frames):
    stored = f.plant_events.where("event_no % 3 <> 0").select("event_id", "event_type", "event_no")
    again = f.plant_events.where("event_no % 2 = 0 OR event_no % 3 = 0").select("event_id", "event_type", "event_no")
    return append_unseen(stored, again.unionByName(again), "event_id").groupBy("event_type").agg(
        F.count("*").alias("events"), F.min("event_no").alias("first_no"), F.max("event_no").alias("last_no"))


@query("snk_11_bad_batch_masking", """
SELECT channel, count(*) AS lines FROM sale_lines WHERE warehouse_id NOT IN (SELECT warehouse_id FROM warehouses WHERE capacity_units % 2 = 0)
GROUP BY 1""")
def bad_batch_masking(f: Frames):
    loads = f.sale_lines.withColumn("_batch_id", F.col("warehouse_id"))
    bad = f.warehouses.where("capacity_units % 2 = 0").select(F.col("warehouse_id").alias("_batch_id"))
    return sinks.hide_batches(loads, bad).groupBy("channel").agg(F.count("*").alias("lines"))


@query("snk_12_retention_prune", f"SELECT transaction_date, count(*) AS lines FROM sale_lines WHERE transaction_date >= {A} - 90 GROUP BY 1")
def retention_prune(f: Frames):
    return sinks.keep_recent(f.sale_lines, "transaction_date", AS_OF, 90).groupBy("transaction_date").agg(
        F.count("*").alias("lines"))


# --- projections ---------------------------------------------------------------------


@query("prj_03_cast_to_text", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part""")
def cast_to_text(f: Frames):
    return ingest.all_text(f.table("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))


@query("prj_05_typed_casts", """
SELECT count(*) AS rows, count(TRY_CAST(q AS INTEGER)) AS good_quantity, count(TRY_CAST(p AS DECIMAL(10,2))) AS good_price,
       CAST(sum(TRY_CAST(q AS INTEGER)) AS BIGINT) AS quantity, CAST(sum(TRY_CAST(p AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS price,
       count(TRY_CAST(d AS DATE)) AS good_date, count(CASE WHEN b IN ('true', 'false') THEN 1 END) AS good_flag
FROM (SELECT CASE WHEN l_partkey % 41 = 0 THEN 'abc' WHEN l_partkey % 41 = 1 THEN '' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS q,
             CASE WHEN l_partkey % 43 = 0 THEN 'x.y' WHEN l_partkey % 43 = 1 THEN '99999999999.99'
                  ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) END AS p,
             CASE WHEN l_partkey % 47 = 0 THEN 'never' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS d,
             CASE WHEN l_partkey % 5 = 0 THEN 'maybe' WHEN l_partkey % 2 = 0 THEN 'true' ELSE 'false' END AS b FROM lineitem)""")
def typed_casts(f: Frames):
    k = F.col("l_partkey")
    raw = f.table("lineitem").select(
        F.when(k % 41 == 0, "abc").when(k % 41 == 1, "").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("q"),
        F.when(k % 43 == 0, "x.y").when(k % 43 == 1, "99999999999.99")
        .otherwise(F.col("l_extendedprice").cast("decimal(10,2)").cast("string")).alias("p"),
        F.when(k % 47 == 0, "never").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("d"),
        F.when(k % 5 == 0, "maybe").when(k % 2 == 0, "true").otherwise("false").alias("b"))
    return raw.select(as_int("q").alias("q"), as_decimal("p", 10, 2).alias("p"), as_date("d").alias("d"),
                      as_bool("b").alias("b")).agg(
        F.count("*").alias("rows"), F.count("q").alias("good_quantity"), F.count("p").alias("good_price"),
        F.sum("q").alias("quantity"), F.sum("p").cast("decimal(20,2)").alias("price"),
        F.count("d").alias("good_date"), F.count("b").alias("good_flag"))


@query("prj_09_surrogate_key", f"SELECT transaction_id, line_no, sku_id, {s.key('transaction_id', 'line_no', 'sku_id')} AS transaction_key FROM sale_lines")
def surrogate_keys(f: Frames):
    return f.sale_lines.select("transaction_id", "line_no", "sku_id",
                               surrogate_key("transaction_id", "line_no", "sku_id").alias("transaction_key"))


@query("prj_10_grain_key", f"""
SELECT DISTINCT transaction_date, channel, {s.key('transaction_date', 'channel')} AS revenue_key FROM sale_lines""")
def grain_key(f: Frames):
    return f.sale_lines.select("transaction_date", "channel").distinct().withColumn(
        "revenue_key", surrogate_key("transaction_date", "channel"))


# --- filters ---------------------------------------------------------------------------


def _count_by(df, *cols):
    return df.groupBy(*cols).agg(F.count("*").alias("rows"))


@query("flt_01_equality", "SELECT qc_status, count(*) AS rows FROM plant_events WHERE event_type = 'QC_CHECK' GROUP BY 1")
def equality(f: Frames):
    return _count_by(f.plant_events.where("event_type = 'QC_CHECK'"), "qc_status")


@query("flt_02_in_list", "SELECT event_type, count(*) AS rows FROM plant_events WHERE event_type IN ('BATCH_START', 'BATCH_END') GROUP BY 1")
def in_list(f: Frames):
    return _count_by(f.plant_events.where(F.col("event_type").isin("BATCH_START", "BATCH_END")), "event_type")


@query("flt_03_not_in_with_null", "SELECT qc_status, count(*) AS rows FROM plant_events WHERE qc_status NOT IN ('PASS') AND qc_status IS NOT NULL GROUP BY 1")
def not_in(f: Frames):
    status = F.col("qc_status")
    return _count_by(f.plant_events.where(~status.isin("PASS") & status.isNotNull()), "qc_status")


@query("flt_04_trailing_days", f"SELECT transaction_date, count(*) AS rows FROM sale_lines WHERE transaction_date >= {A} - 30 GROUP BY 1")
def trailing_days(f: Frames):
    return _count_by(f.sale_lines.where(F.col("transaction_date") >= F.date_sub(day(AS_OF), 30)), "transaction_date")


@query("flt_05_month_text_window", """
SELECT strftime(transaction_date, '%Y-%m') AS report_month, count(*) AS rows FROM sale_lines
WHERE strftime(transaction_date, '%Y-%m') >= '2001-04' GROUP BY 1""")
def month_text(f: Frames):
    first = month_label(F.add_months(day(AS_OF), -3))
    rows = f.sale_lines.withColumn("report_month", month_label("transaction_date"))
    return _count_by(rows.where(F.col("report_month") >= first), "report_month")


@query("flt_06_month_to_date", f"SELECT transaction_date, count(*) AS rows FROM sale_lines WHERE transaction_date BETWEEN DATE '2001-07-01' AND {A} GROUP BY 1")
def month_to_date(f: Frames):
    today = day(AS_OF)
    return _count_by(f.sale_lines.where(F.col("transaction_date").between(F.trunc(today, "month"), today)), "transaction_date")


@query("flt_07_prior_months", """
SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, count(*) AS rows FROM sale_lines
WHERE transaction_date >= DATE '2001-05-01' AND transaction_date < DATE '2001-07-01' GROUP BY 1""")
def prior_months(f: Frames):
    d = F.col("transaction_date")
    rows = f.sale_lines.where((d >= months_back(AS_OF, 2)) & (d < months_back(AS_OF, 0)))
    return _count_by(rows.withColumn("month", month_start("transaction_date")), "month")


@query("flt_08_latest_snapshot", f"SELECT * FROM ({_POS}) WHERE snapshot_date = (SELECT max(snapshot_date) FROM stock)")
def latest_snapshot(f: Frames):
    rows = _positions(f)
    return rows.where(F.col("snapshot_date") == rows.agg(F.max("snapshot_date")).scalar())


@query("flt_09_not_null_not_empty", "SELECT batch_id, count(*) AS rows FROM shipments WHERE batch_id IS NOT NULL AND batch_id <> '' GROUP BY 1")
def not_empty(f: Frames):
    return _count_by(f.shipments.where(F.col("batch_id").isNotNull() & (F.col("batch_id") != "")), "batch_id")


@query("flt_10_regex", """
SELECT count(*) FILTER (regexp_matches(sku_id, '^SKU-[A-Z0-9-]+$')) AS sku_ok, count(*) FILTER (regexp_matches(sku_id, '^SKU-[0-9]{2}$')) AS two_digits,
       count(*) FILTER (regexp_matches(CAST(unit_price AS VARCHAR), '^[0-9]+([.][0-9]+)?$')) AS price_ok FROM sale_lines""")
def regex(f: Frames):
    return f.sale_lines.agg(
        F.count_if(F.col("sku_id").rlike("^SKU-[A-Z0-9-]+$")).alias("sku_ok"),
        F.count_if(F.col("sku_id").rlike("^SKU-[0-9]{2}$")).alias("two_digits"),
        F.count_if(F.col("unit_price").cast("string").rlike("^[0-9]+([.][0-9]+)?$")).alias("price_ok"))


@query("flt_11_between", """
SELECT count(*) FILTER (quantity_sold BETWEEN 10 AND 20) AS closed, count(*) FILTER (quantity_sold >= 40) AS open_above,
       count(*) FILTER (unit_price < 950) AS open_below FROM sale_lines""")
def between(f: Frames):
    return f.sale_lines.agg(F.count_if(F.col("quantity_sold").between(10, 20)).alias("closed"),
                            F.count_if(F.col("quantity_sold") >= 40).alias("open_above"),
                            F.count_if(F.col("unit_price") < 950).alias("open_below"))


@query("flt_12_empty_frame", f"SELECT * FROM ({_POS}) WHERE false")
def empty_frame(f: Frames):
    return _positions(f).where(F.lit(False))


@query("flt_13_rank_cut", """
SELECT * FROM (SELECT week_start_date, route_id, region, rank() OVER (PARTITION BY week_start_date ORDER BY total_shipments DESC, route_id, region) AS r
FROM route_weeks) WHERE r <= 3""")
def rank_cut(f: Frames):
    weekly = f.shipments.where("actual_delivery_date IS NOT NULL").groupBy(
        week_start("ship_date").alias("week_start_date"), "route_id", "region").agg(F.count("*").alias("n"))
    return ranking.top_per_group(weekly, ["week_start_date"], [F.desc("n"), F.asc("route_id"), F.asc("region")], 3, "r",
                                 ties=True).drop("n")


# --- joins ---------------------------------------------------------------------------------


@query("jn_02_date_dimension", """
SELECT c.fiscal_quarter, count(*) AS rows FROM sale_lines l LEFT JOIN dim_calendar c ON l.transaction_date = c.full_date GROUP BY 1""")
def date_dimension(f: Frames):
    # One row per calendar day: the size is bounded by the calendar.
    days = F.broadcast(f.order_days.select("full_date", "fiscal_quarter"))
    return _count_by(f.sale_lines.join(days, F.col("transaction_date") == F.col("full_date"), "left"), "fiscal_quarter")


@query("jn_03_star_lookups", """
SELECT product_category, retail_segment, warehouse_type, count(*) AS rows, CAST(sum(quantity_sold) AS BIGINT) AS units
FROM sale_lines l LEFT JOIN products p ON l.sku_id = p.sku_id LEFT JOIN customers c ON l.retailer_id = c.retailer_id AND c.is_current
LEFT JOIN warehouses w ON l.warehouse_id = w.warehouse_id GROUP BY 1, 2, 3""")
def star_lookups(f: Frames):
    joined = (f.sale_lines.join(f.products.select("sku_id", "product_category"), "sku_id", "left")
              .join(f.customers.where("is_current").select("retailer_id", "retail_segment"), "retailer_id", "left")
              .join(f.warehouses.select("warehouse_id", "warehouse_type"), "warehouse_id", "left"))
    return joined.groupBy("product_category", "retail_segment", "warehouse_type").agg(
        F.count("*").alias("rows"), F.sum("quantity_sold").alias("units"))


@query("jn_04_composite_key", """
SELECT s.sku_id, s.warehouse_id, s.snapshot_date, r.safety_stock_units FROM stock s
LEFT JOIN reorder r ON s.sku_id = r.sku_id AND s.warehouse_id = r.warehouse_id""")
def composite_key(f: Frames):
    r = f.reorder.select("sku_id", "warehouse_id", "safety_stock_units")
    return f.stock.select(*_KEYS).join(r, ["sku_id", "warehouse_id"], "left")


@query("jn_05_event_pairing", "SELECT batch_id, batch_start_ts IS NOT NULL AS has_start, batch_date, end_events FROM batch_pairs")
def event_pairing(f: Frames):
    from shelfline.plans.conform import pair_batches
    return pair_batches(f.plant_events).select("batch_id", F.col("batch_start_ts").isNotNull().alias("has_start"),
                                               "batch_date", "end_events")


@query("jn_06_batches_with_checks", """
SELECT b.batch_id, coalesce(q.checks, 0) AS checks FROM batch_pairs b LEFT JOIN
(SELECT batch_id, count(*) AS checks FROM plant_events WHERE event_type = 'QC_CHECK' GROUP BY 1) q ON b.batch_id = q.batch_id""")
def batches_with_checks(f: Frames):
    from shelfline.plans.conform import pair_batches
    checks = f.plant_events.where("event_type = 'QC_CHECK'").groupBy("batch_id").agg(F.count("*").alias("checks"))
    return pair_batches(f.plant_events).select("batch_id").join(checks, "batch_id", "left").withColumn(
        "checks", F.coalesce("checks", F.lit(0)))


@query("jn_07_batches_with_downtime", "SELECT batch_id, downtime_hours FROM fact_batch")
def batches_with_downtime(f: Frames):
    return f.fact_batch.select("batch_id", "downtime_hours")


_TRACK = "retailer_name, retail_segment, channel, region, account_status"


@query("jn_08_change_detection", """
SELECT retailer_id, retail_segment FROM account_changes WHERE custkey % 10 = 0""")
def change_detection(f: Frames):
    track = _TRACK.split(", ")
    mark = lambda df: df.select("retailer_id", "retail_segment", row_digest(*track).alias("digest"))
    return mark(f.account_changes).join(mark(f.account_feed).select("retailer_id", "digest"),
                                        ["retailer_id", "digest"], "left_anti").drop("digest")


@query("jn_09_join_on_carried_key", """
SELECT p.product_name, CAST(sum(net_revenue) AS DECIMAL(18,2)) AS revenue FROM fact_sales f JOIN products p ON f.sku_id = p.sku_id GROUP BY 1""")
def carried_key(f: Frames):
    per_sku = f.fact_sales.groupBy("sku_id").agg(F.sum("net_revenue").alias("r"))
    return per_sku.join(f.products.select("sku_id", "product_name"), "sku_id").groupBy("product_name").agg(
        F.sum("r").cast("decimal(18,2)").alias("revenue"))


@query("jn_10_inner_star", """
SELECT w.region AS warehouse_region, p.product_category, count(*) AS rows FROM stock s JOIN warehouses w ON s.warehouse_id = w.warehouse_id
JOIN products p ON s.sku_id = p.sku_id GROUP BY 1, 2""")
def inner_star(f: Frames):
    return _count_by(f.stock.join(f.warehouses.select("warehouse_id", F.col("region").alias("warehouse_region")), "warehouse_id")
                     .join(f.products.select("sku_id", "product_category"), "sku_id"), "warehouse_region", "product_category")


@query("jn_11_compound_condition", """
SELECT c.retail_segment, count(*) AS rows FROM sale_lines l LEFT JOIN account_history c ON l.retailer_id = c.retailer_id AND c.is_current GROUP BY 1""")
def compound_condition(f: Frames):
    l, c = f.sale_lines.alias("l"), f.account_history.alias("c")
    return _count_by(l.join(c, (F.col("l.retailer_id") == F.col("c.retailer_id")) & F.col("c.is_current"), "left"),
                     "retail_segment")


@query("jn_12_share_of_one_row_total", f"""
SELECT channel, CAST(sum(quantity_sold) AS BIGINT) AS units, {s.pct('sum(quantity_sold)', '(SELECT sum(quantity_sold) FROM sale_lines)', 18, 4)} AS share_pct
FROM sale_lines GROUP BY 1""")
def share_of_total(f: Frames):
    total = f.sale_lines.agg(F.sum("quantity_sold")).scalar()
    return f.sale_lines.groupBy("channel").agg(F.sum("quantity_sold").alias("units")).withColumn(
        "share_pct", pct("units", total, 18, 4))


@query("jn_13_membership", """
SELECT (SELECT count(*) FROM sale_lines WHERE sku_id IN (SELECT sku_id FROM products WHERE price_tier = 'Premium')) AS members,
       (SELECT count(*) FROM sale_lines WHERE sku_id NOT IN (SELECT sku_id FROM products WHERE price_tier = 'Premium')) AS orphans""")
def membership(f: Frames):
    known = f.products.where("price_tier = 'Premium'").select("sku_id")
    inside = f.sale_lines.join(known, "sku_id", "left_semi").agg(F.count("*").alias("members"))
    return inside.withColumn("orphans", f.sale_lines.join(known, "sku_id", "left_anti").agg(F.count("*")).scalar())


@query("jn_14_period_windows", "SELECT product_category, region, channel, current_month_revenue, prior_month_revenue, current_ytd_revenue, prior_ytd_revenue FROM kpi_s02")
def period_windows(f: Frames):
    return f.kpi_s02.select("product_category", "region", "channel", "current_month_revenue", "prior_month_revenue",
                            "current_ytd_revenue", "prior_ytd_revenue")


@query("jn_15_carry_forward", "SELECT week_start_date, route_id, region, consecutive_weeks_in_worst10 FROM kpi_d04")
def carry_forward(f: Frames):
    return f.kpi_d04.select("week_start_date", "route_id", "region", "consecutive_weeks_in_worst10")


@query("jn_16_sales_by_stocking_warehouse", "SELECT sku_id, warehouse_id, CAST(units AS BIGINT) AS units FROM sold_where_stocked")
def stocking_warehouse(f: Frames):
    from shelfline.plans.kpi_stock import _sold_where_stocked
    return _sold_where_stocked(f.sale_lines, f.stock, AS_OF, 30)


@query("jn_17_sales_with_returns", """
SELECT transaction_id, sku_id, gross_sales_amount, return_amount, net_revenue, units_sold FROM net_lines""")
def sales_with_returns(f: Frames):
    return net_sale_lines(f.sale_lines, f.returns, [])


@query("jn_18_retained_set", """
SELECT p.retailer_id, c.retailer_id IS NOT NULL AS retained
FROM (SELECT DISTINCT retailer_id FROM sale_lines WHERE date_trunc('month', transaction_date) = DATE '2001-05-01') p
LEFT JOIN (SELECT DISTINCT retailer_id FROM sale_lines WHERE date_trunc('month', transaction_date) = DATE '2001-06-01') c
  ON p.retailer_id = c.retailer_id""")
def retained_set(f: Frames):
    m = F.trunc("transaction_date", "month")
    before = f.sale_lines.where(m == months_back(AS_OF, 2)).select("retailer_id").distinct()
    after = f.sale_lines.where(m == months_back(AS_OF, 1)).select("retailer_id").distinct().withColumn("_r", F.lit(True))
    return before.join(after, "retailer_id", "left").select("retailer_id", F.col("_r").isNotNull().alias("retained"))


@query("jn_19_trace_chain", "SELECT batch_id, shipment_id, retailer_id, is_fully_traceable FROM trace_chain")
def trace_chain(f: Frames):
    return f.kpi_p04.select("batch_id", "shipment_id", "retailer_id", "is_fully_traceable")


@query("jn_20_cards_without_fanout", """
SELECT (SELECT CAST(sum(total_revenue) AS DECIMAL(20,2)) FROM kc_revenue) AS revenue, (SELECT count(*) FROM kc_fulfillment) AS delivery_rows,
       (SELECT count(*) FROM kc_yield) AS yield_rows""")
def cards(f: Frames):
    return f.kc_revenue.agg(F.sum("total_revenue").cast("decimal(20,2)").alias("revenue")).withColumns({
        "delivery_rows": f.kc_fulfillment.agg(F.count("*")).scalar(), "yield_rows": f.kc_yield.agg(F.count("*")).scalar()})


# --- aggregates -------------------------------------------------------------------------------


@query("agg_01_basic", f"""
SELECT channel, count(*) AS lines, CAST(sum(quantity_sold) AS BIGINT) AS units, {s.ratio('sum(unit_price)', 'count(unit_price)', 18, 4)} AS avg_price,
       min(transaction_date) AS first_day, max(transaction_date) AS last_day FROM sale_lines GROUP BY 1""")
def basic(f: Frames):
    return f.sale_lines.groupBy("channel").agg(
        F.count("*").alias("lines"), F.sum("quantity_sold").alias("units"),
        ratio(F.sum("unit_price"), F.count("unit_price"), 18, 4).alias("avg_price"),
        F.min("transaction_date").alias("first_day"), F.max("transaction_date").alias("last_day"))


@query("agg_02_count_distinct", """
SELECT channel, count(DISTINCT transaction_id) AS transactions, count(DISTINCT retailer_id) AS retailers, count(DISTINCT sku_id) AS skus
FROM sale_lines GROUP BY 1""")
def count_distinct(f: Frames):
    return f.sale_lines.groupBy("channel").agg(
        F.count_distinct("transaction_id").alias("transactions"), F.count_distinct("retailer_id").alias("retailers"),
        F.count_distinct("sku_id").alias("skus"))


@query("agg_03_conditional", """
SELECT production_line_id, count(*) FILTER (event_type = 'QC_CHECK') AS checks, count(*) FILTER (qc_status = 'FAIL') AS fails,
       CAST(coalesce(sum(actual_output_cases) FILTER (event_type = 'BATCH_END'), 0) AS BIGINT) AS cases FROM plant_events GROUP BY 1""")
def conditional(f: Frames):
    end = F.when(F.col("event_type") == "BATCH_END", F.col("actual_output_cases"))
    return f.plant_events.groupBy("production_line_id").agg(
        F.count_if(F.col("event_type") == "QC_CHECK").alias("checks"), F.count_if(F.col("qc_status") == "FAIL").alias("fails"),
        F.coalesce(F.sum(end), F.lit(0)).alias("cases"))


@query("agg_04_conditional_distinct", """
SELECT channel, count(DISTINCT CASE WHEN transaction_date >= DATE '2001-01-01' THEN retailer_id END) AS active_this_year FROM sale_lines GROUP BY 1""")
def conditional_distinct(f: Frames):
    return f.sale_lines.groupBy("channel").agg(F.count_distinct(
        F.when(F.col("transaction_date") >= F.trunc(day(AS_OF), "year"), F.col("retailer_id"))).alias("active_this_year"))


@query("agg_05_boolean_sum", "SELECT channel, CAST(sum(CAST(is_fully_shipped AS INTEGER)) AS BIGINT) AS fully_shipped FROM shipments GROUP BY 1")
def boolean_sum(f: Frames):
    return f.shipments.groupBy("channel").agg(F.sum(F.col("is_fully_shipped").cast("int")).alias("fully_shipped"))


@query("agg_06_guarded_ratio", f"""
SELECT route_id, {s.ratio('sum(logistics_cost_usd)', 'sum(cases_delivered)', 18, 4)} AS cost_per_case,
       {s.ratio('sum(logistics_cost_usd)', 'sum(CASE WHEN cases_delivered > 1000 THEN 1 ELSE 0 END)', 18, 4)} AS no_divisor FROM shipments GROUP BY 1""")
def guarded_ratio(f: Frames):
    return f.shipments.groupBy("route_id").agg(
        ratio(F.sum("logistics_cost_usd"), F.sum("cases_delivered"), 18, 4).alias("cost_per_case"),
        ratio(F.sum("logistics_cost_usd"), F.count_if(F.col("cases_delivered") > 1000), 18, 4).alias("no_divisor"))


@query("agg_07_mean_of_percentages", f"SELECT production_line_id, {s.ratio('sum(avg_yield_rate_pct)', 'count(avg_yield_rate_pct)', 10, 6)} AS mean_yield FROM kc_yield GROUP BY 1")
def mean_of_percentages(f: Frames):
    return f.kc_yield.groupBy("production_line_id").agg(
        ratio(F.sum("avg_yield_rate_pct"), F.count("avg_yield_rate_pct"), 10, 6).alias("mean_yield"))


@query("agg_08_global", "SELECT count(*) AS lines, CAST(sum(unit_price * quantity_sold) AS DECIMAL(20,2)) AS revenue, count(DISTINCT retailer_id) AS retailers FROM sale_lines")
def global_aggregate(f: Frames):
    return f.sale_lines.agg(F.count("*").alias("lines"),
                            F.sum(F.col("unit_price") * F.col("quantity_sold")).cast("decimal(20,2)").alias("revenue"),
                            F.count_distinct("retailer_id").alias("retailers"))


@query("agg_09_arg_max", """
SELECT region, arg_max(retailer_id, (units, retailer_id)) AS top_retailer FROM
(SELECT region, retailer_id, sum(quantity_sold) AS units FROM sales GROUP BY 1, 2) GROUP BY 1""")
def arg_max(f: Frames):
    units = f.sales.groupBy("region", "retailer_id").agg(F.sum("quantity_sold").alias("units"))
    return units.groupBy("region").agg(F.max_by("retailer_id", F.struct("units", "retailer_id")).alias("top_retailer"))


@query("agg_10_distinct_rows", "SELECT DISTINCT retailer_id, channel, transaction_date FROM sale_lines")
def distinct_rows(f: Frames):
    return f.sale_lines.select("retailer_id", "channel", "transaction_date").distinct()


@query("agg_11_all_pass", "SELECT batch_id, bool_and(qc_status IS DISTINCT FROM 'FAIL') AS all_passed FROM plant_events WHERE event_type = 'QC_CHECK' GROUP BY 1")
def all_pass(f: Frames):
    return f.plant_events.where("event_type = 'QC_CHECK'").groupBy("batch_id").agg(
        F.bool_and(~F.col("qc_status").eqNullSafe("FAIL")).alias("all_passed"))


@query("agg_12_two_stage", """
SELECT retailer_id, CAST(sum(n) AS BIGINT) AS lines, max(n) AS busiest_day, count(*) AS active_days FROM
(SELECT retailer_id, transaction_date, count(*) AS n FROM sale_lines GROUP BY 1, 2) GROUP BY 1""")
def two_stage(f: Frames):
    daily = f.sale_lines.groupBy("retailer_id", "transaction_date").agg(F.count("*").alias("n"))
    return daily.groupBy("retailer_id").agg(F.sum("n").alias("lines"), F.max("n").alias("busiest_day"),
                                            F.count("*").alias("active_days"))


@query("agg_14_null_rates", f"""
SELECT count(*) AS row_count, {s.pct('count(*) - count(batch_id)', 'count(*)')} AS batch_id, {s.pct('count(*) - count(qc_status)', 'count(*)')} AS qc_status,
       {s.pct('count(*) - count(event_id)', 'count(*)')} AS event_id FROM plant_events""")
def null_rates(f: Frames):
    return profile.null_rates(f.plant_events, ["batch_id", "qc_status", "event_id"])


@query("agg_14_repeated_keys", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated(f: Frames):
    return repeated_keys(f.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("agg_15_coverage", "SELECT count(*) AS uncovered FROM (SELECT DISTINCT sku_id, warehouse_id FROM stock) s WHERE NOT EXISTS (SELECT 1 FROM reorder r WHERE r.sku_id = s.sku_id AND r.warehouse_id = s.warehouse_id AND r.reorder_point_units > 60)")
def coverage(f: Frames):
    points = f.reorder.where("reorder_point_units > 60").select("sku_id", "warehouse_id")
    return f.stock.select("sku_id", "warehouse_id").distinct().join(points, ["sku_id", "warehouse_id"], "left_anti").agg(
        F.count("*").alias("uncovered"))


# --- windows -------------------------------------------------------------------------------------

_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
_ORDER = "l_shipdate DESC, l_partkey, l_suppkey, l_quantity"


@query("win_01_latest_record", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER) AS quantity, CAST(l_shipdate AS DATE) AS ship_date
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) AS rn FROM lineitem) WHERE rn = 1""")
def latest_record(f: Frames):
    rows = f.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                      F.col("l_quantity").cast("int").alias("quantity"), F.col("l_shipdate").cast("date").alias("ship_date"))
    return latest_per_key(rows, ["l_orderkey", "l_linenumber"], ["ship_date"])


@query("win_02_latest_by_effective_date", """
SELECT sku_id, version_cost, valid_from FROM (SELECT *, row_number() OVER (PARTITION BY sku_id ORDER BY valid_from DESC) AS rn
FROM cost_history WHERE valid_from <= DATE '2000-06-30') WHERE rn = 1""")
def latest_effective(f: Frames):
    past = f.cost_history.where("valid_from <= date '2000-06-30'").select("sku_id", "version_cost", "valid_from")
    return latest_per_key(past, ["sku_id"], ["valid_from"])


@query("win_03_uniqueness_split", """
SELECT l_linenumber, count(*) FILTER (rn = 1) AS first_rows, count(*) FILTER (rn > 1) AS repeats FROM
(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS rn FROM lineitem) GROUP BY 1""")
def uniqueness_split(f: Frames):
    rows = f.table("lineitem").select(*_LINE)
    marked = mark_repeats(rows, ["l_orderkey", "l_linenumber"])
    return marked.groupBy("l_linenumber").agg(F.count_if(~F.col("_repeat")).alias("first_rows"),
                                              F.count_if("_repeat").alias("repeats"))


@query("win_04_rank_two_keys", """
SELECT week_start_date, route_id, region, rank() OVER (PARTITION BY week_start_date ORDER BY route_otd_pct, route_cost_per_case DESC) AS worst_rank FROM route_weeks""")
def rank_two_keys(f: Frames):
    weekly = f.shipments.where("actual_delivery_date IS NOT NULL").groupBy(
        week_start("ship_date").alias("week_start_date"), "route_id", "region").agg(
        pct(F.count_if(F.expr("actual_delivery_date <= promised_delivery_date")), F.count("*"), 18, 6).alias("otd"),
        ratio(F.sum("logistics_cost_usd"), F.sum("cases_delivered"), 18, 4).alias("cost"))
    w = Window.partitionBy("week_start_date").orderBy(F.asc("otd"), F.desc("cost"))
    return weekly.select("week_start_date", "route_id", "region", F.rank().over(w).alias("worst_rank"))


@query("win_05_global_rank_cut", """
SELECT sku_id, CAST(units AS BIGINT) AS units, r FROM (SELECT *, row_number() OVER (ORDER BY units DESC, sku_id) AS r FROM
(SELECT sku_id, sum(quantity_sold) AS units FROM sale_lines GROUP BY 1)) WHERE r <= 15""")
def global_rank(f: Frames):
    units = f.sale_lines.groupBy("sku_id").agg(F.sum("quantity_sold").alias("units"))
    return ranking.top_n(units, [F.desc("units"), F.asc("sku_id")], 15, "r")


@query("win_06_rank_and_group_total", """
SELECT * FROM (SELECT month, channel, units, rank() OVER (PARTITION BY month ORDER BY units DESC) AS unit_rank,
       CAST(sum(units) OVER (PARTITION BY month) AS BIGINT) AS month_units FROM
(SELECT strftime(transaction_date, '%Y-%m') AS month, channel, CAST(sum(quantity_sold) AS BIGINT) AS units FROM sale_lines GROUP BY 1, 2))""")
def rank_and_total(f: Frames):
    units = f.sale_lines.groupBy(month_label("transaction_date").alias("month"), "channel").agg(F.sum("quantity_sold").alias("units"))
    w = Window.partitionBy("month")
    return units.withColumns({"unit_rank": F.rank().over(w.orderBy(F.desc("units"))), "month_units": F.sum("units").over(w)})


@query("win_07_whole_set_totals", """
SELECT batch_id, is_fully_traceable, (SELECT count(DISTINCT batch_id) FROM trace_chain) AS batches,
       (SELECT count(*) FROM trace_chain WHERE is_fully_traceable) AS traceable_rows FROM trace_chain""")
def whole_set_totals(f: Frames):
    chain = f.kpi_p04.select("batch_id", "is_fully_traceable")
    return chain.withColumns({"batches": chain.agg(F.count_distinct("batch_id")).scalar(),
                              "traceable_rows": chain.agg(F.count_if("is_fully_traceable")).scalar()})


@query("win_08_streaks", "SELECT route_id, region, max(consecutive_weeks_in_worst10) AS longest FROM kpi_d04 GROUP BY 1, 2")
def streaks(f: Frames):
    return f.kpi_d04.groupBy("route_id", "region").agg(F.max("consecutive_weeks_in_worst10").alias("longest"))


@query("win_09_prior_rank_movement", "SELECT retailer_id, revenue_rank, prior_period_rank, rank_movement FROM kpi_c01")
def rank_movement(f: Frames):
    return f.kpi_c01.select("retailer_id", "revenue_rank", "prior_period_rank", "rank_movement")


@query("win_11_share_of_total", f"""
SELECT region, channel, {s.pct('sum(quantity_sold)', '(SELECT sum(quantity_sold) FROM sales)', 18, 4)} AS share_pct FROM sales GROUP BY 1, 2""")
def share_of_set(f: Frames):
    units = f.sales.groupBy("region", "channel").agg(F.sum("quantity_sold").alias("units"))
    return units.select("region", "channel", pct("units", units.agg(F.sum("units")).scalar(), 18, 4).alias("share_pct"))


# --- sorts and sets -----------------------------------------------------------------------------------


@query("srt_01_multi_key_sort", "SELECT report_month, channel, units FROM (SELECT strftime(transaction_date, '%Y-%m') AS report_month, channel, CAST(sum(quantity_sold) AS BIGINT) AS units FROM sale_lines GROUP BY 1, 2)")
def multi_key_sort(f: Frames):
    units = f.sale_lines.groupBy(month_label("transaction_date").alias("report_month"), "channel").agg(
        F.sum("quantity_sold").alias("units"))
    return units.orderBy(F.desc("report_month"), F.desc("units"), "channel")


@query("srt_02_top_n", "SELECT retailer_id, CAST(sum(quantity_sold) AS BIGINT) AS units FROM sale_lines GROUP BY 1 ORDER BY units DESC, retailer_id LIMIT 20")
def top_n(f: Frames):
    units = f.sale_lines.groupBy("retailer_id").agg(F.sum("quantity_sold").alias("units"))
    return ranking.top_n(units, [F.desc("units"), F.asc("retailer_id")], 20)


@query("srt_03_top_k_per_group", """
SELECT * FROM (SELECT channel, sku_id, units, row_number() OVER (PARTITION BY channel ORDER BY units DESC, sku_id) AS r FROM
(SELECT channel, sku_id, CAST(sum(quantity_sold) AS BIGINT) AS units FROM sale_lines GROUP BY 1, 2)) WHERE r <= 5""")
def top_k(f: Frames):
    units = f.sale_lines.groupBy("channel", "sku_id").agg(F.sum("quantity_sold").alias("units"))
    return ranking.top_per_group(units, ["channel"], [F.desc("units"), F.asc("sku_id")], 5, "r")


@query("set_02_nary_union", "SELECT tag, count(*) AS rows FROM (SELECT 'late' AS tag FROM shipments WHERE actual_delivery_date > promised_delivery_date UNION ALL SELECT 'open' FROM shipments WHERE actual_delivery_date IS NULL UNION ALL SELECT 'part' FROM shipments WHERE NOT is_fully_shipped) GROUP BY 1")
def nary_union(f: Frames):
    # One scan tags every row with all its faults instead of a union of filtered scans.
    faults = F.array_compact(F.array(
        F.when(F.expr("actual_delivery_date > promised_delivery_date"), "late"),
        F.when(F.col("actual_delivery_date").isNull(), "open"), F.when(~F.col("is_fully_shipped"), "part")))
    return _count_by(f.shipments.select(F.explode(faults).alias("tag")), "tag")


@query("set_03_difference", """
SELECT retailer_id FROM account_feed WHERE retailer_id NOT IN (SELECT retailer_id FROM sale_lines WHERE transaction_date >= DATE '2001-06-01')""")
def difference(f: Frames):
    active = f.sale_lines.where("transaction_date >= date '2001-06-01'").select("retailer_id")
    return f.account_feed.select("retailer_id").join(active, "retailer_id", "left_anti")


# --- scalar functions -----------------------------------------------------------------------------------


@query("fn_date_parse", """
SELECT count(TRY_CAST(d AS DATE)) AS dates, count(TRY_CAST(t AS TIMESTAMP)) AS stamps FROM (
SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'xx' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d,
       CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS t FROM orders)""")
def date_parse(f: Frames):
    k = F.col("o_orderkey")
    raw = f.table("orders").select(
        F.when(k % 13 == 0, "xx").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d"),
        F.when(k % 17 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("t"))
    return raw.agg(F.count(as_date("d")).alias("dates"), F.count(as_timestamp("t")).alias("stamps"))


@query("fn_date_parts", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       CAST(weekofyear(o_orderdate) AS INTEGER) AS w, CAST(quarter(o_orderdate) AS INTEGER) AS q, dayname(o_orderdate) AS day_name,
       monthname(o_orderdate) AS month_name, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS k FROM orders""")
def date_parts(f: Frames):
    d = F.col("d")
    return f.table("orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct().select(
        "d", F.year(d).alias("y"), F.month(d).alias("m"), F.weekofyear(d).alias("w"), F.quarter(d).alias("q"),
        F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "MMMM").alias("month_name"), date_key(d).alias("k"))


@query("fn_date_arithmetic", """
SELECT DISTINCT d, CAST(d - 30 AS DATE) AS minus_30, CAST(d + INTERVAL 1 MONTH AS DATE) AS next_month, last_day(d) AS month_end,
       CAST(date_trunc('week', d) AS DATE) AS week, CAST(date_trunc('month', d) AS DATE) AS month FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_arithmetic(f: Frames):
    d = F.col("d")
    return f.table("orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct().select(
        "d", F.date_sub(d, 30).alias("minus_30"), F.add_months(d, 1).alias("next_month"), F.last_day(d).alias("month_end"),
        week_start(d).alias("week"), month_start(d).alias("month"))


@query("fn_duration", f"SELECT event_id, {s.ratio('epoch(downtime_end_ts) - epoch(downtime_start_ts)', '3600', 6, 2)} AS hours FROM plant_events")
def duration(f: Frames):
    return f.plant_events.select("event_id", hours_between("downtime_start_ts", "downtime_end_ts").alias("hours"))


@query("fn_month_end_flags", "SELECT full_date, days_in_month, is_month_end, is_quarter_end, is_year_end FROM dim_calendar")
def month_end_flags(f: Frames):
    return f.order_days.select("full_date", "days_in_month", "is_month_end", "is_quarter_end", "is_year_end")


@query("fn_fiscal_calendar", "SELECT full_date, fiscal_year, fiscal_quarter, fiscal_period FROM dim_calendar")
def fiscal_calendar(f: Frames):
    return f.order_days.select("full_date", "fiscal_year", "fiscal_quarter", "fiscal_period")


@query("fn_holiday", "SELECT full_date, holiday_name FROM dim_calendar WHERE is_holiday")
def holiday(f: Frames):
    return f.order_days.where("is_holiday").select("full_date", "holiday_name")


@query("fn_string", "SELECT DISTINCT retailer_id || '|' || channel AS pair, upper(channel) AS loud, 'X-' || length(retailer_id) AS tag FROM sale_lines")
def string_functions(f: Frames):
    return f.sale_lines.select(F.concat_ws("|", "retailer_id", "channel").alias("pair"), F.upper("channel").alias("loud"),
                               F.concat(F.lit("X-"), F.length("retailer_id").cast("string")).alias("tag")).distinct()


@query("fn_hash", f"SELECT retailer_id, {s.digest('retailer_name', 'retail_segment', 'channel')} AS digest FROM account_feed")
def hash_function(f: Frames):
    return f.account_feed.select("retailer_id", row_digest("retailer_name", "retail_segment", "channel").alias("digest"))


@query("fn_math", """
SELECT sku_id, warehouse_id, snapshot_date, abs(units_on_hand - reorder_point_units) AS gap, greatest(units_on_hand, reorder_point_units) AS top,
       CAST(ceil(units_on_hand / 7.0) AS BIGINT) AS weeks, round(inventory_value, 1) AS value_round FROM stock s""")
def math_functions(f: Frames):
    return f.stock.select(*_KEYS, F.abs(F.col("units_on_hand") - F.col("reorder_point_units")).alias("gap"),
                          F.greatest("units_on_hand", "reorder_point_units").alias("top"),
                          F.ceil(F.col("units_on_hand") / 7).alias("weeks"), F.round("inventory_value", 1).alias("value_round"))


@query("fn_conditional", """
SELECT CASE WHEN units_on_hand = 0 THEN 'OUT_OF_STOCK' WHEN units_on_hand <= reorder_point_units THEN 'REORDER_REQUIRED' ELSE 'OK' END AS status,
       count(*) AS rows, count(nullif(units_in_transit, 0)) AS moving FROM stock GROUP BY 1""")
def conditional_functions(f: Frames):
    status = (F.when(F.col("units_on_hand") == 0, "OUT_OF_STOCK")
              .when(F.col("units_on_hand") <= F.col("reorder_point_units"), "REORDER_REQUIRED").otherwise("OK"))
    return f.stock.groupBy(status.alias("status")).agg(
        F.count("*").alias("rows"), F.count(F.nullif(F.col("units_in_transit"), F.lit(0))).alias("moving"))


@query("fn_boolean_parse", """
SELECT word, count(*) AS rows, bool_and(lower(word) IN ('true', '1', 'active')) AS is_active FROM
(SELECT ['true', 'TRUE', '1', 'active', '0', 'no'][o_orderkey % 6 + 1] AS word FROM orders) GROUP BY 1""")
def boolean_parse(f: Frames):
    words = F.array(*[F.lit(w) for w in ("true", "TRUE", "1", "active", "0", "no")])
    rows = f.table("orders").select(F.element_at(words, (F.col("o_orderkey") % 6 + 1).cast("int")).alias("word"))
    return rows.groupBy("word").agg(F.count("*").alias("rows"), F.bool_and(is_true_word("word", ("active",))).alias("is_active"))


@query("fn_array_explode", "SELECT status, count(*) AS rows FROM (SELECT unnest([o_orderstatus, 'ALL']) AS status FROM orders) GROUP BY 1")
def array_functions(f: Frames):
    return _count_by(f.table("orders").select(F.explode(F.array("o_orderstatus", F.lit("ALL"))).alias("status")), "status")


@query("fn_json", """
SELECT retailer_id, '{"retailer_id":"' || retailer_id || '","channel":"' || channel || '","credit_terms_days":' || credit_terms_days || '}' AS body FROM account_feed""")
def json_function(f: Frames):
    return f.account_feed.select("retailer_id", F.to_json(F.struct("retailer_id", "channel", "credit_terms_days")).alias("body"))


@query("fn_sql_expression", "SELECT count(*) FILTER (quantity_sold > 40 AND channel <> 'DTC') AS hits FROM sale_lines")
def sql_expression(f: Frames):
    return f.sale_lines.agg(F.count_if(F.expr("quantity_sold > 40 AND channel <> 'DTC'")).alias("hits"))
