"""Layer jobs over stored tables: raw, conformed, reporting.

A job reads tables, applies the plans and writes; nothing else is shared between
jobs, so each can be rerun on its own. Dates and times are parameters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import as_int, month_label, surrogate_key
from shelfline.operators import history
from shelfline.operators import quality as q
from shelfline.operators.dedup import latest_per_key
from shelfline.plans import changes, conform, dimensions, facts, ingest, kpi_core, kpi_tables
from shelfline.plans.gate import admit
from shelfline.session import settle
from shelfline.sources import files, sinks


def run_raw(spark: SparkSession, config: dict, batch_id: str) -> dict[str, int]:
    """Land every feed once; returns are an optional feed."""
    returns = f"{config['sources']['erp']['base_path']}/returns.csv"
    optional = {"erp_returns": ingest.ingest_returns(spark, config, batch_id)} if sinks.exists(spark, returns) else {}
    return {
        **optional,
        "pos_transactions": ingest.ingest_pos_transactions(spark, config, batch_id),
        "erp_sales": ingest.ingest_erp_sales(spark, config, batch_id),
        "iot_sensor_events": ingest.ingest_production(spark, config, batch_id),
        "erp_inventory": ingest.ingest_inventory(spark, config, batch_id),
        "erp_products": ingest.ingest_products(spark, config, batch_id),
        "erp_customers": ingest.ingest_customers(spark, config, batch_id),
        "erp_warehouses": ingest.ingest_warehouses(spark, config, batch_id),
        "logistics_shipments": ingest.ingest_shipments(spark, config, batch_id),
    }


def _raw(spark: SparkSession, config: dict, name: str, load: str | None) -> DataFrame:
    """A raw table, all of it or one load."""
    df = files.table(spark, config["tables"]["bronze"][name], merge_schema=True)
    return df if load is None else df.where(F.col("_batch_id") == load)


def run_sales(spark: SparkSession, config: dict, run_ts: str, run_id: str, load: str | None = None) -> int:
    """Receipt lines of a load: typed, checked, merged by transaction, position and product."""
    clean = admit(config, _raw(spark, config, "pos_transactions", load), conform.SALES_INPUT_RULES,
                  lambda rows: conform.shape_sales(rows, run_ts).withColumn("source", F.lit("POS")),
                  conform.SALES_OUTPUT_RULES, "pos_transactions", "sales_transactions", run_ts, run_id)
    return _merge_sales(spark, config, clean)


def run_erp_sales(spark: SparkSession, config: dict, run_ts: str, run_id: str, load: str | None = None) -> int:
    """Invoice lines of a load beside the receipt lines, told apart by ``source``."""
    raw = conform.erp_sale_lines(_raw(spark, config, "erp_sales", load))
    clean = admit(config, raw, conform.SALES_INPUT_RULES,
                  lambda rows: conform.shape_sales(rows, run_ts).withColumn("source", F.lit("ERP")).withColumn(
                      "transaction_key", surrogate_key(F.lit("ERP"), "transaction_id", "line_no", "sku_id")),
                  conform.SALES_OUTPUT_RULES, "erp_sales", "sales_transactions", run_ts, run_id)
    return _merge_sales(spark, config, clean)


def _merge_sales(spark: SparkSession, config: dict, clean: DataFrame) -> int:
    path = config["tables"]["silver"]["sales_transactions"]
    if sinks.exists(spark, path):  # the feeds name different columns
        stored = spark.read.parquet(path)
        clean = clean.select(*[F.col(c) if c in clean.columns else F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in stored.columns])
    return sinks.upsert_partitions(spark, path, clean, ["transaction_key"], "transaction_date",
                                   ["updated_at", "net_line_amount", "unit_price", "quantity_sold"])


def run_returns(spark: SparkSession, config: dict, run_ts: str, run_id: str, load: str | None = None) -> int:
    """Returns of a load with their reason and whether their receipt is known."""
    silver = config["tables"]["silver"]
    valid = admit(config, _raw(spark, config, "erp_returns", load), (q.not_null(["return_id"]),), conform.cast_returns,
                  conform.RETURN_RULES, "erp_returns", "sales_returns", run_ts, run_id)
    linked = conform.link_returns(valid, spark.read.parquet(silver["sales_transactions"]))
    return sinks.upsert_partitions(spark, silver["sales_returns"], conform.stamp(linked, run_ts), ["return_key"], "return_date")


def run_spend(spark: SparkSession, config: dict, run_ts: str, run_id: str, period: tuple[str, str], load: str | None = None) -> int:
    """Spend per account of one period, from the account feed."""
    feed = conform.transform_customers(_raw(spark, config, "erp_customers", load), run_ts)
    shape = lambda rows: conform.total_spend(rows.withColumns({
        "period_start_date": F.lit(period[0]).cast("date"), "period_end_date": F.lit(period[1]).cast("date")}))
    clean = admit(config, feed, (q.not_null(["retailer_id"]),), shape, conform.SPEND_RULES, "erp_customers", "sales_spend", run_ts, run_id)
    return sinks.upsert_partitions(spark, config["tables"]["silver"]["sales_spend"], clean, ["spend_key"], "period_start_date")


def run_products(spark: SparkSession, config: dict, run_ts: str, run_id: str = "manual") -> int:
    rows = admit(config, _raw(spark, config, "erp_products", None), (q.not_null(["sku_id", "product_category"]),),
                 lambda rows: conform.transform_products(rows, run_ts), (), "erp_products", "products", run_ts, run_id)
    return sinks.write_next(rows, config["tables"]["silver"]["products"])


def run_customers(spark: SparkSession, config: dict, run_ts: str, load: str | None = None, run_id: str = "manual") -> int:
    tracked = list(conform.TRACKED_ACCOUNT_COLUMNS)
    rows = admit(config, _raw(spark, config, "erp_customers", load), (q.not_null(["retailer_id", "record_effective_date"]),),
                 lambda rows: conform.transform_customers(rows, run_ts), (q.not_null(["record_effective_date"]),),
                 "erp_customers", "customers", run_ts, run_id)
    feed = rows.select("retailer_id", *tracked, "account_activation_date", "record_effective_date")
    root = config["tables"]["silver"]["customers"]
    state = sinks.read_current(spark, root)
    return sinks.write_next(history.apply_history(state, feed, "retailer_id", tracked, "record_effective_date"), root)


def apply_scd_type2(spark: SparkSession, df_incoming: DataFrame, target_table: str, natural_key: str,
                    tracked_cols: list[str], valid_from_col: str = "record_effective_date") -> None:
    """Merge a feed into the stored history at ``target_table`` as its next version."""
    state = sinks.read_current(spark, target_table)
    sinks.write_next(history.apply_history(state, df_incoming, natural_key, tracked_cols, valid_from_col), target_table)


def run_warehouses(spark: SparkSession, config: dict, run_ts: str, run_id: str = "manual") -> int:
    rows = admit(config, _raw(spark, config, "erp_warehouses", None), (q.not_null(["warehouse_id"]),),
                 lambda rows: conform.transform_warehouses(rows, run_ts), (), "erp_warehouses", "warehouses", run_ts, run_id)
    return sinks.write_next(rows, config["tables"]["silver"]["warehouses"])


def run_inventory(spark: SparkSession, config: dict, run_ts: str, run_id: str, load: str | None = None) -> int:
    silver = config["tables"]["silver"]
    products = sinks.read_current(spark, silver["products"])
    clean = admit(config, _raw(spark, config, "erp_inventory", load), conform.STOCK_INPUT_RULES,
                  lambda rows: conform.shape_stock(rows, products, run_ts), conform.STOCK_OUTPUT_RULES,
                  "erp_inventory", "inventory_stock", run_ts, run_id)
    rows = sinks.upsert_partitions(spark, silver["inventory_stock"], clean, ["stock_key"], "snapshot_date", key_has_partition=True)
    points = conform.reorder_points(spark.read.parquet(silver["inventory_stock"]))
    sinks.write_next(points, silver["ref_reorder_points"])
    return rows


EVENT_RULES = (q.not_null(["event_id"], rule_id="EVT-ID"),)


def run_production(spark: SparkSession, config: dict, run_ts: str, load: str | None = None, run_id: str = "manual") -> int:
    """Rebuild the batches a load touched from all their events, and store its events.

    Events without an id are rejected and logged, as in the stream.
    """
    silver = config["tables"]["silver"]
    now = admit(config, _raw(spark, config, "iot_sensor_events", load), EVENT_RULES, None, (), "iot_sensor_events", "production_events", run_ts, run_id)
    events = now
    if load is not None:
        touched = now.where("batch_id IS NOT NULL").select("batch_id").distinct()
        earlier = _raw(spark, config, "iot_sensor_events", None).where("event_id IS NOT NULL")
        events = earlier.join(touched, "batch_id", "left_semi")
    once = latest_per_key(events, ["event_id"], ["_ingested_at"])
    batches = admit(config, conform.shape_batches(once), conform.BATCH_RULES[2:], None, (), "iot_sensor_events",
                    "production_batches", run_ts, run_id)
    judged = conform.stamp(conform.aggregate_batch_qc(batches, once), run_ts, "production")
    fresh = conform.conform_events(latest_per_key(now, ["event_id"], ["_ingested_at"]))
    sinks.upsert_partitions(spark, silver["production_events"], conform.stamp(fresh, run_ts, "production"),
                            ["event_key"], "event_date")
    return sinks.upsert_partitions(spark, silver["production_batches"], judged, ["batch_key"], "batch_date")


def run_shipments(spark: SparkSession, config: dict, run_ts: str, run_id: str, load: str | None = None) -> int:
    raw = _raw(spark, config, "logistics_shipments", load)
    headers = _raw(spark, config, "erp_sales", None).select("order_id", "retailer_id")
    clean = admit(config, conform.resolve_shipment_party(raw, headers), conform.SHIPMENT_INPUT_RULES,
                  lambda rows: conform.shape_shipments(rows, run_ts), conform.SHIPMENT_OUTPUT_RULES,
                  "logistics_shipments", "shipments", run_ts, run_id)
    return sinks.upsert_partitions(spark, config["tables"]["silver"]["shipments"], clean, ["shipment_key"], "ship_date")


def _from(df: DataFrame, date: str, since: str | None) -> DataFrame:
    """Rows from the month of ``since`` on; the partition column prunes the rest."""
    return df if since is None else df.where(F.col(date) >= F.trunc(F.lit(since).cast("date"), "month"))


def run_dimensions(spark: SparkSession, config: dict) -> dict[str, int]:
    """Dimensions of what is stored; the calendar spans the years of all stored dates."""
    silver, gold = config["tables"]["silver"], config["tables"]["gold"]
    current = lambda name: sinks.read_current(spark, silver[name])
    dated = (("sales_transactions", "transaction_date"), ("inventory_stock", "snapshot_date"),
             ("production_batches", "batch_date"), ("shipments", "ship_date"))
    dim_date = dimensions.calendar_over([(spark.read.parquet(silver[name]), date) for name, date in dated])
    places = current("warehouses").select(
        "warehouse_id", F.col("name").alias("warehouse_name"), "region", F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("string").alias("warehouse_type"), as_int("capacity_cases").alias("capacity_units"))
    return {"dim_date": sinks.overwrite(dim_date, gold["dim_date"], ["year"]),
            "dim_product": sinks.overwrite(dimensions.product_dimension(current("products")), gold["dim_product"]),
            "dim_customer": sinks.overwrite(dimensions.customer_dimension(current("customers")), gold["dim_customer"]),
            "dim_region": sinks.overwrite(dimensions.region_dimension(current("customers")), gold["dim_region"]),
            "dim_channel": sinks.overwrite(dimensions.channel_dimension(current("customers")), gold["dim_channel"]),
            "dim_warehouse": sinks.overwrite(dimensions.warehouse_dimension(places), gold["dim_warehouse"])}


def run_facts(spark: SparkSession, config: dict, since: str | None = None) -> dict[str, int]:
    """Facts of all days, or only of the months from ``since`` on."""
    silver, gold = config["tables"]["silver"], config["tables"]["gold"]
    current = lambda name: sinks.read_current(spark, silver[name])
    recent = lambda name, date: _from(spark.read.parquet(silver[name]), date, since)
    products, customers, days = current("products"), current("customers"), spark.read.parquet(gold["dim_date"])
    batches = recent("production_batches", "batch_date")
    hit = facts.attribute_downtime(batches, spark.read.parquet(silver["production_events"]))
    booked = facts.booked_hours(hit)
    plans = (
        ("fact_sales", "transaction_date", facts.compute_fact_sales(
            recent("sales_transactions", "transaction_date"), products, customers, days)),
        ("fact_inventory", "snapshot_date", facts.compute_fact_inventory_snapshot(
            recent("inventory_stock", "snapshot_date"), current("ref_reorder_points"), days)),
        ("fact_production", "batch_date", facts.compute_fact_production_batch(batches, booked, days)),
        ("fact_shipment", "ship_date", facts.compute_fact_shipment(recent("shipments", "ship_date"), customers, days)),
    )
    put = sinks.overwrite if since is None else sinks.overwrite_partitions
    return {name: put(df, gold[name], [by]) for name, by, df in plans}


def _kpi_plans(spark: SparkSession, config: dict, since: str | None) -> dict[str, DataFrame]:
    silver, gold = config["tables"]["silver"], config["tables"]["gold"]
    current = lambda name: sinks.read_current(spark, silver[name])
    fact = lambda name, date: _from(spark.read.parquet(gold[name]), date, since)
    products, customers = current("products"), current("customers")
    sales = fact("fact_sales", "transaction_date")
    # Receipts name no warehouse; their cost counts once a feed does.
    located = sales if "warehouse_key" in sales.columns else sales.withColumn("warehouse_key", F.lit(None).cast("bigint"))
    monthly = lambda df: df.withColumn("report_month", month_label("report_date"))
    return {
        "kpi_daily_revenue": monthly(kpi_core.compute_kpi_daily_revenue(sales, products, customers)),
        "kpi_fulfillment": monthly(kpi_core.compute_kpi_fulfillment_rate(fact("fact_shipment", "ship_date"), customers)),
        "kpi_inv_turnover": kpi_core.compute_kpi_inventory_turnover(fact("fact_inventory", "snapshot_date"), located),
        "kpi_prod_yield": monthly(kpi_core.compute_kpi_production_yield(fact("fact_production", "batch_date"))),
    }


def run_kpis(spark: SparkSession, config: dict, since: str | None = None) -> dict[str, int]:
    """The four standing KPI tables, one partition per month."""
    put = sinks.overwrite if since is None else sinks.overwrite_partitions
    return {name: put(df, config["tables"]["gold"][name], ["report_month"]) for name, df in _kpi_plans(spark, config, since).items()}


# Conformed tables whose merges the reporting layer follows, and the date they are stored by.
FOLLOWED = {"sales_transactions": "transaction_date", "sales_returns": "return_date", "inventory_stock": "snapshot_date",
            "production_batches": "batch_date", "production_events": "event_date", "shipments": "ship_date"}


def _returns(spark: SparkSession, config: dict) -> DataFrame:
    """Stored returns; none before the first return."""
    path = config["tables"]["silver"]["sales_returns"]
    if sinks.exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], "transaction_id string, sku_id string, return_amount decimal(12,2), return_date date")


def kpi_inputs(spark: SparkSession, config: dict) -> dict[str, DataFrame]:
    """What the specification's KPI tables are built from, out of the conformed tables."""
    silver = config["tables"]["silver"]
    current = lambda name: sinks.read_current(spark, silver[name])
    stored = lambda name: spark.read.parquet(silver[name])
    accounts = current("customers").where("is_current")
    places = accounts.select("retailer_id", F.col("region").alias("_region"), F.col("channel").alias("_channel"))

    def placed(df: DataFrame) -> DataFrame:
        """Region and channel of the account where the feed names none."""
        with_both = df.join(places, "retailer_id", "left")
        own = lambda c: F.coalesce(c, f"_{c}") if c in df.columns else F.col(f"_{c}")
        return with_both.withColumns({"region": own("region"), "channel": own("channel")}).drop("_region", "_channel")

    shipments = stored("shipments")
    if "batch_id" not in shipments.columns:  # the feed names no batch: no chain is complete
        shipments = shipments.withColumn("batch_id", F.lit(None).cast("string"))
    spend = stored("sales_spend") if sinks.exists(spark, silver["sales_spend"]) else spark.createDataFrame(
        [], "retailer_id string, period_start_date date, total_acquisition_cost_usd decimal(18,2)")
    return {"sales": placed(stored("sales_transactions")), "returns": _returns(spark, config), "products": current("products"),
            "stock": stored("inventory_stock"), "reorder": current("ref_reorder_points"), "batches": stored("production_batches"),
            "events": stored("production_events"), "shipments": placed(shipments), "accounts": accounts, "spend": spend}


def run_sales_lines(spark: SparkSession, config: dict, run_ts: str, span: changes.Span | None = None) -> int:
    """The sale fact of one row a line with its returns, whole or for some months."""
    i, path = kpi_inputs(spark, config), config["tables"]["gold"]["fact_sales_lines"]
    history_rows = sinks.read_current(spark, config["tables"]["silver"]["customers"])
    sales = i["sales"] if span is None else i["sales"].where(changes.in_months("transaction_date", span))
    fact = facts.sales_line_fact(sales, i["returns"], i["shipments"], i["products"], history_rows, run_ts)
    return sinks.overwrite(fact, path, ["transaction_date"]) if span is None else changes.replace_months(fact, path, "transaction_date", span)


def run_changed(spark: SparkSession, config: dict, run_ts: str) -> dict[str, int]:
    """Bring the reporting layer up to date with the merges since the last run, however old the rows they brought.

    Each merge recorded the days it touched. A changed day rebuilds its month in the facts it
    feeds and in the KPI tables that look at it, following the windows: weeks begin in the
    month before, streaks run on, stoppages meet batches of the next day, returns go back to
    their receipt. All other partitions keep their files. Tables about the day of the run are
    written for that day. The record goes only when everything is written: a run that broke
    off is done again.
    """
    silver, gold = config["tables"]["silver"], config["tables"]["gold"]
    new = changes.Changes(spark, {name: silver[name] for name in FOLLOWED})
    out = run_dimensions(spark, config)
    current = lambda name: sinks.read_current(spark, silver[name])
    products, customers, days = current("products"), current("customers"), spark.read.parquet(gold["dim_date"])
    month = changes.months_reached
    returned = [] if not new.days["sales_returns"] else changes.receipts_of(
        spark.read.parquet(silver["sales_returns"]), spark.read.parquet(silver["sales_transactions"]), new.days["sales_returns"])
    spans = {
        "fact_sales": month(new.days["sales_transactions"]),
        "fact_inventory": month(new.days["inventory_stock"]),
        "fact_production": changes.merged(month(new.days["production_batches"]), month(new.days["production_events"], -1, 1)),
        "fact_shipment": month(new.days["shipments"]),
    }
    stored = lambda table, fact: spark.read.parquet(silver[table]).where(changes.in_months(FOLLOWED[table], spans[fact]))

    def production() -> DataFrame:
        batches = stored("production_batches", "fact_production")
        hit = facts.attribute_downtime(batches, spark.read.parquet(silver["production_events"]))
        return facts.compute_fact_production_batch(batches, facts.booked_hours(hit), days)

    plans = {
        "fact_sales": ("transaction_date", lambda: facts.compute_fact_sales(stored("sales_transactions", "fact_sales"), products, customers, days)),
        "fact_inventory": ("snapshot_date", lambda: facts.compute_fact_inventory_snapshot(
            stored("inventory_stock", "fact_inventory"), current("ref_reorder_points"), days)),
        "fact_production": ("batch_date", production),
        "fact_shipment": ("ship_date", lambda: facts.compute_fact_shipment(stored("shipments", "fact_shipment"), customers, days)),
    }
    for name, (by, plan) in plans.items():
        if spans[name]:
            out[name] = changes.replace_months(plan(), gold[name], by, spans[name])
    lines = changes.merged(spans["fact_sales"], month(returned))
    if lines:
        out["fact_sales_lines"] = run_sales_lines(spark, config, run_ts, lines)
    out |= _write_kpis(spark, config, {
        "kpi_daily_revenue": spans["fact_sales"], "kpi_fulfillment": spans["fact_shipment"], "kpi_prod_yield": spans["fact_production"],
        "kpi_inv_turnover": changes.merged(spans["fact_inventory"], spans["fact_sales"])})
    changed = {"sales": [*new.days["sales_transactions"], *returned], "batches": new.days["production_batches"],
               "events": new.days["production_events"], "shipments": new.days["shipments"]}
    out |= kpi_tables.write_kpi_tables(kpi_inputs(spark, config), gold["kpi"], run_ts[:10], changed=changed)
    new.done()
    return out


def _write_kpis(spark: SparkSession, config: dict, spans: dict[str, changes.Span]) -> dict[str, int]:
    """The standing KPI tables of the given months."""
    gold, out = config["tables"]["gold"], {}
    for name, df in _kpi_plans(spark, config, None).items():
        span = spans[name]
        if span:
            month = F.to_date("report_month", "yyyy-MM")
            rows = settle(df.where(changes.in_months("report_date" if "report_date" in df.columns else month, span)), name)
            stored = spark.read.schema(rows.schema).parquet(gold[name]).select("report_month").distinct() if sinks.exists(spark, gold[name]) else rows.select("report_month").limit(0)
            gone = settle(stored.where(changes.in_months(month, span)).join(rows.select("report_month").distinct(), "report_month", "left_anti"), "gone")
            out[name] = sinks.overwrite_partitions(rows, gold[name], ["report_month"])
            sinks.drop_partitions(spark, gold[name], gone)
    return out


def run_gold(spark: SparkSession, config: dict, since: str | None = None) -> dict[str, int]:
    """The reporting layer rebuilt, whole or from a month on."""
    return {**run_dimensions(spark, config), **run_facts(spark, config, since), **run_kpis(spark, config, since)}


def run_all(spark: SparkSession, config: dict, batch_id: str, run_ts: str, since: str | None = None, invoices: bool = False,
            spend_period: tuple[str, str] | None = None) -> dict[str, int]:
    """One full run of all layers for one load.

    The reporting layer follows what the load changed in the conformed tables. With ``since``
    its months from that day on are rebuilt besides; ``invoices`` adds the invoice lines to
    the conformed sales. The account feed's spend is booked for ``spend_period``, by
    default the month of the run.
    """
    landed = run_raw(spark, config, batch_id)
    run_products(spark, config, run_ts, batch_id)
    run_customers(spark, config, run_ts, batch_id, batch_id)
    run_warehouses(spark, config, run_ts, batch_id)
    if {"trade_spend_usd", "broker_commission_usd", "field_sales_cost_usd"} <= set(_raw(spark, config, "erp_customers", None).columns):
        today = dt.date.fromisoformat(run_ts[:10])
        last = (today.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        run_spend(spark, config, run_ts, batch_id, spend_period or (str(today.replace(day=1)), str(last)), batch_id)
    run_sales(spark, config, run_ts, batch_id, batch_id)
    if invoices:
        run_erp_sales(spark, config, run_ts, batch_id, batch_id)
    if "erp_returns" in landed:
        run_returns(spark, config, run_ts, batch_id, batch_id)
    run_inventory(spark, config, run_ts, batch_id, batch_id)
    run_production(spark, config, run_ts, batch_id, batch_id)
    run_shipments(spark, config, run_ts, batch_id, batch_id)
    followed = run_changed(spark, config, run_ts)
    return {**landed, **followed, **(run_gold(spark, config, since) if since else {})}
