"""Domain frames derived from the provided tables.

The mapping turns the generic order, part, customer, supplier and event tables
into sales, products, accounts, warehouses, stock, shipments and production
events. Everything is a projection, an equi-join or a grouped aggregate; join
sides carry no broadcast hint because none has a proven bound, so Spark decides
by measured size.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import surrogate_key
from shelfline.plans import (
    conform, dimensions, facts, kpi_accounts, kpi_core, kpi_delivery, kpi_production, kpi_sales,
    kpi_stock,
)
from shelfline.session import settle

AS_OF = "2001-07-15"
EVENTS_AS_OF = "2024-01-30"
EVENTS_NOW = "2024-01-31 00:00:00"

MONEY = "decimal(10,2)"

# Schemas of the provided tables: no job is spent on reading footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def channel_of(key: str) -> Column:
    return (F.when(F.col(key) % 3 == 0, "Retail").when(F.col(key) % 3 == 1, "Wholesale")
            .otherwise("DTC"))


def _id(prefix: str, col: str | Column) -> Column:
    return F.concat(F.lit(prefix), (F.col(col) if isinstance(col, str) else col).cast("string"))


class Frames:
    """Lazily built frames of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def share(self, *names: str, **parts: tuple[str, ...]) -> None:
        """Store the named frames, in the order given, for queries that read them many times; of ``parts`` these columns only."""
        for name, columns in {**dict.fromkeys(names, ("*",)), **parts}.items():
            setattr(self, name, settle(getattr(self, name).select(*columns), name.replace("_", "-")))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def regions(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")

    # --- master data -----------------------------------------------------
    @cached_property
    def products(self) -> DataFrame:
        price = F.col("p_retailprice").cast(MONEY)
        share = (F.lit(50) + F.col("p_partkey") % 40).cast("decimal(4,0)")
        return self.table("part").select(
            _id("SKU-", "p_partkey").alias("sku_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_category"),
            F.col("p_brand").alias("brand"),
            F.col("p_size").alias("package_size_ml"),
            price.alias("list_price"),
            (price * share * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY).alias("standard_cost_per_unit"),
            F.when(F.col("p_partkey") % 3 == 0, "Economy").when(F.col("p_partkey") % 3 == 1, "Standard")
            .otherwise("Premium").alias("price_tier"),
        )

    @cached_property
    def account_feed(self) -> DataFrame:
        """First delivery of the account master: one row per customer."""
        c = self.table("customer")
        k = F.col("c_custkey")
        return c.join(self.regions, c.c_nationkey == F.col("n_nationkey")).select(
            _id("RTL-", "c_custkey").alias("retailer_id"),
            F.col("c_name").alias("retailer_name"),
            F.col("c_mktsegment").alias("retail_segment"),
            channel_of("c_custkey").alias("channel"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("state"),
            F.element_at(F.array(*[F.lit(d) for d in (15, 30, 45, 60, 90)]),
                         (k % 5 + 1).cast("int")).alias("credit_terms_days"),
            F.date_add(F.lit("1995-01-01").cast("date"), (k * 7 % 2400).cast("int"))
            .alias("account_activation_date"),
            F.when(k % 20 == 0, "INACTIVE").otherwise("ACTIVE").alias("account_status"),
            F.lit("1995-01-01").cast("date").alias("record_effective_date"),
            k.alias("custkey"),
        )

    @cached_property
    def account_changes(self) -> DataFrame:
        """Second delivery: a tenth changes segment, another tenth is resent unchanged."""
        moved = F.col("custkey") % 10 == 0
        return (self.account_feed.where(F.col("custkey") % 10 <= 1)
                .withColumn("retail_segment", F.when(moved, "KEY-ACCOUNT").otherwise(F.col("retail_segment")))
                .withColumn("record_effective_date", F.lit("1999-01-01").cast("date")))

    @cached_property
    def accounts(self) -> DataFrame:
        """Current slice of the accounts."""
        moved = F.col("custkey") % 10 == 0
        return self.account_feed.withColumn(
            "retail_segment", F.when(moved, "KEY-ACCOUNT").otherwise(F.col("retail_segment")))

    @cached_property
    def account_history(self) -> DataFrame:
        """Every account version with its half-open validity."""
        moved = F.col("custkey") % 10 == 0
        turn = F.lit("1999-01-01").cast("date")
        first = F.struct(F.col("retail_segment"), F.lit("1995-01-01").cast("date").alias("valid_from"),
                         F.when(moved, turn).alias("valid_to"), (~moved).alias("is_current"))
        second = F.struct(F.lit("KEY-ACCOUNT").alias("retail_segment"), turn.alias("valid_from"),
                          F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
        versions = F.when(moved, F.array(first, second)).otherwise(F.array(first))
        return (self.account_feed.withColumn("_v", F.explode(versions))
                .select("retailer_id", "retailer_name", "channel", "region", "account_status",
                        "_v.retail_segment", "_v.valid_from", "_v.valid_to", "_v.is_current"))

    @cached_property
    def cost_history(self) -> DataFrame:
        """Product cost versions: a yearly step, closed at the next January."""
        p = self.products.select("sku_id", "standard_cost_per_unit")
        years = F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("y")
        step = (F.lit(100) + F.col("y") - 1995).cast("decimal(4,0)") * F.lit("0.01").cast("decimal(3,2)")
        return p.select("sku_id", "standard_cost_per_unit", years).select(
            "sku_id",
            (F.col("standard_cost_per_unit") * step).cast(MONEY).alias("version_cost"),
            F.make_date("y", F.lit(1), F.lit(1)).alias("valid_from"),
            F.when(F.col("y") < 2001, F.make_date(F.col("y") + 1, F.lit(1), F.lit(1))).alias("valid_to"),
        )

    @cached_property
    def warehouses(self) -> DataFrame:
        s = self.table("supplier")
        k = F.col("s_suppkey")
        return s.join(self.regions, s.s_nationkey == F.col("n_nationkey")).select(
            _id("WH-", "s_suppkey").alias("warehouse_id"), F.col("s_name").alias("warehouse_name"),
            F.col("r_name").alias("region"), F.col("n_name").alias("state"),
            F.when(k % 3 == 0, "Distribution Center").when(k % 3 == 1, "Production Facility")
            .otherwise("Cold Storage").alias("warehouse_type"),
            (F.lit(1000) + k * 37 % 9000).cast("int").alias("capacity_units"))

    # --- transactions ----------------------------------------------------
    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with their header: the widest join of the mapping."""
        l, o = self.table("lineitem"), self.table("orders")
        return l.join(o, l.l_orderkey == o.o_orderkey)

    @cached_property
    def region_lines(self) -> DataFrame:
        """Order lines with their header and the buyer's region. The region is joined to the
        orders, by key, so the lines move once and no text is made to join on."""
        l, o, c = self.table("lineitem"), self.table("orders"), self.table("customer")
        buyers = c.join(self.regions, c.c_nationkey == F.col("n_nationkey")).select("c_custkey", F.col("r_name").alias("region"))
        return l.join(o.join(buyers, o.o_custkey == F.col("c_custkey")).drop("c_custkey"), l.l_orderkey == F.col("o_orderkey"))

    @cached_property
    def sale_lines(self) -> DataFrame:
        return self._sold(self.lines)

    def _sold(self, lines: DataFrame) -> DataFrame:
        p = self.table("part").select("p_partkey", F.col("p_retailprice").cast(MONEY).alias("unit_price"))
        return lines.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
            _id("TXN-", "l_orderkey").alias("transaction_id"),
            F.col("l_linenumber").alias("line_no"),
            _id("SKU-", "l_partkey").alias("sku_id"),
            _id("RTL-", "o_custkey").alias("retailer_id"),
            _id("WH-", "l_suppkey").alias("warehouse_id"),
            F.col("l_quantity").cast("int").alias("quantity_sold"),
            "unit_price",
            F.col("o_orderdate").cast("date").alias("transaction_date"),
            channel_of("o_custkey").alias("channel"),
            (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_pct"),
            *(["region"] if "region" in lines.columns else []),
        )

    @cached_property
    def sales(self) -> DataFrame:
        """Sale lines with the buyer's region."""
        return self._sold(self.region_lines)

    @cached_property
    def returns(self) -> DataFrame:
        reasons = F.array(*[F.lit(r) for r in ("DAMAGED", "EXPIRED", "WRONG_ITEM", "QUALITY", "OTHER", "UNKNOWN")])
        return self.table("lineitem").where("l_returnflag = 'R'").select(
            F.concat_ws("-", F.lit("RET"), "l_orderkey", "l_linenumber").alias("return_id"),
            _id("TXN-", "l_orderkey").alias("transaction_id"),
            _id("SKU-", "l_partkey").alias("sku_id"),
            (F.col("l_linenumber") % 3 + 1).cast("int").alias("quantity_returned"),
            (F.col("l_extendedprice").cast("decimal(14,2)") * F.lit("0.1").cast("decimal(2,1)"))
            .cast("decimal(14,2)").alias("return_amount"),
            F.date_add(F.col("l_shipdate").cast("date"), 10).alias("return_date"),
            F.element_at(reasons, (F.col("l_linenumber") % 6 + 1).cast("int")).alias("return_reason_code"),
        )

    @cached_property
    def shipments(self) -> DataFrame:
        ship = F.col("l_shipdate").cast("date")
        qty = F.col("l_quantity").cast("int")
        full = F.col("l_linestatus") == "F"
        rate = F.lit("3.00").cast("decimal(4,2)") + (F.col("l_suppkey") % 17).cast("decimal(3,0)") * F.lit("0.25").cast("decimal(3,2)")
        return self.region_lines.select(
            _id("RTL-", "o_custkey").alias("retailer_id"),
            F.concat_ws("-", F.lit("SHP"), "l_orderkey", "l_linenumber").alias("shipment_id"),
            _id("ORD-", "l_orderkey").alias("order_id"),
            _id("WH-", "l_suppkey").alias("warehouse_id"),
            _id("RT-", F.col("l_suppkey") % 40).alias("route_id"),
            channel_of("o_custkey").alias("channel"),
            ship.alias("ship_date"),
            F.date_add(ship, 5).alias("promised_delivery_date"),
            F.when(F.col("l_partkey") % 11 != 0,
                   F.date_add(ship, ((F.col("l_partkey") + F.col("l_suppkey")) % 9).cast("int")))
            .alias("actual_delivery_date"),
            qty.alias("cases_delivered"),
            (qty.cast("decimal(8,0)") * rate).cast(MONEY).alias("logistics_cost_usd"),
            full.alias("is_fully_shipped"),
            qty.alias("quantity_ordered"),
            F.when(full, qty).otherwise(qty - 1).alias("quantity_shipped"),
            F.when(F.col("l_orderkey") % 50 != 0, _id("B-", F.col("l_orderkey") % 2000)).alias("batch_id"),
            "region",
        )

    @cached_property
    def stock(self) -> DataFrame:
        """One count per (sku, warehouse, day with movement)."""
        moved = self.lines.groupBy(
            "l_partkey", "l_suppkey", F.col("o_orderdate").cast("date").alias("snapshot_date")).agg(F.lit(1).alias("_one"))
        p, s = F.col("l_partkey"), F.col("l_suppkey")
        days = F.datediff("snapshot_date", F.lit("1995-01-01").cast("date"))
        raw = moved.select(
            _id("SKU-", "l_partkey").alias("sku_id"), _id("WH-", "l_suppkey").alias("warehouse_id"),
            "snapshot_date",
            ((p * 31 + s * 17 + days * 7) % 500).cast("int").alias("units_on_hand"),
            ((p + s * 3 + days) % 100).cast("int").alias("units_in_transit"),
            ((p + days) % 20).cast("int").alias("units_reserved"),
            (F.lit(50) + (p + s) % 200).cast("int").alias("reorder_point_units"))
        cost = self.products.select("sku_id", "standard_cost_per_unit")
        return raw.join(cost, "sku_id").select(
            *raw.columns, "standard_cost_per_unit",
            (F.col("units_on_hand") * F.col("standard_cost_per_unit")).cast("decimal(14,2)").alias("inventory_value"))

    # --- production ------------------------------------------------------
    @cached_property
    def plant_events(self) -> DataFrame:
        """Sensor-style event stream with five consecutive events per batch."""
        kind = F.col("event_type")
        types = (F.when(kind == "signup", "BATCH_START").when(kind == "purchase", "BATCH_END")
                 .when(kind == "view", "QC_CHECK").when(kind == "error", "DOWNTIME_UNPLANNED")
                 .otherwise("DOWNTIME_PLANNED"))
        e = F.col("event_id")
        ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
        down = kind.isin("error", "click")
        batch_no = F.floor(e / 5)
        return self.table("events").select(
            _id("EV-", "event_id").alias("event_id"),
            F.when(~down, _id("B-", batch_no)).alias("batch_id"),
            _id("LINE-", F.col("user_id") % 6).alias("production_line_id"),
            types.alias("event_type"),
            ts.alias("event_timestamp"),
            F.when(~down, _id("SKU-", batch_no % 200)).alias("sku_id"),
            F.when(kind.isin("signup", "purchase"), (F.lit(100) + batch_no % 50)).cast("int").alias("expected_output_cases"),
            F.when(kind == "purchase", F.floor((F.lit(100) + batch_no % 50) * (80 + e % 25) / 100))
            .cast("int").alias("actual_output_cases"),
            F.when(kind == "view", F.when(e % 10 == 0, "FAIL").otherwise("PASS"))
            .when(kind == "purchase", "PENDING").alias("qc_status"),
            F.when(down, ts).alias("downtime_start_ts"),
            F.when(down, ts + F.make_dt_interval(secs=F.floor(F.col("value") * 60).cast("decimal(18,6)"))).alias("downtime_end_ts"),
            e.alias("event_no"),
        )

    # --- conformed and star-schema frames --------------------------------
    @cached_property
    def batches(self) -> DataFrame:
        return conform.conform_batches(self.plant_events)

    @cached_property
    def prod_events(self) -> DataFrame:
        return conform.conform_events(self.plant_events)

    @cached_property
    def reorder(self) -> DataFrame:
        return conform.reorder_points(self.stock)

    @cached_property
    def spend(self) -> DataFrame:
        """Monthly spend of each account, booked in its activation month."""
        k = F.col("custkey")
        start = F.trunc("account_activation_date", "month")
        feed = self.account_feed.select(
            "retailer_id", "retail_segment", "region",
            (k % 50 * 100).cast("decimal(14,4)").alias("trade_spend_usd"),
            (k % 20 * 50).cast("decimal(14,4)").alias("broker_commission_usd"),
            (k % 10 * 75).cast("decimal(14,4)").alias("field_sales_cost_usd"),
            start.alias("period_start_date"), F.last_day(start).alias("period_end_date"))
        return conform.conform_spend(feed)

    @cached_property
    def customers(self) -> DataFrame:
        return self.account_history.withColumn("surrogate_key", surrogate_key("retailer_id", "valid_from"))

    @cached_property
    def order_days(self) -> DataFrame:
        """Calendar of the years in which orders were placed."""
        return dimensions.calendar_of(self.table("orders").select(
            F.col("o_orderdate").cast("date").alias("d")), "d")

    @cached_property
    def ship_days(self) -> DataFrame:
        return dimensions.calendar_of(self.table("lineitem").select(
            F.col("l_shipdate").cast("date").alias("d")), "d")

    @cached_property
    def event_days(self) -> DataFrame:
        return dimensions.calendar_of(self.table("events").select(F.col("ts").cast("date").alias("d")), "d")

    @cached_property
    def fact_sales(self) -> DataFrame:
        keyed = self.sale_lines.withColumn("transaction_key", surrogate_key("transaction_id", "line_no", "sku_id"))
        return facts.compute_fact_sales(keyed, self.products, self.customers, self.order_days)

    @cached_property
    def fact_inventory(self) -> DataFrame:
        return facts.compute_fact_inventory_snapshot(
            conform.compute_days_of_supply(self.stock), self.reorder, self.order_days)

    @cached_property
    def fact_batch(self) -> DataFrame:
        """Batch fact; stoppages reach their batch by time overlap."""
        hit = facts.attribute_downtime(self.batches, self.prod_events)
        return facts.compute_fact_production_batch(self.batches, facts.booked_hours(hit), self.event_days)

    @cached_property
    def fact_shipment(self) -> DataFrame:
        flagged = conform.compute_on_time_flag(self.shipments).withColumn(
            "shipment_key", surrogate_key("shipment_id"))
        return facts.compute_fact_shipment(flagged, self.customers, self.ship_days)

    @cached_property
    def kc_revenue(self) -> DataFrame:
        return kpi_core.compute_kpi_daily_revenue(self.fact_sales, self.products, self.customers)

    @cached_property
    def kc_fulfillment(self) -> DataFrame:
        return kpi_core.compute_kpi_fulfillment_rate(self.fact_shipment, self.customers)

    @cached_property
    def kc_turnover(self) -> DataFrame:
        return kpi_core.compute_kpi_inventory_turnover(self.fact_inventory, self.fact_sales)

    @cached_property
    def kc_yield(self) -> DataFrame:
        return kpi_core.compute_kpi_production_yield(self.fact_batch)

    # --- specification KPIs ----------------------------------------------
    @cached_property
    def kpi_s01(self) -> DataFrame:
        return kpi_sales.daily_revenue(self.sales, self.returns, self.products)

    @cached_property
    def kpi_s02(self) -> DataFrame:
        return kpi_sales.period_comparison(self.kpi_s01, AS_OF)

    @cached_property
    def kpi_s04(self) -> DataFrame:
        return kpi_sales.weekly_margin(self.sale_lines, self.returns, self.products, AS_OF)

    @cached_property
    def kpi_i01(self) -> DataFrame:
        return kpi_stock.stock_levels(self.stock, self.reorder, self.products, AS_OF)

    @cached_property
    def kpi_i02(self) -> DataFrame:
        return kpi_stock.turnover_30d(self.sale_lines, self.stock, self.products, AS_OF)

    @cached_property
    def kpi_i03(self) -> DataFrame:
        return kpi_stock.days_sales_of_inventory(self.sale_lines, self.stock, AS_OF)

    @cached_property
    def kpi_p01(self) -> DataFrame:
        return kpi_production.batch_yield(self.batches, self.products)

    @cached_property
    def kpi_p02(self) -> DataFrame:
        return kpi_production.quality_rate(self.batches, self.products)

    @cached_property
    def kpi_p03(self) -> DataFrame:
        return kpi_production.unplanned_downtime(self.prod_events)

    @cached_property
    def kpi_p04(self) -> DataFrame:
        return kpi_production.traceability(self.batches, self.shipments, self.accounts, EVENTS_NOW)

    @cached_property
    def kpi_d01(self) -> DataFrame:
        return kpi_delivery.on_time_delivery(self.shipments)

    @cached_property
    def kpi_d02(self) -> DataFrame:
        return kpi_delivery.order_fulfillment(self.shipments)

    @cached_property
    def kpi_d03(self) -> DataFrame:
        return kpi_delivery.cost_per_case(self.shipments)

    @cached_property
    def kpi_d04(self) -> DataFrame:
        return kpi_delivery.worst_routes(self.shipments)

    @cached_property
    def kpi_c01(self) -> DataFrame:
        return kpi_accounts.top_retailers(self.sale_lines, self.returns, self.accounts, AS_OF)

    @cached_property
    def kpi_c02(self) -> DataFrame:
        return kpi_accounts.acquisition_cost(self.accounts, self.spend, AS_OF)

    @cached_property
    def kpi_c03(self) -> DataFrame:
        return kpi_accounts.retention(self.sale_lines, self.accounts, AS_OF)

    @cached_property
    def kpi_c04(self) -> DataFrame:
        return kpi_accounts.concentration(self.sale_lines, self.returns, AS_OF)
