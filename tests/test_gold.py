import datetime as dt
from decimal import Decimal as D

import pytest

from shelfline.functions import surrogate_key
from shelfline.plans import dimensions, facts, kpi_core, kpi_delivery
from shelfline.operators import ranking

day = dt.date


@pytest.fixture(scope="module")
def calendar(spark):
    return dimensions.generate_date_dimension(spark, 2025, 2025).cache()


def test_calendar(calendar):
    assert calendar.count() == 365
    rows = {r.full_date: r for r in calendar.collect()}
    assert rows[day(2025, 1, 1)].date_key == 20250101 and rows[day(2025, 1, 1)].is_holiday
    assert rows[day(2025, 1, 4)].is_weekend and not rows[day(2025, 1, 6)].is_weekend
    assert rows[day(2025, 1, 5)].day_of_week == 1 and rows[day(2025, 1, 5)].iso_day_of_week == 7
    first = rows[day(2025, 10, 1)]
    assert (first.fiscal_quarter, first.fiscal_year, first.fiscal_period) == ("FQ1", 2026, "2026-FQ1")
    assert rows[day(2025, 2, 28)].is_month_end and not rows[day(2025, 2, 28)].is_quarter_end


def test_calendar_fiscal_start_is_a_parameter(spark):
    row = dimensions.generate_date_dimension(spark, 2025, 2025, fiscal_start_month=1).where("full_date = '2025-04-01'").first()
    assert (row.fiscal_year, row.fiscal_quarter) == (2025, "FQ2")


@pytest.fixture(scope="module")
def star(spark, calendar):
    products = spark.createDataFrame([("s1", "Juice", D("1.50"))], "sku_id string, product_category string, standard_cost_per_unit decimal(10,2)")
    customers = spark.createDataFrame([("r1", 7, "West", "Retail", True), ("r1", 8, "East", "Retail", False)],
                                      "retailer_id string, surrogate_key bigint, region string, channel string, is_current boolean")
    txn = spark.createDataFrame([(1, "t1", "r1", "s1", "w1", 10, D("3.50"), day(2025, 3, 1)), (2, "t2", "r2", "s9", "w1", 2, D("5.00"), day(2024, 3, 1))],
                                "transaction_key bigint, transaction_id string, retailer_id string, sku_id string, warehouse_id string, "
                                "quantity_sold int, unit_price decimal(10,2), transaction_date date")
    return products, customers, facts.compute_fact_sales(txn, products, customers, calendar)


def test_fact_sales(star):
    rows = {r.transaction_key: r for r in star[2].collect()}
    a, b = rows[1], rows[2]
    assert (a.net_revenue, a.cogs, a.gross_margin_amount, a.return_amount) == (D("35.00"), D("15.00"), D("20.00"), D("0.00"))
    assert (a.date_key, a.customer_key) == (20250301, 7)
    assert (b.cogs, b.date_key, b.customer_key, b.product_key) == (D("0.00"), None, None, None)


def test_daily_revenue_kpi(star):
    products, customers, fact = star
    rows = {r.report_date: r for r in kpi_core.compute_kpi_daily_revenue(fact, products, customers).collect()}
    a = rows[day(2025, 3, 1)]
    assert (a.product_category, a.region, a.total_revenue, a.gross_margin_pct, a.transaction_count) == ("Juice", "West", D("35.00"), D("57.14"), 1)
    assert rows[day(2024, 3, 1)].region is None


def test_inventory_alert(spark, calendar):
    stock = spark.createDataFrame([("s1", "w1", 300, D("1"), D("2"), day(2025, 1, 1)), ("s2", "w1", 5000, D("1"), D("2"), day(2025, 1, 1))],
                                  "sku_id string, warehouse_id string, units_on_hand int, inventory_value decimal(14,2), dsi_days decimal(8,1), snapshot_date date")
    rop = spark.createDataFrame([("s1", "w1", 400), ("s2", "w1", 600)], "sku_id string, warehouse_id string, reorder_point_units int")
    out = facts.compute_fact_inventory_snapshot(stock, rop, calendar).collect()
    assert {r.sku_id: r.reorder_alert_flag for r in out} == {"s1": True, "s2": False}


def test_batch_downtime_is_summed(spark, calendar):
    batches = spark.createDataFrame([(1, "b1", "L", "s", 10, 9, D("90.00"), True, "PASS", day(2025, 1, 1)), (2, "b2", "L", "s", 10, 9, D("90.00"), True, "PASS", day(2025, 1, 1))],
                                    "batch_key bigint, batch_id string, production_line_id string, sku_id string, expected_output_cases int, actual_output_cases int, "
                                    "yield_rate_pct decimal(5,2), qc_pass_flag boolean, qc_status string, batch_date date")
    events = spark.createDataFrame([("b1", "DOWNTIME_UNPLANNED", D("2.50")), ("b1", "DOWNTIME_PLANNED", D("1.00")), ("b1", "QC_CHECK", D("9.00"))],
                                   "batch_id string, event_type string, downtime_hours decimal(6,2)")
    out = facts.compute_fact_production_batch(batches, events, calendar).collect()
    assert {r.batch_id: r.downtime_hours for r in out} == {"b1": D("3.50"), "b2": D("0.00")}


def test_production_kpi(spark):
    d = day(2025, 1, 1)
    fact = spark.createDataFrame([(d, "A", D("96.50"), True, D("1.00"), 100, 96), (d, "A", D("95.00"), True, D("0.50"), 100, 95), (d, "B", D("80.00"), False, D("0.00"), 10, 8)],
                                 "batch_date date, production_line_id string, yield_rate_pct decimal(5,2), qc_pass_flag boolean, downtime_hours decimal(8,2), "
                                 "expected_output_units int, actual_output_units int")
    a = {r.production_line_id: r for r in kpi_core.compute_kpi_production_yield(fact).collect()}["A"]
    assert (a.avg_yield_rate_pct, a.qc_pass_rate_pct, a.total_downtime_hours, a.overall_yield_pct) == (D("95.75"), D("100.00"), D("1.50"), D("95.50"))


def test_fulfillment_counts_undelivered(spark):
    d = day(2025, 1, 1)
    ship = spark.createDataFrame([(7, d, True, True, 5, D("1.00")), (7, d, False, True, 5, D("2.00")), (7, d, False, False, 5, D("4.00"))],
                                 "customer_key bigint, ship_date date, on_time_flag boolean, is_fully_shipped boolean, cases_delivered int, logistics_cost_usd decimal(10,2)")
    customers = spark.createDataFrame([(7, "West", "Retail", True)], "surrogate_key bigint, region string, channel string, is_current boolean")
    r = kpi_core.compute_kpi_fulfillment_rate(ship, customers).first()
    assert (r.on_time_delivery_pct, r.fulfillment_rate_pct, r.avg_logistics_cost_per_shipment) == (D("33.33"), D("66.67"), D("2.33"))


def test_delivery_rates(spark):
    d = day(2025, 1, 6)
    ship = spark.createDataFrame([("a", "o1", d, day(2025, 1, 8), day(2025, 1, 7), True), ("b", "o1", d, day(2025, 1, 8), day(2025, 1, 9), False), ("c", "o2", d, day(2025, 1, 8), None, True)],
                                 "shipment_id string, order_id string, ship_date date, promised_delivery_date date, actual_delivery_date date, is_fully_shipped boolean")
    from pyspark.sql import functions as F
    ship = ship.withColumns({"channel": F.lit("Retail"), "region": F.lit("West")})
    assert kpi_delivery.on_time_delivery(ship).first().otd_pct == D("50.00")
    assert kpi_delivery.order_fulfillment(ship).first().fulfillment_rate_pct == D("50.00")


def test_turnover_by_warehouse(spark):
    inv = spark.createDataFrame([(1, day(2025, 1, 1), D("100.00"), 5), (1, day(2025, 1, 2), D("300.00"), 5), (2, day(2025, 1, 2), D("0.00"), 0)],
                                "warehouse_key bigint, snapshot_date date, inventory_value decimal(14,2), units_on_hand int")
    sold = spark.createDataFrame([(1, day(2025, 1, 9), D("50.00"))], "warehouse_key bigint, transaction_date date, cogs decimal(14,2)")
    rows = {r.warehouse_key: r for r in kpi_core.compute_kpi_inventory_turnover(inv, sold).collect()}
    assert (rows[1].avg_inventory_value, rows[1].inventory_turnover_rate, rows[1].days_inventory_outstanding) == (D("200.00"), D("0.25"), D("1460.0"))
    assert rows[2].inventory_turnover_rate is None


def test_returns_do_not_multiply(spark):
    sales = spark.createDataFrame([("t", "s", 1, D("10.00")), ("t", "s", 2, D("10.00"))], "transaction_id string, sku_id string, quantity_sold int, unit_price decimal(10,2)")
    back = spark.createDataFrame([("t", "s", D("4.00")), ("t", "s", D("1.00")), ("x", "s", D("9.00"))], "transaction_id string, sku_id string, return_amount decimal(14,2)")
    r = facts.net_sale_lines(sales, back, []).collect()
    assert len(r) == 1 and (r[0].gross_sales_amount, r[0].return_amount, r[0].net_revenue) == (D("30.0000"), D("5.0000"), D("25.0000"))


def test_streak_resets_after_a_gap(spark):
    weeks = [day(2025, 1, 6) + dt.timedelta(days=7 * i) for i in (0, 1, 3, 4, 5)]
    df = spark.createDataFrame([("r", w) for w in weeks], "route string, week date")
    assert [r.n for r in ranking.with_streak(df, ["route"], "week", "n").orderBy("week").collect()] == [1, 2, 1, 2, 3]


def test_trailing_counts_days_not_rows(spark):
    df = spark.createDataFrame([("a", day(2025, 1, 1), 1), ("a", day(2025, 1, 7), 2), ("a", day(2025, 1, 8), 4)], "g string, d date, n int")
    assert [r.t for r in ranking.trailing(df, ["g"], "d", 7, {"t": "n"}).orderBy("d").collect()] == [1, 3, 6]


def test_rank_within_population(spark):
    pop = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", None)], "k string, m int")
    got = {r.k: r.r for r in ranking.rank_within(pop.where("k <> 'b'"), pop, "k", "m", "r").collect()}
    assert got == {"a": 2, "c": 3, "d": None}


def test_keys_tell_null_from_empty(spark):
    df = spark.createDataFrame([(None, "b"), ("", "b"), ("a", "b")], "x string, y string")
    assert df.select(surrogate_key("x", "y").alias("k")).distinct().count() == 3


def test_windows_end_at_as_of(spark):
    """Rows after ``as_of`` change nothing."""
    from shelfline.plans import kpi_stock, reports

    def stock_of(days):
        return spark.createDataFrame([("s", "w", day(2025, 1, d), 100, D("50.00")) for d in days],
                                     "sku_id string, warehouse_id string, snapshot_date date, units_on_hand int, inventory_value decimal(14,2)")

    def sales_of(days):
        return spark.createDataFrame([("s", day(2025, 1, d), 3) for d in days], "sku_id string, transaction_date date, quantity_sold int")

    products = spark.createDataFrame([("s", D("2.00"))], "sku_id string, standard_cost_per_unit decimal(10,2)")
    for kpi in (lambda days: kpi_stock.turnover_30d(sales_of(days), stock_of(days), products, "2025-01-20"),
                lambda days: kpi_stock.days_sales_of_inventory(sales_of(days), stock_of(days), "2025-01-20")):
        assert list(map(str, kpi(range(1, 21)).collect())) == list(map(str, kpi(range(1, 32)).collect()))
    fact = spark.createDataFrame([(day(2025, 1, d), 1, 1, 0, 5, D("1.00"), D("1.0"), d % 2 == 0) for d in (19, 20, 25)],
                                 "snapshot_date date, warehouse_key bigint, product_key bigint, units_on_hand int, reorder_point_units int, "
                                 "inventory_value decimal(14,2), dsi_days decimal(8,1), reorder_alert_flag boolean")
    assert [r.snapshot_date for r in reports.reorder_status(fact, "2025-01-20").collect()] == [day(2025, 1, 20)]
    assert [r.snapshot_date for r in kpi_stock.reorder_alerts(fact, "2025-01-22").collect()] == [day(2025, 1, 20)]


def test_calendar_follows_the_data_and_region_codes_differ(spark):
    dates = spark.createDataFrame([(day(2019, 5, 1),), (day(2021, 2, 3),), (None,)], "d date")
    late = spark.createDataFrame([(day(2022, 7, 1),)], "d date")
    span = dimensions.calendar_over([(dates, "d"), (late, "d"), (late.limit(0), "d")])
    assert span.count() == 365 + 366 + 365 + 365
    regions = spark.createDataFrame([(r, "x") for r in ("Northeast", "Southeast", "Midwest", "Southwest", "West", "ASIA")], "region string, state string")
    assert sorted(r.region_id for r in dimensions.region_dimension(regions).collect()) == ["ASIA", "MW", "NE", "SE", "SW", "W"]
