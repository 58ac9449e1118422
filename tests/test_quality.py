import pytest
from pyspark.sql import functions as F

from shelfline import contracts as c
from shelfline import rules
from shelfline.operators import quality as q
from shelfline.operators.dedup import mark_repeats

SCHEMA = "id string, sku string, price decimal(10,2), qty int"


@pytest.fixture()
def lines(spark):
    return spark.createDataFrame([
        ("t1", "s1", None, 1), ("t2", None, None, 2), (None, "s3", None, 3), ("t4", "s4", None, 4)], SCHEMA).withColumn(
        "price", F.col("qty").cast("decimal(10,2)"))


def test_not_null_removes_and_tags(lines):
    clean, bad, n = q.check_not_null(lines, ["id", "sku"])
    assert (clean.count(), bad.count(), n) == (2, 2, 2)
    assert {r[q.REASON] for r in bad.collect()} == {"null_in_columns:id,sku"}


def test_not_null_warning_keeps_rows(lines):
    clean, bad, n = q.check_not_null(lines, ["id"], severity="warning")
    assert (clean.count(), bad.count(), n) == (4, 0, 1)
    assert "_dq_null_flag" in clean.columns


def test_unique_keeps_first_by_order(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    clean, bad, n = q.check_unique(df, ["k"], order=[F.col("v").desc()])
    assert n == 2 and sorted(r.v for r in clean.collect()) == [2, 3, 5] and sorted(r.v for r in bad.collect()) == [1, 4]


def test_unique_warning_flags(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    clean, _, n = q.check_unique(df, ["k"], severity="warning")
    assert n == 1 and clean.where("_dq_dup_flag").count() == 1


def test_range_fails_null_and_bounds(spark):
    df = spark.createDataFrame([(-1,), (0,), (50,), (None,)], "x int")
    clean, bad, n = q.check_range(df, "x", min_val=0, severity="error")
    assert (clean.count(), n) == (2, 2)
    assert bad.first()[q.REASON] == "out_of_range:x[0,None]"
    flagged, _, _ = q.check_range(df, "x", max_val=10)
    assert flagged.where("_dq_range_x").count() == 2


def test_referential_null_passes(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    ref = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    for reference in (ref, ["a", "b"]):
        clean, bad, n = q.check_referential_integrity(df, "k", reference, severity="error")
        assert (clean.count(), bad.count(), n) == (2, 1, 1)


def test_custom_unknown_passes(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "x int")
    clean, bad, n = q.check_custom(df, "x > 5", "big", severity="error")
    assert (clean.count(), bad.count(), n) == (2, 1, 1)


def test_rule_list_is_sequential(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", -5), (None, 7)], "k string, v int")
    result = q.run_quality_checks(df, [
        {"type": "not_null", "columns": ["k"], "severity": "error"},
        {"type": "range", "column": "v", "min_val": 0, "severity": "error"},
        {"type": "unique", "columns": ["k"], "severity": "error"},
        {"type": "nonsense", "severity": "error"},
        {"type": "custom", "condition_expr": "v = 1", "flag_col": "is_one", "severity": "warning"},
    ], fail_rate_pct=100)
    assert [r["failed_count"] for r in result["report"]] == [1, 2, 1, 0, 1]
    assert [r["status"] for r in result["report"]] == ["applied"] * 3 + ["skipped", "applied"]
    assert result["clean_df"].count() + result["quarantine_df"].count() == 5


def test_halt_is_strict(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), (1,)], "x int")
    rule = [{"type": "not_null", "columns": ["x"], "severity": "error"}]
    with pytest.raises(ValueError, match="DQ halt"):
        q.run_quality_checks(df, rule, fail_rate_pct=50)
    q.run_quality_checks(df, rule, fail_rate_pct=75)


def test_quarantine_is_written_before_halt(spark, tmp_path):
    df = spark.createDataFrame([(None,), (1,)], "x int")
    path = str(tmp_path / "rejects")
    with pytest.raises(ValueError):
        q.run_quality_checks(df, [{"type": "not_null", "columns": ["x"], "severity": "error"}], quarantine_table=path)
    assert spark.read.parquet(path).count() == 1


def test_repeats_of_a_hot_key_with_exact_copies(spark):
    hot = spark.range(0, 3000, 1, 6).select(F.lit("hot").alias("k"), (F.col("id") % 3).cast("int").alias("v"))
    rest = spark.range(0, 50, 1, 3).select(F.concat(F.lit("k"), F.col("id") % 20).alias("k"), F.col("id").cast("int").alias("v"))
    marked = mark_repeats(hot.unionByName(rest), ["k"])
    firsts = {r.k: r.v for r in marked.where("NOT _repeat").collect()}
    assert marked.count() == 3050
    assert marked.where("NOT _repeat").count() == 21
    assert firsts["hot"] == 0 and firsts["k7"] == 7


def test_ineligible_rows_do_not_compete(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3)], "k string, v int")
    out = {r.v: r._repeat for r in mark_repeats(df, ["k"], eligible=F.col("v") > 1).collect()}
    assert out == {1: False, 2: False, 3: True}


def test_contract_compiles_conditions(spark):
    row = ("e1", "b1", "L1", "DOWNTIME_UNPLANNED", "2024-01-01T00:00:00", None)
    df = spark.createDataFrame([row, (*row[:3], "QC_CHECK", *row[4:]), (*row[:3], "OTHER", *row[4:])],
                               "event_id string, batch_id string, production_line_id string, event_type string, "
                               "event_timestamp string, downtime_start_ts string")
    fields = tuple(f for f in c.CONTRACTS["iot_sensor_events"] if f.name in df.columns)
    compiled = c.contract_rules(fields)
    bad = q.rejected_rows(q.tag(df, compiled), compiled).collect()
    assert {r.event_type for r in bad} == {"DOWNTIME_UNPLANNED", "OTHER"}


def test_catalog_resolves_time_and_references(spark):
    df = spark.createDataFrame([("r1", "2024-01-01"), ("r9", "2024-01-01")], "retailer_id string, transaction_date string")
    ref = spark.createDataFrame([("r1",)], "retailer_id string")
    got = rules.rules_for("sales_transactions", df.columns, "2024-01-02 00:00:00", {"customers": ref})
    assert [r.rule_id for r in got] == ["SLV-SALES-TXN-005", "SLV-SALES-TXN-008", "SLV-SALES-TXN-010"]
    assert q.clean_rows(q.tag(df, got)).count() == 1


def test_reject_log_carries_the_row(spark):
    df = spark.createDataFrame([("a", None)], "k string, v int")
    log = q.reject_log(q.tag(df, [q.not_null(["v"], rule_id="R1")]), [q.not_null(["v"], rule_id="R1")],
                       "raw", "target", "b", "run", "2024-01-01 00:00:00").first()
    assert log.rule_id == "R1" and log.raw_record_json == '{"k":"a","v":null}' and log.rule_type == "NOT_NULL"


def test_quotes_and_backslashes_in_rules(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",), ("7",), ("x",)], "v string")
    assert q.clean_rows(q.tag(df, [q.one_of("v", ["it's", "a\\b"])])).count() == 2
    assert q.clean_rows(q.tag(df, [q.matches("v", r"^\d$|'")])).count() == 2


def test_skipped_rules_are_named(spark):
    got = rules.skipped_rules("sales_transactions", ["retailer_id", "transaction_date"])
    assert "missing_reference:customers" in got.values() and any(v.startswith("missing_column:") for v in got.values())
    applied = rules.rules_for("sales_transactions", ["retailer_id", "transaction_date"], "2024-01-02 00:00:00")
    assert len(applied) + len(got) == len(rules.CATALOG["sales_transactions"])
