"""Uniqueness by semi-join reduction: unique rows pass unranked, hot keys are ranked in two steps, no row is lost."""

import re

from pyspark.sql import functions as F

from shelfline.operators import dedup
from shelfline.operators import quality as q
from shelfline.operators.dedup import mark_repeats


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_window_over_unique_rows(spark):
    df = spark.range(0, 9000, 1, 5).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id")
    marked = mark_repeats(df, ["k"])
    alone, ranked = re.split(r"\n(?= {0,6}[+:]- \*?\(?\d*\)? ?Project)", physical(marked).split("Union", 1)[1], maxsplit=2)[-2:]
    assert "LeftAnti" in alone and "Window" not in alone and "Exchange hashpartitioning" not in alone
    assert ranked.count("Window ") == 2 and ranked.rindex("LeftSemi") > ranked.rindex("Window ")
    out = marked.groupBy("_repeat").count().collect()
    assert {r["_repeat"]: r["count"] for r in out} == {False: 6001, True: 2999}
    assert marked.where("k = 'hot' AND NOT _repeat").first().id == 0


def test_clean_and_rejected_make_the_input(spark):
    rows = [(i % 40 if i % 3 else 1, i % 7, None if i % 11 == 0 else f"v{i % 5}") for i in range(600)]
    df = spark.createDataFrame(rows, "a int, b int, c string")
    rules = [q.not_null(["c"]), q.unique(["a", "b"]), q.unique(["a"], severity="warning", flag="_dq_a")]
    tagged = q.tag(df, rules)
    clean, bad = q.clean_rows(tagged), q.rejected_rows(tagged, rules)
    assert clean.count() + bad.count() == 600
    eligible = {(a, b) for a, b, c in rows if c is not None}
    assert {(r.a, r.b) for r in clean.collect()} == eligible and clean.count() == len(eligible)
    assert clean.where("NOT _dq_a").count() == len({a for a, _ in eligible})


def test_null_keys_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 3)], "k string, v int")
    assert {r.v: r._repeat for r in mark_repeats(df, ["k"]).collect()} == {1: False, 2: True, 3: False}
    assert mark_repeats(df.limit(0), ["k"]).count() == 0


def test_hashes_are_not_stored_in_the_rows(spark):
    df = spark.range(0, 100).select((F.col("id") % 60).alias("k"), "id")
    assert "_hash" not in physical(mark_repeats(df, ["k"]))


def test_rows_meet_a_reference_with_one_verdict(spark):
    df = spark.range(0, 100).select("id", (F.col("id") % 7).alias("a"), F.concat(F.lit("v"), "id").alias("b"))
    rules = [q.custom("b LIKE 'v1%'", "odd", "error"), q.referential("a", spark.range(0, 5).select(F.col("id").alias("a")), "error")]
    tagged = q.tag(df, rules)
    joined = tagged.select(q.FAILED)._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter", 1)[1]
    assert q.FAILED in joined.split("Aggregate", 1)[0]
    assert {(r["a"] > 4, r[q.FAILED]) for r in tagged.where("b NOT LIKE 'v1%'").collect()} == {(False, None), (True, 1)}
    assert tagged.where("b LIKE 'v1%' AND _dq_failed <> 0").count() == 0


def test_many_repeated_keys_are_dealt_once(spark, monkeypatch):
    monkeypatch.setattr(dedup, "FEW_KEYS", 20)
    n = F.col("id")
    rows = spark.range(0, 300, 1, 5).select(F.when(n % 10 == 9, None).otherwise(n % 60).alias("k"), (n * 7 % 50).alias("v"), (n % 4 > 0).alias("open"))
    pick = lambda df: {(r.k, r.v, r.open, r._repeat): r["count"] for r in df.groupBy("k", "v", "open", "_repeat").count().collect()}
    once = mark_repeats(rows, ["k"], eligible=F.col("open"))
    plan = physical(once)
    assert plan.count("Window ") == 1 and "LeftSemi" not in plan and "LeftAnti" not in plan
    assert once.columns == [*rows.columns, "_repeat"] and once.count() == 300
    # Hot keys among many leave that window for the two steps.
    monkeypatch.setattr(dedup, "HOT_ROWS", 10)
    both = mark_repeats(rows, ["k"], eligible=F.col("open"))
    assert physical(both).count("Window ") == 3
    monkeypatch.setattr(dedup, "FEW_KEYS", 1_000)
    assert pick(once) == pick(both) == pick(mark_repeats(rows, ["k"], eligible=F.col("open")))
    assert once.where("NOT open AND _repeat").count() == 0
    assert once.where("open AND NOT _repeat").count() == rows.where("open").select("k").distinct().count()
