"""Stored day sets: codes that stay, months that are rewritten alone, unions equal to direct counts."""

import datetime as dt
import pathlib
import random

from pyspark.sql import functions as F

from shelfline.operators.numbering import number_rows
from shelfline.plans import distinct_states as ds

D = dt.date


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "id string, d date, region string")


def test_sets_roll_up_and_codes_stay(spark, tmp_path):
    rng, root = random.Random(2), str(tmp_path / "s")
    rows = [(f"r{rng.randrange(300)}", D(2025, 1, 1) + dt.timedelta(days=rng.randrange(90)), rng.choice(["e", "w", None])) for _ in range(2000)] + [(None, D(2025, 1, 3), "e")]
    early = [r for r in rows if r[1] < D(2025, 3, 1)]
    ds.write_states(rows_of(spark, early), root, "id", "d", ["region"])
    codes = lambda: {r.id: r.code for r in spark.read.parquet(f"{root}/dictionary").collect()}
    files = lambda: {p for p in pathlib.Path(root).rglob("days/*/*.parquet")}
    before, stored = codes(), files()
    assert sorted(before.values()) == list(range(1, len(before) + 1))
    march = [r for r in rows if r[1] >= D(2025, 3, 1)]
    ds.write_states(rows_of(spark, march), root, "id", "d", ["region"])
    assert before.items() <= codes().items() and len(set(codes().values())) == len(codes()) == len({r[0] for r in rows if r[0]})
    assert stored <= files() and all("2025-03" in str(p) for p in files() - stored)
    late = [r for r in rows if r[1].month == 2] + [("brand-new", D(2025, 2, 28), "w")]  # a month given again, with one more row
    ds.write_states(rows_of(spark, late), root, "id", "d", ["region"])
    rows = rows + late[-1:]
    states = ds.read_states(spark, root)
    want = {}
    for i, d, region in rows:
        if i:
            want.setdefault((d.strftime("%Y-%m"), region), set()).add(i)
    got = {(r.state_month, r.region): r.n for r in ds.distinct_by(states, [ds.MONTH, "region"], "n").collect()}
    assert got == {k: len(v) for k, v in want.items()}
    days = {d for i, d, _ in rows if i}
    trail = {r.report_date: r.n for r in ds.trailing_distinct(states, 7, name="n").collect()}
    assert trail == {d: len({i for i, x, _ in rows if i and d - dt.timedelta(days=6) <= x <= d}) for d in days}


def test_numbers_are_dense_and_in_order(spark):
    df = spark.range(0, 500, 1, 7).select((F.col("id") * 37 % 500).alias("k"))
    got = [(r.k, r.n) for r in number_rows(df, ["k"], "n", 10).orderBy("n").collect()]
    assert got == [(k, k + 10) for k in range(500)]
    assert number_rows(df.limit(0), ["k"], "n").count() == 0
