"""Interleaved layout: footers prune for every column of the curve, not only for the first."""

import datetime as dt
import pathlib

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from shelfline.sources import sinks


def opened(path, column, low, high):
    """Row groups whose footer range meets the filter, and all row groups."""
    hit = total = 0
    for file in pathlib.Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = next(s for k in range(meta.num_columns) if (c := meta.row_group(g).column(k)).path_in_schema == column and (s := c.statistics))
            total += 1
            hit += stats.min <= high and low <= stats.max
    return hit, total


def test_every_column_prunes(spark, tmp_path):
    n = F.col("id")
    rows = spark.range(0, 40_000, 1, 4).select(
        F.concat(F.lit("S"), F.lpad((n * 7919 % 1000).cast("string"), 4, "0")).alias("sku"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n * 104729 % 730).cast("int")).alias("day"),
        F.when(n % 97 != 0, (n * 15485863 % 5000).cast("int")).alias("units"))
    sinks.write_clustered(rows, str(tmp_path / "linear"), ["sku", "day", "units"], 32)
    sinks.write_interleaved(rows, str(tmp_path / "curve"), ["sku", "day", "units"], files=32)
    back = spark.read.parquet(str(tmp_path / "curve"))
    assert back.exceptAll(rows).count() == 0 and back.count() == 40_000
    wanted = {"sku": ("S0100", "S0120"), "day": (dt.date(2024, 3, 1), dt.date(2024, 3, 20)), "units": (100, 200)}
    for column, (low, high) in wanted.items():
        curve, total = opened(tmp_path / "curve", column, low, high)
        assert curve <= total * 0.6, (column, curve, total)
        if column != "sku":
            assert curve < opened(tmp_path / "linear", column, low, high)[0] * 0.6


def test_ranges_count_the_cuts_below_in_generated_code(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, None, 1.0), (1, 2.0, nan), (2, 2.5, None), (3, 9.0, 0.0), (4, nan, 7.0)], "id int, _o0 double, _o1 double")
    ranged = sinks._ranges(df, [[2.0, 1.0, 2.0, 5.0, nan], None], 3)
    assert [(r._r0, r._r1) for r in ranged.orderBy("id").collect()] == [(0, 0), (1, 0), (2, 0), (3, 0), (3, 0)]
    # A loop over the cuts, as filter() plans it, is interpreted row by row.
    assert "lambda" not in ranged._jdf.queryExecution().executedPlan().toString()
