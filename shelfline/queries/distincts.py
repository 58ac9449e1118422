"""Distinct receipts by month, region and trailing days, from stored day sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.plans import distinct_states as ds
from shelfline.queries.frames import Frames
from shelfline.queries.registry import query
from shelfline.session import work_dir


def _states(f: Frames) -> DataFrame:
    """Day sets of all receipts; the last two months arrive in a second run."""
    root = work_dir(f.spark, "receipt-sets")
    late = F.col("transaction_date") >= F.lit("1996-01-01").cast("date")
    for part in (~late, late):
        ds.write_states(f.sales.where(part), root, "transaction_id", "transaction_date", ["region"])
    return ds.read_states(f.spark, root)


@query("agg_02_distinct_from_states", """
SELECT strftime(transaction_date, '%Y-%m') AS state_month, region, count(DISTINCT transaction_id) AS receipts FROM sales GROUP BY 1, 2""")
def distinct_month_region(f: Frames):
    return ds.distinct_by(_states(f), [ds.MONTH, "region"], "receipts")


@query("agg_13_distinct_rollup", """
SELECT state_month, region, count(DISTINCT transaction_id) AS receipts
FROM (SELECT *, strftime(transaction_date, '%Y-%m') AS state_month FROM sales) GROUP BY GROUPING SETS ((state_month), (region), ())""")
def distinct_rollup(f: Frames):
    states = _states(f)
    none = F.lit(None).cast("string")
    total = ds.distinct_by(states.withColumn("all", F.lit(1)), ["all"], "receipts")
    return (ds.distinct_by(states, [ds.MONTH], "receipts").withColumn("region", none)
            .unionByName(ds.distinct_by(states, ["region"], "receipts").withColumn(ds.MONTH, none))
            .unionByName(total.drop("all").withColumns({ds.MONTH: none, "region": none})))


@query("win_10_trailing_distinct", """
SELECT d.report_date, count(DISTINCT transaction_id) AS receipts FROM (SELECT DISTINCT transaction_date AS report_date FROM sales) d
JOIN sales s ON s.transaction_date BETWEEN d.report_date - 29 AND d.report_date GROUP BY 1""")
def trailing_distinct(f: Frames):
    return ds.trailing_distinct(_states(f), 30, name="receipts")
