"""Frames reach the buyer's region by key, and queries that read a frame many times store it once."""

import datetime as dt
import re

from pyspark.sql import functions as F

from shelfline.queries import checks, kpi_store
from shelfline.queries.frames import Frames, SCHEMAS
from shelfline.sources import sinks


def _tables(spark, path):
    at = dt.datetime(2001, 7, 1)
    rows = {
        "region": [(0, "EUROPE"), (1, "ASIA")], "nation": [(0, "FRANCE", 0), (1, "JAPAN", 1)],
        "customer": [(1, "a", 0, 0.0, "X"), (2, "b", 1, 0.0, "X"), (2, "b2", 0, 0.0, "Y"), (None, "n", 0, 0.0, "X"), (4, "far", 9, 0.0, "X")],
        "part": [(1, "p", "b", "t", 1, 9.5), (2, "q", "b", "t", 1, 8.0)],
        "orders": [(1, 1, "O", 1.0, at, "1"), (2, 2, "O", 1.0, at, "1"), (3, None, "O", 1.0, at, "1"), (4, 4, "O", 1.0, at, "1"), (5, 77, "O", 1.0, at, "1")],
        "lineitem": [(o, 1 + (o or 0) % 2, 1, n, 3.0, 10.0, 0.1, 0.0, "R", "F", at) for o in (1, 2, 2, 3, 4, 5, None) for n in (1, 2)]}
    for name, some in rows.items():
        spark.createDataFrame(some, SCHEMAS[name]).write.parquet(f"{path}/{name}.parquet")
    return Frames(spark, str(path))


def test_region_is_joined_by_key(spark, tmp_path):
    f = _tables(spark, tmp_path)
    for found in (f.sales, f.shipments):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search(r"Join.*(retailer_id|RTL-)", plan)
    where = f.accounts.select("retailer_id", "region")
    was = f.sale_lines.join(where, "retailer_id")
    now = f.sales.select(*was.columns)
    assert now.exceptAll(was).count() == was.exceptAll(now).count() == 0
    assert f.shipments.groupBy("retailer_id").agg(F.count("*").alias("n")).collect().__len__() == 2
    assert f.shipments.where("retailer_id = 'RTL-2'").count() == 8  # two orders' lines met by two rows of the customer


def test_kpi_families_read_stored_inputs(spark, sf_dir, monkeypatch):
    seen, write = {}, kpi_store.kpi_tables.write_kpi_tables
    monkeypatch.setattr(kpi_store.kpi_tables, "write_kpi_tables", lambda inputs, *a: seen.update(inputs) or write(inputs, *a))
    assert kpi_store._family(Frames(spark, sf_dir), "distribution").count() > 0
    assert not [p for p in seen["shipments"].inputFiles() if "lineitem" in p]


def test_interleaved_rows_are_computed_once(spark, tmp_path, monkeypatch):
    stored = []
    monkeypatch.setattr(sinks, "settle", lambda df, label: stored.append(label) or df)
    sinks.write_interleaved(spark.range(0, 50), str(tmp_path / "t"), ["id"], files=2)
    assert stored == ["interleaved"] and spark.read.parquet(str(tmp_path / "t")).count() == 50


def test_rule_list_reads_stored_lines(spark, tmp_path):
    f = _tables(spark, tmp_path)
    rows = checks._rule_input(f)
    assert not [p for p in rows.inputFiles() if "lineitem" in p]
    want = checks.pos(f).select(*rows.columns[:-1], F.col("unit_price").try_cast("decimal(10,2)").alias("price"))
    assert rows.dtypes == want.dtypes
    assert rows.exceptAll(want).count() == want.exceptAll(rows).count() == 0 and rows.count() == 24
    assert checks.halt_threshold(f).first().total == 24
