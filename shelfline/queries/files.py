"""File sources and sinks: tables are written to a working folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline import contracts as c
from shelfline.operators import quality as q
from shelfline.plans import conform, ingest
from shelfline.queries import sqlframes as s
from shelfline.queries.frames import Frames
from shelfline.queries.layers import receipts
from shelfline.queries.registry import query
from shelfline.session import work_dir
from shelfline.sources import files, sinks

A = s.AS_OF


def _stock_file(f: Frames) -> DataFrame:
    text = lambda n: F.col(n).cast("string")
    return f.stock.select(text("snapshot_date").alias("snapshot_date"), "warehouse_id", "sku_id",
                          text("units_on_hand").alias("quantity_on_hand"),
                          text("reorder_point_units").alias("reorder_point"),
                          text("units_in_transit").alias("quantity_on_order"))


_STOCK_TEXT = """
SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, warehouse_id, sku_id, CAST(units_on_hand AS VARCHAR) AS quantity_on_hand,
       CAST(reorder_point_units AS VARCHAR) AS reorder_point, CAST(units_in_transit AS VARCHAR) AS quantity_on_order FROM stock"""


@query("src_01_csv_scan", _STOCK_TEXT)
def csv_scan(f: Frames):
    path = work_dir(f.spark, "csv") + "/inventory_daily"
    _stock_file(f).write.option("header", True).csv(path)
    return files.read_csv(f.spark, path, c.LANDING["inventory_daily"])


@query("src_01_csv_by_name", "SELECT sku_id, warehouse_id, CAST(NULL AS VARCHAR) AS carrier, count(*) AS rows FROM stock GROUP BY 1, 2")
def csv_by_name(f: Frames):
    path = work_dir(f.spark, "csv") + "/inventory_daily"
    _stock_file(f).write.option("header", True).csv(path)
    named = files.read_csv_by_name(f.spark, path, ["sku_id", "carrier", "warehouse_id"])
    return named.groupBy("sku_id", "warehouse_id", "carrier").agg(F.count("*").alias("rows"))


@query("src_02_ndjson_scan", "SELECT transaction_id, line_no, sku_id, quantity, unit_price, discount_pct FROM pos_raw")
def ndjson_scan(f: Frames):
    path = work_dir(f.spark, "json") + "/pos_transactions"
    receipts(f).write.option("compression", "gzip").json(path)
    raw = files.read_ndjson(f.spark, path, c.POS_SCHEMA)
    return ingest.flatten_pos(raw).select("transaction_id", "line_no", "sku_id", "quantity", "unit_price", "discount_pct")


s.FRAMES["broken_lines"] = """
SELECT sku_id, warehouse_id, snapshot_date, CAST(substr(sku_id, 5) AS INTEGER) % 97 = 0 AS broken FROM stock"""


def _broken_csv(f: Frames) -> DataFrame:
    """Stock lines as text; every 97th sku has a field too many."""
    path = work_dir(f.spark, "broken") + "/inventory_daily"
    rows = _stock_file(f)
    line = F.concat_ws(",", *rows.columns)
    bad = F.substring("sku_id", 5, 20).cast("int") % 97 == 0
    rows.select(F.when(bad, F.concat(line, F.lit(",surplus"))).otherwise(line).alias("value")).write.text(path)
    return files.read_csv_capturing(f.spark, path, c.LANDING["inventory_daily"], header=False)


@query("src_07_malformed_capture", """
SELECT 'good' AS outcome, count(*) FILTER (NOT broken) AS rows FROM broken_lines UNION ALL
SELECT 'MALFORMED_RECORD', count(*) FILTER (broken) FROM broken_lines""")
def malformed_capture(f: Frames):
    captured = _broken_csv(f)
    good = files.well_formed(captured).select(F.lit("good").alias("outcome"))
    bad = files.malformed(captured).select(F.col("reason").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count("*").alias("rows"))


@query("src_08_header_mismatch_halt", "SELECT count(*) AS kept_rows, true AS halted FROM stock")
def header_mismatch(f: Frames):
    """A file whose header differs fails before anything is replaced."""
    root = work_dir(f.spark, "header")
    good, bad, table = f"{root}/good", f"{root}/bad", f"{root}/table"
    columns = c.LANDING["inventory_daily"]
    _stock_file(f).write.option("header", True).csv(good)
    _stock_file(f).withColumnRenamed("sku_id", "article").write.option("header", True).csv(bad)
    sinks.write_next(files.read_csv(f.spark, good, columns, strict_header=True), table)
    halted = False
    try:
        sinks.write_next(files.read_csv(f.spark, bad, columns, strict_header=True), table)
    except Exception:  # noqa: BLE001 - any read failure must leave the table alone
        halted = True
    return sinks.read_current(f.spark, table).agg(F.count("*").alias("kept_rows")).withColumn("halted", F.lit(halted))


@query("src_09_empty_batch_guard", "SELECT count(*) AS kept_rows, false AS wrote_empty FROM stock")
def empty_guard(f: Frames):
    path = work_dir(f.spark, "guard") + "/stock"
    sinks.write_if_any(f.stock, path)
    wrote = sinks.write_if_any(f.stock.where("units_on_hand < 0"), path)
    return f.spark.read.parquet(path).agg(F.count("*").alias("kept_rows")).withColumn("wrote_empty", F.lit(wrote))


@query("prj_04_lineage_metadata", """
SELECT sku_id, warehouse_id, CAST(units_on_hand AS VARCHAR) AS units_on_hand, 'inventory.csv' AS _source_file, 'load-1' AS _batch_id,
       'manual_2001-08-02' AS _pipeline_run_id, DATE '2001-08-02' AS ingestion_date, '2001-08-02 03:00:00' AS _ingested_at FROM stock""")
def lineage(f: Frames):
    rows = f.stock.select("sku_id", "warehouse_id", "units_on_hand")
    out = ingest.add_bronze_metadata(rows, "inventory.csv", "load-1", ingested_at="2001-08-02 03:00:00")
    return out.withColumn("_ingested_at", F.date_format("_ingested_at", "yyyy-MM-dd HH:mm:ss"))


@query("prj_07_audit_stamp", """
SELECT sku_id, warehouse_id, '2001-08-02 03:00:00' AS created_at, '2001-08-02 03:00:00' AS updated_at, 'load-1' AS _source_batch_id FROM stock""")
def audit_stamp(f: Frames):
    out = conform.stamp(f.stock.select("sku_id", "warehouse_id"), "2001-08-02 03:00:00", "load-1")
    at = lambda n: F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n)
    return out.select("sku_id", "warehouse_id", at("created_at"), at("updated_at"), "_source_batch_id")


@query("snk_01_append_evolving", """
SELECT ingestion_date, count(*) AS rows, count(units_in_transit) AS with_transit FROM
(SELECT DATE '2001-08-01' AS ingestion_date, NULL AS units_in_transit FROM stock UNION ALL
 SELECT DATE '2001-08-02', units_in_transit FROM stock WHERE units_on_hand > 100) GROUP BY 1""")
def append_evolving(f: Frames):
    path = work_dir(f.spark, "append") + "/stock"
    first = f.stock.select("sku_id", "warehouse_id", "units_on_hand")
    later = f.stock.where("units_on_hand > 100").select("sku_id", "warehouse_id", "units_on_hand", "units_in_transit")
    sinks.append_raw(first.withColumn("ingestion_date", F.lit("2001-08-01").cast("date")), path)
    sinks.append_raw(later.withColumn("ingestion_date", F.lit("2001-08-02").cast("date")), path)
    return files.table(f.spark, path, merge_schema=True).groupBy("ingestion_date").agg(
        F.count("*").alias("rows"), F.count("units_in_transit").alias("with_transit"))


@query("snk_02_full_overwrite", "SELECT channel, count(*) AS lines, count(*) AS written FROM (SELECT channel FROM sale_lines) GROUP BY 1")
def full_overwrite(f: Frames):
    path = work_dir(f.spark, "overwrite") + "/lines"
    sinks.overwrite(f.sale_lines.select("sku_id", "quantity_sold"), path)
    sinks.overwrite(f.sale_lines.select("channel", "transaction_date"), path, ["channel"])
    return f.spark.read.parquet(path).groupBy("channel").agg(F.count("*").alias("lines"), F.count("transaction_date").alias("written"))


@query("snk_05_create_on_first_write", "SELECT 1 AS first_version, 2 AS versions, count(*) AS rows FROM stock_updates s")
def first_write(f: Frames):
    from shelfline.queries.primitives import _KEYS, _updates
    root = work_dir(f.spark, "versions") + "/stock"
    created = sinks.read_current(f.spark, root) is None
    sinks.write_next(_updates(f), root)
    from shelfline.operators.upsert import merge_upsert
    sinks.write_next(merge_upsert(sinks.read_current(f.spark, root), _updates(f), _KEYS), root)
    versions = sinks.versions(f.spark, root)
    return sinks.read_current(f.spark, root).agg(F.count("*").alias("rows")).select(
        F.lit(versions[0] if created else 0).alias("first_version"), F.lit(len(versions)).alias("versions"), "rows")


@query("snk_06_partition_overwrite", """
SELECT report_month, CAST(sum(units) AS BIGINT) AS units FROM (SELECT strftime(transaction_date, '%Y-%m') AS report_month,
quantity_sold + CASE WHEN transaction_date >= DATE '2001-06-01' THEN 1 ELSE 0 END AS units FROM sale_lines) GROUP BY 1""")
def partition_overwrite(f: Frames):
    path = work_dir(f.spark, "partitions") + "/monthly"
    monthly = f.sale_lines.select(F.date_format("transaction_date", "yyyy-MM").alias("report_month"), "quantity_sold")
    total = lambda df, extra: df.groupBy("report_month").agg(F.sum(F.col("quantity_sold") + extra).alias("units"))
    sinks.overwrite_partitions(total(monthly, 0), path, ["report_month"])
    again = total(monthly.where("report_month >= '2001-06'"), 1)
    sinks.overwrite_partitions(again, path, ["report_month"])
    sinks.overwrite_partitions(again, path, ["report_month"])
    return f.spark.read.parquet(path).select(F.col("report_month").cast("string").alias("report_month"), "units")


@query("snk_07_database_creation", "SELECT channel, count(*) AS lines FROM sale_lines GROUP BY 1")
def database_creation(f: Frames):
    name = "shelfline_" + work_dir(f.spark, "db").rsplit("-", 1)[-1].lower().replace("_", "x")
    location = work_dir(f.spark, "dbdata")
    f.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    sinks.ensure_database(f.spark, name)
    f.sale_lines.select("channel").write.mode("overwrite").saveAsTable(f"{name}.lines")
    return f.spark.table(f"{name}.lines").groupBy("channel").agg(F.count("*").alias("lines"))


@query("snk_08_quarantine_append", """
SELECT _dq_failure_reason, count(*) AS rows FROM (
SELECT 'null_in_columns:batch_id' AS _dq_failure_reason FROM plant_events WHERE batch_id IS NULL UNION ALL
SELECT 'out_of_range:units_on_hand[1,None]' FROM stock WHERE units_on_hand < 1) GROUP BY 1""")
def quarantine_append(f: Frames):
    path = work_dir(f.spark, "quarantine") + "/rejects"
    for df, rule in ((f.plant_events, q.not_null(["batch_id"])), (f.stock, q.in_range("units_on_hand", 1, None, "error"))):
        sinks.append_rejects(q.rejected_rows(q.tag(df, [rule]), [rule]), path)
    return files.table(f.spark, path, merge_schema=True).groupBy(q.REASON).agg(F.count("*").alias("rows"))


@query("snk_13_interleaved_layout", """
SELECT 'product' AS filtered_by, count(*) AS lines, CAST(sum(quantity_sold) AS BIGINT) AS units FROM sale_lines WHERE sku_id BETWEEN 'SKU-1' AND 'SKU-11'
UNION ALL SELECT 'day', count(*), CAST(sum(quantity_sold) AS BIGINT) FROM sale_lines WHERE transaction_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'
UNION ALL SELECT 'quantity', count(*), CAST(sum(quantity_sold) AS BIGINT) FROM sale_lines WHERE quantity_sold >= 48""")
def interleaved_layout(f: Frames):
    """Sale lines along a space-filling curve, read back by each of its columns."""
    path = work_dir(f.spark, "interleaved") + "/lines"
    sinks.write_interleaved(f.sale_lines, path, ["sku_id", "transaction_date", "quantity_sold"], files=16)
    lines = f.spark.read.parquet(path)
    by = {"product": "sku_id BETWEEN 'SKU-1' AND 'SKU-11'", "day": "transaction_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'",
          "quantity": "quantity_sold >= 48"}
    found = [lines.where(w).agg(F.count("*").alias("lines"), F.sum("quantity_sold").alias("units")).select(F.lit(k).alias("filtered_by"), "lines", "units")
             for k, w in by.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("snk_13_clustered_layout", f"SELECT transaction_date, count(*) AS lines FROM sale_lines WHERE transaction_date >= {A} - 30 GROUP BY 1")
def clustered(f: Frames):
    path = work_dir(f.spark, "clustered") + "/lines"
    sinks.write_clustered(f.sale_lines.select("transaction_date", "sku_id", "quantity_sold"), path, ["transaction_date", "sku_id"])
    from shelfline.functions.time import day
    from shelfline.queries.frames import AS_OF
    return f.spark.read.parquet(path).where(F.col("transaction_date") >= F.date_sub(day(AS_OF), 30)).groupBy(
        "transaction_date").agg(F.count("*").alias("lines"))
