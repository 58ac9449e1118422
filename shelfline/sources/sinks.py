"""Table sinks. Each write is one action; its row count comes from that write."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.dedup import latest_per_key
from shelfline.operators.upsert import merge_columns, merge_upsert
from shelfline.session import settle, work_dir
from shelfline.sources import key_index


# Fixed value: how Spark names the folder of a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append_raw(df: DataFrame, path: str, by: str = "ingestion_date") -> int:
    """Append partitioned by load date; returns the rows written. Added columns are
    picked up by readers that merge schemas."""
    watched, seen = _counted(df)
    watched.write.mode("append").partitionBy(by).parquet(path)
    return seen.get["rows"]


def overwrite(df: DataFrame, path: str, by: Sequence[str] = ()) -> int:
    """Replace a table whose old content is not an input of ``df``."""
    watched, seen = _counted(df)
    writer = watched.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return seen.get["rows"]


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> int:
    """Replace only the partitions present in ``df``: reruns of a day are idempotent."""
    watched, seen = _counted(df)
    (watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
    return seen.get["rows"]


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Lay files out by the columns readers filter on, so footers prune row groups."""
    ranged = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    ranged.sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str], bits: int = 6, files: int | None = None) -> None:
    """Lay files out along a space-filling curve, so that a filter on any of ``columns`` prunes.

    Each column is cut into 2^``bits`` ranges of about equal rows; the bits of a row's range
    numbers are interleaved to its place on the curve. The cuts, a few dozen values a column, are
    all that reaches the driver. NULLs lie in the first range. The rows are read for the cuts, for
    the file bounds and for the files, so they are stored first.
    """
    df = settle(df, "interleaved")
    size = 1 << bits
    parts = [k / size for k in range(1, size)]
    cuts = df.agg(*[F.percentile_approx(_ordinal(df, c), parts, 10_000).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    ranked = _ranges(df.withColumns({f"_o{i}": _ordinal(df, c) for i, c in enumerate(columns)}), cuts, bits)
    place = F.lit(0).cast("bigint")
    for i in range(len(columns)):
        for b in range(bits):
            bit = F.shiftright(F.col(f"_r{i}"), b).bitwiseAND(F.lit(1)).cast("bigint")
            place = place.bitwiseOR(F.shiftleft(bit, b * len(columns) + i))
    laid = ranked.select(*df.columns, place.alias("_curve"))
    ranged = laid.repartitionByRange(files, "_curve") if files else laid.repartitionByRange("_curve")
    ranged.sortWithinPartitions("_curve").drop("_curve").write.mode("overwrite").parquet(path)


def _ranges(df: DataFrame, cuts: Sequence[list[float] | None], bits: int) -> DataFrame:
    """Add ``_r{i}``, how many cuts lie below ``_o{i}``: ``bits`` halvings, one a projection, all in generated code.

    Cuts are filled up to 2^``bits`` - 1 with NaN, which lies below nothing. A NULL counts no cut.
    """
    filled = []
    for c in cuts:
        known = sorted({x for x in c or [] if x == x})
        filled.append(F.array(*[F.lit(x) for x in known + [float("nan")] * ((1 << bits) - 1 - len(known))]))
    out = df.withColumns({f"_r{i}": F.lit(0) for i in range(len(filled))})
    for b in reversed(range(bits)):
        step = 1 << b
        out = out.withColumns({f"_r{i}": F.when(F.get(cut, F.col(f"_r{i}") + (step - 1)) < F.col(f"_o{i}"), F.col(f"_r{i}") + step)
                               .otherwise(F.col(f"_r{i}")) for i, cut in enumerate(filled)})
    return out


def _ordinal(df: DataFrame, column: str) -> Column:
    """A number that orders like the column; a text counts by its first six bytes."""
    kind = df.schema[column].dataType.typeName()
    if kind == "string":
        head = F.rpad(F.hex(F.substring(F.col(column).cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop, _ = _folder(spark, path)
    return bool(fs.exists(hadoop))


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions under a versioned table, ascending."""
    fs, hadoop, jvm = _folder(spark, root)
    if not fs.exists(hadoop):
        return []
    out = []
    for status in fs.listStatus(hadoop):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v=") and fs.exists(done):
            out.append(int(name[2:]))
    return sorted(out)


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest complete version, or None before the first write."""
    have = versions(spark, root)
    return spark.read.parquet(f"{root}/v={have[-1]}") if have else None


def write_next(df: DataFrame, root: str, by: Sequence[str] = ()) -> int:
    """Write the next version beside the one being read, never over it. Readers move
    on once the success marker exists, so a failed write changes nothing."""
    have = versions(df.sparkSession, root)
    return overwrite(df, f"{root}/v={(have[-1] + 1) if have else 1}", by)


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], by: str,
                      update: Sequence[str] | None = None, key_has_partition: bool = False) -> int:
    """Merge into a partitioned table by rewriting only the partitions it touches.

    Touched are the partitions of the source rows and those that hold a matching key, so a
    row whose partition value changes leaves no copy behind. An index of Bloom filters beside
    the table names the partitions that may hold a key; only their key columns are read, to
    keep those that do. When the key determines the partition (``key_has_partition``)
    there is nothing to look up. With ``update``,
    matched rows take just those columns. The merged rows are settled before any file is
    replaced, and a note beside the table lets the next merge finish one that broke off.
    Returns the rows written.
    """
    if not exists(spark, path):
        if not key_has_partition:
            source = settle(source, "first")
            key_index.add_keys(spark, path, source, keys, by)
        rows = overwrite_partitions(source, path, [by])
        _record_change(source.select(by).distinct(), path, by, "first")
        return rows
    _finish_merge(spark, path, by)
    current = spark.read.parquet(path)
    current = current.select(*[F.col(c).cast(source.schema[c].dataType) if c in source.columns else F.col(c)
                               for c in current.columns])
    source = settle(source, "source")
    wanted = source.select(by).distinct()
    if key_has_partition:
        held = wanted.limit(0)
    else:
        if not exists(spark, key_index.index_path(path)):
            key_index.rebuild(spark, path, keys, by)
        maybe = settle(key_index.parts_that_may_hold(spark, path, source, keys, by), "maybe")
        held = settle(_of_parts(current, maybe, by).join(source.select(*keys).distinct(), list(keys), "left_semi").select(by).distinct(), "held")
        key_index.add_keys(spark, path, source, keys, by)
    touched = settle(held.unionByName(wanted).distinct(), "touched")
    affected = _of_parts(current, touched, by)
    merged = merge_upsert(affected, source, keys) if update is None else merge_columns(affected, source, keys, update)
    base = work_dir(spark, "merge")
    merged.write.parquet(f"{base}/rows")
    merged = spark.read.schema(merged.schema).parquet(f"{base}/rows")
    # Partitions whose last row moved elsewhere: found before any file is replaced.
    kept = merged.select(F.col(by).alias("_kept")).distinct()
    held.join(kept, F.col(by).eqNullSafe(F.col("_kept")), "left_anti").write.parquet(f"{base}/emptied")
    touched.select(F.col(by).cast("string").alias("part")).write.parquet(f"{base}/touched")
    spark.createDataFrame([(base,)], "base string").coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(_note(path))
    return _finish_merge(spark, path, by)


def _note(path: str) -> str:
    return f"{path.rstrip('/')}_merging"


def _finish_merge(spark: SparkSession, path: str, by: str) -> int:
    """Publish the merge that the note names, once more if it broke off before; then the note goes."""
    if not exists(spark, f"{_note(path)}/_SUCCESS"):
        return 0
    base = spark.read.parquet(_note(path)).first()["base"]
    rows = overwrite_partitions(spark.read.parquet(f"{base}/rows"), path, [by])
    drop_partitions(spark, path, spark.read.parquet(f"{base}/emptied"))
    _record_change(spark.read.parquet(f"{base}/touched"), path, "part", base.rsplit("/", 1)[-1])
    drop_folder(spark, _note(path))
    return rows


def _changes(path: str) -> str:
    return f"{path.rstrip('/')}_changes"


def _record_change(parts: DataFrame, path: str, by: str, ident: str) -> None:
    """Keep the partition values a merge touched, for what is built from the table; repeating it changes nothing."""
    parts.select(F.col(by).cast("string").alias("part")).distinct().coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(f"{_changes(path)}/id={ident}")


def change_ids(spark: SparkSession, path: str) -> list[str]:
    """Merges recorded beside a table and not yet forgotten."""
    fs, hadoop, jvm = _folder(spark, _changes(path))
    if not fs.exists(hadoop):
        return []
    found = (s.getPath() for s in fs.listStatus(hadoop))
    return sorted(p.getName()[3:] for p in found if p.getName().startswith("id=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def changed_days(spark: SparkSession, path: str, ids: Sequence[str]) -> list[dt.date | None]:
    """Days that the given merges touched: a list of partition values, no rows."""
    if not ids:
        return []
    read = spark.read.schema("part string").parquet(*[f"{_changes(path)}/id={i}" for i in ids])
    return [r[0] for r in read.select(F.col("part").cast("date")).distinct().collect()]


def forget_changes(spark: SparkSession, path: str, ids: Sequence[str]) -> None:
    for i in ids:
        drop_folder(spark, f"{_changes(path)}/id={i}")


def _of_parts(current: DataFrame, parts: DataFrame, by: str) -> DataFrame:
    """Stored rows of the listed partitions. The list, a value a partition, prunes folders before any file is opened."""
    listed = [r[0] for r in parts.collect()]
    found = F.col(by).isin([v for v in listed if v is not None])
    return current.where(found | F.col(by).isNull() if None in listed else found)


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop, _ = _folder(spark, path)
    fs.delete(hadoop, True)


def drop_partitions(spark: SparkSession, root: str, parts: DataFrame) -> None:
    """Delete whole partitions, listed by their column values: a few names, no rows."""
    for row in parts.collect():
        names = (f"{k}={NULL_FOLDER if v is None else v}" for k, v in row.asDict().items())
        fs, hadoop, _ = _folder(spark, "/".join([root, *names]))
        fs.delete(hadoop, True)


def append_epoch(df: DataFrame, root: str, epoch: int) -> None:
    """Store the rows a micro-batch changed under its epoch.

    The cost follows the micro-batch, not the table. A replayed epoch replaces itself.
    """
    overwrite_partitions(df.withColumn("epoch", F.lit(epoch).cast("bigint")), root, ["epoch"])


def latest_rows(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Current table behind ``append_epoch``: the newest row of every key."""
    return latest_per_key(spark.read.parquet(root), keys, ["epoch"]).drop("epoch")


def compact(spark: SparkSession, root: str, keys: Sequence[str], target: str) -> int:
    """Fold all epochs into one row per key in the next version of ``target``."""
    return write_next(latest_rows(spark, root, keys), target)


def append_rejects(rejects: DataFrame, path: str) -> None:
    """Quarantine append; readers merge the differing columns."""
    rejects.write.mode("append").parquet(path)


def write_if_any(df: DataFrame, path: str) -> bool:
    """Skip a zero-row write, so an empty delivery never replaces good data."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return True


def hide_batches(df: DataFrame, bad_batches: DataFrame, batch: str | Column = "_batch_id") -> DataFrame:
    """Rows of quarantined loads disappear at read time."""
    return df.join(bad_batches.select("_batch_id").distinct(), "_batch_id", "left_anti")


def keep_recent(df: DataFrame, date: str, as_of: str, days: int = 90) -> DataFrame:
    """Rows inside the retention window; on the partition column this prunes files."""
    return df.where(F.col(date) >= F.date_sub(F.lit(as_of).cast("date"), days))


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
