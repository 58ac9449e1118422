"""Text file sources with fixed schemas; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.contracts import CORRUPT, text_schema


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], strict_header: bool = False) -> DataFrame:
    """Header CSV, all columns text. ``strict_header`` fails the read when the header
    does not name exactly these columns in order."""
    return (spark.read.schema(text_schema(*columns)).option("header", True)
            .option("enforceSchema", not strict_header)
            .option("mode", "FAILFAST" if strict_header else "PERMISSIVE").csv(path))


def read_csv_by_name(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header CSV matched by column name: order is free, missing columns are NULL."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in columns])


def read_feed_csv(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """A delivered CSV by its own header: required columns as text, the text of a malformed
    line, and the file.

    The order of columns is free and further columns are ignored. A header without a required
    column halts the read before anything is written; so does a file whose header differs from
    the first file's. Lines with too many or too few fields are marked, not dropped.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"{path}: header lacks {', '.join(missing)}")
    rows = (spark.read.schema(text_schema(*header, CORRUPT)).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))
    return rows.select(*[F.col(f"`{c}`") for c in required], CORRUPT, F.col("_metadata.file_path").alias("_source_file"))


def _parsed_lines(spark: SparkSession, path: str, schema: T.StructType, parse) -> DataFrame:
    """Parse text lines into columns, the raw line of a bad record and its file.

    Parsing the line as an expression, not as a scan, leaves any later projection
    free to drop columns.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_source_file"))
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    row = parse(F.col("value"), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.withColumn("_row", row).select("_row.*", "_source_file", F.col("value").alias("_line"))


def read_csv_capturing(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True) -> DataFrame:
    """Comma-separated lines with malformed ones marked instead of dropped."""
    parse = lambda v, schema, options: F.from_csv(v, schema.simpleString()[7:-1].replace(":", " "), options)
    rows = _parsed_lines(spark, path, text_schema(*columns), parse)
    return rows.where(F.col("_line") != ",".join(columns)) if header else rows


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(schema).json(path)


def read_ndjson_capturing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with malformed ones marked instead of dropped."""
    return _parsed_lines(spark, path, schema, F.from_json)


def well_formed(captured: DataFrame) -> DataFrame:
    return captured.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_line")


def malformed(captured: DataFrame) -> DataFrame:
    """Bad lines with their file and a reason."""
    return captured.where(F.col(CORRUPT).isNotNull()).select(
        "_source_file", F.col("_line").alias("raw_line"), F.lit("MALFORMED_RECORD").alias("reason"))


def table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A stored table; ``merge_schema`` reads appended files of differing width."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)
