"""Quality rules with cross-document line frequency: frequent lines go, depleted documents are rejected."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfline.llm.common import fresh, settle, text_column
from shelfline.llm.textstats import base_stats, lines_with_words

MIN_WORDS = 50
REPEAT_PERCENT = 50
# A line is boilerplate of its host when more different documents than both limits hold it.
MIN_DOCS = 20
HOST_PERCENT = 5
# A document is depleted when fewer of its words than this are left.
KEPT_PERCENT = 30

STATS = ("doc_id bigint, host string, text_hash bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
         "n_dup_lines bigint, n_repeat_words bigint, line_keys array<bigint>, line_words array<int>")


def normalised(line: bytes) -> bytes:
    """A line for comparison: ASCII lower case, words apart by one space."""
    return b" ".join(line.lower().split())


def line_key(host: str | None, line: bytes) -> int:
    """Signed 64-bit hash of a host and a normalised line."""
    lead = b"\x00" if host is None else b"\x01" + host.encode("utf-8", "surrogatepass")
    value = xxhash.xxh3_64_intdigest(lead + b"\n" + normalised(line))
    return value - (1 << 64) if value >> 63 else value


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("text_hash", pa.int64())]
                       + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                       + [("line_keys", pa.list_(pa.int64())), ("line_words", pa.list_(pa.int32()))])
    for batch in batches:
        ids, hosts, hashes, texts = (batch.column(i).to_pylist() for i in range(4))
        stats: list[tuple] = []
        keys: list[list[int]] = []
        counts: list[list[int]] = []
        for host, text in zip(hosts, texts, strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            words, lines = raw.split(), lines_with_words(raw)
            stats.append(base_stats(text, raw, words, lines))
            own: dict[int, int] = {}
            for line in lines:
                key = line_key(host, line)
                own[key] = own.get(key, 0) + len(line.split())
            keys.append(list(own))
            counts.append(list(own.values()))
        columns = [ids, hosts, hashes, *(list(c) for c in zip(*stats, strict=True)), keys, counts] if stats else [[] for _ in schema]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def judge_documents(docs: DataFrame, host: str = "source", id_column: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                    host_percent: float = HOST_PERCENT, kept_percent: float = KEPT_PERCENT) -> DataFrame:
    """One row per document: the base counts, the words its frequent lines take, the verdict, those lines' keys.

    A line counts once for each different text of its host, so copies of one document do not make its lines
    frequent. Frequent means in more than ``min_docs`` texts and in more than ``host_percent`` percent of the
    host's texts. Lines are counted by key with map-side sums; only keys above ``min_docs`` are looked at
    again, and a very common line is a short key in joins that adaptive execution splits.

    NULL and empty texts have no words and fail the base rule. NULL hosts form one host. NULL, tied and
    repeated ids and repeated rows are judged row by row. An empty table gives no rows; extra columns are
    left behind.
    """
    body = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[host].cast("string").alias("host"),
                       F.xxhash64(text_column(docs, text)).alias("text_hash"), text_column(docs, text).alias("text"))
    measured = settle(body.mapInArrow(_measure, STATS).withColumn("row", F.monotonically_increasing_id()), "lines")
    pairs = measured.select("row", "host", "text_hash", F.explode(F.arrays_zip("line_keys", "line_words")).alias("l")).select(
        "row", "host", "text_hash", F.col("l.line_keys").alias("key"), F.col("l.line_words").alias("words"))
    often = measured.select(F.explode("line_keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > min_docs)
    near = settle(pairs.join(often.select("key"), "key"), "frequent-lines")
    # NULL hosts compare as one host.
    limits = measured.select("host", "text_hash").distinct().groupBy("host").agg(
        F.greatest(F.lit(float(min_docs)), F.count("*") * (host_percent / 100.0)).alias("limit")).withColumnRenamed("host", "of")
    over = (
        near.select("key", "host", "text_hash").distinct().groupBy("key", "host").agg(F.count("*").alias("n"))
        .join(limits, F.col("host").eqNullSafe(F.col("of"))).where(F.col("n") > F.col("limit")).select("key")
    )
    removed = near.join(over, "key").groupBy("row").agg(F.sum("words").alias("words_removed"), F.collect_set("key").alias("removed_keys"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("words_removed", F.lit(0))
    return (
        measured.drop("line_keys", "line_words").join(removed, "row", "left")
        .select("doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                failed.alias("base_failed"), (~failed & (100 * left >= kept_percent * F.col("n_words"))).alias("kept"),
                F.coalesce("words_removed", F.lit(0)).cast("bigint").alias("words_removed"), "removed_keys")
    )


@F.pandas_udf(StringType())
def _without_lines(texts: pd.Series, hosts: pd.Series, keys: pd.Series) -> pd.Series:
    out = []
    for text, host, gone in zip(texts, hosts, keys, strict=True):
        drop = set(gone)
        lines = text.split("\n")
        out.append("\n".join(x for x in lines if not x.strip(" \t\x0b\x0c\r")
                             or line_key(host, x.encode("utf-8", "surrogatepass")) not in drop))
    return pd.Series(out, dtype=object)


def apply_verdicts(docs: DataFrame, verdicts: DataFrame, host: str = "source", id_column: str = "doc_id", text: str = "text",
                   length_column: str | None = None) -> DataFrame:
    """The kept documents with their frequent lines removed, all other columns as they were.

    ``length_column`` names a column that follows the text's length.

    ``verdicts`` comes from ``judge_documents`` over the same rows. Rows with the same id, host and text
    have the same verdict, so those three columns are the key.
    """
    ident, place, mark, gone = (fresh(docs, n) for n in ("id", "host", "hash", "gone"))
    wanted = verdicts.where("kept").groupBy(F.col("doc_id").alias(ident), F.col("host").alias(place), F.col("text_hash").alias(mark)).agg(
        F.first("removed_keys").alias(gone))
    joined = docs.join(wanted, docs[id_column].cast("bigint").eqNullSafe(wanted[ident]) & docs[host].cast("string").eqNullSafe(wanted[place])
                       & (F.xxhash64(text_column(docs, text)) == wanted[mark]))
    has = joined.where(F.col(gone).isNotNull())
    none = joined.where(F.col(gone).isNull())
    cleaned = has.withColumn(text, _without_lines(F.col(text), F.col(host).cast("string"), F.col(gone)))
    if length_column:
        cleaned = cleaned.withColumn(length_column, F.length(text).cast(docs.schema[length_column].dataType))
    return none.select(docs.columns).unionByName(cleaned.select(docs.columns))
