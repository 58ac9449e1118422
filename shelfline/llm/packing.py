"""Sequence packing by power-of-two decomposition."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import in_slices, text_column
from shelfline.llm.encode import encoder

ENCODED = 256  # documents tokenised together
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"


def binary_lengths(n: int, longest: int) -> list[int]:
    """``n`` as whole ``longest`` pieces and then its binary digits, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, longest: int = 1024, id_column: str = "doc_id",
                   text: str = "text", with_ids: bool = True) -> DataFrame:
    """Cut every document into pieces of power-of-two length; each piece is one sequence of its own.

    No sequence crosses documents and none needs padding, as every length is a power of two. Sequences of
    equal length share a bucket (``bucket`` is its exponent), from which batches of one shape are drawn.
    Nothing is shuffled: a document's cut depends on its own length alone. ``longest`` is a power of two.

    NULL and empty texts are documents of the end id alone, in one piece. NULL, tied and repeated ids are
    packed row by row. Very long texts are many pieces. An empty table gives no pieces; extra columns are left behind.
    Without ``with_ids`` the column ``ids`` is NULL: what is not read need not travel.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    end = end_id.to_bytes(4, "little")
    body = docs.select(docs[id_column].cast("bigint").alias("doc_id"), text_column(docs, text).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for some in in_slices(rows, ENCODED):
                out: list[list] = [[], [], [], [], [], []]
                for (doc_id, _), raw in zip(some, coder.encode([t for _, t in some]), strict=True):
                    raw += end
                    total = len(raw) // 4
                    lengths = binary_lengths(total, longest)
                    starts = list(itertools.accumulate(lengths[:-1], initial=0))
                    pieces = [raw[4 * at : 4 * (at + length)] for at, length in zip(starts, lengths, strict=True)]
                    for column, values in zip(out, ([doc_id] * len(pieces), starts, lengths, map(zlib.crc32, pieces), [total] * len(pieces), pieces if with_ids else [None] * len(pieces)), strict=True):
                        column += values
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return body.mapInArrow(cut, PIECES).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
        F.log2("length").cast("int").alias("bucket"))


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """Store the sequences by length: a reader of one bucket gets batches of one shape."""
    pieces.write.partitionBy("bucket").mode("overwrite").parquet(folder)
