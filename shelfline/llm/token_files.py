"""Token ids in bit-packed files: write a corpus, read whole documents or any range of ids.

File layout (little endian): ``MAGIC``; blocks of ``BLOCK`` ids, each id in ``bits`` bits, the last block
padded with zero bits to whole bytes; the index (document ids, a NULL flag each, document starts, byte offset of every block);
a JSON footer, its length in four bytes, ``MAGIC`` again. ``bits`` is the least that holds the largest id.
Files follow ascending document ids: NULL ids first, then by id; equal ids lie side by side, shorter texts
first. Empty and NULL texts are documents of one end id; an empty table gives no files and no rows.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import fresh, in_slices, text_column
from shelfline.llm.encode import encoder

MAGIC = b"BITPACK1"
BLOCK = 4096  # ids a block; a multiple of 8, so that every full block ends on a byte
ENCODED = 256  # documents tokenised together
MANIFEST = "path string, docs bigint, tokens bigint, first_null boolean, first_id bigint, shard bigint"
READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"


def bits_for(vocab_size: int) -> int:
    """The least bits that hold every id below ``vocab_size``."""
    return max(1, (vocab_size - 1).bit_length())


def _lanes(bits: int) -> Iterator[tuple[int, int, int]]:
    """The ids of one period of whole 64-bit words: number in the period, word, shift."""
    for k in range(64 // math.gcd(bits, 64)):
        yield k, k * bits >> 6, k * bits & 63


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive ``bits``-bit numbers, lowest bit first: every id is shifted into its 64-bit word."""
    period, step = 64 // math.gcd(bits, 64), bits // math.gcd(bits, 64)
    whole = -(-len(ids) // period)
    wide = np.zeros(whole * period, np.uint64)
    wide[: len(ids)] = ids
    wide = wide.reshape(whole, period)
    words = np.zeros((whole, step + 1), np.uint64)
    for k, word, shift in _lanes(bits):
        words[:, word] |= wide[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= wide[:, k] >> np.uint64(64 - shift)
    return words[:, :step].astype("<u8").tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a packed block."""
    period, step = 64 // math.gcd(bits, 64), bits // math.gcd(bits, 64)
    whole = -(-count // period)
    raw = np.zeros(whole * step * 8, np.uint8)
    raw[: min(len(data), len(raw))] = np.frombuffer(data, np.uint8)[: len(raw)]
    words = raw.view("<u8").reshape(whole, step)
    out = np.empty((whole, period), np.uint64)
    for k, word, shift in _lanes(bits):
        out[:, k] = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            out[:, k] |= words[:, word + 1] << np.uint64(64 - shift)
    return (out.reshape(-1)[:count] & np.uint64((1 << bits) - 1)).astype("<u4")


class ShardWriter:
    """Streams one file: blocks leave as they fill, only the index stays in memory until the end."""

    def __init__(self, filesystem: fs.FileSystem, path: str, bits: int):
        self.out, self.bits = filesystem.open_output_stream(path), bits
        self.out.write(MAGIC)
        self.at, self.blocks, self.rest, self.waiting, self.tokens = len(MAGIC), [], [], 0, 0
        self.doc_ids, self.starts = [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.tokens)
        self.tokens += len(ids)
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK:
            self._drain(self.waiting - self.waiting % BLOCK)

    def _drain(self, count: int) -> None:
        joined = np.concatenate(self.rest) if self.rest else np.zeros(0, "<u4")
        for i in range(0, count, BLOCK):
            data = pack(joined[i : min(i + BLOCK, count)], self.bits)
            self.blocks.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.rest = [joined[count:].copy()]
        self.waiting = len(self.rest[0])

    def close(self) -> None:
        self._drain(self.waiting)
        index = [
            np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(),
            np.array([d is None for d in self.doc_ids], "u1").tobytes(),
            np.array(self.starts, "<u8").tobytes(),
            np.array(self.blocks, "<u8").tobytes(),
        ]
        footer = json.dumps({"bits": self.bits, "block": BLOCK, "docs": len(self.doc_ids), "tokens": self.tokens,
                             "blocks": len(self.blocks), "index_at": self.at}).encode()
        for part in (*index, footer, np.array([len(footer)], "<u4").tobytes(), MAGIC):
            self.out.write(part)
        self.out.close()


class ShardReader:
    """Random access to one file: any range of ids costs the blocks it touches."""

    def __init__(self, path: str):
        filesystem, inner = fs.FileSystem.from_uri(path)
        self.file = filesystem.open_input_file(inner)
        size = self.file.size()
        tail = self.file.read_at(len(MAGIC) + 4, size - len(MAGIC) - 4)
        length = int(np.frombuffer(tail[:4], "<u4")[0])
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        self.meta = json.loads(self.file.read_at(length, size - len(MAGIC) - 4 - length))
        n, b, at = self.meta["docs"], self.meta["blocks"], self.meta["index_at"]
        raw = self.file.read_at(17 * n + 8 * b, at)
        self.doc_ids = np.frombuffer(raw, "<i8", n)
        self.nulls = np.frombuffer(raw, "u1", n, 8 * n)
        self.starts = np.append(np.frombuffer(raw, "<u8", n, 9 * n), np.uint64(self.meta["tokens"])).astype(np.int64)
        self.blocks = np.append(np.frombuffer(raw, "<u8", b, 17 * n), np.uint64(at)).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids ``start`` to ``stop`` of this file."""
        if stop <= start:
            return np.zeros(0, "<u4")
        size = self.meta["block"]
        low, high = start // size, (stop - 1) // size + 1
        data = self.file.read_at(int(self.blocks[high] - self.blocks[low]), int(self.blocks[low]))
        count = min(high * size, self.meta["tokens"]) - low * size
        return unpack(data, self.meta["bits"], count)[start - low * size : stop - low * size]

    def document(self, k: int) -> np.ndarray:
        """All ids of the ``k``-th document of this file."""
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_column: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """Encode ``docs`` and write one file per range of ids; returns the manifest with each file's first id number.

    The rows are dealt by id range before they are encoded, so texts move once and ids never. Every attempt
    of a task writes a file of its own; the manifest names those of the attempts that counted. Extra columns
    are left behind.
    """
    size = fresh(docs, "length")
    body = (
        docs.select(docs[id_column].cast("bigint").alias("doc_id"), text_column(docs, text).alias("text"))
        .withColumn(size, F.length("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), size, "text")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, coder, writer = TaskContext.get(), encoder(tokenizer), None
        shard = context.partitionId()
        filesystem, inner = fs.FileSystem.from_uri(folder)
        name = f"{shard:06d}-{context.taskAttemptId()}"
        final, draft = f"shard-{name}.bin", f"draft-{name}"
        bits, end = bits_for(max(coder.vocab_size, end_id + 1)), np.array([end_id], "<u4")
        first = None
        for batch in batches:
            names = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for some in in_slices(list(zip(names, texts, strict=True)), ENCODED):
                for (doc_id, _), raw in zip(some, coder.encode([t for _, t in some]), strict=True):
                    if writer is None:
                        filesystem.create_dir(inner, recursive=True)
                        writer, first = ShardWriter(filesystem, f"{inner}/{draft}", bits), doc_id
                    writer.add(doc_id, np.concatenate([np.frombuffer(raw, "<u4"), end]))
        if writer is not None:
            writer.close()
            filesystem.move(f"{inner}/{draft}", f"{inner}/{final}")
            yield pa.RecordBatch.from_pydict(
                {"path": [f"{folder}/{final}"], "docs": [len(writer.doc_ids)], "tokens": [writer.tokens],
                 "first_null": [first is None], "first_id": [first], "shard": [shard]},
                schema=pa.schema([("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()),
                                  ("first_null", pa.bool_()), ("first_id", pa.int64()), ("shard", pa.int64())]))

    spark = docs.sparkSession
    # One row a file: counts and paths only.
    files = sorted(body.mapInArrow(write, MANIFEST).collect(), key=lambda r: r.shard)
    start, rows = 0, []
    for f in files:
        rows.append((f.path, start, f.docs, f.tokens))
        start += f.tokens
    manifest = spark.createDataFrame(rows, "path string, start bigint, docs bigint, tokens bigint")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return manifest


def read_token_files(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document from the files: doc_id, start (ids of all documents before it), n_tokens, crc32, ids.

    Without ``with_ids`` the ids are read and checked but not handed on. Repeated and NULL ids are
    documents of their own; a manifest without files gives no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = ShardReader(path)
                for some in in_slices(list(range(reader.meta["docs"])), ENCODED):
                    low = int(reader.starts[some[0]])
                    flat = reader.ids(low, int(reader.starts[some[-1] + 1]))
                    ids = [flat[int(reader.starts[k]) - low : int(reader.starts[k + 1]) - low].tobytes() for k in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if reader.nulls[k] else int(reader.doc_ids[k]) for k in some], pa.int64()),
                         pa.array([base + int(reader.starts[k]) for k in some], pa.int64()),
                         pa.array([len(raw) // 4 for raw in ids], pa.int64()),
                         pa.array([zlib.crc32(raw) for raw in ids], pa.int64()), pa.array(ids if with_ids else [None] * len(ids), pa.binary())], schema=schema)

    files = manifest.select("path", "start")
    return files.repartition(max(1, files.count())).mapInArrow(read, READ)
