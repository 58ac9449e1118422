"""N-gram Jaccard join by chosen paths.

Sets of word shingles are collapsed to distinct sets, then split recursively on sampled shared tokens: each
node of a path picks one or two min-wise tokens, so that a pair of Braun-Blanquet similarity ``threshold`` or
more (every pair of that Jaccard is one) keeps one common child on average. Small buckets are compared pair
by pair on their sketches; runs are repeated until the target recall. What may be similar is then compared
exactly, in bounded blocks, and only classes and link counts leave a block, never all pairs.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import fresh, mixed, settle, text_column
from shelfline.llm.components import components

THRESHOLD = 0.8
SHINGLE_WORDS = 5
RECALL = 0.9999  # of one pair at the threshold, over all runs
DEPTH = 6  # levels of a path
BUCKET = 512  # sets a bucket may hold to be compared pair by pair
SKETCH = 128  # min-wise tokens of a set
DENSE = 0.4  # mean share of equal min-wise tokens that makes a large bucket one group of near copies
PROBES = 16  # tokens compared for that
SLACK = 0.16  # a sketch estimate this far below the threshold still counts as maybe similar
BLOCK = 256  # sets of a cluster compared with another such block in one go
FORK = 1 / THRESHOLD - 1  # chance of a second child: 1 / threshold children on average
COLUMNS = 8192  # tokens multiplied in one step

_ODD = mixed(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_FACTORS = mixed(np.arange(1, SKETCH + 1, dtype=np.uint64) + np.uint64(1 << 32)) | np.uint64(1)


def shingles(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; a text with fewer words is one shingle."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    known: dict[bytes, int] = {}
    codes = []
    for w in words:
        code = known.get(w)
        if code is None:
            code = known[w] = xxhash.xxh3_64_intdigest(w)
        codes.append(code)
    h = np.array(codes, np.uint64)
    with np.errstate(over="ignore"):
        if len(h) < size:
            return mixed(np.array([(h * _ODD[: len(h)]).sum(dtype=np.uint64) + np.uint64(len(h))]))
        total = np.zeros(len(h) - size + 1, np.uint64)
        for k in range(size):
            total += h[k : len(h) - size + 1 + k] * _ODD[k]
    return np.unique(mixed(total))


def fingerprint(tokens: np.ndarray) -> bytes:
    """128 bits naming the set."""
    with np.errstate(over="ignore"):
        pair = [mixed(tokens ^ np.uint64(c)).sum(dtype=np.uint64) for c in (0x1234567, 0x89ABCDEF)]
    return np.array(pair, "<u8").tobytes()


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The least 32-bit hash of the set under each of ``SKETCH`` orders."""
    low = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(tokens), 1024):
        with np.errstate(over="ignore"):
            part = (tokens[i : i + 1024, None] * _FACTORS) >> np.uint64(32)
        low = np.minimum(low, part.min(axis=0).astype(np.uint32))
    return low


def survival(depth: int, threshold: float) -> float:
    """Least chance that a pair at the threshold still shares a node ``depth`` levels down one run."""
    alive = 1.0
    for _ in range(depth):
        lost = 1 - threshold * alive
        alive = 1 - (1 - FORK) * lost - FORK * lost**2
    return alive


def runs_for(recall: float, depth: int = DEPTH, threshold: float = THRESHOLD) -> int:
    """Runs needed for the recall of a pair at the threshold."""
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(depth, threshold)))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, nodes, sizes, sketched, short = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            tokens = shingles(text)
            if not len(tokens):
                for column in (prints, nodes, sizes, sketched, short):
                    column.append(None)
                continue
            own, low = fingerprint(tokens), sketch(tokens)
            prints.append(own)
            nodes.append(int(np.frombuffer(own, "<i8", 1)[0]))
            sizes.append(len(tokens))
            sketched.append(low.astype("<u4").tobytes())
            short.append(low.astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints, pa.binary()), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                                          pa.array(sketched, pa.binary()), pa.array(short, pa.binary())],
                                         names=["doc_id", "text_hash", "print", "node", "tokens", "sketch", "short"])


def _groups(batches: Iterator[pa.RecordBatch], keys: int, solve: Callable, least: int = 2048) -> Iterator:
    """Call ``solve`` on every run of equal leading ``keys`` columns of a sorted stream; holds the open run only."""
    kept: list[pa.RecordBatch] = []

    def flush(table: pa.Table, final: bool) -> tuple[list, pa.Table | None]:
        columns = [table.column(i).to_numpy() for i in range(keys)]
        n = table.num_rows
        new = np.ones(n, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        if not final:
            starts, ends = starts[:-1], ends[:-1]
        done = int(ends[-1]) if len(ends) else 0
        return solve(table, starts, ends), table.slice(done) if done < n else None

    rows = 0
    for batch in batches:
        if batch.num_rows:
            kept.append(batch)
            rows += batch.num_rows
        if rows >= least:
            out, rest = flush(pa.Table.from_batches(kept).combine_chunks(), False)
            yield from out
            kept = rest.to_batches() if rest is not None else []
            rows = sum(b.num_rows for b in kept)
            least = max(least, 2 * rows)
    if kept:
        yield from flush(pa.Table.from_batches(kept).combine_chunks(), True)[0]


def _roots(near: np.ndarray) -> np.ndarray:
    """The first member of each member's component, from a symmetric matrix of links."""
    n = len(near)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] < 0:
            root[i] = i
            edge = np.array([i])
            while len(edge):
                edge = np.flatnonzero(near[edge].any(axis=0) & (root < 0))
                root[edge] = i
    return root


def _bucket_edges(least_equal: int) -> Callable:
    """Per bucket, a star from the first member to all members its sketch links reach."""

    def solve(table: pa.Table, starts: np.ndarray, ends: np.ndarray) -> list[pa.RecordBatch]:
        if not len(starts):
            return []
        nodes = table.column(1).to_numpy()
        marks = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint8).reshape(-1, SKETCH)
        a, b = [], []
        pairs = starts[ends - starts == 2]
        hit = pairs[(marks[pairs] == marks[pairs + 1]).sum(axis=1) >= least_equal]
        a.append(nodes[hit])
        b.append(nodes[hit + 1])
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            if e - s > 2:
                own = marks[s:e]
                near = np.concatenate([(own[i : i + 32, None, :] == own[None, :, :]).sum(axis=2) >= least_equal for i in range(0, e - s, 32)])
                root = _roots(near)
                a.append(nodes[s:e])
                b.append(nodes[s + root])
        first, second = np.concatenate(a), np.concatenate(b)
        real = first != second
        return [pa.RecordBatch.from_arrays([pa.array(first[real]), pa.array(second[real])], names=["a", "b"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _groups(batches, 1, solve)

    return run


def candidate_edges(sets: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, bucket: int = BUCKET, depth: int = DEPTH) -> DataFrame:
    """Edges (a, b) between nodes that some run of the tree brought together and whose sketches look similar.

    ``sets``: node, sketch, short. A large bucket whose sets resemble its least one on average is a group of near
    copies that no token splits: it is joined as it is, as are buckets still too large at the last level. All
    of their sets go to the exact comparison.
    """
    roots = []
    for run in range(runs_for(recall, depth, threshold)):
        draw = int(mixed(np.array([1000 + run], np.uint64))[0])
        roots += [(2 * run, draw % SKETCH)] + ([(2 * run + 1, draw // SKETCH % SKETCH)] if (draw >> 40) % 1000 < 1000 * FORK else [])

    def token(position):
        return F.substring("sketch", 4 * position + 1, 4)

    rows = sets.select("node", F.explode(F.array(*(F.xxhash64(F.lit(j), token(p)) for j, p in roots))).alias("key"))
    leaves, stars = [], []
    for level in range(1, depth + 1):
        counts = settle(rows.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("lead")).where("n > 1"), "buckets")
        leaves.append(rows.join(counts.where(F.col("n") <= bucket).select("key").hint("merge"), "key").select("key", "node"))
        large = counts.where(F.col("n") > bucket)
        if large.isEmpty():
            break
        if level == depth:
            stars.append(rows.join(large.select("key", "lead"), "key").select(F.col("node").alias("a"), F.col("lead").alias("b")))
            break
        # The sets of large buckets take their sketch along, so the table of sets is visited once.
        crowd = rows.join(large.select("key", "lead"), "key")
        crowd = settle(crowd if level > 1 else crowd.join(sets.select("node", "sketch"), "node"), "crowd")
        whole = _dense(crowd)
        stars.append(crowd.join(whole, "key").select(F.col("node").alias("a"), F.col("lead").alias("b")))
        again = crowd.join(whole, "key", "left_anti")
        child = lambda i: F.xxhash64("key", F.lit(i), F.expr(
            f"substring(sketch, CAST(4 * pmod(xxhash64(key, {i}), {SKETCH}) + 1 AS INT), 4)"))
        fork = F.pmod(F.xxhash64("key", F.lit(99)), F.lit(1000)) < int(1000 * FORK)
        rows = settle(again.select("node", "sketch", F.explode(F.when(fork, F.array(child(1), child(2))).otherwise(F.array(child(1)))).alias("key")), "paths")
    members = leaves[0]
    for more in leaves[1:]:
        members = members.unionByName(more)
    keyed = members.join(sets.select("node", "short").hint("merge"), "node").select("key", "node", "short")
    found = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(
        _bucket_edges(math.ceil((threshold - SLACK) * SKETCH)), "a bigint, b bigint")
    for star in stars:
        found = found.unionByName(star)
    return found


def _dense(crowd: DataFrame) -> DataFrame:
    """The keys of large buckets whose sets share ``DENSE`` of their sampled tokens with the bucket's least set."""
    lead = crowd.where("node = lead").select("key", F.col("sketch").alias("lead_sketch")).dropDuplicates(["key"])
    at = [4 * i * (SKETCH // PROBES) + 1 for i in range(PROBES)]
    equal = [(F.substring("sketch", i, 4) == F.substring("lead_sketch", i, 4)).cast("int") for i in at]
    share = functools.reduce(operator.add, equal) / F.lit(PROBES)
    return settle(crowd.join(lead, "key").groupBy("key").agg(F.avg(share).alias("share")).where(F.col("share") >= DENSE).select("key"), "dense")


def _exact(threshold: float) -> Callable:
    """Per pair of blocks: one row a set with the links it has there, and the root of its component there."""

    def one(table: pa.Table, s: int, e: int) -> list[tuple]:
        prints = table.column(3).slice(s, e - s).to_pylist()
        block = table.column(4).slice(s, e - s).to_numpy()
        copies = table.column(5).slice(s, e - s).to_numpy().astype(np.float64)
        sets = [np.frombuffer(raw, "<u4") for raw in table.column(6).slice(s, e - s).to_pylist()]
        within = table.column(1)[s].as_py() == table.column(2)[s].as_py()
        n, sizes = e - s, np.array([len(x) for x in sets], np.float64)
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(n), sizes.astype(np.int64))
        value, where, count = np.unique(tokens, return_inverse=True, return_counts=True)
        shared = np.cumsum(count > 1) - 1
        column = np.where(count > 1, shared, -1)[where]
        use = column >= 0
        column, owner = column[use], owner[use]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        common = np.zeros((n, n), np.float32)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            i, j = np.searchsorted(column, [low, low + COLUMNS])
            part = np.zeros((n, min(COLUMNS, int(column[j - 1]) + 1 - low)), np.float32)
            part[owner[i:j], column[i:j] - low] = 1
            common += part @ part.T
        near = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-6
        np.fill_diagonal(near, False)
        if not within:
            near &= block[:, None] != block[None, :]
        links = near @ copies
        root = _roots(near)
        return [(prints[i], prints[root[i]], int(links[i])) for i in range(n) if links[i]]

    def solve(table: pa.Table, starts: np.ndarray, ends: np.ndarray) -> list[pa.RecordBatch]:
        rows = [row for s, e in zip(starts.tolist(), ends.tolist(), strict=True) if e - s > 1 for row in one(table, s, e)]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        return [pa.RecordBatch.from_arrays([pa.array(list(columns[0]), pa.binary()), pa.array(list(columns[1]), pa.binary()),
                                            pa.array(list(columns[2]), pa.int64())], names=["print", "root", "links"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _groups(batches, 3, solve, least=64)

    return run


def _member_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 32-bit tokens of the texts that are the member they were joined to."""
    for batch in batches:
        keep, raw = [], []
        for k, (text, own) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            tokens = shingles(text)
            if len(tokens) and fingerprint(tokens) == own:
                keep.append(k)
                raw.append((tokens >> np.uint64(32)).astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(keep, pa.int64())), pa.array(raw, pa.binary())], names=["print", "set"])


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, bucket: int = BUCKET, block: int = BLOCK,
                      id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_copies.

    Documents whose shingle sets have a Jaccard similarity of ``threshold`` or more are linked; a class is a
    connected component of links, named by its least doc_id. ``n_links`` counts the linked documents, those
    with the same set included; ``n_copies`` counts the documents with the same set. A set hashed to 32 bits
    a token decides the exact comparison (two of a pair's tokens meet by chance once in ten thousand pairs).

    A text without words (NULL, empty, white space) is a class of its own without links. NULL ids stand
    for documents too; a class of NULL ids only has a NULL name. Repeated rows are copies of each other. An
    empty table gives no rows; extra columns are left behind.
    """
    return classified(docs, threshold, recall, bucket, block, id_column, text).select("doc_id", "class_id", "n_links", "n_copies")


def one_of_each_class(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without all but one document of each class: the least id (then the least hash of its text).

    Texts without words are classes of their own and all stay. Of repeated rows one stays.
    """
    found = classified(docs, threshold, recall, id_column=id_column, text=text)
    chosen = found.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("c"))
    ident, mark, bare, turn = (fresh(docs, n) for n in ("id", "hash", "bare", "turn"))
    keep = chosen.select("c.doc_id", "c.text_hash", F.lit(False).alias(bare)).unionByName(
        found.where("root IS NULL").select("doc_id", "text_hash", F.lit(True).alias(bare)).distinct()).toDF(ident, mark, bare)
    same = docs[id_column].cast("bigint").eqNullSafe(F.col(ident)) & (F.xxhash64(text_column(docs, text)) == F.col(mark))
    order = Window.partitionBy(ident, mark).orderBy(mark)
    return docs.join(keep, same).withColumn(turn, F.row_number().over(order)).where(F.col(bare) | (F.col(turn) == 1)).select(docs.columns)


def classified(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, bucket: int = BUCKET, block: int = BLOCK,
               id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``similar_documents`` with the hash of the text and the class's root set (NULL without words)."""
    named = docs.select(docs[id_column].cast("bigint").alias("doc_id"), text_column(docs, text).alias("text"))
    sketched = settle(named.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _sketches, "doc_id bigint, text_hash bigint, print binary, node bigint, tokens bigint, sketch binary, short binary"), "sketches")
    sets = settle(
        sketched.where("print IS NOT NULL").groupBy("print").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("node").alias("node"),
            F.first("sketch").alias("sketch"), F.first("short").alias("short")), "sets")
    clusters = components(candidate_edges(sets, threshold, recall, bucket))
    sized = clusters.join(clusters.groupBy("root").agg(F.count("*").alias("size")), "root")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / block)).cast("int")
    members = settle(
        sets.select("print", "first_id", "copies", "node").join(sized, "node")
        .select("print", "first_id", "copies", F.col("root").alias("cluster"), blocks.alias("blocks"))
        .withColumn("block", F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")), "members")
    of = members.select("print", "first_id")
    texts = named.join(of.hint("merge"), F.col("doc_id").eqNullSafe(F.col("first_id"))).select("text", "print")
    compact = texts.mapInArrow(_member_sets, "print binary, set binary").dropDuplicates(["print"])
    dealt = (
        members.drop("first_id").join(compact, "print")
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "print", "block", "copies", "set")
    )
    compared = settle(
        dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(_exact(threshold), "print binary, root binary, links bigint"),
        "links")
    many = members.where("blocks > 1").select("print")
    # One block's components are final; those of several blocks are joined by their shared members.
    whole = compared.join(many, "print", "left_anti").select("print", "root")
    spread = components(compared.join(many, "print", "left_semi").select(F.col("print").alias("a"), F.col("root").alias("b")))
    roots = whole.unionByName(spread.select(F.col("node").alias("print"), "root"))
    links = compared.groupBy("print").agg(F.sum("links").alias("links"))
    placed = sets.select("print", "first_id", "copies").join(roots, "print", "left").join(links, "print", "left").withColumn(
        "root", F.coalesce("root", "print"))
    names = placed.groupBy("root").agg(F.min("first_id").alias("class_id"))
    known = placed.join(names, "root").select("print", "root", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                                              F.col("copies").alias("n_copies"))
    return sketched.select("doc_id", "text_hash", "print").join(known, "print", "left").select(
        "doc_id", "text_hash", "root", F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"))
