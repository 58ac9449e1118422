"""Exact top-k by inner product: ball trees per shard, branch and bound, shared k-th scores."""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import settle

SHARD_ROWS = 8192
QUERY_ROWS = 256
LEAF_ROWS = 128
NONE = np.iinfo(np.int64).max


def _blob(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _arrays(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as f:
        return {k: f[k] for k in f.files}


def build_tree(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """A ball tree in arrays: per node centre, radius, range of points, least id, children (-1: leaf)."""
    order = np.arange(len(ids))
    centre, radius, span, least, child = [], [], [], [], []

    def grow(start: int, stop: int) -> int:
        own = order[start:stop]
        part = points[own]
        mid = part.mean(axis=0)
        away = ((part - mid) ** 2).sum(axis=1)
        node = len(radius)
        centre.append(mid)
        radius.append(math.sqrt(away.max()))
        span.append((start, stop))
        least.append(ids[own].min())
        child.append((-1, -1))
        if stop - start > leaf and radius[node] > 0:
            far = part[away.argmax()]
            other = part[((part - far) ** 2).sum(axis=1).argmax()]
            side = part @ (other - far)
            half = (stop - start) // 2
            order[start:stop] = own[np.argpartition(side, half)]
            child[node] = (grow(start, start + half), grow(start + half, stop))
        return node

    grow(0, len(ids))
    return {"ids": ids[order], "points": points[order], "centre": np.array(centre).reshape(len(radius), -1), "radius": np.array(radius),
            "span": np.array(span, np.int64), "least": np.array(least, np.int64), "child": np.array(child, np.int64)}


def _scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: floating point while it is exact, else 64-bit integers."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(points).max(initial=0)) * max(1, queries.shape[1])
    if top < 2.0**53:
        return (queries @ points.T).astype(np.int64)
    return queries.astype(np.int64) @ points.astype(np.int64).T


def search_tree(tree: dict[str, np.ndarray], query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray, floor_id: np.ndarray):
    """Best ``k`` of the tree for each query: scores (rows x k) and ids, NONE where there are fewer.

    Nodes are taken in the order of their upper bound ``q.c + |q| r`` for the best query that still needs
    them. A query leaves a node that cannot beat its k-th result here or the k-th result (``floor``,
    ``floor_id``) it brought from another shard; equal scores are worth a visit only for a smaller id.
    """
    n = len(query_ids)
    length = np.sqrt((queries**2).sum(axis=1))
    score = np.full((n, k), np.iinfo(np.int64).min)
    found = np.full((n, k), NONE)
    worst, worst_id = floor.copy(), floor_id.copy()

    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        value = queries[rows] @ tree["centre"][node] + length[rows] * tree["radius"][node]
        return np.floor(value + 1e-9 * np.abs(value) + 1e-6)

    def needed(high: np.ndarray, node: int, rows: np.ndarray) -> np.ndarray:
        return (high > worst[rows]) | ((high == worst[rows]) & (tree["least"][node] < worst_id[rows]))

    rows = np.arange(n)
    queue = [(-float(bound(0, rows).max(initial=0)), 0, rows)] if n else []
    while queue:
        _, node, rows = heapq.heappop(queue)
        rows = rows[needed(bound(node, rows), node, rows)]
        if not len(rows):
            continue
        left, right = tree["child"][node]
        if left >= 0:
            for c in (left, right):
                heapq.heappush(queue, (-float(bound(c, rows).max()), int(c), rows))
            continue
        start, stop = tree["span"][node]
        ids = tree["ids"][start:stop]
        new = _scores(queries[rows], tree["points"][start:stop])
        good = ((new > worst[rows, None]) | ((new == worst[rows, None]) & (ids[None, :] < worst_id[rows, None]))) & (ids[None, :] != query_ids[rows, None])
        hit = good.any(axis=1)
        rows, new, good = rows[hit], new[hit], good[hit]
        if not len(rows):
            continue
        low = np.iinfo(np.int64).min
        all_scores = np.concatenate([score[rows], np.where(good, new, low)], axis=1)
        all_ids = np.concatenate([found[rows], np.where(good, ids[None, :], NONE)], axis=1)
        best = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]
        score[rows], found[rows] = np.take_along_axis(all_scores, best, 1), np.take_along_axis(all_ids, best, 1)
        full = found[rows, -1] != NONE
        better = full & ((score[rows, -1] > worst[rows]) | ((score[rows, -1] == worst[rows]) & (found[rows, -1] < worst_id[rows])))
        worst[rows[better]], worst_id[rows[better]] = score[rows[better], -1], found[rows[better], -1]
    return score, found, worst, worst_id


def _matrix(values: pd.Series, dim: int) -> np.ndarray:
    return np.array(values.tolist(), np.float64).reshape(len(values), dim)


def whole_vectors(vectors: DataFrame, scale: int, id_column: str, vector: str) -> DataFrame:
    """vec_id, v (floor of ``scale`` times each component), dim; rows that cannot take part are left out."""
    rows = vectors.select(vectors[id_column].cast("bigint").alias("vec_id"), F.transform(vectors[vector], lambda x: x.cast("double")).alias("x"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & fine).select(
        "vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("double")).alias("v"), F.size("x").alias("dim"))


def top_k(vectors: DataFrame, asks: str = "vec_id % 50 = 0", k: int = 5, scale: int = 256, id_column: str = "vec_id", vector: str = "embedding",
          shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` largest inner products of each query with all other rows.

    ``asks`` is a condition on vec_id. Rows are dealt at random to shards of about ``shard_rows``, queries to
    blocks of about ``query_rows``; a block meets every shard, one pair of blobs at a time, so memory is
    bounded by the two. The first shard's k-th scores go with the queries to all other shards.

    NULL ids, NULL vectors and vectors with NULL or non-finite components take no part. Vectors meet those of
    their own length only. A repeated id is one query (its least vector); no row is a result of a query of its
    own id, other queries see every repeat. Ties go to the smaller id. An empty table gives no rows; extra
    columns are left behind. Scores are exact within 63 bits.
    """
    rows = settle(whole_vectors(vectors, scale, id_column, vector), "vectors")
    asked = settle(rows.where(asks).groupBy("vec_id", "dim").agg(F.min("v").alias("v")).withColumn(
        "one", F.row_number().over(Window.partitionBy("vec_id").orderBy("dim"))).where("one = 1").drop("one"), "queries")
    # One row for each vector length.
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("parts"))
    wants = asked.groupBy("dim").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("wants"))

    def shard(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = build_tree(group["vec_id"].to_numpy(np.int64), _matrix(group["v"], keys[0]))
        return pd.DataFrame({"dim": [keys[0]], "part": [keys[1]], "tree": [_blob(**tree)]})

    def block(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
        n = len(group)
        low = np.full(n, np.iinfo(np.int64).min)
        data = _blob(ids=group["vec_id"].to_numpy(np.int64), points=_matrix(group["v"], keys[0]), floor=low, floor_id=np.full(n, NONE))
        return pd.DataFrame({"dim": [keys[0]], "block": [keys[1]], "asked": [data]})

    numbered = rows.withColumn("at", F.monotonically_increasing_id()).join(sizes, "dim")
    trees = settle(numbered.withColumn("part", F.pmod(F.xxhash64("at"), F.col("parts")).cast("int")).groupBy("dim", "part").applyInPandas(
        shard, "dim int, part int, tree binary"), "trees")
    blocks = asked.join(wants, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("wants")).cast("int")).groupBy(
        "dim", "block").applyInPandas(block, "dim int, block int, asked binary")

    def search(keep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    tree, q = _arrays(batch.column("tree")[row].as_py()), _arrays(batch.column("asked")[row].as_py())
                    score, found, worst, worst_id = search_tree(tree, q["ids"], q["points"], k, q["floor"], q["floor_id"])
                    real = found != NONE
                    out = {"query_id": np.repeat(q["ids"], real.sum(axis=1)), "vec_id": found[real], "score": score[real]}
                    if keep:
                        blob = _blob(ids=q["ids"], points=q["points"], floor=worst, floor_id=worst_id)
                        hits = _blob(**out)
                        yield pa.RecordBatch.from_pydict({"dim": batch.column("dim").slice(row, 1), "block": batch.column("block").slice(row, 1),
                                                          "asked": pa.array([blob], pa.binary()), "hits": pa.array([hits], pa.binary())})
                    else:
                        yield pa.RecordBatch.from_pydict(out)

        return run

    def hits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict(_arrays(raw))

    first = settle(
        blocks.join(trees.where("part = 0"), "dim").repartition("dim", "block").mapInArrow(search(True), "dim int, block int, asked binary, hits binary"), "first")
    others = first.join(sizes.where("parts > 1"), "dim").select("dim", "asked", F.explode(F.expr("sequence(1, parts - 1)")).alias("part"))
    schema = "query_id bigint, vec_id bigint, score bigint"
    rest = others.join(trees, ["dim", "part"]).select("dim", "asked", "tree").mapInArrow(search(False), schema)
    hits = rest.unionByName(first.select("hits").mapInArrow(hits_of, schema))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
