"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown to a fixed depth and stored as complete binary trees in flat arrays, so a whole batch of
documents walks down all trees with a few numpy gathers per level.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import settle, text_column
from shelfline.llm.textstats import base_stats, lines_with_words

# The fit reads at most this many labelled documents: those with the smallest hashes of their id.
FIT_ROWS = 20_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
PENALTY = 1.0
LEAST_WEIGHT = 2.0

FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "unique_share", "top_word_share",
            "upper_share", "digit_share", "stop_share", "comma_share", "mark_share", "pipe_share", "strong_share", "other_punct_share",
            "wide_share", "line_words", "short_word_share", "capital_word_share", "longest_word", "blank_share")
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_WIDE = bytes(range(128, 256))


def features(text: str) -> list[float]:
    """The document's statistics; all zero but for the empty text's constants."""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = raw.split(), lines_with_words(raw)
    n, chars, symbols, dup_lines, repeats = base_stats(text, raw, words, lines)
    size, total = max(1, len(raw)), max(1, n)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1

    def share(kind: bytes) -> float:
        return (len(raw) - len(raw.translate(None, kind))) / size

    return [math.log1p(n), chars / total, symbols / max(1, chars), dup_lines / max(1, len(lines)), repeats / total,
            len(counts) / total, max(counts.values(), default=0) / total, share(_UPPER), share(_DIGIT), raw.count(b".") / total,
            raw.count(b",") / total, (raw.count(b"!") + raw.count(b"?")) / total, raw.count(b"|") / total,
            (raw.count(b"#") + raw.count(b"*")) / total, share(b"%&$@+=/\\<>{}[]()_~^:;\"'-"), share(_WIDE),
            n / max(1, len(lines)), sum(len(w) <= 3 for w in words) / total, sum(w[:1].isupper() for w in words) / total,
            math.log1p(max(map(len, words), default=0)), (len(text) - chars) / max(1, len(text))]


@dataclass
class BoostedTrees:
    """Complete trees of ``depth`` levels; node ``i`` has children ``2i + 1`` and ``2i + 2``."""

    depth: int
    base: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # trees x inner nodes; a value above goes right
    leaf: np.ndarray  # trees x leaves

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> BoostedTrees:
        """Logistic loss; a table without both labels gives the constant of its one label, or one half."""
        inner, leaves = 2**depth - 1, 2**depth
        if len(y) == 0 or y.min() == y.max():
            base = 0.0 if len(y) == 0 else (4.0 if y[0] else -4.0)
            return cls(depth, base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        width = bins + 1
        rate0 = float(y.mean())
        base = math.log(rate0 / (1 - rate0))
        score = np.full(len(y), base)
        feature = np.zeros((trees, inner), np.int64)
        cut = np.full((trees, inner), np.inf)
        leaf = np.zeros((trees, leaves))
        for t in range(trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = p - y, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            for level in range(depth):
                count = 2**level
                gain = np.full((count, x.shape[1], width), -np.inf)
                for f in range(x.shape[1]):
                    slot = node * width + binned[:, f]
                    g = np.bincount(slot, grad, count * width).reshape(count, width).cumsum(axis=1)
                    h = np.bincount(slot, hess, count * width).reshape(count, width).cumsum(axis=1)
                    gt, ht = g[:, -1:], h[:, -1:]
                    value = g**2 / (h + PENALTY) + (gt - g) ** 2 / (ht - h + PENALTY) - gt**2 / (ht + PENALTY)
                    value[(h < LEAST_WEIGHT) | (ht - h < LEAST_WEIGHT)] = -np.inf
                    value[:, len(cuts[f]) :] = -np.inf
                    gain[:, f, :] = value
                best = gain.reshape(count, -1).argmax(axis=1)
                high = gain.reshape(count, -1).max(axis=1)
                which, where = best // width, best % width
                for k in range(count):
                    if high[k] > 1e-9:
                        feature[t, count - 1 + k], cut[t, count - 1 + k] = which[k], cuts[which[k]][where[k]]
                inner_at = count - 1 + node
                node = 2 * node + (x[np.arange(len(y)), feature[t, inner_at]] > cut[t, inner_at])
            g, h = np.bincount(node, grad, leaves), np.bincount(node, hess, leaves)
            leaf[t] = -rate * g / (h + PENALTY)
            score += leaf[t, node]
        return cls(depth, base, feature, cut, leaf)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        trees, rows = len(self.leaf), np.arange(len(x))[:, None]
        total = np.full(len(x), self.base)
        if trees:
            offset = np.arange(trees)[None, :] * self.feature.shape[1]
            node = np.zeros((len(x), trees), np.int64)
            feature, cut = self.feature.reshape(-1), self.cut.reshape(-1)
            for _ in range(self.depth):
                at = offset + node
                node = 2 * node + 1 + (x[rows, feature[at]] > cut[at])
            total += self.leaf.reshape(-1)[np.arange(trees)[None, :] * self.leaf.shape[1] + node - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def measure(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and its statistics as one array, by one pass over whole texts."""
    body = docs.select(docs[id_column].cast("bigint").alias("doc_id"), text_column(docs, text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[float(v) for v in features(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return body.mapInArrow(run, "doc_id bigint, x array<double>")


def learn_quality(measured: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> BoostedTrees:
    """Fit on measured documents that ``labels`` (doc_id, quality) marks.

    Rows of NULL id or label teach nothing; repeated labels of an id are averaged and rounded up from one half;
    of repeated ids one document counts. At most ``fit_rows`` rows, the smallest hashes of the ids, reach the driver.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        (F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("y"))
    # Expected to pass a fifth more labels than the bound, so that no task offers the limit a list of its own.
    span = 1 << 40
    below = int(min(1.0, 1.2 * fit_rows / max(1, marks.count())) * span)
    drawn = marks.withColumn("draw", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(span))).where(F.col("draw") < below)
    rows = (
        measured.where("doc_id IS NOT NULL").join(drawn, "doc_id")
        .orderBy("draw", "doc_id", "x").limit(fit_rows).select("doc_id", "x", "y").toPandas().drop_duplicates("doc_id")
    )
    x = np.array(rows["x"].tolist(), dtype=np.float64).reshape(len(rows), len(FEATURES))
    return BoostedTrees.fit(x, rows["y"].to_numpy(np.float64))


def score_quality(measured: DataFrame, model: BoostedTrees) -> DataFrame:
    """doc_id and score of every measured row.

    NULL and empty texts are scored by their (zero) statistics; NULL, tied and repeated ids row by row; an
    empty table gives no rows. Extra columns never get this far.
    """
    shared = measured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(1).to_pylist(), dtype=np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], names=["doc_id", "score"])

    return measured.mapInArrow(run, "doc_id bigint, score double")


def rate_documents(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Learn from ``labels`` and score every document; the statistics are computed once and settled."""
    measured = settle(measure(docs, id_column, text), "document-stats")
    return score_quality(measured, learn_quality(measured, labels, fit_rows))
