"""Removal of repeated passages: windows of words meet in the bucket of their minimiser, packed as super-k-mers."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import arrow_session, mixed, settle, text_column

WINDOW = 50  # words
GRAM = 8  # words of a minimiser
MOST_WINDOWS = 128  # of one packed string; longer runs are cut, which parts no two equal windows
# A bucket met more often than this is counted window by window over all tasks.
HOT_BUCKET = 1000
CHUNK_BYTES = 8 << 20  # packed strings that a task sorts at once, about
HELD_BYTES = 32 << 20  # packed strings that a task holds to drop repeats before they travel
BITS_PER_KEY = 12
MOST_BITS = 1 << 29  # of a broadcast filter; beyond it the filter passes more, and nothing is lost


@dataclass
class Runs:
    """Super-k-mers of a list of texts: text, first window, number of windows, bucket of each."""

    words: list[list[bytes]]
    text: np.ndarray
    first: np.ndarray
    count: np.ndarray
    bucket: np.ndarray


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` consecutive values."""
    done = 1
    n = len(values) - span + 1
    while 2 * done <= span:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:n], values[span - done : span - done + n])


def super_kmers(texts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> Runs:
    """Runs of consecutive windows whose least word-gram hash is the same; every window lies in exactly one."""
    words = [t.split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    known = list(set().union(*words))
    none = np.zeros(0, np.int64)
    if sizes.sum() < window or not known:
        return Runs(words, none, none, none, none)
    code = {w: i for i, w in enumerate(known)}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    flat = hashes[np.fromiter(map(code.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(sizes.sum()))]
    n = len(flat)
    with np.errstate(over="ignore"):
        grams = flat[: n - gram + 1].copy()
        for k in range(1, gram):
            grams *= np.uint64(0x9E3779B97F4A7C15)
            grams += flat[k : n - gram + 1 + k]
    least = mixed(_least(mixed(grams), window - gram + 1)).view(np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)
    at = np.flatnonzero(np.arange(n - window + 1) + window <= ends[owner[: n - window + 1]])
    if not len(at):
        return Runs(words, none, none, none, none)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (least[at[1:]] != least[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])
    starts = np.flatnonzero(new)
    inside = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    starts = np.flatnonzero(inside % MOST_WINDOWS == 0)
    count = np.diff(np.append(starts, len(at)))
    text = owner[at[starts]]
    return Runs(words, text, at[starts] - (ends - sizes)[text], count, least[at[starts]])


def places(buckets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two filter positions of each bucket; a bucket number is a well mixed hash."""
    raw = buckets.view(np.uint64)
    return (raw & np.uint64(bits - 1)).astype(np.int64), ((raw >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)


class BucketFilter:
    """A bit filter over bucket numbers, without false negatives."""

    def __init__(self, bits: int):
        self.bits = bits
        self.bytes = np.zeros(max(1, bits // 8), np.uint8)

    def has(self, buckets: np.ndarray) -> np.ndarray:
        one, two = (self.bytes[p >> 3] >> (p & 7).astype(np.uint8) & 1 for p in places(buckets, self.bits))
        return (one & two).astype(bool)

    @classmethod
    def of(cls, keys: DataFrame, most_bits: int = MOST_BITS) -> BucketFilter:
        """The filter of column ``bucket``, put together from 4 KB bitmaps; its size follows the number of keys up to ``most_bits``."""
        bits = 1 << 15
        wanted = keys.count() * BITS_PER_KEY
        while bits < min(wanted, most_bits):
            bits *= 2
        out = cls(bits)
        both = F.array(*[place.bitwiseAND(F.lit(bits - 1)) + 1 for place in (F.col("bucket"), F.shiftrightunsigned("bucket", 32))])
        maps = keys.select(F.explode(both).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map"))
        for r in maps.toLocalIterator():
            out.bytes[(r["part"] - 1) * 4096 : r["part"] * 4096] |= np.frombuffer(bytes(r["map"]), np.uint8)[: len(out.bytes)]
        return out


def _buckets(window: int, gram: int):
    """Bucket, least and greatest doc_id, number of super-k-mers; one row a bucket and batch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = super_kmers([t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()], window, gram)
            ids = batch.column(0).to_numpy()[runs.text]
            order = np.argsort(runs.bucket, kind="stable")
            bucket, ids = runs.bucket[order], ids[order]
            at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else order
            yield pa.RecordBatch.from_pydict({
                "bucket": bucket[at], "low": np.minimum.reduceat(ids, at) if len(at) else ids, "high": np.maximum.reduceat(ids, at) if len(at) else ids,
                "n": np.diff(np.append(at, len(ids)))})

    return scan


CANDIDATES = "doc_id bigint, text string, first array<int>, count array<int>, bucket array<bigint>, pack array<binary>"


def _candidates(shared, window: int, gram: int, wanted: bool):
    """Texts with a super-k-mer in a shared bucket, and those runs with the hash of their packed words; or the other texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            runs = super_kmers(texts, window, gram)
            passed = np.flatnonzero(shared.value.has(runs.bucket))
            held = np.zeros(len(texts), dtype=bool)
            held[runs.text[passed]] = True
            rows = pa.array(np.flatnonzero(held == wanted))
            ids = batch.column(0).take(rows)
            if not wanted:
                words = [runs.words[i] for i in rows.to_pylist()]
                yield pa.RecordBatch.from_arrays([ids, pa.array(list(map(len, words)), pa.int64()), pa.array([b" ".join(w) for w in words], pa.string())],
                                                 names=["doc_id", "n_words", "kept"])
                continue
            text, first, count = runs.text[passed], runs.first[passed], runs.count[passed]
            packs = [xxhash.xxh3_128_digest(b" ".join(runs.words[t][a : a + n])) for t, a, n in zip(text.tolist(), first.tolist(), (count + window - 1).tolist(), strict=True)]
            offsets = np.append(np.searchsorted(text, np.flatnonzero(held)), len(text)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v, t)) for v, t in (
                (first, pa.int32()), (count, pa.int32()), (runs.bucket[passed], pa.int64()), (packs, pa.binary()))]
            yield pa.RecordBatch.from_arrays([ids, batch.column(1).take(rows), *lists], names=["doc_id", "text", "first", "count", "bucket", "pack"])

    return scan


def _packed(hot, window: int, wanted: bool):
    """The packed strings of the candidates' runs in hot buckets, or of the others; repeats in a task travel once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def rows() -> pa.RecordBatch:
            own = list(held.values())
            out = pa.RecordBatch.from_arrays([
                pa.array(list(held), pa.binary()), pa.array([r[0] for r in own], pa.int64()), pa.array([r[1] for r in own], pa.string()),
                pa.array([r[2] for r in own], pa.int64()), pa.array([r[3] for r in own], pa.int64())], names=["pack", "bucket", "words", "low", "high"])
            held.clear()
            return out

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            firsts, counts, buckets, packs = (batch.column(k) for k in range(2, 6))
            for i, (doc, text) in enumerate(zip(ids, texts, strict=True)):
                bucket = buckets[i].values.to_numpy()
                chosen = np.flatnonzero(hot.value.has(bucket) == wanted).tolist()
                if not chosen:
                    continue
                words, first, count, pack = text.encode("utf-8", "surrogatepass").split(), firsts[i].as_py(), counts[i].as_py(), packs[i].as_py()
                for k in chosen:
                    old = held.get(pack[k])
                    if old is None:
                        run = b" ".join(words[first[k] : first[k] + count[k] + window - 1])
                        held[pack[k]] = [int(bucket[k]), run, doc, doc]
                        size += len(run) + 100
                    else:
                        old[2], old[3] = min(old[2], doc), max(old[3], doc)
                if size > HELD_BYTES:
                    yield rows()
                    size = 0
        yield rows()

    return scan


def window_names(codes: np.ndarray, window: int) -> np.ndarray:
    """A number for each window of word codes, the same for equal windows only: names of 1, 2, 4, ... words are paired."""
    names, span = codes, 1
    while span < window:
        step = min(span, window - span)
        pair = names[: len(names) - step] * (int(names.max(initial=0)) + 1) + names[step:]
        names = pd.factorize(pair)[0].astype(np.int64)
        span += step
    return names


def count_windows(packs: dict[bytes, list], window: int) -> tuple[list[bytes], list[np.ndarray]]:
    """Packed strings with a window that starts in a smaller document than some of theirs, and each window's least document.

    ``packs`` maps the hash of a packed string to (words, low, high): its words and the least and greatest
    document it stands in.
    """
    words = [r[0].split() for r in packs.values()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    known: dict[bytes, int] = {w: i for i, w in enumerate(set().union(*words))}
    codes = np.fromiter(map(known.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)
    at = np.flatnonzero(np.arange(len(codes)) + window <= ends[owner])
    names, owner = window_names(codes, window)[at], owner[at]
    low = np.fromiter((r[1] for r in packs.values()), np.int64, len(words))[owner]
    high = np.fromiter((r[2] for r in packs.values()), np.int64, len(words))
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    least = np.empty(len(at), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(low[order], first), np.diff(np.append(first, len(at))))
    edges = np.searchsorted(owner, np.arange(len(words) + 1))
    told = np.flatnonzero(np.minimum.reduceat(least, edges[:-1]) < high)
    keys = list(packs)
    return [keys[i] for i in told.tolist()], [least[edges[i] : edges[i + 1]] for i in told.tolist()]


def _verdict(packs: dict[bytes, list], window: int) -> pa.RecordBatch:
    keys, lows = count_windows(packs, window) if packs else ([], [])
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lows])]).astype(np.int32)
    values = pa.array(np.concatenate(lows) if lows else np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), values)], names=["pack", "lows"])


def _count_buckets(window: int):
    """Verdicts of whole buckets; rows come sorted by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        last, size = None, 0
        for batch in batches:
            for pack, bucket, words, low, high in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if bucket != last and size > CHUNK_BYTES:
                    yield _verdict(held, window)
                    held, size = {}, 0
                last = bucket
                old = held.get(pack)
                if old is None:
                    held[pack] = [words.encode("utf-8", "surrogatepass"), low, high]
                    size += len(words) + 100
                else:
                    old[1], old[2] = min(old[1], low), max(old[2], high)
        yield _verdict(held, window)

    return count


def _windows(window: int):
    """Every window of a packed string by its 128-bit hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packs, ats, keys, lows = [], [], [], []
            for pack, text, low in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                words = raw.split()
                starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]).tolist()
                n = len(words) - window + 1
                keys += [xxhash.xxh3_128_digest(raw[starts[i] : starts[i + window] - 1]) for i in range(n)]
                packs += [pack] * n
                ats += range(n)
                lows += [low] * n
            yield pa.RecordBatch.from_arrays([pa.array(packs, pa.binary()), pa.array(ats, pa.int32()), pa.array(keys, pa.binary()), pa.array(lows, pa.int64())],
                                             names=["pack", "at", "key", "low"])

    return cut


def _cut_words(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, kept, spans = [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                away = np.zeros(len(words) + 1, np.int64)
                for part in found or ():
                    for r in part:
                        away[r["from"]] += 1
                        away[r["to"] + window] -= 1
                away = np.cumsum(away)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], away.view(np.int8), [0]])))
                spans.append([{"from": a, "to": b} for a, b in edges.reshape(-1, 2).tolist()])
                counts.append(len(words))
                gone.append(int(away.sum()))
                kept.append(b" ".join(w for w, x in zip(words, away.tolist(), strict=True) if not x))
            span = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span),
                                              pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "removed", "kept"])

    return cut


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                    hot_bucket: int = HOT_BUCKET, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, n_words, n_removed, removed (spans of words, end excluded), kept (the words left, one space between).

    A word goes when a window of ``window`` words over it also starts in a document of smaller id; windows are
    judged on the texts given. Each window belongs to the bucket of its minimiser, the least hash among its
    word-grams; consecutive windows of one bucket are one super-k-mer. A first pass finds the buckets that more
    than one document meets, kept as a broadcast bit filter of bounded size. Super-k-mers of those buckets
    travel to the bucket as one packed string each, collapsed to one a task, where all windows are named and
    sorted. Buckets met more than ``hot_bucket`` times are not brought to one task: their strings are
    made distinct, and their windows counted by 128-bit hash with map-side minima.

    NULL and empty texts have no words. NULL ids are neither smaller nor greater than any: their texts stay
    and remove nothing. Of repeated ids none is smaller; repeated rows are judged alike. Texts below ``window``
    words stay. Very long texts are cut into many super-k-mers. An empty table gives no rows; extra columns
    are left behind.
    """
    spark = arrow_session(docs.sparkSession)
    body = docs.select(docs[id_column].cast("bigint").alias("doc_id"), text_column(docs, text).alias("text"))
    known = body.where("doc_id IS NOT NULL")
    met = settle(known.mapInArrow(_buckets(window, gram), "bucket bigint, low bigint, high bigint, n bigint")
                 .groupBy("bucket").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
                 .where("low < high").select("bucket", "n"), "buckets")
    context = spark.sparkContext
    shared = context.broadcast(BucketFilter.of(met, most_bits))
    hot = context.broadcast(BucketFilter.of(met.where(F.col("n") > hot_bucket), most_bits))
    found = settle(known.mapInArrow(_candidates(shared, window, gram, True), CANDIDATES).withColumn("row", F.monotonically_increasing_id()), "candidates")

    strings = "pack binary, bucket bigint, words string, low bigint, high bigint"
    source = found.select("doc_id", "text", "first", "count", "bucket", "pack")
    verdicts = (
        source.mapInArrow(_packed(hot, window, False), strings).repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_count_buckets(window), "pack binary, lows array<bigint>")
    )
    distinct = settle(source.mapInArrow(_packed(hot, window, True), strings).groupBy("pack").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.first("words").alias("words")), "hot-strings")
    windows = settle(distinct.select("pack", "words", "low").mapInArrow(_windows(window), "pack binary, at int, key binary, low bigint"), "hot-windows")
    # A window of one string alone has the string's own least document: only the others come back.
    least = settle(windows.groupBy("key").agg(F.min("low").alias("least"), F.count("*").alias("n")).where("n > 1").select("key", "least"), "hot-least")
    told = windows.select("pack", "at", "key").join(least, "key").groupBy("pack").agg(
        F.map_from_entries(F.collect_list(F.struct("at", "least"))).alias("told"))
    sizes = windows.groupBy("pack").agg(F.count("*").cast("int").alias("n"))
    hot_verdicts = distinct.select("pack", "low", "high").join(sizes, "pack").join(told, "pack", "left").where("low < high OR told IS NOT NULL").select(
        "pack", F.expr("transform(sequence(0, n - 1), i -> coalesce(try_element_at(told, i), low))").alias("lows"))

    runs = found.select("row", "doc_id", F.explode(F.arrays_zip("pack", "first")).alias("r")).select("row", "doc_id", "r.pack", "r.first")
    gone = F.transform("lows", lambda low: low < F.col("doc_id"))
    spans = F.expr("""transform(arrays_zip(
        filter(sequence(0, size(gone) - 1), i -> gone[i] AND (i = 0 OR NOT gone[i - 1])),
        filter(sequence(0, size(gone) - 1), i -> gone[i] AND (i = size(gone) - 1 OR NOT gone[i + 1]))),
        x -> struct(first + x['0'] AS from, first + x['1'] AS to))""")
    removed = (
        runs.join(verdicts.unionByName(hot_verdicts), "pack").select("row", "first", gone.alias("gone")).where("exists(gone, g -> g)")
        .select("row", spans.alias("spans")).groupBy("row").agg(F.collect_list("spans").alias("spans"))
    )
    cut = found.select("row", "doc_id", "text").join(removed, "row", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut_words(window), "doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<from:int,to:int>>, kept string")
    others = "doc_id bigint, n_words bigint, kept string"
    whole = known.mapInArrow(_candidates(shared, window, gram, False), others).unionByName(_untouched(body.where("doc_id IS NULL"), others))
    return cut.unionByName(whole.select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"),
                                        F.array().cast("array<struct<from:int,to:int>>").alias("removed"), "kept"))


def _untouched(body: DataFrame, schema: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [t.encode("utf-8", "surrogatepass").split() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, words)), pa.int64()), pa.array([b" ".join(w) for w in words], pa.string())],
                                             names=["doc_id", "n_words", "kept"])

    return body.mapInArrow(scan, schema)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT row, doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS w FROM (SELECT *, unnest(range(1, len(words) - 48)) AS i FROM d)),
hit AS (SELECT row, i FROM (SELECT row, i, doc_id, min(doc_id) OVER (PARTITION BY w) AS least FROM windows) WHERE least < doc_id),
gone AS (SELECT row, list_sort(list(DISTINCT p)) AS away FROM (SELECT row, unnest(range(i, i + 50)) AS p FROM hit) GROUP BY row),
marked AS (SELECT d.row, doc_id, words, coalesce(away, []) AS away FROM d LEFT JOIN gone USING (row)),
left_over AS (SELECT row, list(word ORDER BY p) AS kept FROM (SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM marked) x
              ANTI JOIN (SELECT row, unnest(away) AS p FROM marked) y ON x.row = y.row AND x.p = y.p GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(away) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM marked LEFT JOIN left_over USING (row)
"""
