"""Divergence of a language's sources: exact term counts by a perfect hash, compared source by source."""

from __future__ import annotations

import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import arrow_session, numbered, settle
from shelfline.llm.perfect_hash import PerfectHash, hashes_of, shard_of

MIN_DOCS = 10
TOP = 10
SHARD_TERMS = 1 << 15  # terms of a shard, about
BLOCK_TERMS = 1 << 10  # terms and
TILE = 64  # sources that meet in one step
ROUND_BYTES = 64 << 20  # shards broadcast at once, about; more shards take more rounds over the texts
BUFFER_TERMS = 200_000  # counted terms a task holds before they are looked up
DENSE_BYTES = 64 << 20  # slots a task holds before it hands them on

# Term characters are ASCII letters and all code points from 0x80; only A to Z are lowered.
_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

ENTRY = "struct<tile:int, place:int, slot:int, n:bigint>"


def terms_of(text: str) -> list[bytes]:
    """The text's terms as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each (lang, term), added up inside the task as long as they are few."""
    seen: dict[str, Counter] = defaultdict(Counter)

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, c in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()),
                                              pa.array(list(c.values()), pa.int64())], names=["lang", "term", "docs"])
        seen.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen[lang].update(set(terms_of(text)))
        if sum(map(len, seen.values())) > 5 * BUFFER_TERMS:
            yield from rows()
    yield from rows()


def _build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for lang, shard, shards, terms in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            table = PerfectHash([t.encode() for t in terms])
            out.append((lang, shard, shards, len(terms), pickle.dumps(table), [t.decode() for t in table.terms.to_pylist()]))
        columns = zip(*out, strict=True) if out else ([] for _ in range(6))
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)],
                                         names=["lang", "shard", "shards", "size", "table", "terms"])


class _Slots:
    """Dense counts of each (lang, source) and shard, incremented by the terms' slots."""

    def __init__(self, tables: dict[str, dict[int, PerfectHash]], shards: dict[str, int]):
        self.tables, self.shards = tables, shards
        self.dense: dict[tuple[str, str, int], np.ndarray] = {}
        self.bytes = 0

    def add(self, counted: dict[tuple[str, str], Counter]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, list[str]] = defaultdict(list)
        for lang, source in counted:
            by_lang[lang].append(source)
        for lang, sources in by_lang.items():
            tables = self.tables.get(lang)
            if not tables:
                continue
            terms = list(set().union(*(counted[lang, s] for s in sources)))
            hashes = hashes_of(terms)
            shard, slot = shard_of(hashes, self.shards[lang]), np.full(len(terms), -1, np.int64)
            for k, table in tables.items():
                own = np.flatnonzero(shard == k)
                slot[own] = table.slots([terms[i] for i in own], hashes[own])
            where = {t: i for i, t in enumerate(terms)}
            for source in sources:
                c = counted[lang, source]
                at = np.fromiter(map(where.__getitem__, c), np.int64, len(c))
                n = np.fromiter(c.values(), np.int64, len(c))
                n, at = n[slot[at] >= 0], at[slot[at] >= 0]
                for k in np.unique(shard[at]).tolist():
                    key, own = (lang, source, k), shard[at] == k
                    if key not in self.dense:
                        self.dense[key] = np.zeros(len(tables[k].terms), np.int64)
                        self.bytes += self.dense[key].nbytes
                    self.dense[key][slot[at[own]]] += n[own]
                if self.bytes > DENSE_BYTES:
                    yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (lang, source, shard), counts in self.dense.items():
            at = np.flatnonzero(counts)
            if len(at):
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(at), pa.string()), "source": pa.array([source] * len(at), pa.string()),
                    "shard": np.full(len(at), shard, np.int32), "slot": at.astype(np.int32), "n": counts[at]})
        self.dense.clear()
        self.bytes = 0


def _recount(spark, body: DataFrame, shards: DataFrame) -> DataFrame:
    """Counts of the terms of the given shards in every (lang, source), from the texts."""
    tables: dict[str, dict[int, PerfectHash]] = defaultdict(dict)
    number: dict[str, int] = {}
    for r in shards.select("lang", "shard", "shards", "table").toLocalIterator():
        tables[r["lang"]][r["shard"]] = pickle.loads(r["table"])
        number[r["lang"]] = r["shards"]
    shared = spark.sparkContext.broadcast((dict(tables), number))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, counted = _Slots(*shared.value), defaultdict(Counter)
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if lang in slots.tables:
                    counted[lang, source].update(terms_of(text))
            if sum(map(len, counted.values())) > BUFFER_TERMS:
                yield from slots.add(counted)
                counted.clear()
        yield from slots.add(counted)
        yield from slots.rows()

    return body.mapInArrow(count, "lang string, source string, shard int, slot int, n bigint")


def exact_rate(n: str, total: str) -> Column:
    """1 + floor(10^9 * (n + 2) / total) of two columns in three steps of long division; 64 bits hold totals below 9 * 10^15."""
    rest, out = f"({n} + 2)", "1"
    for place in (1_000_000, 1_000, 1):
        out = f"{out} + ({rest} * 1000) div {total} * {place}L"
        rest = f"(({rest} * 1000) % {total})"
    return F.expr(out)


def _rates(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same for a matrix of counts, one total a row."""
    rest, out = counts + 2, np.ones_like(counts)
    for place in (1_000_000, 1_000, 1):
        rest = rest * 1000
        out += rest // total[:, None] * place
        rest %= total[:, None]
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one block of terms for all pairs of two tiles of sources."""
    for batch in batches:
        low, high = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        entries = batch.column(6)
        langs, firsts, seconds, values = [], [], [], []
        for i, (lang, width, a, b) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 3, 4, 5)), strict=True)):
            cells = entries[i].values
            tile, place, slot, n = (cells.field(k).to_numpy() for k in range(4))
            rates = []
            for members, own in ((a, tile == low[i]), (b, tile == high[i])):
                counts = np.zeros((len(members), width), np.int64)
                counts[place[own], slot[own]] = n[own]
                rates.append(_rates(counts, np.array([m["total"] for m in members], np.int64)))
            for x, p in enumerate(rates[0]):
                skip = x + 1 if low[i] == high[i] else 0
                q = rates[1][skip:]
                value = ((p - q) ** 2 // (p + q)).sum(axis=1)
                langs += [lang] * len(q)
                firsts += [a[x]["source"]] * len(q)
                seconds += [m["source"] for m in b[skip:]]
                values.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(firsts, pa.string()), pa.array(seconds, pa.string()),
                                          pa.array(np.concatenate(values) if values else [], pa.int64())], names=["lang", "first", "second", "value"])


def audit_sources(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP,
                  shard_terms: int = SHARD_TERMS, round_bytes: int = ROUND_BYTES, tile: int = TILE, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """How far a language's sources lie apart (part ``pair``), and each source's most telling terms (part ``term``).

    A first pass counts the documents of each term of a language; terms in ``min_docs`` or more are kept and dealt
    to shards, each a minimal perfect hash with its terms stored. The shards are broadcast, as many as
    ``round_bytes`` holds, and a second pass over the texts adds every verified hit to the slots of its source;
    a larger vocabulary takes several rounds. Sources meet in tiles of ``tile``, block of terms by block, so no
    task holds all terms or all sources of a language. Rates and sums are whole numbers, exact at any size.

    NULL lang, source and text count as the empty text. A group without a kept term takes part with counts of
    0; a language without kept terms gives pairs of value 0 and no terms. Repeated rows count each. Ties of
    value ascend by the item's UTF-8 bytes. An empty table gives no rows; extra columns are left behind; very
    long texts are taken whole.
    """
    spark = arrow_session(docs.sparkSession)
    body = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = settle(body.select("lang", "text").mapInArrow(_frequencies, "lang string, term string, docs bigint")
                  .groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term"), "terms")
    sizes = settle(kept.groupBy("lang").agg(F.count("*").alias("v")), "sizes")
    dealt = kept.join(sizes, "lang").withColumn("shards", F.ceil(F.col("v") / shard_terms).cast("int"))
    shards = settle(
        dealt.groupBy("lang", F.pmod(F.xxhash64("term"), "shards").cast("int").alias("shard"), "shards").agg(F.collect_list("term").alias("terms"))
        .select("lang", "shard", "shards", "terms")
        .mapInArrow(_build_shards, "lang string, shard int, shards int, size int, table binary, terms array<string>"), "shards")

    held = shards.agg(F.sum(F.octet_length("table"))).first()[0] or 0
    rounds = max(1, -(-held // round_bytes))
    turn = F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds))
    found = None
    for k in range(rounds):
        part = _recount(spark, body, shards.where(turn == k))
        found = part if found is None else found.unionByName(part)
    counts = settle(found.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n")), "counts")

    groups = body.select("lang", "source").distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = settle(groups.join(sums, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", (F.coalesce("n", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("total"), F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("v", F.lit(0)).alias("v")), "groups")
    placed = numbered(groups, ["lang", "source"], "place")
    first = placed.groupBy("lang").agg(F.min("place").alias("first"), F.sum("n").alias("of_lang"))
    seat = F.col("place") - F.col("first")
    info = settle(placed.join(first, "lang").select(
        "lang", "source", "total", (F.col("of_lang") + 2 * F.col("v")).alias("lang_total"),
        F.floor(seat / tile).cast("int").alias("tile"), (seat % tile).cast("int").alias("place")), "groups")

    pairs = _pairs(counts, info, shards, tile, block_terms)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    by_term = _telling(counts, info, shards).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return by_pair.unionByName(by_term)


def _pairs(counts: DataFrame, info: DataFrame, shards: DataFrame, tile: int, block_terms: int) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's sources."""
    tiles = info.groupBy("lang", "tile").agg(F.sort_array(F.collect_list(F.struct("place", "source", "total"))).alias("members"))
    last = tiles.groupBy("lang").agg(F.max("tile").alias("last"))
    # A language without a term has one block without a term, so that its pairs appear.
    spans = last.join(shards.select("lang", "shard", "size"), "lang", "left").select(
        "lang", F.coalesce("shard", F.lit(0)).alias("shard"), F.coalesce("size", F.lit(0)).alias("size"))
    blocks = spans.select("lang", "shard", "size", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / block_terms) - 1, F.lit(0)))).alias("block"))
    width = F.least(F.lit(block_terms), F.col("size") - F.col("block") * block_terms).cast("int")
    low = tiles.select("lang", F.col("tile").alias("low"), F.col("members").alias("a"))
    high = tiles.select("lang", F.col("tile").alias("high"), F.col("members").alias("b"))
    entry = F.lit(None).cast(ENTRY)
    frames = low.join(high, "lang").where("low <= high").join(blocks, "lang").select(
        "lang", "shard", F.col("block").cast("int"), "low", "high", width.alias("width"), "a", "b", entry.alias("entry"))
    seats = info.select("lang", "source", "tile", "place").join(last, "lang")
    other = F.explode(F.sequence(F.lit(0), F.col("last")))
    cells = counts.join(seats, ["lang", "source"]).select(
        "lang", "shard", F.floor(F.col("slot") / block_terms).cast("int").alias("block"), "tile", other.alias("other"),
        F.struct("tile", "place", (F.col("slot") % block_terms).cast("int").alias("slot"), "n").cast(ENTRY).alias("entry"))
    none = F.lit(None)
    cells = cells.select("lang", "shard", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
                         none.cast("int").alias("width"), none.cast(tiles.schema["members"].dataType).alias("a"),
                         none.cast(tiles.schema["members"].dataType).alias("b"), "entry")
    met = frames.unionByName(cells).groupBy("lang", "shard", "block", "low", "high").agg(
        F.max("width").alias("width"), F.first("a", True).alias("a"), F.first("b", True).alias("b"), F.collect_list("entry").alias("entries"))
    sums = met.select("lang", "low", "high", "width", "a", "b", "entries").mapInArrow(
        _compare, "lang string, first string, second string, value bigint").groupBy("lang", "first", "second").agg(F.sum("value").alias("value"))
    sums = settle(sums, "pairs")
    return sums.select("lang", F.col("first").alias("source"), F.col("second").alias("item"), "value").unionByName(
        sums.select("lang", F.col("second").alias("source"), F.col("first").alias("item"), "value"))


def _telling(counts: DataFrame, info: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms more frequent in the source than in its language."""
    named = shards.select("lang", "shard", F.posexplode("terms").alias("slot", "item"))
    overall = counts.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("overall"))
    terms = named.join(overall, ["lang", "shard", "slot"])
    rated = counts.join(terms, ["lang", "shard", "slot"]).join(info, ["lang", "source"]).select(
        "lang", "source", "item", exact_rate("n", "total").alias("p"), exact_rate("overall", "lang_total").alias("q"))
    return rated.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
words AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
groups AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v FROM (SELECT DISTINCT lang FROM groups) g),
counted AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM groups LEFT JOIN counted USING (lang, source) GROUP BY ALL),
rates AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                 CAST(1 + 1000000000 * CAST(coalesce(c.n, 0) + 2 AS HUGEINT) // (t.n + 2 * v.v) AS BIGINT) AS p
          FROM groups g JOIN kept k USING (lang) JOIN totals t USING (lang, source) JOIN v USING (lang) LEFT JOIN counted c USING (lang, source, term)),
overall AS (SELECT lang, term, CAST(1 + 1000000000 * CAST(sum(n) + 2 AS HUGEINT) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v.v)) AS BIGINT) AS q
            FROM counted JOIN v USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
                     FROM rates x JOIN rates y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
          ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
telling AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM rates JOIN overall USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
           UNION ALL
           SELECT lang, source, 'term', item, CAST(value AS BIGINT), row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM telling)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
