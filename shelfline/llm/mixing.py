"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents are dealt into blocks; a source's target becomes whole passes over its blocks plus
a part of a permuted pass. The exact block quotas of all sources are then split recursively among the output
shards, so every shard holds a hypergeometric share of each source; the shard's blocks are a run of the
permuted order, disjoint from all others, and its documents are shuffled within the shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import fresh, settle, text_column

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_PASSES = 2.0
BLOCK_DOCS = 64
SHARDS = 64
BINS = 1024
# Up to so many sources the mix is designed on the driver and broadcast; beyond, it is a settled table (``_Many``).
MOST_SOURCES = 10_000
WORDS = r"[^\x20\x09-\x0D]+"


def targets_of(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_PASSES) -> dict[str | None, float]:
    """Words wanted of each source: weights repeat over sources by code point (NULL last); what exceeds
    ``most`` times a source's size is reshared by weight among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), list(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if weight[s] * unit > most * sizes[s]]
        if not above:
            return out | {s: weight[s] * unit for s in open_}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """``quotas`` (one whole number a source) dealt to ``shards`` rows whose totals differ by one at most."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(have: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[low] = have
            return
        mid = (low + high) // 2
        total = int(have.sum())
        left = total * (mid - low) // (high - low)
        part = rng.multivariate_hypergeometric(have, left, method="marginals") if total else have
        split(part, low, mid)
        split(have - part, mid, high)

    split(np.asarray(quotas, np.int64), 0, shards)
    return out


@dataclass
class Source:
    """What the mix decides for one source."""

    name: str | None
    size: int
    docs: int
    target: float
    blocks: int
    factor: int
    shift: int
    passes: int = 0
    rest: float = 0.0
    low: int = 0  # blocks of the part pass before this position are taken whole
    width: int = 0


def keyed(docs: DataFrame, seed: int, id_column: str, source: str, text: str) -> tuple[Column, Column]:
    """(words, random key) of a row, from its contents alone."""
    return (F.coalesce(F.regexp_count(docs[text], F.lit(WORDS)), F.lit(0)).cast("bigint"),
            F.xxhash64(F.lit(seed), docs[id_column], docs[source], text_column(docs, text)))


def _position(key: Column) -> Column:
    """The place of the key's block in the source's permuted order."""
    return F.pmod(F.pmod(key, F.col("blocks")) * F.col("factor") + F.col("shift"), F.col("blocks"))


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))


def _sources(rows: DataFrame, seed: int, weights, share, most, block_docs) -> list[Source] | None:
    """The sources in order, None when they are more than ``MOST_SOURCES``."""
    found = _sizes(rows).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        return None
    sizes = {r["source"]: r["size"] for r in found}
    target, rng, out = targets_of(sizes, weights, share, most), np.random.default_rng(seed), []
    for r in sorted(found, key=lambda r: (r["source"] is None, r["source"] or "")):
        n = math.ceil(r["docs"] / block_docs)
        factor = int(rng.integers(1, n + 1))
        while math.gcd(factor, n) != 1:
            factor = factor % n + 1
        s = Source(r["source"], r["size"], r["docs"], target[r["source"]], n, factor, int(rng.integers(0, n)))
        s.passes = int(s.target // s.size) if s.size else 0
        s.rest, s.width = s.target - s.passes * s.size, n
        out.append(s)
    return out


def _table(spark, sources: Iterable[Source], more: dict | None = None) -> DataFrame:
    rows = [(s.name, s.size, s.target, s.blocks, s.factor, s.shift, s.passes, s.rest, s.low, s.width, (more or {}).get(s.name)) for s in sources]
    return spark.createDataFrame(rows, "of string, source_size bigint, target double, blocks bigint, factor bigint, shift bigint, passes int, "
                                       "rest double, low bigint, width bigint, ends array<bigint>")


def _with(rows: DataFrame, table: DataFrame, few: bool = True) -> DataFrame:
    """Rows with their source's decisions; at most ``MOST_SOURCES`` rows are broadcast."""
    return rows.join(F.broadcast(table) if few else table, rows["source"].eqNullSafe(table["of"])).drop("of")


def _narrow_down(rows: DataFrame, sources: list[Source]) -> None:
    """Find each source's last block: bins of the permuted order, then bins of the bin, down to one block."""
    while any(s.width > 1 for s in sources):
        wide = [s for s in sources if s.width > 1]
        step = F.ceil(F.col("width") / BINS).cast("bigint")
        at = _with(rows, _table(rows.sparkSession, wide)).withColumn("at", _position(F.col("key")) - F.col("low")).where("at >= 0 AND at < width")
        bins = at.groupBy("source", "rest", (F.col("at") / step).cast("bigint").alias("bin")).agg(F.sum("size").alias("words"))
        order = Window.partitionBy("source").orderBy("bin")
        ends = bins.withColumn("end", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        edge = {r["source"]: r for r in ends.where("end > rest AND end - words <= rest").collect()}
        for s in wide:
            size = math.ceil(s.width / BINS)
            hit = edge.get(s.name)
            if hit is None:  # no bin goes beyond what is wanted: all of the range is taken
                s.low, s.width = s.low + s.width, 0
            else:
                s.low, s.rest, s.width = s.low + hit["bin"] * size, s.rest - (hit["end"] - hit["words"]), min(size, s.width - hit["bin"] * size)
                if hit["words"] == 0:
                    s.width = 0


def _numbered(sizes: DataFrame) -> DataFrame:
    """Sources by code point (NULL last) with their row number from 0; no task sees more than a range of them."""
    parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source")]
    at = F.monotonically_increasing_id()
    ranged = settle(sizes.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", at), "mix-sources")
    part = F.shiftright("at", 33)
    before, starts = 0, []
    for r in sorted(ranged.groupBy(part.alias("part")).count().collect(), key=lambda r: r["part"]):
        starts.append((r["part"], before))
        before += r["count"]
    starts = sizes.sparkSession.createDataFrame(starts, "part bigint, before bigint")
    return ranged.withColumn("part", part).join(F.broadcast(starts), "part").withColumn(
        "number", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "before", "at")


def _with_targets(numbered: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``targets_of`` as aggregate rounds: the words of a unit weight only rise, and so close ever more sources."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights)).cast("int") + 1)
    table = settle(numbered.withColumn("weight", weight), "mix-weights")
    total = table.agg(F.sum("size")).first()[0]
    closed, unit = F.lit(False), None
    known = -1
    while True:
        r = table.agg(F.sum(F.when(~closed, F.col("weight"))), F.coalesce(F.sum(F.when(closed, F.col("size"))), F.lit(0)),
                      F.count(F.when(closed, 1))).first()
        if r[0] is None or r[2] == known:
            break
        known, unit = r[2], (share * total - most * r[1]) / r[0]
        closed = F.col("weight") * F.lit(unit) > F.lit(float(most)) * F.col("size")
    return table.withColumn("target", F.when(closed, F.lit(float(most)) * F.col("size")).otherwise(F.col("weight") * F.lit(unit)))


def _coprime(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        factor, blocks = batch["factor"].to_numpy(np.int64).copy(), batch["blocks"].to_numpy(np.int64)
        while (bad := np.gcd(factor, blocks) != 1).any():
            factor[bad] = factor[bad] % blocks[bad] + 1
        batch["factor"] = factor
        yield batch


def _many_sources(rows: DataFrame, seed: int, weights, share, most, block_docs) -> DataFrame:
    """What ``_sources`` and ``_narrow_down`` decide, as a settled table of one row a source."""
    draw = lambda k: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull()), F.col("blocks"))
    table = _with_targets(_numbered(_sizes(rows)), weights, share, most).withColumn("blocks", F.ceil(F.col("docs") / block_docs).cast("bigint"))
    passes = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("int")
    table = table.select(F.col("source").alias("of"), "number", F.col("size").alias("source_size"), "target", "blocks", (draw(1) + 1).alias("factor"),
                         draw(2).alias("shift"), passes.alias("passes"), (F.col("target") - passes * F.col("size")).alias("rest"),
                         F.lit(0).cast("bigint").alias("low"), F.col("blocks").alias("width"))
    table = settle(table.mapInPandas(_coprime, table.schema), "mix-table")
    while table.agg(F.max("width")).first()[0] > 1:
        bin_size = F.ceil(F.col("width") / BINS).cast("bigint")
        at = _with(rows, table.where("width > 1"), few=False).withColumn("at", _position(F.col("key")) - F.col("low")).where("at >= 0 AND at < width")
        bins = at.groupBy("source", "rest", (F.col("at") / bin_size).cast("bigint").alias("bin")).agg(F.sum("size").alias("words"))
        order = Window.partitionBy("source").orderBy("bin")
        ends = bins.withColumn("end", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        edge = ends.where("end > rest AND end - words <= rest").select(F.col("source").alias("source_of"), "bin", (F.col("end") - F.col("words")).alias("gone"))
        met = table.join(edge, table["of"].eqNullSafe(edge["source_of"]), "left")
        open_, hit = F.col("width") > 1, F.col("bin").isNotNull()
        table = settle(met.select(
            "of", "number", "source_size", "target", "blocks", "factor", "shift", "passes",
            F.when(open_ & hit, F.col("rest") - F.col("gone")).otherwise(F.col("rest")).alias("rest"),
            F.when(open_ & hit, F.col("low") + F.col("bin") * bin_size).when(open_, F.col("low") + F.col("width")).otherwise(F.col("low")).alias("low"),
            F.when(open_ & hit, F.least(bin_size, F.col("width") - F.col("bin") * bin_size)).when(open_, F.lit(0)).otherwise(F.col("width"))
            .cast("bigint").alias("width")), "mix-table")
    return table


def _with_ends(table: DataFrame, shards: int, seed: int) -> DataFrame:
    """The table with every source's shard ends. Groups of sources, ``MOST_SOURCES`` at most, are split like sources;
    in each group the sources then share out the group's places, which gives the same distribution."""
    quota, group = F.col("passes") * F.col("blocks") + F.col("low") + F.col("width"), F.pmod(F.col("number"), F.lit(MOST_SOURCES))
    table = table.withColumn("quota", quota.cast("bigint")).withColumn("group", group)
    sums = sorted(tuple(r) for r in table.groupBy("group").agg(F.sum("quota")).collect())
    dealt = split_quotas(np.array([q for _, q in sums], np.int64), shards, np.random.default_rng(seed + 1))
    places = table.sparkSession.createDataFrame([(g, [int(x) for x in column]) for (g, _), column in zip(sums, dealt.T, strict=True)],
                                                "group bigint, places array<bigint>")

    def share_out(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("number")
        left, rng, ends = np.array(part["places"].iloc[0], np.int64), np.random.default_rng([seed + 2, int(key[0])]), []
        for quota in part["quota"]:
            mine = rng.multivariate_hypergeometric(left, int(quota), method="marginals") if quota else np.zeros_like(left)
            left = left - mine
            ends.append(mine.cumsum().tolist())
        return pd.DataFrame({"number_of": part["number"], "ends": ends})

    ends = table.select("group", "number", "quota").join(F.broadcast(places), "group").groupBy("group").applyInPandas(
        share_out, "number_of bigint, ends array<bigint>")
    return settle(table.join(ends, table["number"] == ends["number_of"]).drop("number_of", "number", "quota", "group"), "mix-table")


def _fill(keys: tuple, block: pd.DataFrame) -> pd.DataFrame:
    """Documents of one last block, in random order, as long as they fit, then the one that comes nearest to the rest."""
    left, take = float(block["rest"].iloc[0]), []
    block = block.sort_values("key")
    sizes, counts = block["size"].tolist(), block["n"].tolist()
    for size, n in zip(sizes, counts, strict=True):
        k = min(n, int(left // size)) if size else 0
        left -= k * size
        take.append(k)
    spare = [(abs(left - sizes[i]), i) for i in range(len(take)) if take[i] < counts[i]]
    if spare and min(spare)[0] < left:
        take[min(spare)[1]] += 1
    return pd.DataFrame({"source_of": block["source"], "key_of": block["key"], "take": take, "n_of": block["n"]})


def decide(docs: DataFrame, seed: int = 1, weights=WEIGHTS, share: float = SHARE, most: float = MOST_PASSES, block_docs: int = BLOCK_DOCS,
           shards: int = SHARDS, id_column: str = "doc_id", source: str = "source", text: str = "text"):
    """The mix of ``docs`` as (settled narrow rows, function that adds ``draws`` to rows of source, key, size).

    ``draws`` lists the shard of every time the document is drawn, none to ``most``.
    """
    spark = docs.sparkSession
    size, key = keyed(docs, seed, id_column, source, text)
    rows = settle(docs.select(docs[id_column].alias("doc_id"), docs[source].cast("string").alias("source"), size.alias("size"), key.alias("key")), "mix")
    sources = _sources(rows, seed, weights, share, most, block_docs)
    few = sources is not None
    if few:
        _narrow_down(rows, sources)
        ending = _table(spark, [s for s in sources if s.width == 1])
    else:
        many = _many_sources(rows, seed, weights, share, most, block_docs)
        ending = many.where("width = 1")
    last = _with(rows, ending, few).withColumn("at", _position(F.col("key"))).where("at = low")
    filled = settle(last.groupBy("source", "key", "size", "rest").agg(F.count("*").alias("n")).groupBy("source").applyInPandas(
        _fill, "source_of string, key_of bigint, take bigint, n_of bigint").where("take > 0"), "last-blocks")
    # Block draws of each source: whole passes, then the part pass with its last, partly drawn block.
    if few:
        quotas = np.array([s.passes * s.blocks + s.low + s.width for s in sources], np.int64)
        dealt = split_quotas(quotas, shards, np.random.default_rng(seed + 1)) if len(sources) else np.zeros((shards, 0), np.int64)
        ends = {s.name: [int(x) for x in column] for s, column in zip(sources, dealt.cumsum(axis=0).T, strict=True)}
        table = _table(spark, sources, ends)
    else:
        table = _with_ends(many, shards, seed)
    split = filled.where("take < n_of")
    some_split = not split.isEmpty()

    def draw(rows: DataFrame) -> DataFrame:
        placed = _with(rows, table, few).withColumn("at", _position(F.col("key")))
        # One block of documents a source at most.
        placed = placed.join(F.broadcast(filled) if few else filled, placed["source"].eqNullSafe(filled["source_of"]) & (placed["key"] == filled["key_of"]), "left")
        if some_split:  # equal rows of which only some fit: the first of them
            among = Window.partitionBy("source", "key").orderBy("key")
            part = F.col("take") < F.col("n_of")
            placed = placed.where(~F.coalesce(part, F.lit(False))).withColumn("turn", F.lit(0)).unionByName(
                placed.where(part).withColumn("turn", F.row_number().over(among)))
        else:
            placed = placed.withColumn("turn", F.lit(0))
        extra = (F.col("at") < F.col("low")) | ((F.col("width") == 1) & (F.col("at") == F.col("low")) & (F.col("turn") <= F.coalesce("take", F.lit(0)))
                                                & F.col("take").isNotNull())
        passes = F.col("passes") + F.when(extra, 1).otherwise(0)
        shard = lambda e: F.size(F.filter("ends", lambda end: end <= e * F.col("blocks") + F.col("at")))
        draws = F.when(passes > 0, F.transform(F.sequence(F.lit(0), F.greatest(passes - 1, F.lit(0))), shard)).otherwise(F.array().cast("array<int>"))
        return placed.withColumn("draws", draws).drop("blocks", "factor", "shift", "passes", "rest", "low", "width", "ends", "at", "turn", "take",
                                                      "n_of", "source_of", "key_of")

    return rows, draw


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, draws of every row, without its text.

    NULL and empty texts have size 0 and are drawn with the whole passes of their source; NULL sources are one
    source, last in order. NULL, tied and repeated ids are drawn row by row; of equal rows any may be the
    one that fits. An empty table gives no rows; extra columns are left behind.
    """
    rows, draw = decide(docs, **options)
    return draw(rows).drop("key")


def mix(docs: DataFrame, seed: int = 1, id_column: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mixed corpus: a row for every draw, all columns of ``docs``, in the order of shards and shuffled within them."""
    _, draw = decide(docs, seed=seed, id_column=id_column, source=source, text=text, **options)
    size, key = keyed(docs, seed, id_column, source, text)
    whole = fresh(docs, "row")
    carried = docs.select(F.struct(*docs.columns).alias(whole), docs[source].cast("string").alias("source"), size.alias("size"), key.alias("key"))
    drawn = draw(carried).select(whole, "key", F.posexplode("draws").alias("turn", "shard"))
    shuffled = drawn.withColumn("order", F.xxhash64(F.lit(seed), "key", "turn"))
    return shuffled.repartitionByRange("shard", "order").sortWithinPartitions("shard", "order").select(f"{whole}.*")
