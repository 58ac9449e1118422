"""Language identification with bit-sliced Bloom filters over letter trigrams."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import STEP_CHARS, mixed, settle

UNKNOWN = "und"
SLOTS = 1 << 18  # positions of the filters; one word of language bits each
PROBES = 3
# Bounds of the fit: documents a language, and trigrams a language (the commonest of them).
DOCS_PER_LANGUAGE = 3000
GRAMS_PER_LANGUAGE = 8000
# A trigram belongs to a language when this share of its documents has it, and when its rate
# is at least this part of the highest rate among the languages.
DOC_SHARE = 0.01
RELATIVE_RATE = 0.2
SPACE = 32


@functools.cache
def _letters() -> np.ndarray:
    """Code point to lower-case letter, or to a space."""
    table = np.full(0x110000, SPACE, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Packed trigrams whose middle is a letter, in bounded steps; a word's ends count as spaces."""
    table = _letters()
    for at in range(0, len(text), STEP_CHARS):
        part = text[max(0, at - 2) : at + STEP_CHARS]
        points = table[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
        lead, tail = ([SPACE] if at == 0 else []), ([SPACE] if at + STEP_CHARS >= len(text) else [])
        points = np.concatenate([np.array(lead, np.int64), points, np.array(tail, np.int64)])
        if len(points) >= 3:
            gram = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
            yield gram[points[1:-1] != SPACE]


@dataclass
class LanguageFilters:
    """``slots[p, w]`` holds, bit by bit, the languages of word ``w`` that use position ``p``."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    typical: dict[str, float] = field(default_factory=dict)

    @classmethod
    def build(cls, grams: dict[str, np.ndarray]) -> LanguageFilters:
        languages = sorted(grams)
        width = max(1, (len(languages) + 63) // 64)
        slots = np.zeros((SLOTS, width), np.uint64)
        for k, name in enumerate(languages):
            bit = np.uint64(1) << np.uint64(k % 64)
            for at in positions(grams[name]):
                slots[at, k // 64] |= bit
        fill = np.array([((slots[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
        return cls(languages, slots, fill**PROBES)

    def popcounts(self, grams: np.ndarray) -> np.ndarray:
        """How many of the trigrams each language's filter has."""
        found = None
        for at in positions(grams):
            found = self.slots[at] if found is None else found & self.slots[at]
        return np.array([int(((found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).sum()) for k in range(len(self.languages))])

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score; ``und`` without a letter, or when no language was learned."""
        real = self.shares(text)
        if real is None:
            return UNKNOWN, 0.0
        best = int(np.argmax(real))
        return self.languages[best], float(min(1.0, max(0.0, real[best])))

    def shares(self, text: str | None) -> np.ndarray | None:
        """The part of the text's trigrams in each filter, less false hits; None without a letter or a language."""
        total, counts = 0, np.zeros(len(self.languages))
        for grams in trigrams(text or ""):
            total += len(grams)
            if len(grams) and self.languages:
                counts += self.popcounts(grams)
        if total == 0 or not self.languages:
            return None
        return (counts / total - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9)

    def score_of(self, text: str | None, language: str) -> float | None:
        """The score of one language, None where there is none."""
        real = self.shares(text) if language in self.languages else None
        return None if real is None else float(min(1.0, max(0.0, real[self.languages.index(language)])))

    def typical_of(self, language: str) -> float:
        """The typical score of the language's documents; 1 where none was learned."""
        return self.typical.get(language, 1.0)


def positions(grams: np.ndarray) -> list[np.ndarray]:
    """The filter positions of each trigram, one array a probe."""
    h = mixed(grams)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [((a + np.uint64(i) * b) % np.uint64(SLOTS)).astype(np.int64) for i in range(PROBES)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parts = [np.unique(g, return_counts=True) for g in trigrams(text)]
            if parts:
                gram, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                by.setdefault(lang, []).append((gram, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)))
        for lang, rows in by.items():
            gram, where = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
            uses = np.bincount(where, np.concatenate([r[1] for r in rows])).astype(np.int64)
            docs = np.bincount(where).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(gram), pa.string()), "gram": gram, "docs": docs, "uses": uses})


def learn_languages(rows: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, grams_per_language: int = GRAMS_PER_LANGUAGE,
                    scaled: bool = False) -> LanguageFilters:
    """Fit the filters on ``rows`` (lang, text); NULL langs and texts teach nothing.

    The fit reads at most ``docs_per_language`` documents of each language, those with the smallest hashes
    of their text, and keeps at most ``grams_per_language`` trigrams each: both bound what reaches the driver.
    ``scaled`` adds each language's typical score: the median over the sample, each half judged by filters of the other.
    An empty table gives filters without languages.
    """
    known = rows.select(F.col("lang").cast("string").alias("lang"), "text").where("lang IS NOT NULL AND text IS NOT NULL")
    draw = known.withColumn("draw", F.pmod(F.xxhash64("text", F.lit(20)), F.lit(1 << 40)))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageFilters.build({})
    # Expected to pass a fifth more than the bound; the rank then settles it.
    limit = F.lit(None)
    for lang, n in sizes.items():
        limit = F.when(F.col("lang") == lang, F.lit(int(min(1.0, 1.2 * docs_per_language / n) * (1 << 40)))).otherwise(limit)

    sample = (
        draw.where(F.col("draw") < limit)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text")))
        .where(F.col("rank") <= docs_per_language).select("lang", "text")
    )
    seen = {lang: min(n, docs_per_language) for lang, n in sizes.items()}
    if not scaled:
        return _fit(sample, seen, grams_per_language)
    half = F.pmod(F.xxhash64("text", F.lit(21)), F.lit(2)).cast("int")
    sample = settle(sample.withColumn("half", half), "language-sample")
    halves = []
    for k in (0, 1):
        part = sample.where(F.col("half") == k)
        halves.append(_fit(part, {r["lang"]: r["count"] for r in part.groupBy("lang").count().collect()}, grams_per_language))
    filters = _fit(sample, seen, grams_per_language)
    filters.typical = _typical(sample, halves)
    return filters


def _fit(sample: DataFrame, seen: dict[str, int], grams_per_language: int) -> LanguageFilters:
    # The ranked rows of a language lie in one task; deal them out before the counting.
    dealt = sample.select("lang", "text").repartition(F.xxhash64("text"))
    counted = dealt.mapInArrow(_count, "lang string, gram bigint, docs bigint, uses bigint").groupBy("lang", "gram").agg(
        F.sum("docs").alias("docs"), F.sum("uses").alias("uses"))
    top = Window.partitionBy("lang").orderBy(F.desc("docs"), F.desc("uses"), "gram")
    found = counted.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= grams_per_language).toPandas()
    if found.empty:
        return LanguageFilters.build({})
    found["rate"] = found["uses"] / found.groupby("lang")["uses"].transform("sum")
    found["best"] = found.groupby("gram")["rate"].transform("max")
    share = found["docs"] / found["lang"].map(seen)
    keep = found[(share >= DOC_SHARE) & (found["rate"] >= RELATIVE_RATE * found["best"])]
    return LanguageFilters.build({lang: g["gram"].to_numpy(np.int64) for lang, g in keep.groupby("lang")} if len(keep) else {})


def _typical(sample: DataFrame, halves: list[LanguageFilters]) -> dict[str, float]:
    """Median score of each language's sample by its own filter, learned from the other half of the sample."""
    shared = sample.sparkSession.sparkContext.broadcast(halves)

    @F.pandas_udf("double")
    def own(langs: pd.Series, texts: pd.Series, half: pd.Series) -> pd.Series:
        scores = [shared.value[1 - h].score_of(t, lang) for lang, t, h in zip(langs, texts, half, strict=True)]
        return pd.Series(scores, dtype="float64")

    dealt = sample.repartition(F.xxhash64("text")).select("lang", own("lang", "text", "half").alias("score"))
    # Arrow gives a score that is missing as NULL or NaN.
    scored = dealt.where("score IS NOT NULL AND NOT isnan(score)").groupBy("lang").agg(F.median("score").alias("score"))
    return {r["lang"]: r["score"] for r in scored.collect()}


def language_of(filters: LanguageFilters, text: Column, spark) -> Column:
    """A struct (lang_pred, score, typical score of lang_pred) for a text column."""
    shared = spark.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double, typical double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(t) for t in texts]
        return pd.DataFrame([(*f, shared.value.typical_of(f[0])) for f in found], columns=["lang_pred", "score", "typical"])

    return predict(text)


def identify(docs: DataFrame, filters: LanguageFilters, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row; no shuffle.

    NULL and empty texts and texts without a letter are ``und`` with score 0. Ties between languages go to the first by
    name. NULL, tied and repeated ids are judged row by row; an empty table gives no rows; extra columns are
    left behind.
    """
    return docs.select(docs[id_column].cast("bigint").alias("doc_id"), language_of(filters, docs[text], docs.sparkSession).alias("r")).select(
        "doc_id", "r.lang_pred", "r.score")


def held_out(id_column: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls on ``fold``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds == fold
