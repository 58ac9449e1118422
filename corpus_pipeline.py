"""A training corpus in five stages, from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import langid, line_rules, mixing, packing, setjoin
from shelfline.llm.common import arrow_session, documents, fresh, settle
from shelfline.llm.encode import tokenizer_path

# As a part of the language's typical score: the share of a text's trigrams that a bounded list has differs by language.
LEAST_LANGUAGE_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; ``und`` and weak guesses go."""
    arrow_session(spark)
    filters = langid.learn_languages(docs.select("lang", "text"), scaled=True)
    guess = fresh(docs, "language")
    return (
        docs.withColumn(guess, langid.language_of(filters, docs["text"], spark))
        .where((F.col(guess)["lang_pred"] != langid.UNKNOWN) & (F.col(guess)["score"] >= LEAST_LANGUAGE_SCORE * F.col(guess)["typical"])).select(docs.columns)
    )


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted, without their host's frequent lines."""
    arrow_session(spark)
    return line_rules.apply_verdicts(docs, line_rules.judge_documents(docs), length_column="n_chars")


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    arrow_session(spark)
    return setjoin.one_of_each_class(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for every draw."""
    arrow_session(spark)
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length."""
    arrow_session(spark)
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0, with_ids=False).drop("ids")


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("jaccard_join", duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Learned filters, sampled paths, random draws and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are written before the next reads them."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
