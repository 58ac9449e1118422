"""Registered queries of the training-data operators, and their check statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import balltree, chats, divergence, langid, licences, line_rules, merkle, mixing, packing, passages, quality, setjoin, token_files
from shelfline.llm.common import documents, work_dir
from shelfline.llm.encode import tokenizer_path

WORDS = r"[^\x20\x09-\x0D]+"


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line-frequency verdict of every document."""
    return line_rules.judge_documents(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_removed")


OP1_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORDS}') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORDS}')) AS lines FROM d),
windows AS (SELECT doc_id, i, words[i : i + 2] AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, source, text, line, array_to_string(regexp_extract_all(
            translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}'), ' ') AS norm,
            len(regexp_extract_all(line, '{WORDS}')) AS n
          FROM (SELECT doc_id, source, text, unnest(lines) AS line FROM w)),
limits AS (SELECT source, greatest({line_rules.MIN_DOCS}, count(DISTINCT text) * {line_rules.HOST_PERCENT} / 100.0) AS most FROM d GROUP BY source),
over AS (SELECT l.source, l.norm FROM lines l JOIN limits m ON l.source IS NOT DISTINCT FROM m.source
         GROUP BY l.source, l.norm, m.most HAVING count(DISTINCT l.text) > m.most),
removed AS (SELECT l.doc_id, sum(l.n) AS words_removed FROM lines l JOIN over o ON l.source IS NOT DISTINCT FROM o.source AND l.norm = o.norm GROUP BY l.doc_id),
counted AS (SELECT w.doc_id, len(words) AS n_words, list_sum(list_transform(words, lambda x: length(x))) AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(words_removed, 0) AS words_removed
            FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)),
failed AS (SELECT *, n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.REPEAT_PERCENT} * n_words AS base_failed FROM counted)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * (n_words - words_removed) >= {line_rules.KEPT_PERCENT} * n_words AS kept,
       CAST(words_removed AS BIGINT) AS words_removed
FROM failed
"""


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, written bit-packed and read back from the files."""
    docs = documents(spark, sf_dir)
    manifest = token_files.write_token_files(docs, work_dir(spark, "tokens"), tokenizer_path("word_bpe_49k.json"), end_id=1)
    return token_files.read_token_files(manifest, with_ids=False).drop("ids")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from two thirds of the labels."""
    docs, held = documents(spark, sf_dir), langid.held_out("doc_id", 3, 1)
    labels = documents(spark, sf_dir, "labels").where(~held)
    return quality.rate_documents(docs, labels).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix_plan(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence matches of every document."""
    return licences.scan_licences(documents(spark, sf_dir))


def _licence_sql() -> str:
    known, book = licences.rule_book()
    wanted = ", ".join(f"({r}, '{name}', {i}, '{s.decode()}', {len(ids)})" for r, (name, ids) in enumerate(book)
                       for i, n in enumerate(ids) for s in [next(k for k, v in known.items() if v == n)])
    return f"""
WITH rules(rule, licence, i, sentence, k) AS (VALUES {wanted}),
folded AS (SELECT doc_id, regexp_replace(translate(coalesce(text, '') || chr(10), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^a-z0-9.!?;:\\n]', ' ', 'g') AS t FROM documents),
parts AS (SELECT doc_id, list_filter(list_transform(string_split_regex(t, '[.!?;:]+[ \\n]+|\\n+'),
                 lambda x: trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '') AS s FROM folded),
numbered AS (SELECT doc_id, len(s) AS doc_sentences, unnest(s) AS sentence, unnest(range(len(s))) AS pos FROM parts),
hits AS (SELECT doc_id, doc_sentences, rule, licence, k, pos - i AS first_sentence FROM numbered JOIN rules USING (sentence)
         GROUP BY doc_id, doc_sentences, rule, licence, k, pos - i HAVING count(*) = k)
SELECT doc_id, licence, CAST(rule AS BIGINT) AS rule, CAST(first_sentence AS BIGINT) AS first_sentence, CAST(k AS BIGINT) AS n_sentences,
       CAST(doc_sentences AS BIGINT) AS doc_sentences
FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits o WHERE o.doc_id = h.doc_id AND o.k > h.k AND o.first_sentence <= h.first_sentence
                              AND h.first_sentence + h.k <= o.first_sentence + o.k)
"""


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best other vectors of every fiftieth vector."""
    return balltree.top_k(documents(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def op7_similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and links of every document among all others."""
    return setjoin.similar_documents(documents(spark, sf_dir))


def op8_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return chats.format_chats(documents(spark, sf_dir, "conversations"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs, held = documents(spark, sf_dir), langid.held_out("doc_id", 4, 2)
    filters = langid.learn_languages(docs.where(~held).select("lang", "text"))
    return langid.identify(docs, filters).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document."""
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), end_id=0, with_ids=False).drop("ids")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every pair of a language's sources, and each source's most telling terms."""
    return divergence.audit_sources(documents(spark, sf_dir))


def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated passages of fifty words leave of every document."""
    return passages.without_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and tamper check of every document."""
    return merkle.prove(merkle.build_manifest(documents(spark, sf_dir))).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator, by number."""
    own = [v for k, v in globals().items() if k.startswith("op") and callable(v)]
    return {f.__name__: f for f in sorted(own, key=lambda f: int(f.__name__[2:].split("_")[0]))}


def oracle_sql() -> dict[str, str]:
    """Check statements of the operators that SQL can express."""
    return {"op1_line_frequency": OP1_SQL, "op5_licences": _licence_sql(), "op6_top_k": OP6_SQL, "op8_chats": chats.SQL,
            "op11_divergence": divergence.SQL, "op12_passages": passages.SQL, "op13_merkle": merkle.SQL}
