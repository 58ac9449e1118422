"""Chat formatting: keep the maximal snapshots of logged conversations and render them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# The markers as they may stand in a turn, behind any number of backslashes that an earlier escape set.
FORGED = r"<(\\*)\|(im_start|im_end)\|>"


def _escaped(value: Column) -> Column:
    """Markers inside a turn with one more backslash: no text can open or close a turn, and the way back is plain."""
    return F.regexp_replace(value, FORGED, r"<$1\\|$2|>")


def _digest(seed: int, pos: Column, role: Column, text: Column) -> Column:
    """A hash of one turn at its position; NULL differs from every value."""
    return F.xxhash64(F.lit(seed), pos, role.isNull(), F.coalesce(role, F.lit("")), text.isNull(), F.coalesce(text, F.lit("")))


def turn_prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, low, high, last: the rolling 128-bit hash of every prefix of every conversation.

    The hash is a running exclusive-or of turn hashes that contain the position, so order counts.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = conversations.select("conv_id", "turn", "role", "text").withColumn("pos", F.row_number().over(order))
    return (
        numbered.withColumn("a", _digest(1, F.col("pos"), F.col("role"), F.col("text")))
        .withColumn("b", _digest(2, F.col("pos"), F.col("role"), F.col("text")))
        .select("conv_id", "pos", F.bit_xor("a").over(so_far).alias("low"), F.bit_xor("b").over(so_far).alias("high"),
                F.lead("pos").over(order).isNull().alias("last"))
    )


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of conversations that are no other's prefix; of equal ones the smallest id stays.

    Prefixes are made distinct before the anti-join, so an opening shared by many logs is one row.
    """
    prefixes = turn_prefixes(conversations)
    whole = prefixes.where("last").groupBy("pos", "low", "high").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    inner = prefixes.where("NOT last").select("pos", "low", "high").distinct()
    return whole.join(inner, ["pos", "low", "high"], "left_anti").select("conv_id", F.col("pos").cast("bigint").alias("n_turns"), "n_copies")


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and the rendered text of every maximal conversation.

    Turns are taken by turn number, then role, then text, NULL first; repeated rows are repeated turns. A NULL role is
    rendered as ``unknown``, a NULL text as empty. The two markers in a role or text are escaped, a line break in a role
    becomes a space. Very long texts are rendered whole. Rows of NULL conv_id are one conversation. An empty table
    gives no rows; extra columns are left behind.
    """
    kept = maximal_conversations(conversations).withColumnRenamed("conv_id", "kept_id")
    turns = conversations.select("conv_id", F.struct("turn", "role", "text").alias("t"))
    role = lambda t: F.replace(_escaped(F.coalesce(t["role"], F.lit("unknown"))), F.lit("\n"), F.lit(" "))
    segment = lambda t: F.concat(F.lit(OPEN), role(t), F.lit("\n"), _escaped(F.coalesce(t["text"], F.lit(""))), F.lit(CLOSE + "\n"))
    rendered = F.array_join(F.transform(F.sort_array(F.collect_list("t")), segment), "").alias("text")
    return (
        turns.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
        .groupBy("conv_id", "n_turns", "n_copies").agg(rendered)
    )


_SQL_ESCAPED = "regexp_replace({}, '" + FORGED + r"', '<\1\\|\2|>', 'g')"

SQL = f"""
WITH logs AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
  FROM conversations GROUP BY conv_id),
prefixes AS (SELECT DISTINCT list_slice(turns, 1, k) AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM logs)),
whole AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM logs GROUP BY turns)
SELECT conv_id, CAST(len(turns) AS BIGINT) AS n_turns, n_copies,
       array_to_string(list_transform(turns, lambda t: '{OPEN}' || replace({_SQL_ESCAPED.format("coalesce(t.role, 'unknown')")}, chr(10), ' ') || chr(10) || {_SQL_ESCAPED.format("coalesce(t.text, '')")} || '{CLOSE}' || chr(10)), '') AS text
FROM whole WHERE turns NOT IN (SELECT turns FROM prefixes)
"""
