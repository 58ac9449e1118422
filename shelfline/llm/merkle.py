"""Merkle manifest of a dataset: one tree a group, one tree over the groups' roots, and a proof for every row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import arrow_session, numbered, settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels that one stored row climbs: it links a node to its ancestor that many levels up and holds the siblings between.
HOP = 6
TOP = -1  # the tree over the groups' roots
BYTES = 32

LINKS = ("tree bigint, station int, pos bigint, width bigint, siblings binary, to_tree bigint, to_station int, to_pos bigint, "
         "subroot binary, digest binary, top bigint, left bigint")
LINK_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def joined_digest(digests: list[bytes]) -> bytes:
    """SHA-256 of the digests' lower-case hex texts, one after the other."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def hop_up(digests: list[bytes], width: int, fan_out: int, hop: int) -> tuple[list[bytes], bytes]:
    """Siblings of each node of a block on its way up, and the digest ``hop`` levels up.

    ``digests`` are consecutive nodes starting at a multiple of ``fan_out ** hop``; ``width`` is the number of
    nodes in the whole level. A level of one node ends the tree.
    """
    levels = [digests]
    while len(levels) <= hop and width > 1:
        now = levels[-1]
        levels.append([joined_digest(now[i : i + fan_out]) for i in range(0, len(now), fan_out)])
        width = -(-width // fan_out)
    siblings = []
    for at in range(len(digests)):
        parts: list[bytes] = []
        for level in levels[:-1]:
            run = at - at % fan_out
            parts += level[run:at] + level[at + 1 : run + fan_out]
            at //= fan_out
        siblings.append(b"".join(parts))
    return siblings, levels[-1][0]


@dataclass
class Manifest:
    """``leaves``: one row a document with its place; ``nodes``: the stored links; ``root``: None without documents."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None
    fan_out: int
    hop: int


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the value's UTF-8 byte count, a colon and the value; integers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _build(spark, level: DataFrame, station: int, fan_out: int, hop: int) -> DataFrame:
    """The links of one stored level: nodes in blocks of ``fan_out ** hop``, one group each."""
    block = fan_out**hop
    names = [c.split()[0] for c in LINKS.split(", ")]
    kinds = [LINK_TYPES[c.split()[1]] for c in LINKS.split(", ")]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, at, top, width, members in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                siblings, parent = hop_up([m["digest"] for m in members], width, fan_out, hop)
                left = -(-width // block)
                done = left == 1
                way = (TOP, 0, top) if done and tree != TOP else (None, None, None) if done else (tree, station + 1, at)
                for k, m in enumerate(members):
                    rows.append((tree, station, m["pos"], width, siblings[k], *way, parent if done and tree != TOP else None,
                                 parent if k == 0 else None, top, left))
            columns = zip(*rows, strict=True) if rows else ([] for _ in names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=names)

    grouped = level.groupBy("tree", F.expr(f"pos div {block}").alias("at")).agg(
        F.first("top").alias("top"), F.first("width").alias("width"), F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("members"))
    return settle(grouped.select("tree", "at", "top", "width", "members").mapInArrow(links, LINKS), "links")


def _grow(spark, level: DataFrame, fan_out: int, hop: int) -> list[DataFrame]:
    """All stored levels of the trees whose lowest level is given."""
    block = fan_out**hop
    widest = level.agg(F.max("width")).first()[0] or 1
    built = []
    while True:
        built.append(_build(spark, level, len(built), fan_out, hop))
        widest = -(-widest // block)
        if widest <= 1:
            return built
        level = built[-1].where("digest IS NOT NULL AND left > 1").select(
            "tree", F.col("to_pos").alias("pos"), "digest", F.col("left").alias("width"), "top")


def build_manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", number: str = "n_chars", fields: tuple[str, ...] = FIELDS,
                   fan_out: int = 2, hop: int = HOP) -> Manifest:
    """Leaves, stored levels and root of ``docs``; every seventh document by its id's crc32 also gets a tampered leaf.

    A leaf is the digest of the encoded ``fields``. Leaves of a group ascend by ``order``; rows of equal id by
    leaf, so the result does not depend on how the rows lie. Groups ascend by UTF-8 bytes, NULL first. Blocks of
    ``fan_out ** hop`` neighbours are hashed together: a large group is many blocks, never one task.

    NULL values are a part of the leaf; a NULL id sorts first and is never tampered with, and neither is a NULL
    number. Empty and very long texts are values like others. Repeated rows are leaves of their own. An empty
    table has no root. Extra columns are left behind.
    """
    spark = arrow_session(docs.sparkSession)
    docs = docs.select(*fields)
    changed = (F.crc32(docs[order].cast("string")) % 7 == 0) & docs[number].isNotNull()
    more = (docs[number].cast("decimal(20,0)") + 1).cast("string")

    def leaf(of: dict[str, Column]) -> Column:
        return F.unhex(F.sha2(F.concat(*[encoded(of.get(c, docs[c])) for c in fields]), 256))

    first = settle(docs.select(
        docs[order].alias("id"), docs[group].cast("string").alias("grp"), leaf({}).alias("leaf"),
        F.when(changed, leaf({number: more})).alias("tampered"), F.monotonically_increasing_id().alias("row")), "leaves")
    placed = settle(numbered(first, ["grp", "id", "leaf", "row"], "place"), "leaves")
    groups = placed.groupBy("grp").agg(F.min("place").alias("tree"), F.count("*").alias("width"))
    groups = settle(numbered(settle(groups, "groups"), ["tree"], "top").withColumnRenamed("grp", "of"), "groups")
    leaves = settle(placed.join(groups, F.col("grp").eqNullSafe(F.col("of"))).select(
        "row", "id", "leaf", "tampered", "tree", (F.col("place") - F.col("tree")).alias("pos"), "width", "top"), "leaves")

    built = _grow(spark, leaves.select("tree", "pos", F.col("leaf").alias("digest"), "width", "top"), fan_out, hop)
    roots = [b.where("digest IS NOT NULL AND left = 1") for b in built]
    lowest = _all(roots).select(F.lit(TOP).cast("bigint").alias("tree"), F.col("top").alias("pos"), "digest",
                                F.lit(groups.count()).alias("width"), F.lit(None).cast("bigint").alias("top"))
    above = _grow(spark, settle(lowest, "roots"), fan_out, hop)
    found = above[-1].where("digest IS NOT NULL").select(F.lower(F.hex("digest"))).first()
    return Manifest(leaves, _all(built + above).drop("digest", "top", "left"), found[0] if found else None, fan_out, hop)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# One row climbs one stored link a step. The digest is folded level by level: ``b`` siblings stand before the node
# and ``r`` after it in its run, as its place and the level's width tell.
CLIMB = """
WITH RECURSIVE climb(row, step, tree, station, pos, digest, siblings, subroot, id, leaf) AS (
  SELECT row, 0, tree, 0, pos, coalesce(tampered, leaf), CAST(NULL AS BINARY), CAST(NULL AS BINARY), id, leaf FROM {leaves}
  UNION ALL
  SELECT c.row, c.step + 1, n.to_tree, n.to_station, n.to_pos,
         aggregate(sequence(1, HOP), named_struct('d', c.digest, 'p', n.pos, 'w', n.width, 'at', 1), (a, i) -> CASE WHEN a.w <= 1 THEN a ELSE named_struct(
           'd', unhex(sha2(concat(lower(hex(substring(n.siblings, a.at, BEFORE))), lower(hex(a.d)),
                                  lower(hex(substring(n.siblings, a.at + BEFORE, AFTER)))), 256)),
           'p', a.p div FAN, 'w', (a.w + FAN - 1) div FAN, 'at', a.at + BEFORE + AFTER) END).d,
         n.siblings, n.subroot, CAST(NULL AS BIGINT), CAST(NULL AS BINARY)
  FROM climb c JOIN {nodes} n ON c.tree = n.tree AND c.station = n.station AND c.pos = n.pos
)
SELECT row, step, digest, siblings, subroot, id, leaf FROM climb
"""


def prove(manifest: Manifest) -> DataFrame:
    """Every document's way to the root: doc_id, leaf, subroot, root, proof (siblings' hex texts), folded_root, verified.

    A recursive query climbs the stored links, one row a document and step; a document's few steps are then
    put together. Nodes near the root are hot join keys, which adaptive execution splits on the documents' side.
    The folded root starts from the tampered leaf where there is one. The climb is stored before it is used.
    """
    spark = manifest.leaves.sparkSession
    before, fan = f"CAST({BYTES} * (a.p % FAN) AS INT)", str(manifest.fan_out)
    after = f"CAST({BYTES} * (least(FAN, a.w - a.p + a.p % FAN) - 1 - a.p % FAN) AS INT)"
    sql = CLIMB.replace("BEFORE", before).replace("AFTER", after).replace("FAN", fan).replace("HOP", str(manifest.hop))
    limits = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": "-1"}
    old = {k: spark.conf.get(k) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        steps = spark.sql(sql, leaves=manifest.leaves, nodes=manifest.nodes)
        ways = settle(steps.groupBy("row").agg(
            F.max("id").alias("id"), F.max("leaf").alias("leaf"), F.max("subroot").alias("subroot"), F.max_by("digest", "step").alias("folded"),
            F.sort_array(F.collect_list(F.when(F.col("step") > 0, F.struct("step", "siblings")))).alias("parts")), "proofs")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    root, folded = F.lit(manifest.root), F.lower(F.hex("folded"))
    return ways.select(
        F.col("id").alias("doc_id"), F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"), root.alias("root"),
        F.array_join(F.transform("parts", lambda p: F.lower(F.hex(p["siblings"]))), "").alias("proof"),
        folded.alias("folded_root"), (folded == root).alias("verified"))


SQL = """
WITH RECURSIVE entry AS (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS v FROM range(256) t(i)),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM entry),
docs AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT)),
             lambda c, d: xor(c // 256, t[CAST(xor(c % 256, d) AS INTEGER) + 1]), 4294967295), 4294967295) AS crc
  FROM documents CROSS JOIN crc_table),
leaves AS (
  SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || tail) AS leaf,
         sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars + (crc % 7 = 0)::INT AS VARCHAR)) || ':' || (n_chars + (crc % 7 = 0)::INT) END || tail) AS own
  FROM docs),
placed AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id, leaf) AS row,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos,
                  dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS width FROM leaves),
low(tree, level, pos, width, h) AS (
  SELECT tree, 0, pos, width, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, (any_value(width) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE width > 1 GROUP BY tree, level, pos // 2),
tops AS (SELECT tree AS pos, h, (SELECT count(DISTINCT tree) FROM placed) AS width FROM low WHERE width = 1),
high(level, pos, width, h) AS (
  SELECT 0, pos, width, h FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, (any_value(width) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE width > 1 GROUP BY level, pos // 2),
up(row, tree, level, pos, width, h, proof) AS (
  SELECT row, tree, 0, pos, width, own, '' FROM placed
  UNION ALL
  SELECT u.row, u.tree, u.level + 1, u.pos // 2, (u.width + 1) // 2,
         sha256(CASE WHEN u.pos % 2 = 1 THEN n.h || u.h ELSE u.h || coalesce(n.h, '') END), u.proof || coalesce(n.h, '')
  FROM up u LEFT JOIN low n ON n.tree = u.tree AND n.level = u.level AND n.pos = xor(u.pos, 1) WHERE u.width > 1),
over(row, level, pos, width, h, proof) AS (
  SELECT row, 0, tree, (SELECT count(*) FROM tops), h, proof FROM up WHERE width = 1
  UNION ALL
  SELECT u.row, u.level + 1, u.pos // 2, (u.width + 1) // 2,
         sha256(CASE WHEN u.pos % 2 = 1 THEN n.h || u.h ELSE u.h || coalesce(n.h, '') END), u.proof || coalesce(n.h, '')
  FROM over u LEFT JOIN high n ON n.level = u.level AND n.pos = xor(u.pos, 1) WHERE u.width > 1)
SELECT p.doc_id, p.leaf, t.h AS subroot, r.h AS root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = r.h AS verified
FROM placed p JOIN tops t ON t.pos = p.tree JOIN over o ON o.row = p.row AND o.width = 1 CROSS JOIN (SELECT h FROM high WHERE width = 1) r
"""
