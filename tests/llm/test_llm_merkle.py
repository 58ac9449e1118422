"""Merkle manifest against a plain tree, on NULLs, ties, repeated rows, lone groups, long texts and clashing columns."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from shelfline.llm import merkle
from shelfline.llm.common import arrow_session

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ROWS = [(i, f"text {i}", "en", "s", i) for i in range(1, 40)] + [(i, f"texte {i} é", "fr", None, None if i % 2 else i) for i in range(40, 51)] + [
    (7, "text 7", "en", "s", 7), (7, "text 7", "en", "s", 7), (7, "other", "en", "s", 1), (None, "x", "en", "s", 3), (None, None, None, None, None),
    (60, "", "zz", "", 0), (61, "y " * 200_000, None, "s", 2**63 - 1), (-5, "neg", "en", "s", -1)]
CLASH = ("row", "leaf", "tree", "pos", "width", "top", "id", "place", "grp", "digest")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    i, text, lang, source, n = row
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n if n is None else n + more, text)])


def climb(nodes, fan, at, own):
    """(root, siblings, folded) for the node ``at``, whose digest is taken as ``own`` on the way."""
    siblings = []
    while len(nodes) > 1:
        run = at - at % fan
        left, right = nodes[run:at], nodes[at + 1 : run + fan]
        siblings += left + right
        own = h(*left, own, *right)
        nodes = [h(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)]
        at //= fan
    return nodes[0], siblings, own


def plain(rows, fan):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = [sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for lang in langs]
    roots = [climb([leaf_of(r) for r in t], fan, 0, "")[0] for t in trees]
    out = []
    for k, t in enumerate(trees):
        leaves = [leaf_of(r) for r in t]
        for at, r in enumerate(t):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            sub, low, own = climb(leaves, fan, at, leaf_of(r, 1) if bad else leaves[at])
            root, high, own = climb(roots, fan, k, own)
            assert sub == roots[k]
            out.append((r[0], leaves[at], sub, root, "".join(low + high), own, own == root))
    return out


def key(r):
    return tuple(str(v) for v in r)


@pytest.mark.parametrize(("fan", "hop"), [(2, 1), (2, 6), (3, 2)])
def test_manifest_is_the_plain_tree(spark, fan, hop):
    arrow_session(spark)
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(5).select("*", *[F.lit("extra").alias(c) for c in CLASH])
    got = [tuple(r) for r in merkle.prove(merkle.build_manifest(docs, fan_out=fan, hop=hop)).collect()]
    want = plain(ROWS, fan)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[6] for r in got} == {True, False}


def test_one_document_and_none(spark):
    arrow_session(spark)
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], SCHEMA)
    [r] = merkle.prove(merkle.build_manifest(docs)).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof == "" and r.verified
    empty = merkle.build_manifest(docs.limit(0))
    assert empty.root is None and merkle.prove(empty).count() == 0


def test_places_are_whole(spark):
    rows = spark.range(1000).selectExpr("id % 7 as k", "id").repartition(9)
    got = [(r.k, r.id) for r in merkle.numbered(rows, ["k", "id"], "place").orderBy("place").collect()]
    assert got == sorted((i % 7, i) for i in range(1000))
