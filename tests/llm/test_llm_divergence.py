"""Source divergence against whole-number brute force; perfect hashes against their terms."""

import collections
import pickle
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import divergence
from shelfline.llm.common import arrow_session
from shelfline.llm.perfect_hash import PerfectHash, hashes_of, shard_of

SCHEMA = "doc_id bigint, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
CLASH = ("term", "docs", "shard", "slot", "n", "tile", "place", "value", "rank", "item", "p", "q")


def brute(rows, least, top):
    docs = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]) for _, text, lang, source in rows]
    spread, counts = collections.Counter(), collections.defaultdict(collections.Counter)
    for lang, source, terms in docs:
        spread.update({(lang, t) for t in terms})
        counts[lang, source].update(terms)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for (x, t), n in spread.items() if x == lang and n >= least]
        own = {s: {t: c[t] for t in kept} for (x, s), c in counts.items() if x == lang}
        everywhere = {t: sum(c[t] for c in own.values()) for t in kept}
        rate = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p, q = {s: rate(c) for s, c in own.items()}, rate(everywhere)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in own if o != s))
            telling = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if own[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, item, -v, k) for part, found in (("pair", pairs), ("term", telling)) for k, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def corpus():
    rng, rows = random.Random(3), []
    vocab = [f"{rng.choice(['Ab', 'é', 'Σ', 'z'])}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    for i in range(260):
        lang = rng.choice(["en", "en", "fr", None])
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "Ü", None, f"s{i % 11}"])
        text = " ".join(rng.choice(vocab[: 40 + 4 * (i % 20)]) + rng.choice(["", ",", "9", "_\n"]) for _ in range(rng.randint(0, 60)))
        rows.append((i, text, lang, source))
    rows += [(300, None, "en", "empty"), (301, "", "xx", "only"), (302, "1 2", "xx", "other"), (None, "Aba Aba", "en", "a"), (None, "Aba Aba", "en", "a")]
    return rows + [(303, "long " * 300_000 + "abb", "fr", "b")]


@pytest.mark.parametrize("sizes", [{}, {"shard_terms": 16, "round_bytes": 2000, "tile": 3, "block_terms": 5}])
def test_divergence_is_brute_force(spark, monkeypatch, sizes):
    arrow_session(spark)
    rows = corpus()
    if sizes:
        monkeypatch.setattr(divergence, "BUFFER_TERMS", 50)
        monkeypatch.setattr(divergence, "DENSE_BYTES", 400)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).select("*", *[F.lit("extra").alias(c) for c in CLASH])
    assert sorted(map(tuple, divergence.audit_sources(docs, **sizes).collect())) == brute(rows, 10, 10)


def test_no_documents_and_no_terms(spark):
    arrow_session(spark)
    docs = spark.createDataFrame([(1, "a b", "en", "s"), (2, "a c", "en", "t")], SCHEMA)
    assert divergence.audit_sources(docs.limit(0)).count() == 0
    assert sorted(map(tuple, divergence.audit_sources(docs).collect())) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_perfect_hash():
    terms = [f"t{i}".encode() for i in range(5000)]
    table = pickle.loads(pickle.dumps(PerfectHash(terms)))
    assert sorted(table.slots(terms).tolist()) == list(range(5000))
    assert (table.slots([f"u{i}".encode() for i in range(5000)]) == -1).all()
    alike = np.zeros(5, np.uint64)
    same = PerfectHash(terms[:5], alike)
    assert sorted(same.slots(terms[:5], alike).tolist()) == list(range(5)) and same.slots([b"no"], alike[:1]).tolist() == [-1]
    assert PerfectHash([]).slots([b"x"]).tolist() == [-1]


def test_plans_and_tasks_agree_on_the_shard(spark):
    terms = ["a", "é" * 40, "", "abcdefgh" * 9]
    found = spark.createDataFrame([(t,) for t in terms], "t string").select(F.pmod(F.xxhash64("t"), F.lit(7)).alias("s")).collect()
    assert [r.s for r in found] == shard_of(hashes_of([t.encode() for t in terms]), 7).tolist()


def test_rates_are_exact_near_the_bound(spark):
    n, total = 4_000_000_000_000_000, 8_999_999_999_999_999
    [r] = spark.createDataFrame([(n, total)], "n bigint, total bigint").select(divergence.exact_rate("n", "total").alias("p")).collect()
    want = 1 + 10**9 * (n + 2) // total
    assert r.p == want == divergence._rates(np.array([[n]]), np.array([total]))[0, 0]
