"""Repeated passages against brute force, through whole buckets and through hot ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import passages
from shelfline.llm.common import arrow_session

SCHEMA = "doc_id bigint, text string"
CLASH = ("row", "bucket", "pack", "low", "first", "kept", "n_words", "words", "lows")
RNG = random.Random(9)


def words(n, vocab=3000):
    return [f"w{RNG.randrange(vocab)}" for _ in range(n)]


def brute(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for doc, w in split:
        for k in range(len(w) - window + 1):
            if doc is not None:
                key = tuple(w[k : k + window])
                least[key] = min(least.get(key, doc), doc)
    out = []
    for doc, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if doc is not None and least[tuple(w[k : k + window])] < doc:
                gone[k : k + window] = [True] * window
        out.append((str(doc), len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out)


def corpus(window):
    shared = [words(window + k) for k in range(6)]
    rows = []
    for i in range(150):
        parts = [words(RNG.randint(0, 80)), RNG.choice(shared), words(RNG.randint(0, 30)), RNG.choice(shared)[: RNG.randint(1, window + 3)]]
        rows.append((i, " ".join(sum(parts, [])).replace("w7 ", "w7\n\t ")))
    rows += [(RNG.randrange(200), rows[3][1]) for _ in range(40)]  # copies, some of equal id
    near = words(200)
    for i in range(60):
        near[RNG.randrange(200)] = f"n{i}"
        rows.append((300 + i, " ".join(near)))
    rows += [(None, rows[3][1]), (None, None), (400, None), (401, ""), (402, "same " * 500), (403, "same " * 400), (-1, "same " * 60)]
    return rows + [(404, " ".join(words(120_000, 10**6))), (405, "é 中 " * 60), (406, "é 中 " * 55)]


@pytest.mark.parametrize(("window", "gram", "hot", "bits"), [(50, 8, 1000, 1 << 29), (50, 8, 2, 1 << 29), (12, 3, 20, 1 << 15)])
def test_passages_are_brute_force(spark, monkeypatch, window, gram, hot, bits):
    arrow_session(spark)
    monkeypatch.setattr(passages, "HELD_BYTES", 20_000)
    rows = corpus(window)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).select("*", *[F.lit("extra").alias(c) for c in CLASH])
    got = passages.without_repeats(docs, window=window, gram=gram, hot_bucket=hot, most_bits=bits).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == brute(rows, window)
    assert all(r.n_removed == sum(s["to"] - s["from"] for s in r.removed) for r in got) and any(r.n_removed for r in got)


def test_empty_table(spark):
    arrow_session(spark)
    assert passages.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_each_window_lies_in_one_run():
    texts = [" ".join(words(n)).encode() for n in (0, 49, 50, 51, 400)] + [b"a " * 1000]
    runs = passages.super_kmers(texts)
    for t, text in enumerate(texts):
        found = [w for i in np.flatnonzero(runs.text == t) for w in range(runs.first[i], runs.first[i] + runs.count[i])]
        assert found == list(range(max(0, len(text.split()) - 49)))
    assert runs.count.max() <= passages.MOST_WINDOWS


def test_windows_are_named_by_content():
    codes = np.array([RNG.randrange(2) for _ in range(3000)])
    names, content = passages.window_names(codes, 7), [tuple(codes[i : i + 7]) for i in range(2994)]
    assert len(set(zip(names.tolist(), content))) == len(set(names.tolist())) == len(set(content))
