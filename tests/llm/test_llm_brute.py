"""Operators against brute force, exact round trips and held-out labels."""

import collections
import random
import unicodedata

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from shelfline.llm import balltree, encode, langid, licences, line_rules, mixing, quality, setjoin, token_files
from shelfline.llm.common import arrow_session, documents
from shelfline.llm.components import components
from tools.check_oracle import TABLES, rows_of

RNG = random.Random(5)
VOCAB = [f"w{i}" for i in range(4000)]
LLM = [k for k in entry.queries() if k.startswith("op")]


@pytest.fixture(scope="module", autouse=True)
def arrow(spark):
    arrow_session(spark)


@pytest.mark.parametrize("name", [k for k in LLM if k in entry.oracle_sql()])
def test_matches_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df, want = entry.queries()[name](spark, sf_dir), duck.sql(entry.oracle_sql()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(want.columns, want.fetchall())


def test_all_operators_are_registered():
    assert {int(k[2:].split("_")[0]) for k in LLM} >= set(range(1, 11)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_ids_of_the_text(file):
    coder = encode.PieceEncoder(encode.tokenizer_path(file))
    parts = ["a", "B", "don't", "'s", " ", "  ", "\n", "\n\n", "\t", ".", ",", "...", "!.", "é", "é", "3.14", "_", "中文", "\x1f", " ", "<|endoftext|>", "Σ", "Word", "other", "İ", "क़", "שּׁ", "̇", "ﬁ", "ǅ", "Ж", ";", "?", "a.b"]
    texts = ["".join(RNG.choice(parts) for _ in range(RNG.randint(0, 40))) for _ in range(1500)]
    for raw, text in zip(coder.encode(texts), texts, strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_every_code_point_before_a_stop(file):
    coder = encode.PieceEncoder(encode.tokenizer_path(file))
    known = [chr(i) for i in range(0x110000) if unicodedata.category(chr(i)) not in ("Cs", "Cn", "Co")]
    texts = [f"a{c}, b{c}. {c}! x" for c in known]
    for i in range(0, len(texts), 2000):
        some = texts[i : i + 2000]
        want = coder.tokenizer.encode_batch_fast(some, add_special_tokens=False)
        for text, raw, w in zip(some, coder.encode(some), want, strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == w.ids, ascii(text)


@pytest.mark.parametrize("bits", [1, 5, 13, 16, 17, 24, 32])
def test_bit_packing_round_trip(bits, tmp_path):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 3 * token_files.BLOCK + 77, dtype=np.uint64).astype("<u4")
    assert (token_files.unpack(token_files.pack(ids[:77], bits), bits, 77) == ids[:77]).all()
    from pyarrow import fs

    path = f"{tmp_path}/one.bin"
    writer = token_files.ShardWriter(fs.LocalFileSystem(), path, bits)
    cuts = [0, 1, 5000, 5000, len(ids)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        writer.add(k, ids[a:b])
    writer.close()
    reader = token_files.ShardReader(path)
    assert all((reader.document(k) == ids[a:b]).all() for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert (reader.ids(4090, 8200) == ids[4090:8200]).all() and reader.meta["bits"] == bits


def test_boilerplate_goes_and_depleted_documents_are_rejected(spark):
    def text(k, words=80):
        return "\n".join(" ".join(f"{k}v{i * 10 + j}" for j in range(10)) for i in range(words // 10))
    common = "Home   About contact " * 6
    rows = [(i, f"{common.lower() if i % 2 else common}\n{text(i)}", "h") for i in range(60)]
    rows += [(100 + i, "\n".join([common] * 9) + f"\nown line number {i} of this page", "h") for i in range(3)]
    rows += [(200 + i, text("copy"), "h") for i in range(60)]  # copies are one text: their lines are not frequent
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    verdicts = line_rules.judge_documents(docs).cache()
    got = {r.doc_id: r for r in verdicts.collect()}
    assert all(got[i].kept and got[i].words_removed == 18 for i in range(60))
    assert all(not got[100 + i].kept for i in range(3)) and all(got[200 + i].kept and got[200 + i].words_removed == 0 for i in range(60))
    clean = {r.doc_id: r.text for r in line_rules.apply_verdicts(docs, verdicts).collect()}
    assert clean[3] == text(3) and clean[200] == text("copy") and 100 not in clean


def test_mix_meets_targets(spark, sf_dir):
    plan = mixing.mix_plan(documents(spark, sf_dir)).toPandas()
    plan["taken"] = plan["size"] * plan["draws"].map(len)
    by = plan.groupby("source", dropna=False).agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    total = by["size"].sum()
    assert abs(by["target"].sum() - 1.5 * total) < 1e-6 * total and (by["target"] <= 2 * by["size"] + 1e-6).all()
    biggest = plan.groupby("source")["size"].max()
    assert ((by["taken"] - by["target"]).abs() <= np.maximum(0.03 * by["target"], biggest)).all()
    again = mixing.mix_plan(documents(spark, sf_dir)).toPandas()
    key = lambda p: sorted((r.doc_id, tuple(r.draws)) for r in p.itertuples())
    assert key(plan) == key(again)


def test_splitting_tree_is_exact():
    quotas = np.array([1000, 0, 37, 5])
    dealt = mixing.split_quotas(quotas, 7, np.random.default_rng(1))
    assert (dealt.sum(axis=0) == quotas).all() and dealt.min() >= 0 and np.ptp(dealt.sum(axis=1)) <= 1
    assert mixing.targets_of({"a": 10, "b": 100, None: 10}, (5.0, 2.0, 1.0), 1.5, 2.0) == {"a": 20, None: 20, "b": 140}


def test_repeated_rows_are_split_by_a_mix(spark):
    docs = spark.createDataFrame([(1, "a b c d", "s")] * 40 + [(i, "a b", "t") for i in range(2, 42)], "doc_id bigint, text string, source string")
    plan = mixing.mix_plan(docs).toPandas()
    taken = (plan["size"] * plan["draws"].map(len)).groupby(plan["source"]).sum()
    target = plan.groupby("source")["target"].first()
    assert ((taken - target).abs() <= 4).all()


def brute_links(texts):
    sets = [setjoin.shingles(t or "") for t in texts]
    links, parent = collections.Counter(), list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return links, [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("bucket,block", [(512, 256), (4, 3)])
def test_join_finds_every_link(spark, bucket, block):
    base = [[RNG.choice(VOCAB) for _ in range(RNG.randint(3, 150))] for _ in range(40)]
    texts = [" ".join(b) for b in base]
    for b in base[:12]:  # near copies at all distances, some in chains
        for _ in range(8):
            copy = list(b)
            for _ in range(RNG.randint(0, max(1, len(b) // 25))):
                copy[RNG.randrange(len(copy))] = RNG.choice(VOCAB)
            texts.append(" ".join(copy))
    texts += texts[:5] * 3 + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in setjoin.similar_documents(docs, bucket=bucket, block=block).collect()}
    links, roots = brute_links(texts)
    assert {i: (got[i].class_id, got[i].n_links) for i in got} == {i: (roots[i], links[i]) for i in range(len(texts))}
    kept = sorted(r.doc_id for r in setjoin.one_of_each_class(docs).collect())
    assert kept == sorted(set(roots))


def test_runs_reach_the_recall():
    assert 0.4 < setjoin.survival(6, 0.8) < 0.5 and setjoin.runs_for(0.9999) == 15
    assert (1 - setjoin.survival(6, 0.8)) ** setjoin.runs_for(0.9999) <= 1e-4


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 100 + i) for i in range(1, 40)] + [(50, 50), (None, 3), (7, 2), (2, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(40)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_tree_search_is_exact(spark):
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(900, 6)) * 40) / 256
    points[300:600] = points[0]  # one very common vector
    rows = [(int(i), [float(x) for x in p]) for i, p in enumerate(points)]
    got = balltree.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), k=5, shard_rows=200, query_rows=7).collect()
    whole = np.floor(points * 256)
    want = []
    for q in range(0, 900, 50):
        score = whole @ whole[q]
        order = sorted((i for i in range(900) if i != q), key=lambda i: (-score[i], i))[:5]
        want += [(q, r + 1, i, int(score[i])) for r, i in enumerate(order)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


def test_language_is_right_on_held_out_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held = langid.held_out("doc_id", 4, 2)
    filters = langid.learn_languages(docs.where(~held).select("lang", "text"))
    got = langid.identify(docs.where(held), filters).toPandas().set_index("doc_id")["lang_pred"]
    want = docs.where(held).toPandas().set_index("doc_id")["lang"]
    assert (got == want).mean() > 0.95


def test_more_than_64_languages_fit_the_filters():
    grams = {f"l{i:03d}": np.arange(i * 100, i * 100 + 100, dtype=np.int64) for i in range(70)}
    filters = langid.LanguageFilters.build(grams)
    assert filters.popcounts(grams["l069"]).argmax() == 69 and filters.popcounts(grams["l001"]).argmax() == 1


def test_quality_trees_learn_and_flatten():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = quality.BoostedTrees.fit(x[:2000], y[:2000], trees=40)
    assert ((model.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95

    def walk(row):  # one document at a time through the flat arrays
        total = model.base
        for t in range(len(model.leaf)):
            node = 0
            for _ in range(model.depth):
                node = 2 * node + 1 + int(row[model.feature[t, node]] > model.cut[t, node])
            total += model.leaf[t, node - model.feature.shape[1]]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([walk(r) for r in x[:50]], model.score(x[:50]))


def test_quality_on_held_out_labels(spark, sf_dir):
    labels = documents(spark, sf_dir, "labels")
    held = langid.held_out("doc_id", 3, 1)
    got = quality.rate_documents(documents(spark, sf_dir), labels.where(~held)).toPandas().set_index("doc_id")["score"]
    want = labels.where(held).toPandas().set_index("doc_id")["quality"]
    assert ((got.reindex(want.index) >= 0.5) == (want == 1)).mean() > 0.85


def test_licence_runs():
    known, book = licences.rule_book()
    starts = collections.defaultdict(list)
    for k, (_, ids) in enumerate(book):
        starts[ids[0]].append(k)
    for k, (_, text) in enumerate(licences.RULES):
        found = [known.get(s, -1) for s in licences.sentences("Intro line.\n" + text + "\nOutro")]
        assert (k, 1) in licences.matches(found, book, starts)
    lone = [known.get(s, -1) for s in licences.sentences(licences.RULES[1][1].split(";")[0] + "; something else")]
    assert licences.matches(lone, book, starts) == []
