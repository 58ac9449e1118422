"""Whole jobs: inputs beyond what the given tables hold."""

import collections
import random
import re
import textwrap

import pytest

import corpus_pipeline
from shelfline.llm import licences, mixing
from shelfline.llm.common import arrow_session, documents


@pytest.fixture(scope="module", autouse=True)
def arrow(spark):
    arrow_session(spark)


APACHE = """/*
 * Copyright 2020 Someone
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     https://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 */
int x;"""
BSD = """Copyright (c) 2021, Someone

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
THIRD = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"\nAND ANY'


def named(text, rules=licences.RULES + licences.PUBLISHED):
    return [rules[r][0] for r, _, _ in licences.licence_runs(text, [licences.rule_pattern(w) for _, w in rules])[0]]


def test_licences_as_published():
    assert named(APACHE) == ["apache-2.0"] and named(BSD + END) == ["bsd-2-clause"]
    assert named(BSD + THIRD + END) == ["bsd-3-clause"] and named((BSD + THIRD + END).replace("3. ", "(3) ")) == ["bsd-3-clause"]
    for k, (name, text) in enumerate(licences.RULES + licences.PUBLISHED):
        for width, lead in ((72, "# "), (60, " * "), (50, ";; "), (70, "dnl "), (79, "")):
            said = text.replace("xnamex", "The Holder, Inc.").split("\n")
            lines = "\n".join(lead + line for part in said for line in textwrap.wrap(part, width, break_long_words=False, break_on_hyphens=False))
            runs, n = licences.licence_runs(f"Code.\n\n{lines}\n\nMore code.", [licences.rule_pattern(w) for _, w in licences.RULES + licences.PUBLISHED])
            assert [r for r, _, _ in runs] == [k], (name, lines)
            assert runs[0][1] == 1 and runs[0][2] == n - 2
    assert named("He said that it was licensed under the MIT License.\nReleased under the MIT License if paid.") == []
    assert named("Released under the\n\nMIT Licenses.") == [] and named(licences.RULES[1][1].split(";")[0] + "; something else") == []


def test_licences_on_unwrapped_texts_are_those_of_the_sentences(spark, sf_dir):
    known, book = licences.rule_book()
    starts = collections.defaultdict(list)
    for k, (_, ids) in enumerate(book):
        starts[ids[0]].append(k)
    want = []
    for doc_id, text in documents(spark, sf_dir).select("doc_id", "text").collect():
        found = [known.get(s, -1) for s in licences.sentences(text or "")]
        want += [(doc_id, r, at, len(book[r][1]), len(found)) for r, at in licences.matches(found, book, starts)]
    got = licences.scan_licences(documents(spark, sf_dir)).select("doc_id", "rule", "first_sentence", "n_sentences", "doc_sentences").collect()
    assert want and sorted(map(tuple, got)) == sorted(want)
    odd = "a.b: c\n;; d  e. . .\n\n\n2. F;g ; h\r\n!\n" * 3
    assert len(re.split(rb"[\n.\r]", licences.laid_out((odd + "\n").encode().translate(licences._FOLD)))) == len(licences.sentences(odd))


def test_language_stage_keeps_languages_of_large_alphabets(spark):
    rng = random.Random(4)
    signs = [chr(0x4E00 + i) for i in range(4000)]
    words = {"zh": ["".join(rng.choices(signs, k=rng.choice((1, 2, 2)))) for _ in range(6000)],
             "en": ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 5))) + " " for _ in range(300)]}
    shares = {k: [1 / (i + 8) for i in range(len(v))] for k, v in words.items()}
    rows = [(i, "".join(rng.choices(words[lang], shares[lang], k=200)), lang) for i, lang in enumerate(["zh", "en"] * 150)]
    junk = [(1000 + i, " ".join("".join(rng.choices("qxzjkvwpyb", k=7)) for _ in range(40)), None) for i in range(5)]
    docs = spark.createDataFrame(rows + junk, "doc_id bigint, text string, lang string")
    got = [r.lang for r in corpus_pipeline.language_stage(spark, docs, "").collect()]
    filters = corpus_pipeline.langid.learn_languages(docs.select("lang", "text"))
    scores = sorted(filters.predict(text)[1] for _, text, lang in rows if lang == "zh")
    assert scores[75] < 0.5, "the case is not one of a large alphabet"
    assert collections.Counter(got) == {"zh": 150, "en": 150}


def test_mixing_takes_more_sources_than_the_driver_holds(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, rng.choice([None, "", "a", "b", "é", "big", "big", "big"] + [f"s{k}" for k in range(20)]), "w " * rng.randint(0, 40)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(4).cache()
    few = {r.doc_id: r for r in mixing.mix_plan(docs, block_docs=4).collect()}
    monkeypatch.setattr(mixing, "MOST_SOURCES", 10)
    monkeypatch.setattr(mixing, "BINS", 8)
    many = mixing.mix_plan(docs, block_docs=4).collect()
    assert len(many) == len(rows) and all((r.size, r.source_size) == (few[r.doc_id].size, few[r.doc_id].source_size) for r in many)
    assert all(abs(r.target - few[r.doc_id].target) < 1e-6 * (1 + r.target) for r in many)
    taken, shards = collections.Counter(), collections.Counter()
    for r in many:
        taken[r.source] += r.size * len(r.draws)
        shards.update(r.draws)
    target = {r.source: r.target for r in many}
    assert all(abs(taken[s] - t) <= 40 for s, t in target.items()) and set(shards) == set(range(mixing.SHARDS))
    assert all(shards[k] > 0.3 * sum(shards.values()) / mixing.SHARDS for k in shards)
    assert mixing.mix(docs, block_docs=4).count() == sum(shards.values())
