"""Licence scan: words and sentence ends of a text, runs of them that spell a licence rule, wrapped or not."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfline.llm.common import text_column

# Wordings of public licences and licence notices. The sentences of each text, in order, are one rule.
RULES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
            "shall be included in all copies or substantial portions of the Software."),
    ("bsd-2-clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                     "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                     "the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
)

# Wordings as published that are wrapped or laid out as lists; ``xnamex`` stands for the name of a holder.
PUBLISHED = (
    ("bsd-3-clause", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                     "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                     "the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the "
                     "name of xnamex nor the names of its contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
                 "version."),
    ("lgpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
                 "version."),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                 "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
                 "version."),
    ("gpl-2.0", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991"),
    ("gpl-3.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
    ("lgpl-2.1", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999"),
    ("lgpl-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
    ("agpl-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007"),
    ("apache-2.0", "Apache License\nVersion 2.0, January 2004"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies."),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies."),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
             "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
             "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)

_KEPT = b"abcdefghijklmnopqrstuvwxyz0123456789.!?;:\n"
_FOLD = bytes(c if c in _KEPT else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_MARKS = bytes(32 if c in b".!?;:\n" else c for c in range(256))
_END = re.compile(rb"[.!?;:]+[ \n]+|\n+")


def sentences(text: str) -> list[bytes]:
    """Normalised sentences: ASCII letters in lower case and digits, single spaces; empty ones are left out.

    A sentence ends at a line break and at stop marks before white space or any other symbol.
    """
    folded = (text + "\n").encode("utf-8", "surrogatepass").translate(_FOLD)
    parts = (b" ".join(part.translate(_MARKS).split()) for part in _END.split(folded))
    return [p for p in parts if p]


def rule_book(rules: tuple[tuple[str, str], ...] = RULES) -> tuple[dict[bytes, int], list[tuple[str, list[int]]]]:
    """Sentence identifiers, and each rule as a list of them."""
    known: dict[bytes, int] = {}
    book = [(name, [known.setdefault(s, len(known)) for s in sentences(text)]) for name, text in rules]
    return known, book


def matches(found: list[int], book: list[tuple[str, list[int]]], starts: dict[int, list[int]]) -> list[tuple[int, int]]:
    """(rule, start) of every run of identifiers (-1: unknown) that spells a rule and lies in no longer match."""
    hits = []
    for at, first in enumerate(found):
        for rule in starts.get(first, ()):
            want = book[rule][1]
            if found[at : at + len(want)] == want:
                hits.append((rule, at))
    def within(a: tuple[int, int], b: tuple[int, int]) -> bool:
        long_a, long_b = len(book[a[0]][1]), len(book[b[0]][1])
        return long_b > long_a and b[1] <= a[1] and a[1] + long_a <= b[1] + long_b
    wide = [h for h in hits if len(book[h[0]][1]) > 1]
    return [h for h in hits if not any(within(h, other) for other in wide)]


_GAP = re.compile(rb"[ .!?;:\n]{2,}|[.!?;:\n]")
_STOP = re.compile(rb"[.!?;:][ \n]")
# Leads of comments that are words, and numbers of lists, at the start of a line.
_LEAD, _MARK = rb"(?:(?:dnl|rem)[ \n\r])", rb"(?:(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})[ .])"
_ENDS = b"\n.\r"


def _one_gap(run: re.Match[bytes]) -> bytes:
    head, broken, tail = run.group().partition(b"\n")
    stop = _STOP.search(head + broken)
    if not broken:
        return b"." if stop else b" "
    return b"\r" if stop or b"\n" in tail else b"\n"


def laid_out(folded: bytes) -> bytes:
    """The words of a folded text with one byte between two: a space, a line break in running text (LF), a sentence
    end (full stop), a sentence end or blank line before a new line (CR). All but the space end one of ``sentences``."""
    return _GAP.sub(_one_gap, folded).strip(b" \n.\r")


def rule_pattern(text: str) -> tuple[bytes, re.Pattern[bytes]]:
    """A word that every match has, and the pattern of the rule in laid-out text; group 1 is the rule itself.

    Within a sentence words may lie on two lines, an address also after a blank line; between sentences list numbers
    and blank lines are passed over. A match begins and ends where sentences or lines do.
    """
    parts = re.split(rb"([ \n.\r])", laid_out((text + "\n").encode().translate(_FOLD)))
    spelt = {b"http": rb"https?", b"xnamex": rb"[a-z0-9]+(?:[ \n.\r][a-z0-9]+){0,15}?"}
    out = spelt.get(parts[0], parts[0])
    for before, gap, word in zip(parts[:-1:2], parts[1::2], parts[2::2], strict=True):
        if word == b"http" or before == b"xnamex":
            out += rb"[ \n.\r]" + _LEAD + rb"*"
        elif gap == b" ":
            out += rb"(?: |\n" + _LEAD + rb"?)"
        else:
            out += rb"(?:[\n.\r]" + _LEAD + rb"*|[\n\r]" + _LEAD + rb"*" + _MARK + rb")"
        out += spelt.get(word, word)
    start = rb"(?:(?<![^\n.\r])|(?<![^\n\r])(?:" + _LEAD + rb"|" + _MARK + rb"))"
    return max((w for w in parts[::2] if w not in spelt), key=len), re.compile(start + rb"(" + out + rb")(?![^\n.\r])")


def licence_runs(text: str, patterns: list[tuple[bytes, re.Pattern[bytes]]]) -> tuple[list[tuple[int, int, int]], int]:
    """(rule, first sentence, sentences) of every run that spells a rule and lies in no longer match; sentences of the text."""
    folded = (text + "\n").encode("utf-8", "surrogatepass").translate(_FOLD)
    near = {word for word in {word for word, _ in patterns} if word in folded}
    if not near:
        return [], 0
    body = laid_out(folded)
    hits = [(*m.span(1), k) for k, (word, pattern) in enumerate(patterns) if word in near for m in pattern.finditer(body)]
    if not hits:
        return [], 0
    ends = np.flatnonzero(np.isin(np.frombuffer(body, np.uint8), np.frombuffer(_ENDS, np.uint8)))
    runs, widest = [], (-1, -1)
    for low, high, rule in sorted(hits, key=lambda h: (h[0], -h[1])):
        if high <= widest[1] and (low, high) != widest:
            continue
        if high > widest[1]:
            widest = (low, high)
        first, last = np.searchsorted(ends, [low, high])
        runs.append((rule, int(first), int(last - first) + 1))
    return runs, len(ends) + 1


def scan_licences(docs: DataFrame, rules: tuple[tuple[str, str], ...] = RULES + PUBLISHED, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per match: doc_id, licence, rule number, first sentence (from 0), sentences, their share of the document.

    Sentences are counted as ``sentences`` cuts them, so a notice wrapped over n lines has n at least. One pass over
    whole texts without a shuffle. NULL and empty texts match nothing; NULL, tied and repeated ids are
    scanned row by row; a licence named twice gives two rows. An empty table gives no rows; extra columns are left behind.
    """
    names, wordings = [name for name, _ in rules], [wording for _, wording in rules]
    body = docs.select(docs[id_column].cast("bigint").alias("doc_id"), text_column(docs, text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [rule_pattern(w) for w in wordings]
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                runs, n = licence_runs(body, patterns)
                rows += [(doc_id, names[r], r, at, k, n) for r, at, k in runs]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "licence", "rule", "first_sentence", "n_sentences", "doc_sentences"])

    return body.mapInArrow(run, "doc_id bigint, licence string, rule bigint, first_sentence bigint, n_sentences bigint, doc_sentences bigint")
