"""Numbers describing one text; words are runs of bytes other than space and 0x09 to 0x0D."""

from __future__ import annotations

import numpy as np

SYMBOLS = "#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes]) -> int:
    """Words lying in a three-word window that the text has twice or more, first time included."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    code = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    if len(known) == n:
        return 0
    pair = code[:-1] * len(known) + code[1:]
    if len(known) >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    window = pair[:-1] * len(known) + code[2:]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n - 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= twice
    return int(covered.sum())


def lines_with_words(raw: bytes) -> list[bytes]:
    """The ``\\n``-split lines that have a word."""
    return [line for line in raw.split(b"\n") if line.strip(BLANKS)]


def base_stats(text: str, raw: bytes, words: list[bytes], lines: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    blanks = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    return (len(words), len(text) - blanks, sum(raw.count(c) for c in b"#*$%&|<>"), len(lines) - len(set(lines)),
            repeated_words(words))
