"""Token ids of whole texts by a public tokenizer, through a bounded cache of pieces.

A text is cut only where the tokenizer itself always cuts, so the joined ids of the pieces are the ids of
the text. Words repeat, so most pieces come out of the cache; only new ones reach the tokenizer.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable

import numpy as np

GENERATION = 400_000  # pieces kept in the younger half of the cache; the older half has as many

GLUE = "\x1f"  # leads the first piece of a text, which had no space before it
STOPS = ".,;:!?"
# Letters below this code point are letters to every edition of Unicode; pieces beyond it go to the tokenizer whole.
PLAIN_END = "\u0530"
MARKED = "\u0130"  # the one of them whose lower case ends in a combining mark
# A space or line break after other white space: runs are tokens of their own there.
_RUN = re.compile(r"\s(?=[ \n])")


@functools.cache
def _byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class PieceEncoder:
    """``encode(texts)`` gives little-endian unsigned 32-bit ids, one bytes object a text.

    Two layouts are recognised: byte-level pieces that own their leading space, and word pieces with an
    end-of-word suffix, where white space only separates. Any other tokenizer encodes whole texts.

    A text is cut at spaces and line breaks. A new piece is normalised by the tokenizer's own normaliser;
    if that leaves letters alone, with at most one stop behind them, the tokenizer's model is
    asked for the word and for the stop, since the pattern parts the two. All other pieces go to the
    tokenizer as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix")
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.vocab_size = max(vocab.values()) + 1
        leads = (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and spec.get("normalizer") is None
        self.layout = "suffix" if suffix else "leading" if leads else "whole"
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.letters = _byte_letters()
        self.space = self.letters[32]
        plain = self.layout != "whole"
        self.stops = {c: self._word(c) for c in STOPS} if plain else {}
        self.breaks = array("I", [t.id for t in self.model.tokenize(self.letters[10])]).tobytes() if plain else b""
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.spaced: set[str] = set()  # cached pieces behind which a run of white space can stand

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _pieces(self, text: str) -> list[str] | None:
        if self.layout == "suffix":
            try:  # these characters are lowered one by one, and none of them composes with another
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
            return text.replace("\n", " ").split(" ")
        if self.layout == "leading" and GLUE not in text:
            return (GLUE + text).replace("\n", " \n").split(" ")
        return None

    def _whole(self, piece: str) -> str:
        """The part of the text that a piece stands for."""
        if self.layout == "suffix" or piece[:1] == "\n":
            return piece
        return piece[1:] if piece[:1] == GLUE else " " + piece

    def _word(self, word: str, lead: str = "") -> bytes:
        """Ids of letters, or of one stop, by the model alone."""
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        return array("I", [t.id for t in self.model.tokenize(lead + word)]).tobytes()

    def _normal(self, piece: str) -> str:
        """What the tokenizer's normaliser makes of a piece; plain letters need no call of it."""
        if self.layout != "suffix":
            return piece
        if piece.isascii():
            return piece.lower()
        if max(piece) < PLAIN_END and "Σ" not in piece:
            return unicodedata.normalize("NFC", piece).lower()
        return self.normalizer.normalize_str(piece)

    def _plain(self, piece: str) -> bytes | None:
        """Ids of a piece of letters with at most one stop; None for any other."""
        lead, space = b"", ""
        if self.layout == "leading":
            first = piece[:1]
            if first == GLUE or first == "\n":
                piece = piece[1:]
                lead = self.breaks if first == "\n" else b""
            else:
                space = self.space
        piece = self._normal(piece)
        stop = self.stops.get(piece[-1:], b"")
        if stop:
            piece = piece[:-1]
        if not piece.isalpha() or not (piece.isascii() or max(piece) < PLAIN_END):
            return None
        return lead + self._word(piece, space) + stop

    def _learn(self, missing: Iterable[str]) -> None:
        other = []
        model, space, lower = self.model.tokenize, self.space if self.layout == "leading" else "", self.layout == "suffix"
        for piece in missing:
            if piece.isascii() and piece.isalpha():
                self.young[piece] = array("I", [t.id for t in model(piece.lower() if lower else space + piece)]).tobytes()
                continue
            ids = self._plain(piece)
            if ids is None:
                other.append(piece)
            else:
                self.young[piece] = ids
        found = self.tokenizer.encode_batch_fast([self._whole(p) for p in other], add_special_tokens=False)
        for piece, e in zip(other, found, strict=True):
            self.young[piece] = array("I", e.ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > GENERATION:
            self.old, self.young, self.spaced = self.young, {}, set()
        cut = [self._pieces(t) for t in texts]
        wanted = set().union(*[c for c in cut if c is not None])
        # The pieces of these texts alone: a small table that stays in the processor's cache.
        hits = wanted & self.young.keys()
        near: dict[str, bytes] = dict(zip(hits, map(self.young.__getitem__, hits), strict=True))
        stopped: list[tuple[str, str]] = []
        missing: set[str] = set()
        young, old, stops = self.young.get, self.old.get, self.stops
        for piece in wanted - hits:
            key, end = piece, piece[-1:]
            if end.isspace() or not piece:
                self.spaced.add(piece)
            elif end in stops:
                base = piece[:-1]
                if base.isalpha() and (base.isascii() or (max(base) < PLAIN_END and MARKED not in base)):  # known by its word and its stop
                    stopped.append((piece, base))
                    if base in near:
                        continue
                    key = base
            ids = young(key)
            if ids is None:
                ids = old(key)
                if ids is None:
                    missing.add(key)
                    continue
                self.young[key] = ids
            near[key] = ids
        self._learn(missing)
        for piece in missing:
            near[piece] = self.young[piece]
        for piece, base in stopped:
            near[piece] = near[base] + stops[piece[-1]]
        spaced = wanted & self.spaced
        if spaced and self.layout == "leading":
            cut = [None if c is not None and not spaced.isdisjoint(c) and _RUN.search(t) else c for c, t in zip(cut, texts, strict=True)]
        look = near.__getitem__
        return [self._ids(text) if pieces is None else b"".join(map(look, pieces)) for text, pieces in zip(texts, cut, strict=True)]


@functools.cache
def encoder(path: str) -> PieceEncoder:
    """One encoder a worker process and file."""
    return PieceEncoder(path)


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
