"""Vocabularies of public tokenizers, loaded once in each Python worker.

Both vocabularies cut a text into pieces (words, numbers, runs of signs, and white space where it
counts) before they merge, so a text's ids are those of its pieces one after another. A slice of
texts is cut into pieces by classes of characters, its distinct pieces are looked up in a bounded
memo, and the tokenizers library encodes those that are missing. Texts with characters whose class,
lower case or normal form is not plain (``plain_characters``) are encoded whole by the library.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

from llm.hashing import slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters that a tokenizer may take for white space, or not, beside \x20 and \x09-\x0D.
ODD = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2030), *range(0x205F, 0x2065)]
LETTER, NUMBER, SIGN, BLANK, UNSURE = 1, 2, 3, 0, 9
PLAIN = 0x3000
MEMO = 100_000
LONG = 64
LINE = 256
SLICE = 1 << 21


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def plain_characters(lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(class, lower case if asked for) of the characters under ``PLAIN``, which stands for all others.

    Unsure are characters that are unassigned, combine with others, change in normal form, or have a
    lower case of several characters.
    """
    kind, to = np.full(PLAIN + 1, UNSURE, dtype=np.uint8), np.arange(PLAIN + 1, dtype=np.uint32)
    for c in range(PLAIN):
        x = chr(c)
        low = x.lower() if lower else x
        category = unicodedata.category(low[0])
        if c in (0x20, *range(0x09, 0x0E)):
            kind[c] = BLANK
        elif not (c in ODD or 0x1100 <= c < 0x1200 or len(low) > 1 or ord(low) >= PLAIN or category[0] == "M" or category in ("Cn", "Cs") or unicodedata.normalize("NFC", x) != x):
            kind[c], to[c] = {"L": LETTER, "N": NUMBER}.get(category[0], SIGN), ord(low)
    return kind, to


def starts_of(c: np.ndarray, kind: np.ndarray, at: np.ndarray, spaced: bool) -> np.ndarray:
    """Where pieces start, for characters ``c`` of texts that start at ``at``.

    A piece is a run of letters, of numbers or of signs; an apostrophe that begins a run of signs takes
    s, t, m, d, re, ve or ll with it. If ``spaced``, a piece also takes a space before it, and what is
    left of white space is a piece; else each number is a piece of its own.
    """
    n = len(c)
    edge = np.zeros(n + 3, dtype=bool)
    edge[at] = True  # a text ends at n, too
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    if spaced:
        last = np.flatnonzero((kind[:-1] == BLANK) & (kind[1:] != BLANK) & ~edge[1:n]) if n else np.empty(0, dtype=np.int64)
        start[last] = True
        start[last[c[last] == 0x20] + 1] = False
    else:
        start |= kind == NUMBER
    quote = np.flatnonzero((c == 0x27) & start)
    after = np.concatenate([c, np.zeros(2, dtype=c.dtype)])
    one, two = np.where(edge[quote + 1], 0, after[quote + 1]), np.where(edge[quote + 1] | edge[quote + 2], 0, after[quote + 2])
    is_ = lambda x, letter: x == ord(letter)
    long = ((is_(one, "r") | is_(one, "v")) & is_(two, "e")) | (is_(one, "l") & is_(two, "l"))
    short = is_(one, "s") | is_(one, "t") | is_(one, "m") | is_(one, "d")
    for hit, size in ((quote[short], 1), (quote[long], 2)):
        start[hit + 1] = False
        rest = hit + 1 + size
        start[rest[rest < n]] = True
    return start


class Memo:
    """ids of pieces seen lately, in two generations: when the younger one is full (``MEMO``, or what one slice adds), it replaces the older."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, pieces: list[str]) -> list[bytes | None]:
        """The ids of each piece, None if they are not known; what only the older generation knows is kept in the younger."""
        found = list(map(self.young.get, pieces))
        rest = [i for i, ids in enumerate(found) if ids is None]
        kept = {}
        for i, ids in zip(rest, map(self.old.get, [pieces[i] for i in rest]), strict=True):
            if ids is not None:
                found[i] = kept[pieces[i]] = ids
        self.put(kept)
        return found

    def put(self, new: dict[str, bytes]) -> None:
        if self.young and len(self.young) + len(new) > MEMO:
            self.young, self.old = {}, self.young
        self.young.update(new)


class Encoder:
    """ids of texts, as little-endian unsigned 32-bit integers.

    ``spaced``: white space is part of the vocabulary (byte-level); otherwise the vocabulary drops
    white space and is in lower case.
    """

    def __init__(self, path: str, spaced: bool) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaced = spaced
        self.memo = Memo()
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for x, i in vocab.items() if suffix and x.endswith(suffix)]] = True
        self.lines = Tokenizer(self.tokenizer.model)
        self.lines.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), self.pieces.pre_tokenizer])

    def ids_of(self, distinct: list[str]) -> list[bytes]:
        found = self.memo.get(distinct)
        missing = [i for i, ids in enumerate(found) if ids is None]
        pieces = [distinct[i] for i in missing]
        new = packed(self.pieces, pieces) if self.spaced else self.in_lines(pieces)
        for i, ids in zip(missing, new, strict=True):
            found[i] = ids
        self.memo.put({x: ids for x, ids in zip(pieces, new, strict=True) if len(x) <= LONG})
        return found

    def in_lines(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces without white space: many make one line to the library, and a token that ends a word ends a piece."""
        texts = [" ".join(pieces[at : at + LINE]) for at in range(0, len(pieces), LINE)]
        ids = np.frombuffer(b"".join(packed(self.lines, texts)), dtype="<u4")
        stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(stops) != len(pieces):
            return packed(self.pieces, pieces)
        whole, stops = ids.tobytes(), stops.tolist()
        return [whole[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; a null is empty."""
        out: list[bytes] = []
        for first, last, _, _ in slices(texts, SLICE):
            out += self.slice([x or "" for x in texts.slice(first, last - first).to_pylist()])
        return out

    def slice(self, rows: list[str]) -> list[bytes]:
        known, lower = plain_characters(not self.spaced)
        at = np.cumsum([0, *map(len, rows)])
        c = np.frombuffer("".join(rows).encode("utf-32-le"), dtype="<u4")
        kind = known[np.minimum(c, PLAIN)]
        unsure = np.concatenate([[0], np.cumsum(kind == UNSURE)])[at]
        whole = np.flatnonzero(unsure[1:] > unsure[:-1]).tolist()
        if whole:
            done = packed(self.tokenizer, [rows[i] for i in whole])
            out = self.slice(["" if unsure[i + 1] > unsure[i] else x for i, x in enumerate(rows)])
            for i, ids in zip(whole, done, strict=True):
                out[i] = ids
            return out
        start = starts_of(lower[c], kind, at, self.spaced)
        if not self.spaced:
            keep = kind != BLANK
            at = np.concatenate([[0], np.cumsum(keep)])[at]
            c, start = lower[c[keep]], start[keep]
        begin = np.flatnonzero(start)
        size = np.concatenate([[0], np.cumsum(1 + (c >= 0x80) + (c >= 0x800), dtype=np.int32)])
        edges = size[np.append(begin, len(c))].astype(np.int32)
        text = c.astype("<u4").tobytes().decode("utf-32-le").encode()
        coded = pa.StringArray.from_buffers(len(begin), pa.py_buffer(edges), pa.py_buffer(text)).dictionary_encode()
        ids = self.ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        flat, first = np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        placed = flat[np.repeat(first[codes] - ends[:-1], sizes[codes]) + np.arange(ends[-1])]
        stops = ends[np.searchsorted(begin, at)].tolist()
        return [placed[a:b].tobytes() for a, b in zip(stops[:-1], stops[1:], strict=True)]


def packed(tokenizer, texts: list[str]) -> list[bytes]:  # noqa: ANN001
    return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=4)
def encoder(path: str, spaced: bool) -> Encoder:
    return Encoder(path, spaced)
