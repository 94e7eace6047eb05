"""Exact token ids of whole texts from a tokenizers file, encoding each distinct piece of text once per worker.

A text is cut only where the tokenizer itself always cuts, so the ids of the pieces, one after another, are the
ids of the text (``tests/llm/test_text_operators.py`` compares whole texts). Texts that hold a special string or white
space beyond ASCII are encoded whole by the library instead; nothing is left out.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from invoice_lake.llm.words import KEEP_CASE, LOWER, Texts, hash_spans

CACHE_PIECES = 600_000

_codes = np.arange(256)
_BLANK = (_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D))
_LETTER = ((_codes | 0x20) >= 0x61) & ((_codes | 0x20) <= 0x7A) & (_codes < 0x80)
_MARK = (_codes > 0x20) & (_codes < 0x7F) & ~_LETTER & ~((_codes >= 0x30) & (_codes <= 0x39)) & (_codes != 0x27)
#: White space that is not ASCII, control characters that some patterns take for white space, special strings.
_UNUSUAL = re.compile(
    rb"<\||[\x00-\x08\x1c-\x1f\x7f]|\xc2[\x80-\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, single-threaded because Spark already runs one task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def unusual(texts: Texts) -> np.ndarray:
    """Texts that must be encoded whole."""
    marked = np.zeros(len(texts), bool)
    if len(texts.data):
        places = [m.start() for m in _UNUSUAL.finditer(memoryview(texts.data))]
        marked[np.searchsorted(texts.offsets, places, side="right") - 1] = True
    return marked


def _edges(texts: Texts) -> np.ndarray:
    """Between which bytes a text begins or a letter meets a mark other than an apostrophe."""
    letter, mark = _LETTER[texts.data], _MARK[texts.data]
    edge = np.zeros(len(texts.data) + 1, bool)
    edge[1:-1] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    edge[texts.offsets] = True
    return edge


def cut_dropping_blanks(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Pieces for tokenizers that drop white space and never let a token reach over it."""
    edge, ink = _edges(texts), ~_BLANK[texts.data]
    edge[1:-1] |= ink[:-1] != ink[1:]
    places = np.flatnonzero(edge)
    starts, ends = places[:-1], places[1:]
    keep = ink[starts] if len(starts) else np.empty(0, bool)
    return starts[keep], ends[keep]


def cut_keeping_blanks(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Pieces for byte-level tokenizers whose tokens may start with one space.

    A single blank between two other bytes starts a new token; if it is not a space it is a token alone.
    Longer runs of blanks stay inside their piece.
    """
    edge, data = _edges(texts), texts.data
    blank = _BLANK[data]
    if len(data) > 2:
        lone = np.flatnonzero(blank[1:-1] & ~blank[:-2] & ~blank[2:]) + 1
        lone = lone[~edge[lone] & ~edge[lone + 1]] if len(lone) else lone  # not at the ends of a text
        edge[lone] = True
        edge[lone[data[lone] != 0x20] + 1] = True
    places = np.flatnonzero(edge)
    starts, ends = places[:-1], places[1:]
    keep = ends > starts
    return starts[keep], ends[keep]


class PieceIds:
    """Ids of texts; the ids of pieces seen before come from a cache of bounded size."""

    def __init__(self, path: str, cut, fold: np.ndarray, plain):
        """``fold`` maps bytes that never change the ids; ``plain`` gives the model's own input for simple pieces."""
        self.tokenizer, self.cut, self.fold, self.plain = tokenizer(path), cut, fold, plain
        self.known: dict[int, int] = {}
        self.flat, self.used = np.empty(1 << 16, np.int32), 0
        self.begin, self.count = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int32)

    def _learn(self, hashes: list[int], pieces: list[bytes]) -> None:
        direct = [self.plain(p) for p in pieces]
        rest = [p.decode("utf-8") for p, d in zip(pieces, direct) if d is None]
        encoded = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        tokenize = self.tokenizer.model.tokenize
        ids = [next(encoded).ids if d is None else [t.id for t in tokenize(d)] for d in direct]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        at, n = len(self.known), len(hashes)
        if at + n > len(self.begin):
            self.begin, self.count = (np.resize(x, 2 * (at + n)) for x in (self.begin, self.count))
        if self.used + int(sizes.sum()) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (self.used + int(sizes.sum())))
        ends = self.used + np.cumsum(sizes, dtype=np.int64)
        self.begin[at:at + n], self.count[at:at + n] = ends - sizes, sizes
        self.flat[self.used:int(ends[-1])] = np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum()))
        self.used = int(ends[-1])
        self.known.update(zip(hashes, range(at, at + n)))

    def _rows(self, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        """The cache rows of all pieces, in runs of at most ``CACHE_PIECES``; a run's rows hold until the next is taken."""
        for lo in range(0, len(starts), CACHE_PIECES):
            yield self._known_rows(texts, starts[lo:lo + CACHE_PIECES], ends[lo:lo + CACHE_PIECES])

    def _known_rows(self, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The cache row of each piece. Their distinct pieces fit the cache, which is cleared before learning or not at all."""
        hashes = hash_spans(texts.data, starts, ends, self.fold)
        distinct, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        missing = [i for i, h in enumerate(keys) if h not in self.known]
        if len(self.known) + len(missing) > CACHE_PIECES:
            self.known.clear()
            self.used, missing = 0, range(len(keys))
        for lo in range(0, len(missing), 4096):
            part = missing[lo:lo + 4096]
            spans = [(int(starts[sample[i]]), int(ends[sample[i]])) for i in part]
            self._learn([keys[i] for i in part], [texts.data[s:e].tobytes() for s, e in spans])
        return np.fromiter((self.known[h] for h in keys), np.int64, len(keys))[inverse]

    def _ordinary(self, texts: Texts) -> tuple[Texts, np.ndarray]:
        odd = unusual(texts)
        if not odd.any():
            return texts, odd
        sizes = np.where(odd, 0, np.diff(texts.offsets))
        keep = np.repeat(~odd, np.diff(texts.offsets))
        return Texts(texts.data[keep], np.concatenate([[0], np.cumsum(sizes)])), odd

    def counts(self, texts: Texts) -> np.ndarray:
        """Tokens of each text."""
        plain, odd = self._ordinary(texts)
        starts, ends = self.cut(plain)
        first = np.searchsorted(starts, plain.offsets)
        sums, at = np.zeros(len(starts) + 1, np.int64), 1
        for rows in self._rows(plain, starts, ends):
            sums[at:at + len(rows)] = self.count[rows]
            at += len(rows)
        np.cumsum(sums, out=sums)
        out = sums[first[1:]] - sums[first[:-1]]
        for i in np.flatnonzero(odd):
            out[i] = len(self.tokenizer.encode(texts.bytes(i).decode("utf-8"), add_special_tokens=False).ids)
        return out

    def ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and where each text's ids begin (one more place than texts)."""
        plain, odd = self._ordinary(texts)
        starts, stops = self.cut(plain)
        first = np.searchsorted(starts, plain.offsets)
        found, counted = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for rows in self._rows(plain, starts, stops):
            sizes = self.count[rows].astype(np.int64)
            ends = np.cumsum(sizes)
            found.append(self.flat[np.repeat(self.begin[rows] - (ends - sizes), sizes) + np.arange(int(ends[-1]))])
            counted.append(sizes)
        flat = np.concatenate(found)
        begins = np.concatenate([[0], np.cumsum(np.concatenate(counted))])[first]
        if not odd.any():
            return flat, begins
        parts = [
            np.array(self.tokenizer.encode(texts.bytes(i).decode("utf-8"), add_special_tokens=False).ids, np.int32)
            if odd[i] else flat[begins[i]:begins[i + 1]]
            for i in range(len(texts))
        ]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def _lower_letters(piece: bytes) -> str | None:
    """ASCII letters are one lower-cased pre-token."""
    return piece.decode("ascii").lower() if piece.isalpha() else None


def _spaced_letters(piece: bytes) -> str | None:
    """ASCII letters with at most one space before them are one pre-token; its space is written as U+0120."""
    letters = piece[1:] if piece[:1] == b" " else piece
    return piece.decode("ascii").replace(" ", "\u0120") if letters.isalpha() else None


@lru_cache(maxsize=4)
def word_ids(path: str) -> PieceIds:
    """Ids by a tokenizer that drops white space; kept for the life of the Python worker."""
    return PieceIds(path, cut_dropping_blanks, LOWER, _lower_letters)


@lru_cache(maxsize=4)
def byte_ids(path: str) -> PieceIds:
    """Ids by a byte-level tokenizer; kept for the life of the Python worker."""
    return PieceIds(path, cut_keeping_blanks, KEEP_CASE, _spaced_letters)
