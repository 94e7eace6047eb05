"""Hashed n-gram counts of texts as dense rows, for the classifiers."""

from __future__ import annotations

import numpy as np

from invoice_lake.llm.words import BLANK_WORDS, LOWER, Texts, grams, rows_of

_LETTERS = np.zeros(256, bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = _LETTERS[0x80:] = True


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and for the capital letters of U+00C0 to U+00DE."""
    out = LOWER[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def _scatter(out: np.ndarray, owner: np.ndarray, slot: np.ndarray) -> None:
    width = out.shape[1]
    out += np.bincount(owner * width + slot, minlength=out.size).reshape(out.shape)


def byte_grams(texts: Texts, data: np.ndarray, orders: tuple[int, ...], width: int) -> np.ndarray:
    """Counts of runs of bytes inside one text, hashed to ``width`` (a power of two) slots."""
    out = np.zeros((len(texts), width), np.float32)
    if len(texts.data) == 0:
        return out
    owner = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))
    bits = np.uint32(32 - (width.bit_length() - 1))
    for n in orders:
        m = len(data) - n + 1
        if m <= 0:
            continue
        code = np.full(m, n * 0x85EBCA6B & 0xFFFFFFFF, np.uint32)
        for j in range(n):
            code = (code ^ data[j:j + m]) * np.uint32(0x9E3779B1)
            code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA77)
        inside = owner[:m] == owner[n - 1:]
        _scatter(out, owner[:m][inside], (code >> bits)[inside].astype(np.int64))
    return out


def letter_grams(texts: Texts, width: int, orders: tuple[int, ...] = (1, 2, 3)) -> np.ndarray:
    """Counts of byte n-grams of the lower-cased text; everything but letters is one kind of gap."""
    data = fold_case(texts.data)
    return byte_grams(texts, np.where(_LETTERS[data], data, 0x20).astype(np.uint8), orders, width)


def word_and_byte_grams(texts: Texts, width: int) -> np.ndarray:
    """Counts of words and word pairs (first half of the slots) and of byte n-grams (second half).

    A word equal to the one before it, or to the last but one, counts as a repetition in slots 1 and 2 and not as
    itself, so that repetition looks alike whatever is repeated.
    """
    half = width // 2
    counts = np.zeros((len(texts), half), np.float32)
    words, first = texts.words(BLANK_WORDS)
    bits = np.uint64(64 - (half.bit_length() - 1))
    if len(words):
        owner, fresh = rows_of(first), np.ones(len(words), bool)
        for gap in (1, 2):
            same = np.flatnonzero((words[gap:] == words[:-gap]) & (owner[gap:] == owner[:-gap]) & fresh[gap:]) + gap
            _scatter(counts, owner[same], np.full(len(same), gap, np.int64))
            fresh[same] = False
        _scatter(counts, owner[fresh], (words[fresh] >> bits).astype(np.int64))
        pairs, places = grams(words, first, 2)
        whole = fresh[places] & fresh[places + 1]
        _scatter(counts, owner[places[whole]], (pairs[whole] >> bits).astype(np.int64))
    return np.concatenate([counts, byte_grams(texts, texts.data, (1, 2, 3), half)], axis=1)


def damp(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted logarithms of counts, scaled to length one; a row without counts stays zero."""
    out = np.log1p(counts) * weights
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)


def damp_halves(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``damp`` for words and bytes apart, so that each half carries the same length."""
    half = counts.shape[1] // 2
    parts = [damp(counts[:, :half], weights[:half]), damp(counts[:, half:], weights[half:])]
    return np.concatenate(parts, axis=1) * np.float32(0.5 ** 0.5)
