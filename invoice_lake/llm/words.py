"""Words of Arrow text columns as hashes, computed for many documents at once on their UTF-8 bytes.

Both word patterns of the operators can be decided byte by byte, because every byte of a multi-byte
character is 0x80 or more: ``BLANK_WORDS`` is ``[^\\x20\\x09-\\x0D]+`` and ``ALNUM_WORDS`` is
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa

SLAB_BYTES = 1 << 20
SLAB_ROWS = 512
LONG_WORD = 1 << 16
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

_codes = np.arange(256)
BLANK_WORDS = ~((_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D)))
ALNUM_WORDS = (
    (_codes >= 0x80) | ((_codes >= 0x30) & (_codes <= 0x39))
    | ((_codes >= 0x41) & (_codes <= 0x5A)) | ((_codes >= 0x61) & (_codes <= 0x7A))
)
LOWER = np.where((_codes >= 0x41) & (_codes <= 0x5A), _codes + 32, _codes).astype(np.uint8)
KEEP_CASE = _codes.astype(np.uint8)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants from a seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(seed)) | np.uint64(1)


_BYTE_VALUES = constants(256, 11)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = np.full(n, _ODD, np.uint64), np.full(n, pow(_ODD, -1, 1 << 64), np.uint64)
    base[0] = inverse[0] = 1
    return np.cumprod(base), np.cumprod(inverse)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = KEEP_CASE) -> np.ndarray:
    """A 64-bit hash of each byte span; equal bytes (after ``fold``) give equal hashes at any place."""
    out = np.empty(len(starts), np.uint64)
    values = _BYTE_VALUES[fold]
    long = (ends - starts) > LONG_WORD
    for i in np.flatnonzero(long):
        digest = blake2b(fold[data[starts[i]:ends[i]]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    short = np.flatnonzero(~long)
    at = 0
    while at < len(short):  # spans in order, as many at a time as fit into one slab
        first = int(starts[short[at]])
        stop = int(np.searchsorted(ends[short], first + SLAB_BYTES + LONG_WORD, side="right"))
        stop = max(stop, at + 1)
        part = short[at:stop]
        last = int(ends[part[-1]])
        powers, inverse = _powers(SLAB_BYTES + 2 * LONG_WORD)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(values[data[first:last]] * powers[: last - first], out=sums[1:])
        s, e = starts[part] - first, ends[part] - first
        out[part] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(_ODD))
        at = stop
    return out


@dataclass
class Texts:
    """UTF-8 bytes of consecutive texts; text i lies in data[offsets[i]:offsets[i + 1]]. Null texts are empty."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def spans(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the longest runs of member bytes inside one text, and the first run of each text."""
        inside = members[self.data]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < len(self.data))]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[edges], after[edges - 1] = False, False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def words(self, members: np.ndarray, fold: np.ndarray = KEEP_CASE) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word, and the place of each text's first word (one more place than texts)."""
        starts, ends, first = self.spans(members)
        return hash_spans(self.data, starts, ends, fold), first

    def counts(self, members: np.ndarray) -> np.ndarray:
        """Bytes of each text that are members."""
        sums = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(members[self.data], out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a string column without copying them."""
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, values = column.buffers()
    if len(column) == 0 or places is None:
        return Texts(np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    offsets = np.frombuffer(places, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    return Texts(data[offsets[0]:offsets[-1]], offsets - offsets[0])


def slabs(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut batches into runs of whole rows with about ``SLAB_BYTES`` of text, and give each with its texts."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        whole = texts_of(batch.column(text))
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(whole.offsets, whole.offsets[at] + SLAB_BYTES, side="right")) - 1
            stop = min(max(stop, at + 1), batch.num_rows, at + SLAB_ROWS)
            lo, hi = whole.offsets[at], whole.offsets[stop]
            yield batch.slice(at, stop - at), Texts(whole.data[lo:hi], whole.offsets[at:stop + 1] - lo)
            at = stop


def rows_of(first: np.ndarray, total: int | None = None) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def grams(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k consecutive words that lie in one text, and the place of the first of them."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    out = np.zeros(n, np.uint64)
    for j, factor in enumerate(constants(k, 1000 + k)):
        out += words[j:j + n] * factor
    owner = rows_of(first)
    places = np.flatnonzero(owner[:n] == owner[k - 1:])
    return mix(out[places]), places
