"""Token counts of whole texts; huge texts by overlapping chunks that are spliced where their tokens provably agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from invoice_lake.llm.storage import small_batches, with_fields
from invoice_lake.llm.tokens import byte_ids, tokenizer
from invoice_lake.llm.words import Texts, slabs

#: Texts above CHUNK characters (bytes, to be quick) are encoded in chunks of that many with so many in common.
CHUNK, OVERLAP, LIMIT = 1 << 16, 512, 512


def _splice(text: str, lo: int, hi: int) -> Iterator[int]:
    """Places between lo and hi, last first, where a byte-level tokenizer starts a token whatever lies around.

    That is a single space between two characters that are not white space: no pre-token reaches over its front.
    """
    at = text.rfind(" ", lo + 1, hi - 1)
    while at > lo:
        if not text[at - 1].isspace() and not text[at + 1].isspace():
            yield at
        at = text.rfind(" ", lo + 1, at)


def _starts(encoder, text: str, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.array(encoder.encode(text[lo:hi], add_special_tokens=False).offsets, np.int64).reshape(-1, 2) + lo
    return offsets[:, 0], offsets[:, 1]


def _boundary(at: int, starts: np.ndarray, ends: np.ndarray) -> int:
    """Tokens before ``at`` if a token begins there, else -1."""
    i = int(np.searchsorted(starts, at))
    return i if i == 0 or ends[i - 1] <= at else -1


def count_huge(encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text from overlapping chunks.

    Two neighbouring chunks are spliced at a stable place of their overlap at which both have a token boundary and the
    next token in common. Without one the overlap is widened, in the end over all of the text that is left.
    """
    total, lo, hi = 0, 0, min(chunk, len(text))
    starts, ends = _starts(encoder, text, lo, hi)
    done = 0  # tokens of the current chunk that are counted already
    while hi < len(text):
        common = overlap
        while True:
            next_lo = max(hi - common, lo)
            if next_lo == lo:  # widened to the whole chunk: encode a longer one from its splice
                hi = min(len(text), lo + 2 * (hi - lo))
                starts, ends = _starts(encoder, text, lo, hi)
                break
            next_hi = min(len(text), next_lo + chunk + common)
            next_starts, next_ends = _starts(encoder, text, next_lo, next_hi)
            for at in _splice(text, next_lo, hi):
                i, j = _boundary(at, starts, ends), _boundary(at, next_starts, next_ends)
                agree = i >= 0 and j >= 0 and i < len(starts) and j < len(next_starts) and starts[i] == next_starts[j]
                if agree and i >= done:
                    total += i - done
                    starts, ends, done, lo, hi = next_starts, next_ends, j, next_lo, next_hi
                    break
            else:
                common *= 4
                continue
            break
    return total + len(starts) - done


def _count(batches: Iterator[pa.RecordBatch], path: str, chunk: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in slabs(batches):
        sizes = np.diff(texts.offsets)
        huge = sizes > chunk
        tokens = np.zeros(len(texts), np.int64)
        if not huge.all():
            usual = Texts(texts.data[np.repeat(~huge, sizes)], np.concatenate([[0], np.cumsum(sizes[~huge])]))
            tokens[~huge] = byte_ids(path).counts(usual)
        for i in np.flatnonzero(huge):
            tokens[i] = count_huge(tokenizer(path), texts.bytes(i).decode("utf-8"), chunk)
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(sizes), pa.array(tokens), pa.array(tokens > LIMIT)],
            [*rows.schema.names, "n_bytes", "n_tokens", "over_limit"])


def count_tokens(docs: DataFrame, tokenizer_path: str, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (more than 512 tokens) of each whole ``text``.

    The counts are those of the byte-level tokenizer of the file without added special tokens. Null and empty
    texts have none. Columns of these names are replaced. Rows are neither moved nor merged; no rows give no rows.
    """
    kept = docs.drop("n_bytes", "n_tokens", "over_limit")
    return small_batches(kept).mapInArrow(
        lambda batches: _count(batches, tokenizer_path, chunk),
        with_fields(kept.schema, "n_bytes long, n_tokens long, over_limit boolean"))
