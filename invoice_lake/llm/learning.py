"""What the classifiers share: the held-out fold, bounded samples of labelled rows, corpus statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoice_lake.llm.storage import small_batches
from invoice_lake.llm.words import Texts, slabs


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """The fold that no model learns from: crc32 of the id as text is a multiple of 5. A null id is held out."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(True))


def share_of(key: str, seed: int) -> Column:
    """A number from 0 to 1 by the 64-bit hash of ``key``: a share of the keys lies below it, however small the share."""
    return F.xxhash64(F.lit(seed), key) / F.lit(2.0**64) + 0.5


def sample_below(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows of ``rows``, all if there are fewer, chosen by a hash of ``key`` and so always the same."""
    return rows.where(share_of(key, 41) <= min(1.0, bound / max(1, rows.count())))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, label) of about ``bound`` labelled documents outside the held-out fold.

    A doc_id labelled more than once counts once, with its lowest label; one with several rows gives its first text in order, so
    the bound holds for the joined rows. The labels are cut down to it first, and the join sends a small side to the documents.
    """
    known = labels.where(F.col(label).isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(sample_below(known, "doc_id", bound)), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def _document_counts(batches: Iterator[pa.RecordBatch], width: int, features: Callable[[Texts, int], np.ndarray]):
    seen, rows = np.zeros(width, np.int64), 0
    for _, texts in slabs(batches):
        seen += (features(texts, width) > 0).sum(axis=0)
        rows += len(texts)
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, width)), pa.array(np.concatenate([[rows], seen]))], ["slot", "n"])


def inverse_frequencies(docs: DataFrame, width: int, features: Callable[[Texts, int], np.ndarray]) -> np.ndarray:
    """Smoothed inverse document frequency of every slot over all ``docs``; each task sends one row per slot."""
    parts = small_batches(docs.select("text")).mapInArrow(lambda batches: _document_counts(batches, width, features), "slot long, n long")
    total, seen = 0, np.zeros(width, np.float64)
    for slot, n in parts.groupBy("slot").agg(F.sum("n")).collect():
        if slot < 0:
            total = n
        else:
            seen[slot] = n
    return (np.log((1 + total) / (1 + seen)) + 1).astype(np.float32)


def features_of(
    table: pa.Table, width: int, features: Callable[[Texts, int], np.ndarray], finish: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """Feature rows of a bounded sample, each slab finished and put in its place of one matrix."""
    out, at = np.empty((len(table), width), np.float32), 0
    for _, texts in slabs(table.combine_chunks().to_batches()):
        out[at:at + len(texts)] = finish(features(texts, width))
        at += len(texts)
    return out
