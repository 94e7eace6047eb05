"""Quality scores by a vote of the nearest labelled documents in a latent semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoice_lake.llm.features import damp_halves, word_and_byte_grams
from invoice_lake.llm.learning import features_of, inverse_frequencies, labelled_texts
from invoice_lake.llm.storage import small_batches, with_fields
from invoice_lake.llm.words import slabs

#: Slots of the TF-IDF vectors, latent dimensions, neighbours that vote, and the bound on labelled rows (4 MB of vectors).
WIDTH, DIMENSIONS, NEIGHBOURS, LABELLED_ROWS, ACCEPT, BLOCK = 4096, 64, 16, 6000, 0.3, 256
#: Power of the cosine in a neighbour's weight.
SHARPNESS = 8


@dataclass
class NeighbourModel:
    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 in a vote of the nearest labelled vectors; the prior where nothing is similar.

        A neighbour's weight is a power of its cosine over the share of its label, so that both labels start even.
        """
        latent = _unit(damp_halves(counts, self.weights) @ self.axes)
        out = np.full(len(counts), self.prior)
        k = min(NEIGHBOURS, len(self.vectors))
        share = np.where(self.labels == 1, self.prior, 1 - self.prior)
        for lo in range(0, len(counts) if k else 0, BLOCK):
            cosine = latent[lo:lo + BLOCK] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            closeness = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64)
            weight = closeness ** SHARPNESS / share[near]
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1)
            out[lo:lo + BLOCK] = np.divide(vote, total, out=np.full(len(near), self.prior), where=total > 0)
        return np.clip(out, 0, 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def _axes(rows: np.ndarray, k: int) -> np.ndarray:
    """Leading right singular vectors by a seeded random projection with power steps."""
    start = np.random.default_rng(7).standard_normal((rows.shape[1], k + 16)).astype(np.float32)
    span = np.linalg.qr(rows @ start)[0]
    for _ in range(3):
        span = np.linalg.qr(rows @ (rows.T @ span))[0]
    return np.linalg.svd(span.T @ rows, full_matrices=False)[2][:k].T


def _fit(sample: pa.Table, weights: np.ndarray) -> pa.Table:
    sample = sample.sort_by("doc_id")
    rows = features_of(sample.select(["text"]), len(weights), word_and_byte_grams, lambda counts: damp_halves(counts, weights))
    axes = np.zeros((len(weights), DIMENSIONS), np.float32)
    found = _axes(rows, min(DIMENSIONS, *rows.shape))
    axes[:, :found.shape[1]] = found
    return pa.table({
        "axes": pa.array([axes.astype(np.float32).tobytes()], pa.binary()),
        "vectors": pa.array([_unit(rows @ axes).astype(np.float32).tobytes()], pa.binary()),
        "labels": pa.array([sample["label"].to_pylist()], pa.list_(pa.int32()))})


def fit_neighbours(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_ROWS) -> NeighbourModel:
    """Latent vectors of about ``bound`` documents labelled in ``labels.quality``, outside the held-out fold.

    Document frequencies cover all documents; the projection is fitted in one task on the bounded sample. Without
    labelled rows the model has no neighbours and every score is one half.
    """
    weights = inverse_frequencies(docs, WIDTH, word_and_byte_grams)
    sample = labelled_texts(docs, labels, "quality", bound)
    fitted = sample.groupBy(F.lit(0).alias("all")).applyInArrow(
        lambda group: _fit(group, weights), "axes binary, vectors binary, labels array<int>").collect()
    if not fitted:
        none = np.zeros((0, DIMENSIONS), np.float32)
        return NeighbourModel(weights, np.zeros((WIDTH, DIMENSIONS), np.float32), none, np.zeros(0), 0.5)
    marks = np.array(fitted[0]["labels"], np.float64)
    return NeighbourModel(
        weights, np.frombuffer(fitted[0]["axes"], np.float32).reshape(WIDTH, DIMENSIONS),
        np.frombuffer(fitted[0]["vectors"], np.float32).reshape(-1, DIMENSIONS), marks, float(marks.mean()))


def _score(batches: Iterator[pa.RecordBatch], model: NeighbourModel) -> Iterator[pa.RecordBatch]:
    for rows, texts in slabs(batches):
        score = model.scores(word_and_byte_grams(texts, WIDTH))
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(score), pa.array((score >= ACCEPT).astype(np.int32))],
            [*rows.schema.names, "quality_score", "quality_predicted"])


def score_quality(docs: DataFrame, model: NeighbourModel) -> DataFrame:
    """``docs`` with quality_score (0 to 1, higher: label 1 likelier) and quality_predicted (1 from 0.3 on).

    Reads only the whole ``text``. Null, empty and featureless texts get the share of label 1 in the sample. Every
    document is compared exactly with every labelled vector, in blocks. Columns of these names are replaced.
    No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("quality_score", "quality_predicted")
    return small_batches(kept).mapInArrow(
        lambda batches: _score(batches, shared.value), with_fields(kept.schema, "quality_score double, quality_predicted int"))
