"""Language identification by the nearest of several TF-IDF centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoice_lake.llm.features import damp, letter_grams
from invoice_lake.llm.learning import features_of, inverse_frequencies, share_of
from invoice_lake.llm.storage import small_batches, with_fields
from invoice_lake.llm.words import Texts, slabs

#: Slots of the n-gram vectors, centroids per language, and the bound on the documents that each language's are fitted to.
WIDTH, CENTROIDS, PER_LANGUAGE = 4096, 4, 1500
#: More values of lang than this are an error; it bounds what is broadcast.
MAX_LANGUAGES = 1000
#: A cluster with less than this part of its language's rows is dropped, and its rows go to the others.
LEAST_SHARE = 0.05
#: A document is rejected when its cosine is below this part of the median cosine among its language's fitted documents.
REJECT = 1 / 3
UNDETERMINED = "und"
_ASCII_LETTERS = np.zeros(256, bool)
_ASCII_LETTERS[0x41:0x5B] = _ASCII_LETTERS[0x61:0x7B] = True


@dataclass
class LanguageModel:
    weights: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    cutoffs: np.ndarray


def _cluster(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most k centroids of unit rows by cosine, none of them for a few odd rows.

    The first start is the row nearest the mean; each next one is drawn in proportion to the distance from those before, with a
    fixed seed, so most starts lie in the bulk. Clusters below ``LEAST_SHARE`` are dropped in every round, never the largest.
    """
    draw = np.random.default_rng(7)
    centroids = rows[[int(np.argmax(rows @ rows.mean(axis=0)))]]
    gaps = np.maximum(1 - rows @ centroids[0], 0)
    while len(centroids) < min(k, len(rows)) and gaps.sum() > 1e-6 * len(rows):
        sums = np.cumsum(gaps, dtype=np.float64)
        centroids = np.vstack([centroids, rows[int(np.searchsorted(sums, draw.random() * sums[-1]))]])
        gaps = np.minimum(gaps, np.maximum(1 - rows @ centroids[-1], 0))
    for _ in range(rounds):
        nearest = np.argmax(rows @ centroids.T, axis=1)
        sizes = np.bincount(nearest, minlength=len(centroids))
        stay = np.flatnonzero((sizes >= max(1, LEAST_SHARE * len(rows))) | (sizes == sizes.max()))
        sums = np.stack([rows[nearest == i].sum(axis=0) for i in stay])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centroids


def _fit_language(group: pa.Table, weights: np.ndarray) -> pa.Table:
    group = group.sort_by("doc_id")  # the same result in whatever order the rows come
    rows = features_of(group.select(["text"]), len(weights), letter_grams, lambda counts: damp(counts, weights))
    rows = rows[rows.any(axis=1)]
    centroids = _cluster(rows, CENTROIDS) if len(rows) else np.zeros((0, len(weights)), np.float32)
    usual = float(np.median((rows @ centroids.T).max(axis=1))) if len(rows) else 0.0
    return pa.table({
        "lang": pa.array([group["lang"][0].as_py()] * len(centroids), pa.string()),
        "cutoff": pa.array([REJECT * usual] * len(centroids), pa.float64()),
        "centroid": pa.array([c.astype(np.float32).tobytes() for c in centroids], pa.binary())})


def fit_languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Centroids learned from (doc_id, text, lang) rows with a language.

    Document frequencies cover all rows. Each language is clustered in a task of its own, on about ``per_language``
    ids chosen by a hash, with one row each. Only the centroids reach the driver.
    """
    known = docs.where("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    weights = inverse_frequencies(known, WIDTH, letter_grams)
    counts = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang")
    if not counts:
        return LanguageModel(weights, np.zeros((0, WIDTH), np.float32), [], np.zeros(0))
    rates = [(r["lang"], min(1.0, per_language / r["count"])) for r in counts]
    shares = docs.sparkSession.createDataFrame(rates, "lang string, share double")
    chosen = known.join(F.broadcast(shares), "lang").where(share_of("doc_id", 43) <= F.col("share"))
    fitted = chosen.groupBy("lang", "doc_id").agg(F.min("text").alias("text")).groupBy("lang").applyInArrow(
        lambda group: _fit_language(group, weights), "lang string, cutoff double, centroid binary")
    rows = sorted(fitted.collect(), key=lambda r: (r["lang"], bytes(r["centroid"])))
    centroids = np.array([np.frombuffer(r["centroid"], np.float32) for r in rows], np.float32).reshape(-1, WIDTH)
    return LanguageModel(weights, centroids, [r["lang"] for r in rows], np.array([r["cutoff"] for r in rows]))


def _lettered(texts: Texts) -> np.ndarray:
    """Whether each text has a letter of any script."""
    found = texts.counts(_ASCII_LETTERS) > 0
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in texts.bytes(i).decode("utf-8", "replace"))
    return found


def _predict(batches: Iterator[pa.RecordBatch], model: LanguageModel) -> Iterator[pa.RecordBatch]:
    for rows, texts in slabs(batches):
        usable = _lettered(texts) if model.languages else np.zeros(len(texts), bool)
        lang, score, kept = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if usable.any():
            near = damp(letter_grams(texts, len(model.weights)), model.weights) @ model.centroids.T
            best = np.argmax(near, axis=1)
            top = np.clip(near[np.arange(len(texts)), best], 0, 1)
            lang = [model.languages[b] if u else UNDETERMINED for b, u in zip(best, usable)]
            score, kept = np.where(usable, top, 0.0), usable & (top >= model.cutoffs[best])
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(~kept)],
            [*rows.schema.names, "lang_pred", "lang_score", "lang_rejected"])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred, lang_score (cosine to the nearest centroid, 0 to 1) and lang_rejected; reads only ``text``.

    A null text, a text without a letter, and every text under a model without languages is ``und``, with score 0, and
    rejected. A text whose cosine is below its language's cutoff keeps its nearest language and is rejected. Columns
    of these three names are replaced. Whole texts are used. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "lang_score", "lang_rejected")
    return small_batches(kept).mapInArrow(
        lambda batches: _predict(batches, shared.value),
        with_fields(kept.schema, "lang_pred string, lang_score double, lang_rejected boolean"))
