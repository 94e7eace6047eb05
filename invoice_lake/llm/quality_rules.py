"""Quality rules: a calibrated logistic regression on hashed n-grams behind fixed rules on words and repetition."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoice_lake.llm.features import damp_halves, word_and_byte_grams
from invoice_lake.llm.learning import features_of, labelled_texts
from invoice_lake.llm.storage import small_batches, with_fields
from invoice_lake.llm.words import BLANK_WORDS, Texts, grams, hash_spans, rows_of, slabs

#: Slots of the n-gram vectors, the bound on labelled rows to learn from, and the fixed thresholds.
WIDTH, LABELLED_ROWS, KEEP_PROBABILITY, MIN_WORDS, MAX_REPEATED_PERCENT = 4096, 8000, 0.3, 50, 50
_NOT_CONTINUED = np.array([c & 0xC0 != 0x80 for c in range(256)])
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_NOT_NEWLINE = np.arange(256) != 0x0A


@dataclass
class QualityModel:
    weights: np.ndarray
    intercept: float
    slope: float
    shift: float

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * (rows @ self.weights + self.intercept) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _regress(rows: np.ndarray, labels: np.ndarray, penalty: float = 1e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps."""
    width = rows.shape[1]
    at = look = np.zeros(width + 1, np.float32)
    step = np.float32(1 / (0.5 + penalty))
    for i in range(rounds):
        error = (_sigmoid(rows @ look[:width] + look[width]) - labels).astype(np.float32) / len(rows)
        slope = np.concatenate([rows.T @ error + np.float32(penalty) * look[:width], [error.sum()]])
        after = look - step * slope
        look = after + np.float32(i / (i + 3)) * (after - at)
        at = after
    return at[:width], float(at[width])


def _calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from margins to labels, with counts smoothed by one, by Newton steps."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    rows, theta = np.stack([margins, np.ones_like(margins)], axis=1).astype(np.float64), np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(rows @ theta)
        curve = rows.T @ (rows * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        move = np.linalg.solve(curve, rows.T @ (p - goal))
        theta = theta - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return float(theta[0]), float(theta[1])


def _fit(sample: pa.Table) -> pa.Table:
    sample = sample.sort_by("doc_id")
    apart = np.arange(len(sample)) % 5 == 4
    sample, n = sample.take(pa.array(np.argsort(apart, kind="stable"))), int((~apart).sum())
    rows = features_of(sample.select(["text"]), WIDTH, word_and_byte_grams, lambda counts: damp_halves(counts, np.ones(WIDTH, np.float32)))
    labels = sample["label"].to_numpy().astype(np.float64)
    weights, intercept = _regress(rows[:n], labels[:n])
    slope, shift = _calibrate(rows[n:] @ weights + intercept, labels[n:]) if apart.any() else (1.0, 0.0)
    return pa.table({"weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary()),
                     "terms": pa.array([[intercept, slope, shift]], pa.list_(pa.float64()))})


def fit_quality(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_ROWS) -> QualityModel:
    """The model of ``labels.quality``, learned in one task from about ``bound`` rows outside the held-out fold.

    A fifth of the sample is kept apart for calibration. Without labelled rows every probability is one half.
    """
    sample = labelled_texts(docs, labels, "quality", bound)
    fitted = sample.groupBy(F.lit(0).alias("all")).applyInArrow(lambda group: _fit(group), "weights binary, terms array<double>").collect()
    if not fitted:
        return QualityModel(np.zeros(WIDTH, np.float32), 0.0, 1.0, 0.0)
    return QualityModel(np.frombuffer(fitted[0]["weights"], np.float32), *fitted[0]["terms"])


def _repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a three-word window found twice or more in that text."""
    windows, places = grams(hashes, first, 3)
    if len(places) == 0:
        return np.zeros(len(first) - 1, np.int64)
    owner = rows_of(first)
    order = np.lexsort((windows, owner[places]))
    w, o = windows[order], owner[places][order]
    equal = (w[1:] == w[:-1]) & (o[1:] == o[:-1])
    twice = np.zeros(len(w), bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    covered = np.zeros(len(hashes), bool)
    for j in range(3):
        covered[places[order[twice]] + j] = True
    return np.bincount(owner[covered], minlength=len(first) - 1)


def _repeated_lines(texts: Texts) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text."""
    starts, ends, _ = texts.spans(_NOT_NEWLINE)
    words = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(BLANK_WORDS[texts.data], out=words[1:])
    filled = words[ends] > words[starts]
    starts, ends = starts[filled], ends[filled]
    owner = np.searchsorted(texts.offsets, starts, side="right") - 1
    hashes = hash_spans(texts.data, starts, ends)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    return np.bincount(o[1:][(h[1:] == h[:-1]) & (o[1:] == o[:-1])], minlength=len(texts))


def measures(texts: Texts) -> dict[str, np.ndarray]:
    """The counts behind the fixed rules."""
    hashes, first = texts.words(BLANK_WORDS)
    return {
        "n_words": np.diff(first), "word_chars": texts.counts(BLANK_WORDS & _NOT_CONTINUED), "n_symbols": texts.counts(_SYMBOLS),
        "n_dup_lines": _repeated_lines(texts), "n_repeat_words": _repeated_words(hashes, first)}


def _judge(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    for rows, texts in slabs(batches):
        found = measures(texts)
        failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEATED_PERCENT * found["n_words"])
        p = model.probability(damp_halves(word_and_byte_grams(texts, WIDTH), np.ones(WIDTH, np.float32))).astype(np.float64)
        added = {**{k: pa.array(v, pa.int64()) for k, v in found.items()}, "base_failed": pa.array(failed),
                 "quality_probability": pa.array(p), "quality_kept": pa.array(~failed & (p >= KEEP_PROBABILITY))}
        yield pa.RecordBatch.from_arrays([*rows.columns, *added.values()], [*rows.schema.names, *added])


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality_probability", "quality_kept")


def judge(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with the counts, base_failed, quality_probability and quality_kept of each whole ``text``.

    Kept are texts of at least 50 words, with at most half of them in repeated three-word windows, and a calibrated
    probability of 0.3 or more. Null and empty texts have zero counts and fail. Columns with the added names are
    replaced. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(*ADDED)
    return small_batches(kept).mapInArrow(
        lambda batches: _judge(batches, shared.value),
        with_fields(kept.schema, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                                 "base_failed boolean, quality_probability double, quality_kept boolean"))
