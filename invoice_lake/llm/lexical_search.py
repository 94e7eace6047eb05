"""Ranked lexical search for many items at once, with their common term sets evaluated once per document.

The items are taken in blocks of bounded size. Of a block's terms, those that stand in exactly the same items are one
set; then pairs of sets that share items are joined to larger sets, most shared first. The result is a graph
in which every item is a sum of few nodes, and every node a sum of two others or of terms. A task fills one accumulator
per node for a slab of documents, each once, and all items that share a node add up the same accumulator. Documents pass
twice for each block: for the statistics of the whole corpus, and for the scores, of which a task keeps the best of each item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from invoice_lake.llm.storage import settle, small_batches
from invoice_lake.llm.words import ALNUM_WORDS, LOWER, Texts, rows_of, slabs

TOP = 50
#: Items and terms of a block; an item with more terms is a block of its own. They bound what is sent to the tasks.
BLOCK_ITEMS, BLOCK_TERMS = 1024, 16_384
#: Sets that are compared with each other in the search for shared ones, and accumulators of a step (32 MB).
MINED_SETS, STEP_CELLS = 2048, 4_000_000
#: Parts in which the best rows of an item are first cut down.
PARTS = 32


@dataclass
class SharedSums:
    """Items as sums of nodes. The first nodes are the terms, in ``terms``; ``sums`` lists the others in order.

    ``sums[i]`` is the list of nodes whose accumulators add up to node ``len(terms) + i``; ``items[j]`` those of item j.
    """

    terms: np.ndarray
    sums: list[list[int]]
    items: list[list[int]]


def share_sums(terms_of: list[np.ndarray]) -> SharedSums:
    """The graph of shared term sets of items, each given by its distinct terms."""
    terms = np.unique(np.concatenate(terms_of)) if terms_of else np.empty(0, np.uint64)
    holders: list[list[int]] = [[] for _ in terms]
    for item, own in enumerate(terms_of):
        for t in np.searchsorted(terms, own).tolist():
            holders[t].append(item)
    classes: dict[tuple[int, ...], list[int]] = {}
    for t, items in enumerate(holders):
        classes.setdefault(tuple(items), []).append(t)
    sums: list[list[int]] = []
    sets: dict[int, set[int]] = {}
    for items, members in classes.items():
        if len(members) > 1:
            sums.append(members)
        sets[len(terms) + len(sums) - 1 if len(members) > 1 else members[0]] = set(items)
    _join_pairs(sets, sums, len(terms))
    items: list[list[int]] = [[] for _ in terms_of]
    for node, its in sets.items():
        for item in its:
            items[item].append(node)
    return SharedSums(terms, sums, [sorted(x) for x in items])


def _join_pairs(sets: dict[int, set[int]], sums: list[list[int]], n_terms: int) -> None:
    """Join pairs of sets that at least two items share, most shared first, until a round finds none.

    A pair's new node takes over the items that hold both. A round compares the sets with most items; each takes part once.
    """
    while True:
        nodes = sorted((n for n, items in sets.items() if len(items) > 1), key=lambda n: (-len(sets[n]), n))[:MINED_SETS]
        if len(nodes) < 2:
            return
        width = max(max(sets[n]) for n in nodes) + 1
        held = np.zeros((len(nodes), width), np.float32)
        for i, n in enumerate(nodes):
            held[i, list(sets[n])] = 1
        shared = np.triu(held @ held.T, 1)
        i, j = np.nonzero(shared >= 2)
        used: set[int] = set()
        for at in np.lexsort((j, i, -shared[i, j])).tolist():
            a, b = nodes[i[at]], nodes[j[at]]
            if a in used or b in used:
                continue
            used |= {a, b}
            both = sets[a] & sets[b]
            sums.append([a, b])
            sets[n_terms + len(sums) - 1] = both
            for n in (a, b):
                sets[n] = sets[n] - both
        if not used:
            return


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in slabs(batches):
        words, first = texts.words(ALNUM_WORDS, LOWER)
        terms = [np.unique(words[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([rows.column("item_id"), pa.array(terms, pa.list_(pa.int64()))], ["item_id", "terms"])


def _blocks(items: Iterator[Row]) -> Iterator[list[Row]]:
    block, size = [], 0
    for item in items:
        if block and (len(block) >= BLOCK_ITEMS or size + len(item["terms"]) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        block.append(item)
        size += len(item["terms"])
    if block:
        yield block


def _matches(texts: Texts, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Term counts of texts: text, place in ``terms`` and occurrences of each pair that occurs; then the words of each text."""
    words, first = texts.words(ALNUM_WORDS, LOWER)
    at = np.minimum(np.searchsorted(terms, words), max(len(terms) - 1, 0))
    hit = np.flatnonzero(terms[at] == words) if len(terms) else np.empty(0, np.int64)
    pairs, tf = np.unique(rows_of(first)[hit] * max(len(terms), 1) + at[hit], return_counts=True)
    return pairs // max(len(terms), 1), pairs % max(len(terms), 1), tf, np.diff(first)


def _statistics(batches: Iterator[pa.RecordBatch], terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    seen, n_docs, n_words = np.zeros(len(terms), np.int64), 0, 0
    for _, texts in slabs(batches):
        _, term, _, sizes = _matches(texts, terms)
        seen += np.bincount(term, minlength=len(terms))
        n_docs, n_words = n_docs + int((sizes > 0).sum()), n_words + int(sizes.sum())
    filled = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([[-2, -1], filled])), pa.array(np.concatenate([[n_docs, n_words], seen[filled]]))], ["slot", "n"])


def _node_scores(graph: SharedSums, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores (items x documents): every node's accumulators are filled once, then combined along the graph."""
    node = np.zeros((len(graph.terms) + len(graph.sums), n_docs), np.int64)
    node[term, doc] = value
    for i, parts in enumerate(graph.sums):
        node[len(graph.terms) + i] = node[parts].sum(axis=0)
    return np.stack([node[parts].sum(axis=0) for parts in graph.items])


class _Best:
    """The best ``top`` documents of each item so far: highest score, then lowest doc_id, a null one last."""

    def __init__(self, n_items: int, top: int):
        self.top, self.waiting = top, 0
        self.least = np.ones(n_items, np.int64)
        self.parts = [tuple(np.empty(0, t) for t in (np.int64, bool, np.int64, np.int64))]

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.parts.append((item, unnamed[doc], ids[doc], scores[item, doc]))
        self.waiting += len(item)
        if self.waiting > 4 * self.top * len(self.least):
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        item, unnamed, ids, scores = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, unnamed, -scores, item))
        begins = np.searchsorted(item[order], np.arange(len(self.least)))
        order = order[np.arange(len(order)) - begins[item[order]] < self.top]
        self.parts, self.waiting = [(item[order], unnamed[order], ids[order], scores[order])], 0
        full = np.bincount(item[order], minlength=len(self.least)) >= self.top
        last = np.searchsorted(item[order], np.arange(len(self.least)), side="right") - 1
        self.least[full] = scores[order][last[full]]
        return self.parts[0]


def _score(batches: Iterator[pa.RecordBatch], graph: SharedSums, weights: np.ndarray, docs: int, words: int, top: int) -> Iterator[pa.RecordBatch]:
    best, step = _Best(len(graph.items), top), max(1, STEP_CELLS // max(1, len(graph.terms) + len(graph.sums) + len(graph.items)))
    for rows, texts in slabs(batches):
        ids = rows.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
        unnamed = rows.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        doc, term, tf, sizes = _matches(texts, graph.terms)
        m = 50 + (50 * sizes * docs) // max(words, 1)
        value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        for lo in range(0, len(texts), step):
            hi = min(lo + step, len(texts))
            a, b = np.searchsorted(doc, [lo, hi])
            best.add(_node_scores(graph, doc[a:b] - lo, term[a:b], value[a:b], hi - lo), ids[lo:hi], unnamed[lo:hi])
    item, unnamed, ids, scores = best.cut()
    part = TaskContext.get().partitionId() % PARTS
    yield pa.RecordBatch.from_arrays(
        [pa.array(item), pa.array(ids, mask=unnamed), pa.array(scores), pa.array(np.full(len(item), part))], ["item", "doc_id", "score", "part"])


def _search_block(docs: DataFrame, terms_of: list[np.ndarray], top: int) -> DataFrame:
    """(item, doc_id, score, rank) with items as places in the block."""
    graph, context = share_sums(terms_of), docs.sparkSession.sparkContext
    terms = context.broadcast(graph.terms)
    counted = {r["slot"]: r["n"] for r in docs.select("text").mapInArrow(
        lambda batches: _statistics(batches, terms.value), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    n, words = counted.get(-2, 0), counted.get(-1, 0)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * counted.get(t, 0) + 1))) for t in range(len(graph.terms))], np.int64)
    shared = context.broadcast((graph, weights))
    found = docs.mapInArrow(lambda batches: _score(batches, *shared.value, n, words, top), "item long, doc_id long, score long, part long")
    order = F.desc("score"), F.col("doc_id").asc_nulls_last()
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents of each item of ``benchmark`` (item_id, text) among all ``docs`` (doc_id, text).

    Terms are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII. A term weighs
    floor(1000 ln((2 N + 2) / (2 df + 1))); a document's score sums weight * (10^9 tf div (1000 tf + 20 m)) over the item's
    distinct terms, with m = 50 + 50 n N div L. N is the number of documents with a term, L their terms, n the document's.
    Returns item_id, rank (from 1), doc_id, score; only scores above 0; equal scores by ascending doc_id, null last. Rows with
    one item_id (or none) are one item with the terms of all; rows with equal doc_id are documents of their own. Null texts
    have no terms; items without terms and an empty table give no rows. Other columns are ignored.
    """
    spark, kind = docs.sparkSession, benchmark.schema["item_id"].dataType
    source = small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    terms = benchmark.select("item_id", "text").mapInArrow(_item_terms, f"item_id {kind.simpleString()}, terms array<long>")
    terms = terms.where(F.size("terms") > 0).select("item_id", F.explode("terms").alias("term")).distinct()
    items = settle(terms.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).sort("item_id"), "items")
    found = []
    for block in _blocks(items.toLocalIterator()):
        hits = _search_block(source, [np.array(r["terms"], np.int64).view(np.uint64) for r in block], top)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"item long, item_id {kind.simpleString()}")
        found.append(settle(hits.join(names, "item").select("item_id", "rank", "doc_id", "score"), "hits"))
    return _united(spark, found, kind.simpleString())


def _united(spark: SparkSession, parts: list[DataFrame], kind: str) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
