"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

Documents are tokenised once and cut there: whole windows first, the rest into pieces of at most ``PIECE`` tokens. Whole
windows are sequences as they are. The rest is dealt at random into groups of about ``GROUP_WINDOWS`` windows; in each
group the two partial partitions with the largest imbalance are merged, the heaviest part of one with the lightest of the
other, until one partition is left. Its windows are nearly equal. If the heaviest exceeds the capacity, the group
gets one window more.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoice_lake.llm.storage import settle, small_batches
from invoice_lake.llm.tokens import word_ids
from invoice_lake.llm.words import slabs

CAPACITY, PIECE, GROUP_WINDOWS, END_ID = 4096, 512, 256, 2


def cuts(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document with n tokens."""
    whole = n - n % capacity
    starts = list(range(0, whole, capacity))
    rest = n - whole
    parts = -(-rest // piece)
    edges = [whole + rest * i // parts for i in range(parts + 1)] if parts else [whole]
    return [(s, capacity) for s in starts] + [(a, b - a) for a, b in zip(edges, edges[1:])]


def _tokenise(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    encoder, at = word_ids(path), TaskContext.get().partitionId() << 40
    for rows, texts in slabs(batches):
        flat, begins = encoder.ids(texts)
        out: dict[str, list[int]] = {k: [] for k in ("place", "row", "start", "length", "ids_crc32", "doc_tokens")}
        for i in range(len(texts)):
            ids = np.append(flat[begins[i]:begins[i + 1]], end_id).astype("<u4")
            for start, length in cuts(len(ids), capacity, min(PIECE, capacity)):
                values = (i, at, start, length, zlib.crc32(ids[start:start + length].tobytes()), len(ids))
                for column, value in zip(out.values(), values):
                    column.append(value)
                at += 1
        place = out.pop("place")
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id").take(pa.array(place, pa.int64())), *(pa.array(v, pa.int64()) for v in out.values())],
            ["doc_id", *out])


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece under multiway differencing into ``windows`` windows."""
    n = len(sizes)
    # A partial partition: sums in descending order and, beside each, a node of a binary tree of pieces (-1: none).
    heap = [(-int(s), i, None) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    serial = n

    def opened(entry) -> tuple[np.ndarray, np.ndarray]:
        if entry[2] is not None:
            return entry[2]
        sums, nodes = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[0], nodes[0] = sizes[entry[1]], entry[1]
        return sums, nodes

    while len(heap) > 1:
        (a_sums, a_nodes), (b_sums, b_nodes) = opened(heapq.heappop(heap)), opened(heapq.heappop(heap))
        b_sums, b_nodes = b_sums[::-1], b_nodes[::-1]
        nodes = np.maximum(a_nodes, b_nodes)
        both = np.flatnonzero((a_nodes >= 0) & (b_nodes >= 0))
        if len(both):
            nodes[both] = n + len(children) + np.arange(len(both))
            children.extend(zip(a_nodes[both].tolist(), b_nodes[both].tolist()))
        sums = a_sums + b_sums
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), serial, (sums, nodes)))
        serial += 1
    out = np.zeros(n, np.int64)
    for window, node in enumerate(opened(heap[0])[1].tolist() if heap else []):
        stack = [node] if node >= 0 else []
        while stack:
            node = stack.pop()
            if node < n:
                out[node] = window
            else:
                stack.extend(children[node - n])
    return out


def balance(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each piece, in as few windows as differencing can fill without exceeding the capacity."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        chosen = difference(sizes, windows)
        if len(sizes) == 0 or np.bincount(chosen, weights=sizes).max() <= capacity:
            return chosen
        windows += 1


def _pack_group(group: pa.Table, capacity: int) -> pa.Table:
    group = group.sort_by("row")
    sizes = group["length"].to_numpy()
    window = balance(sizes, capacity)
    order = np.argsort(window, kind="stable")
    window, length = window[order], sizes[order]
    ends = np.cumsum(length)
    opening = np.searchsorted(window, window)
    offset = ends - length - (ends - length)[opening]
    number = (group["part"][0].as_py() << 24) + window
    return group.take(pa.array(order)).drop_columns(["row", "part"]).append_column(
        "sequence_id", pa.array(2 * number, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with their place in sequences of at most ``capacity`` tokens.

    A document's ids are those of its whole text plus ``end_id``; a null or empty text has that id alone. Returns
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset for each piece. Sequences are filled
    without gaps from offset 0. Rows with equal or null doc_id stay documents of their own; other columns are
    ignored; no rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = "start long, length long, ids_crc32 long, doc_tokens long"
    pieces = settle(small_batches(docs.select("doc_id", "text")).mapInArrow(
        lambda batches: _tokenise(batches, tokenizer_path, end_id, capacity), f"doc_id {kind}, row long, {numbers}"), "pieces")
    full, rest = pieces.where(F.col("length") == capacity), pieces.where(F.col("length") < capacity)
    total = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // (capacity * GROUP_WINDOWS)))
    packed = rest.withColumn("part", F.pmod(F.xxhash64(F.lit(29), "row"), F.lit(groups))).groupBy("part").applyInArrow(
        lambda group: _pack_group(group, capacity), f"doc_id {kind}, {numbers}, sequence_id long, offset long")
    alone = full.drop("row").withColumn("sequence_id", 2 * F.monotonically_increasing_id() + 1).withColumn(
        "offset", F.lit(0).cast("long"))
    return packed.unionByName(alone)
