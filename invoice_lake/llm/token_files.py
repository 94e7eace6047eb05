"""Token ids in Arrow files of equal-length sequences.

A file holds record batches of three fixed-size-list columns: ``ids``, ``mask`` (1: a token, 0: padding) and
``ends`` (1: the last token of a document). Masks and ends are packed, eight flags a byte, lowest bit first. A sequence is found by
its number alone and read without a copy from a memory map; ``flags`` unpacks its mask. Documents follow each other in ascending
order; only the last sequence of a file is padded. An index table, written with the files, has each document's place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from invoice_lake.llm.tokens import tokenizer, word_ids
from invoice_lake.llm.words import slabs

LENGTH, BATCH_SEQUENCES, FILE_TOKENS, END_ID = 2048, 64, 8_000_000, 2


class SequenceFile:
    """One file being written; ids are cut to sequences as they come."""

    def __init__(self, folder: str, name: str, length: int, kind: pa.DataType):
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        self.path, self.length, self.kind, self.tokens = f"{folder}/{name}", length, kind, 0
        self.schema = pa.schema([
            ("ids", pa.list_(kind, length)), *((name, pa.list_(pa.uint8(), -(-length // 8))) for name in ("mask", "ends"))])
        self.stream = system.open_output_stream(f"{root}/{name}")
        self.writer = ipc.new_file(self.stream, self.schema)
        self.ids: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.waiting = 0

    def add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.ids.append(ids)
        self.ends.append(ends)
        self.waiting += len(ids)
        self.tokens += len(ids)
        batch = self.length * BATCH_SEQUENCES  # all batches but the last are full: sequence() finds its batch by division
        if self.waiting >= batch:
            self._write(self.waiting - self.waiting % batch)

    def _write(self, n: int) -> None:
        ids, ends = np.concatenate(self.ids), np.concatenate(self.ends)
        self.ids, self.ends, self.waiting = [ids[n:]], [ends[n:]], len(ids) - n
        pad = -n % self.length if n == len(ids) else 0
        mask = np.concatenate([np.ones(n, np.uint8), np.zeros(pad, np.uint8)])
        filled = np.concatenate([ids[:n], np.zeros(pad, ids.dtype)])
        marks = np.concatenate([ends[:n], np.zeros(pad, np.uint8)])
        packed = [np.packbits(x.reshape(-1, self.length), axis=1, bitorder="little") for x in (mask, marks)]
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(filled, self.kind), self.length),
                   *(pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]) for x in packed)]
        for at in range(0, len(columns[0]), BATCH_SEQUENCES):
            self.writer.write_batch(pa.RecordBatch.from_arrays([c.slice(at, BATCH_SEQUENCES) for c in columns], schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            self._write(self.waiting)
        self.writer.close()
        self.stream.close()


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, length: int) -> Iterator[pa.RecordBatch]:
    task, encoder = TaskContext.get(), word_ids(path)
    small = tokenizer(path).get_vocab_size() <= 1 << 16 and end_id < 1 << 16
    kind, file, number = (pa.uint16() if small else pa.uint32()), None, 0
    for rows, texts in slabs(batches):
        if file is not None and file.tokens >= FILE_TOKENS:
            file.close()
            file, number = None, number + 1
        if file is None:  # the attempt's own name: a repeated task never meets the files of a lost one
            name = f"tokens-{task.partitionId():06d}-{number:04d}-{task.taskAttemptId()}.arrow"
            file = SequenceFile(folder, name, length, kind)
        flat, begins = encoder.ids(texts)
        stops = begins[1:] + np.arange(1, len(begins))
        sizes = np.diff(begins) + 1
        ids = np.insert(flat, begins[1:], end_id).astype(np.uint16 if small else np.uint32)
        ends = np.zeros(len(ids), np.uint8)
        ends[stops - 1] = True
        starts = file.tokens + stops - sizes
        file.add(ids, ends)
        n = len(texts)
        yield pa.RecordBatch.from_arrays([
            rows.column("doc_id"), pa.array([file.path] * n), pa.array(np.full(n, task.partitionId())),
            pa.array(np.full(n, number)), pa.array(starts), pa.array(sizes)],
            ["doc_id", "file", "part", "number", "place", "n_tokens"])
    if file is not None:
        file.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Write the ids of all ``docs`` (doc_id, text) in ascending doc_id order to ``folder``; returns the index.

    A document's ids are those of its whole text plus ``end_id``; null and empty texts have that id alone. A null
    doc_id comes first; rows with equal doc_id are ordered by a hash of their text, and may fall into several tasks. The index (doc_id, file, part, number, place,
    n_tokens) names only files of tasks that ended well. ``folder`` is an absolute path or a URI that Arrow can write
    to from every executor. No rows give no files.
    """
    order = "doc_id", F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    kind = docs.schema["doc_id"].dataType.simpleString()
    index = ordered.mapInArrow(
        lambda batches: _write(batches, f"{folder}/files", tokenizer_path, end_id, length),
        f"doc_id {kind}, file string, part long, number long, place long, n_tokens long")
    index.write.parquet(f"{folder}/index")
    return read_index(docs.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def sequence(path: str, number: int, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Ids and packed mask of one sequence; on a local file without copying either."""
    system, root = fs.FileSystem.from_uri(path)
    source = pa.memory_map(root) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(root)
    batch = ipc.open_file(source).get_batch(number // BATCH_SEQUENCES)
    row = number % BATCH_SEQUENCES
    ids, mask = batch.column("ids")[row].values, batch.column("mask")[row].values
    return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=True)


def flags(packed: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Packed masks or ends as one boolean a token, sequence by sequence."""
    rows = packed.reshape(-1, -(-length // 8))
    return np.unpackbits(rows, axis=1, count=length, bitorder="little").astype(bool).ravel()


def _digest(group: pa.Table) -> pa.Table:
    """crc32 of each document's ids, read from the group's file."""
    group = group.sort_by("place")
    system, root = fs.FileSystem.from_uri(group["file"][0].as_py())
    with system.open_input_file(root) as source:
        table = ipc.open_file(source).read_all()
    flat = lambda name: table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    length = table.schema.field("ids").type.list_size
    ids, mask, ends = flat("ids"), flags(flat("mask"), length), flags(flat("ends"), length)
    ids = ids[mask].astype("<u4")
    stops = np.flatnonzero(ends[mask]) + 1
    starts = np.concatenate([[0], stops[:-1]])
    if starts.tolist() != group["place"].to_pylist():
        raise ValueError(f"{root}: documents and index disagree")
    crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, stops)]
    return pa.table({
        "doc_id": group["doc_id"], "start": pa.array(group["base"].to_numpy() + starts, pa.int64()),
        "n_tokens": pa.array(stops - starts, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})


def read_token_files(index: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, read from the files.

    A file is one task's work and holds about ``FILE_TOKENS`` ids at most, or one longer document.
    """
    sizes = index.groupBy("file", "part", "number").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    bases = sizes.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")).alias("base"))
    kind = index.schema["doc_id"].dataType.simpleString()
    return index.join(bases, "file").select("doc_id", "file", "place", "base").groupBy("file").applyInArrow(
        lambda group: _digest(group), f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
