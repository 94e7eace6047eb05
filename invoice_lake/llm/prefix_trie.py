"""A trie of conversation prefixes by truncation peeling.

A conversation is its path: 24 bytes a turn, the digest of role and text and the UTF-8 bytes of all texts so far. Equal
conversations are one path from the start. Sorted, a path's neighbours tell how deep it is shared. Peeling descends from
the deepest place where paths part: all that end there or come up to there are truncated to that depth and regrouped,
which discovers the node and adds up its subtree in one pass. What comes out goes on as one row, with the place where it
is shared next. Turns between two such places have one child each and need no regrouping, so there are as many rounds as
depths at which conversations part, however long the conversations are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from invoice_lake.llm.storage import settle

#: Bytes of a turn in a path: an md5 digest and a big-endian sum.
STEP, DIGEST = 24, 16
#: Rows that a chain of turns is handed out in, and bytes of a piece of a list of ids.
EXPAND_ROWS, PIECE_BYTES = 4096, 1 << 16
#: A branch is a subtree with the turns above it that it shares with nobody.
BRANCH = ("path binary, conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string, "
          "left int, right int")


def _turn(role: Column, text: Column) -> Column:
    """Hex of a turn's step in a path, with the bytes of its own text for now."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    size = F.octet_length(text)
    return F.concat(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)), F.lpad(F.hex(size), 16, "0"))


def _turns(messages: DataFrame) -> DataFrame:
    """conv_id and its turns in order: by turn, null first; equal turns by their content."""
    return messages.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", _turn(F.col("role"), F.col("text")).alias("step")).alias("t")
    ).groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["step"]).alias("steps"))


def paths(messages: DataFrame) -> DataFrame:
    """(conv_id, path) of the conversations as they stand."""
    return _turns(messages).select("conv_id", F.unhex(F.array_join("steps", "")).alias("path"))


def regrown_paths(messages: DataFrame, family: int = 5, longest: int = 9) -> DataFrame:
    """(conv_id, path) of rebuilt conversations: the first h turns of the family's first one, then the own turns after h.

    The family's first conversation is ``conv_id - conv_id % family``; h is crc32 of the decimal id modulo ``longest``.
    """
    own = settle(_turns(messages), "turns")
    heads = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("steps", 1, longest).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % longest).cast("int")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.array().cast("array<string>"))
    tail = F.slice("steps", h + 1, F.greatest(F.size("steps"), F.lit(1)))
    return own.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % family).join(heads, "head_id", "left").select(
        "conv_id", F.unhex(F.array_join(F.concat(head, tail), "")).alias("path"))


def _shared_bytes(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    unlike = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return int(unlike[0]) if len(unlike) else n


def _summed(path: bytes) -> tuple[bytes, int]:
    """The path with the sum of all text bytes up to each turn in place of the turn's own, and the bytes of its last text."""
    steps = np.frombuffer(path, np.uint8).reshape(-1, STEP).copy()
    sizes = np.ascontiguousarray(steps[:, DIGEST:]).view(">u8").ravel().astype(np.uint64)
    steps[:, DIGEST:] = np.cumsum(sizes).astype(">u8").view(np.uint8).reshape(-1, STEP - DIGEST)
    return steps.tobytes(), int(sizes[-1]) if len(sizes) else 0


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct paths with the depth that each shares with the one before and after; -2 at the task's ends."""
    part, waiting, left = TaskContext.get().partitionId(), None, -2

    def row(path, conv_id, count, ends, left, right):
        path, last = _summed(path)
        return {"part": part, "path": path, "conv_id": conv_id, "n_convs": count, "n_children": 0, "n_leaves": 1,
                "saved": (count - 1) * last, "ends": ends, "left": left, "right": right}

    schema = pa.schema([("part", pa.int32()), ("path", pa.binary()), *((n, pa.int64()) for n in ("conv_id", "n_convs", "n_children", "n_leaves", "saved")),
                        ("ends", pa.string()), ("left", pa.int32()), ("right", pa.int32())])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            new = (r["path"], r["conv_id"], r["n_convs"], r["ends"])
            if waiting is not None:
                common = _shared_bytes(waiting[0], new[0]) // STEP
                out.append(row(*waiting, left, common))
                left = common
            waiting = new
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if waiting is not None:
        yield pa.RecordBatch.from_pylist([row(*waiting, left, -2)], schema)


def _edges(group: pa.Table) -> pa.Table:
    """Depths shared across the tasks' ends: at most two rows of each task come here."""
    rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["path"]))
    common = [-1, *(_shared_bytes(a["path"], b["path"]) // STEP for a, b in zip(rows, rows[1:])), -1]
    out = [{"at": r["path"], "edge_left": common[i], "edge_right": common[i + 1]} for i, r in enumerate(rows)]
    return pa.Table.from_pylist(out, pa.schema([("at", pa.binary()), ("edge_left", pa.int32()), ("edge_right", pa.int32())]))


def _leaves(ended: DataFrame) -> DataFrame:
    """The distinct paths as branches."""
    found = settle(ended.repartitionByRange("path").sortWithinPartitions("path").mapInArrow(_neighbours, f"part int, {BRANCH}"), "leaves")
    edges = found.where("left = -2 or right = -2").select("part", "path").groupBy(F.lit(0).alias("all")).applyInArrow(
        lambda group: _edges(group.select(["part", "path"])), "at binary, edge_left int, edge_right int")
    pick = lambda side: F.when(F.col(side) == -2, F.col(f"edge_{side}")).otherwise(F.col(side)).alias(side)
    whole = found.join(edges, F.when((F.col("left") == -2) | (F.col("right") == -2), F.col("path")) == F.col("at"), "left")
    return whole.select(*[pick(f.name) if f.name in ("left", "right") else f.name for f in StructType.fromDDL(BRANCH)])


def _sum_at(path: Column, depth: Column) -> Column:
    """Bytes of the first ``depth`` texts of a path."""
    size = F.conv(F.hex(F.substring(path, depth * STEP - (STEP - DIGEST - 1), F.lit(STEP - DIGEST))), 16, 10).cast("long")
    return F.when(depth > 0, size).otherwise(F.lit(0))


def _placed(branches: DataFrame) -> DataFrame:
    """Branches with the depth of their top node and the depth at which they are shared next (-1: never)."""
    return branches.withColumn("depth", (F.octet_length("path") / STEP).cast("int")).withColumn("meet", F.greatest("left", "right"))


def _regroup(ready: DataFrame, depth: int) -> DataFrame:
    """Branches that meet at ``depth``, truncated to it and added up; those that end there bring no child."""
    above = F.col("depth") > depth
    only = lambda value: F.sum(F.when(above, value).otherwise(0))
    top = F.col("saved") + (F.col("n_convs") - 1) * (_sum_at(F.col("path"), F.col("depth") - 1) - _sum_at(F.col("path"), F.lit(depth)))
    sums = ready.select(F.substring("path", F.lit(1), F.lit(depth * STEP)).alias("path"), "conv_id", "n_convs", "n_leaves", "ends", "left",
                        "right", "depth", top.alias("top")).groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), only(1).cast("long").alias("n_children"),
        only(F.col("n_leaves")).alias("n_leaves"), only(F.col("top")).alias("below"),
        F.max(F.when(~above, F.col("ends"))).alias("ends"), F.min("left").alias("left"), F.min("right").alias("right"))
    last = _sum_at(F.col("path"), F.lit(depth)) - _sum_at(F.col("path"), F.lit(depth - 1))
    return sums.withColumn("saved", F.col("below") + (F.col("n_convs") - 1) * last).select(*[f.name for f in StructType.fromDDL(BRANCH)])


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of each branch's own turns, from the top node up to the one below the meeting place."""
    none = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        for r in batch.to_pylist():
            sums = np.frombuffer(r["path"], np.uint8).reshape(-1, STEP)[:, DIGEST:]
            sums = np.concatenate([[0], np.ascontiguousarray(sums).view(">u8").ravel().astype(np.int64)])
            deep, meet = r["depth"], r["meet"]
            for hi in range(deep, meet, -EXPAND_ROWS):
                depth = np.arange(hi, max(meet, hi - EXPAND_ROWS), -1)
                n = len(depth)
                fill = lambda value: pa.array(np.full(n, value, np.int64))
                parent = np.full(n, r["conv_id"], np.int64)
                at_meet = depth == meet + 1
                parent[at_meet] = r["parent"] if r["parent"] is not None else 0
                top = depth == deep
                yield pa.RecordBatch.from_arrays([
                    fill(r["conv_id"]), pa.array(depth.astype(np.int64)), pa.array(parent, mask=depth == 0), fill(r["n_convs"]),
                    pa.array(np.where(top, r["n_children"], 1)), fill(r["n_leaves"]),
                    pa.array(r["saved"] + (r["n_convs"] - 1) * (sums[max(deep - 1, 0)] - sums[np.maximum(depth - 1, 0)])),
                    pa.array([r["ends"] if t and r["ends"] else none for t in top], pa.string()),
                ], ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of the sorted ids of one path as pieces of text."""
    key, first, ids, size = None, None, [], 0

    def done():
        return pa.RecordBatch.from_pylist([{"key": key, "first": first, "piece": ",".join(ids)}], pa.schema(
            [("key", pa.string()), ("first", pa.int64()), ("piece", pa.string())]))

    for batch in batches:
        for k, i in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (k != key or size >= PIECE_BYTES):
                yield done()
                ids, size = [], 0
            if not ids:
                key, first = k, i
            ids.append(str(i))
            size += len(ids[-1]) + 1
    if ids:
        yield done()


def _joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each path in order, a piece at a time."""
    key, state = None, None
    schema = pa.schema([("key", pa.string()), ("many", pa.string())])
    for batch in batches:
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
            if k != key:
                if state is not None:
                    yield pa.RecordBatch.from_pylist([{"key": key, "many": state.hexdigest()}], schema)
                key, state = k, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"key": key, "many": state.hexdigest()}], schema)


def _ended(convs: DataFrame) -> DataFrame:
    """Distinct paths with the number, the smallest and the digest of the ids of the conversations that are just that path."""
    key = F.hex(F.sha2("path", 256)).alias("key")
    found = settle(convs.groupBy("path").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).select("*", key), "ended")
    several = convs.select(key, "conv_id").join(found.where("n_convs > 1").select("key"), "key")
    pieces = several.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        _pieces, "key string, first long, piece string")
    digests = pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_joined_digests, "key string, many string")
    one = F.sha2(F.col("conv_id").cast("string"), 256)
    return found.join(digests, "key", "left").select("path", "conv_id", "n_convs", F.coalesce("many", one).alias("ends"))


def prefix_trie(convs: DataFrame) -> DataFrame:
    """Nodes of the trie of ``convs`` (conv_id, path; one row per conversation).

    A node is a distinct sequence of first turns; the root has depth 0 and stands for all. Returned per node: conv_id (the
    smallest id of its conversations), depth, parent_conv_id (its parent's conv_id; null at the root), n_convs, n_children,
    n_leaves (childless nodes in its subtree, itself included), saved_tokens (over its subtree, conversations but one
    times the bytes of the node's last text) and ends_sha256 (the digest of the comma-joined ids that end there, or of nothing).
    Conversations without turns end at the root. No conversations give no nodes, not even a root.
    """
    convs = settle(convs, "convs")
    branches = settle(_placed(_leaves(_ended(convs))), "branches")
    depths = branches.select(F.explode(F.array("left", "right")).alias("d")).where("d >= 0").distinct()  # no more than turns in a path
    met: list[DataFrame] = []
    for depth in sorted((r["d"] for r in depths.collect()), reverse=True):
        met.append(settle(_placed(_regroup(branches.where(F.col("meet") == depth), depth)), "branches"))
        branches = branches.unionByName(met[-1])
    own = branches.where("depth > meet")  # others only end where they meet
    parents = branches.sparkSession.createDataFrame([], "at binary, parent long")
    for more in met:
        parents = parents.unionByName(more.select(F.col("path").alias("at"), F.col("conv_id").alias("parent")))
    at = F.when(F.col("meet") >= 0, F.substring("path", F.lit(1), F.col("meet") * STEP))
    return own.join(parents, at == F.col("at"), "left").drop("at", "left", "right").mapInArrow(
        _expand, "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                 "saved_tokens long, ends_sha256 string")
