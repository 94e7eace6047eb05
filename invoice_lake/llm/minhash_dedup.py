"""Near-duplicate documents: MinHash signatures, banding, verification on full shingle sets, components.

Texts with equal shingle sets are one class from the start, so copies cost one row each. Classes that share a band
are candidates. Two rounds turn candidates into links without emitting the pairs of a bucket:

1. star: each bucket's smallest member against the others;
2. rest: in buckets that still hold several components, all pairs between different components. Those whose signatures
   agree are confirmed inside the task, and one spanning forest of the confirmed pairs comes out.

Every link is confirmed on the full sets. Round 2 leaves no untested candidate between components, so the components
are those of all candidate pairs. Large buckets are compared block by block, but not blocks of one component with each
other; blocks are spread over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from invoice_lake.llm.components import connected_components
from invoice_lake.llm.storage import ROW, discard, numbered, settle, small_batches
from invoice_lake.llm.words import BLANK_WORDS, LOWER, Texts, constants, grams, mix, rows_of, slabs

#: 32 bands of 6 minima miss a pair at 0.85 with a chance of 3e-7, and one at 0.3 collides with 2 %.
BANDS, BAND_ROWS, SHINGLE_WORDS, PERCENT = 32, 6, 5, 85
#: Members and shingles of a block (8 MB of hashes), and shingles compared at a time.
BLOCK, BLOCK_SHINGLES, SHINGLE_STEP = 1024, 1_000_000, 4096


def shingle_sets(texts: Texts, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, one text after another, and each text's number of them."""
    words, first = texts.words(BLANK_WORDS, LOWER)
    hashes, places = grams(words, first, k)
    owner = rows_of(first)[places] if len(places) else np.empty(0, np.int64)
    sizes = np.diff(first)
    few = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(few):
        whole = np.empty(len(few), np.uint64)
        for i, row in enumerate(few):
            part = words[first[row]:first[row + 1]]
            whole[i] = (part * constants(len(part), 77 + len(part))).sum(dtype=np.uint64)
        hashes, owner = np.concatenate([hashes, mix(whole)]), np.concatenate([owner, few])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.bincount(owner[fresh], minlength=len(texts))


def minima(hashes: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    """n minima of universal hashes (a * x + b) for every set; sets begin at ``begins``."""
    out = np.empty((len(begins), n), np.uint32)
    a, b = constants(n, 501), constants(n, 502)
    for i in range(n):
        out[:, i] = np.minimum.reduceat(hashes * a[i] + b[i], begins) >> np.uint64(32)
    return out


def _describe(batches: Iterator[pa.RecordBatch], bands: int, band_rows: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in slabs(batches):
        hashes, sizes = shingle_sets(texts)
        full = np.flatnonzero(sizes)
        set_a, set_b = np.zeros(len(texts), np.uint64), np.zeros(len(texts), np.uint64)
        keys, marks = np.zeros((len(texts), bands), np.uint64), np.zeros((len(texts), bands * band_rows), np.uint8)
        if len(full):
            begins = (np.cumsum(sizes) - sizes)[full]
            set_a[full] = np.add.reduceat(mix(hashes ^ np.uint64(3)), begins)
            set_b[full] = np.add.reduceat(mix(hashes ^ np.uint64(5)), begins)
            low = minima(hashes, begins, bands * band_rows)
            marks[full] = (low * np.uint32(0x9E3779B1)) >> np.uint32(24)
            parts = low.reshape(len(full), bands, band_rows).astype(np.uint64) * constants(band_rows, 601)
            keys[full] = mix(parts.sum(axis=2, dtype=np.uint64) + constants(bands, 602))
        width = bands * band_rows
        yield pa.RecordBatch.from_arrays([
            rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(set_a.view(np.int64)), pa.array(set_b.view(np.int64)),
            pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32) * bands, keys.view(np.int64).ravel()),
            pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(texts), [None, pa.py_buffer(marks.tobytes())]).cast(pa.binary()),
        ], ["doc_id", "n_shingles", "set_a", "set_b", "bands", "marks"])


def _list_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in slabs(batches):
        hashes, sizes = shingle_sets(texts)
        places = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.ListArray.from_arrays(places, hashes.view(np.int64))], ["doc_id", "shingles"])


def needed_agreement(percent: int, width: int) -> int:
    """Agreeing signature bytes that a pair at the threshold falls short of with a chance below 1e-7."""
    p = percent / 100 + (1 - percent / 100) / 256
    return math.floor(width * p - 5.4 * math.sqrt(width * p * (1 - p)))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _passing(left: pa.Table, right: pa.Table, same: bool, width: int, percent: int) -> tuple[np.ndarray, ...]:
    """Pairs between two blocks in different components whose sizes and signatures allow a link, best first."""
    need = needed_agreement(percent, width)
    lm, rm = _matrix(left["marks"], width), _matrix(right["marks"], width)
    ln, rn = left["n_shingles"].to_numpy(), right["n_shingles"].to_numpy()
    lc, rc = left["component"].to_numpy(), right["component"].to_numpy()
    found = []
    for i in range(len(ln)):
        j = np.arange(i + 1 if same else 0, len(rn))
        small, large = np.minimum(ln[i], rn[j]), np.maximum(ln[i], rn[j])
        j = j[(rc[j] != lc[i]) & (100 * small >= percent * large)]
        agree = (rm[j] == lm[i]).sum(axis=1)
        ok = agree >= need
        found.append(np.stack([np.full(ok.sum(), i), j[ok], agree[ok]]))
    i, j, agree = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
    order = np.argsort(-agree, kind="stable")
    return i[order], j[order]


def _shared(left: pa.Table, right: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common shingles of each pair (i, j), from products of 0/1 matrices over a step of shingles at a time."""
    li, pi = np.unique(i, return_inverse=True)
    rj, pj = np.unique(j, return_inverse=True)
    parts = [left["shingles"].take(pa.array(li)).combine_chunks(), right["shingles"].take(pa.array(rj)).combine_chunks()]
    sizes = [p.value_lengths().to_numpy() for p in parts]
    hashes = np.concatenate([p.flatten().to_numpy() for p in parts])
    member = np.repeat(np.arange(len(li) + len(rj)), np.concatenate(sizes))
    _, column, count = np.unique(hashes, return_inverse=True, return_counts=True)
    useful = count[column] > 1  # a shingle that stands in one set only is never common
    member, column = member[useful], np.unique(column[useful], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    common = np.zeros((len(li), len(rj)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, SHINGLE_STEP):
        at, stop = np.searchsorted(column, [lo, lo + SHINGLE_STEP])
        present = np.zeros((len(li) + len(rj), SHINGLE_STEP), np.float32)
        present[member[at:stop], column[at:stop] - lo] = 1
        common += present[:len(li)] @ present[len(li):].T
    return common[pi, pj].astype(np.int64)


def _compare(group: pa.Table, width: int, percent: int) -> pa.Table:
    """A spanning forest of the confirmed links between components in one pair of blocks."""
    lo, hi = group["lo"][0].as_py(), group["hi"][0].as_py()
    block = group["block"].to_numpy()
    left, right = group.filter(pa.array(block == lo)), group.filter(pa.array(block == hi))
    i, j = _passing(left, right, lo == hi, width, percent)
    if len(i):
        shared = _shared(left, right, i, j)
        whole = left["n_shingles"].to_numpy()[i] + right["n_shingles"].to_numpy()[j] - shared
        true = 100 * shared >= percent * whole
        i, j = i[true], j[true]
        keep = _spanning(left["component"].to_numpy()[i], right["component"].to_numpy()[j])
        i, j = i[keep], j[keep]
    a, b = left["doc_id"].to_numpy()[i], right["doc_id"].to_numpy()[j]
    return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


def _spanning(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of the pairs that join two parts not joined by an earlier pair."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    keep = []
    for place, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep.append(place)
    return keep


def _star_pairs(members: DataFrame, nodes: DataFrame, percent: int, width: int) -> DataFrame:
    """Each bucket's smallest member with the others, where sizes and signatures allow a link."""
    hubs = members.groupBy("band").agg(F.min("doc_id").alias("a"))
    pairs = members.join(hubs, "band").where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    side = lambda name: nodes.select(
        F.col("doc_id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("marks").alias(f"marks_{name}"))
    need = needed_agreement(percent, width)

    @F.arrow_udf("boolean")
    def agree(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array((_matrix(x, width) == _matrix(y, width)).sum(axis=1) >= need)

    return (
        pairs.join(side("b"), "b").join(side("a"), "a")
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
        .where(agree("marks_a", "marks_b")).select("a", "b").distinct()
    )


def _in_blocks(labelled: DataFrame) -> DataFrame:
    """Members of the buckets with several components, each with its block and the number of ``blocks`` in its bucket.

    A component of half a block or more has ``own`` blocks of its own from ``first`` on, which needn't meet each other. The
    smaller ones share the blocks before those; ``first`` is null there. A bucket has at most two blocks of its own
    components for each full block of rows, so that the sum over them stays short.
    """
    share = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    parts = labelled.groupBy("band", "component").agg(share.alias("share")).withColumn(
        "own", F.when(F.col("share") >= 0.5, F.ceil("share").cast("int")))
    mixed = F.ceil(F.coalesce(F.sum(F.when(F.col("own").isNull(), F.col("share"))), F.lit(0.0))).cast("int")
    buckets = parts.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), mixed.alias("mixed"),
        (mixed + F.coalesce(F.sum("own"), F.lit(0))).cast("int").alias("blocks")).where("low <> high").select("band", "mixed", "blocks")
    before = Window.partitionBy("band").orderBy("component").rowsBetween(Window.unboundedPreceding, -1)
    large = parts.where("own is not null").select("band", "component", "own", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"))
    hashed = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    return (
        labelled.join(buckets, "band").join(large, ["band", "component"], "left")
        .withColumn("first", (F.col("mixed") + F.col("before")).cast("int"))
        .withColumn("block", F.when(F.col("first").isNull(), hashed("mixed")).otherwise(F.col("first") + hashed("own"))))


def _rest_links(members: DataFrame, nodes: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, width: int) -> DataFrame:
    """Links between components that share a bucket, compared block by block."""
    labelled = (
        members.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .join(nodes.select("doc_id", "n_shingles", "marks"), "doc_id")
        .withColumn("component", F.coalesce("component", "doc_id")))
    placed = _in_blocks(labelled)
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where(
        "first is null or other < first or other >= first + own").select(
        "band", "doc_id", "component", "n_shingles", "marks", "block",
        F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    return spread.join(sets, "doc_id").groupBy("band", "lo", "hi").applyInArrow(
        lambda group: _compare(group, width, percent), "a long, b long").distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    side = lambda name: sets.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"set_{name}"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    whole = F.size("set_a") + F.size("set_b") - F.col("shared")
    return (
        pairs.join(side("b"), "b").join(side("a"), "a").withColumn("shared", shared)
        .where(F.col("shared") * 100 >= whole * percent).select("a", "b").distinct()
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its set size, the smallest doc_id of its component, and kept.

    A set holds the distinct five-word shingles of the whole text, lower-cased in A-Z; fewer words are one shingle;
    no words or no text give an empty set, which is linked with nothing. Two texts are linked if their sets
    share at least ``percent`` of their union. Rows with the same doc_id count as one document. Rows without a
    doc_id take part in nothing and are kept. No rows give no rows; other columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    width = bands * band_rows
    described = settle(small_batches(source).mapInArrow(
        lambda batches: _describe(batches, bands, band_rows),
        "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, marks binary"), "described")
    filled = described.where("n_shingles > 0 and doc_id is not null")
    of_set = ["n_shingles", "set_a", "set_b"]
    classes = settle(filled.groupBy(*of_set).agg(F.min("doc_id").alias("class_id")), "classes")
    nodes = filled.join(classes, of_set).where("doc_id = class_id").dropDuplicates(["doc_id", *of_set])
    nodes = settle(nodes.select("doc_id", "n_shingles", "bands", "marks"), "nodes")
    banded = nodes.select("doc_id", F.posexplode("bands").alias("place", "key")).select(
        "doc_id", F.xxhash64("place", "key").alias("band"))
    shared = banded.groupBy("band").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low <> high")
    members = settle(banded.join(shared.select("band"), "band").distinct(), "members")
    wanted = source.join(members.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = settle(  # repeated rows give one set
        wanted.groupBy("doc_id", F.xxhash64("text").alias("hash")).agg(F.first("text").alias("text")).mapInArrow(
            _list_sets, "doc_id long, shingles array<long>"), "sets")

    links = settle(_confirmed(_star_pairs(members, nodes, percent, width), sets, percent), "links")
    labels = connected_components(links)
    more = settle(_rest_links(members, nodes, sets, labels, percent, width), "links")
    if not more.isEmpty():
        labels = connected_components(links.unionByName(more))
    for table in (members, sets, nodes):
        discard(table)
    found = described.select("doc_id", *of_set).join(classes, of_set, "left").join(
        labels.withColumnRenamed("node", "class_id"), "class_id", "left")
    component = F.coalesce("component", "class_id", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest doc_id, a null one only if all are null.

    Every row is a document of its own here, also with a null doc_id or one that other rows have too.
    """
    rows = numbered(docs)
    found = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text"), **options)
    named = found.join(rows.select(F.col(ROW).alias("doc_id"), F.col("doc_id").alias("id")), "doc_id")
    first = named.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", F.col("doc_id").alias(ROW))).alias("first"))
    lost = rows.select(ROW).join(first.select(f"first.{ROW}"), ROW, "left_anti")
    return rows.join(lost, ROW, "left_anti").select(*docs.columns)
