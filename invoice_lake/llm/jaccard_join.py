"""Exact n-gram Jaccard self-join by set-relation skipping.

Sets are ordered by one order of all shingles, rare ones first, and an index lists for each shingle the sets that hold it
among their first ones, with its position. Two sets at the threshold meet in the list of their first common shingle,
where their positions add up to no more than the shingles in which they may differ. Three relations skip work:

1. position and size: blocks of a list whose positions or sizes rule a link out are never compared;
2. answers: each list's first set is compared with the others, exactly; sets that it links are one component from then on, and
   lists of one component are skipped. Of other pairs, the difference of two sets lies between the difference and the
   sum of their differences from that first set, which rules out most without looking at either set;
3. parity bits: a set's bitmap holds the parity of its shingles in each slot; unlike bits of two sets are never more than
   the shingles in which the sets differ.

What remains is confirmed on full sets: in each group one set is the leader, the others are written as their differences
from it, and every pair's difference follows from these differences alone. No link is lost, and pairs of one component
are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoice_lake.llm.components import connected_components, forest
from invoice_lake.llm.minhash_dedup import shingle_sets
from invoice_lake.llm.storage import discard, settle, small_batches
from invoice_lake.llm.words import mix, rows_of, slabs

PERCENT, SHINGLE_WORDS = 90, 3
#: Counters of the shingle order (2 MB), counts from which a list is dealt to several tasks, sets that a task remembers.
SLOT_BITS, SPLIT_CLASS, REMEMBERED = 18, 12, 1 << 19
#: Rows of a block of a list, rows of a tile, pairs and columns compared at a time, the fewest bits of a bitmap.
BLOCK, TILE, STEP_PAIRS, STEP_COLUMNS, LEAST_BITS = 1024, 128, 1 << 18, 4096, 512
#: Bits of the filter of wanted documents (4 MB); when it fills up, more sets are read than needed.
WANTED_BITS = 25


def most_unlike(total, percent: int):
    """Shingles in which two sets of together ``total`` shingles may differ at the threshold."""
    return total * (100 - percent) // (100 + percent)


def _most_unlike(total: Column, percent: int) -> Column:
    return F.floor(total * (100 - percent) / (100 + percent))


def _count_slots(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(1 << SLOT_BITS, np.int64)
    for _, texts in slabs(batches):
        seen += np.bincount((shingle_sets(texts, k)[0] >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(seen))
    parts = seen.reshape(64, -1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(64)), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "seen"])


def _add_slots(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in group["seen"].to_pylist())
    return pa.table({"part": group["part"].slice(0, 1), "seen": pa.array([total.tobytes()], pa.binary())})


def shingle_ranks(source: DataFrame, k: int) -> np.ndarray:
    """The order's classes: the binary logarithm of how many sets hold a shingle of each slot, over all documents.

    A shingle that stands in more than about one of a thousand sets is told apart; any order gives the same links.
    """
    counted = source.select("text").mapInArrow(lambda batches: _count_slots(batches, k), "part long, seen binary")
    rows = counted.groupBy("part").applyInArrow(_add_slots, "part long, seen binary").collect()
    seen = np.zeros((64, (1 << SLOT_BITS) // 64), np.int64)
    for r in rows:
        seen[r["part"]] = np.frombuffer(r["seen"], np.int64)
    return np.floor(np.log2(seen.ravel() + 1)).astype(np.uint8)


def _identity(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set; 0 for empty ones."""
    out, full = np.zeros(len(sizes), np.uint64), np.flatnonzero(sizes)
    if len(full):
        begins = (np.cumsum(sizes) - sizes)[full]
        out[full] = mix(np.add.reduceat(mix(hashes ^ np.uint64(7)), begins) + sizes[full].astype(np.uint64)) | np.uint64(1)
    return out.view(np.int64)


def parity_bits(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all bitmaps and their lengths in bytes: powers of two of at least twice as many bits as shingles."""
    bits = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype(np.int64))
    owner, begins = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(bits) - bits
    at = begins[owner] + (hashes & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8), bitorder="little"), bits // 8


def _describe(batches: Iterator[pa.RecordBatch], ranks: np.ndarray, percent: int, k: int) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for rows, texts in slabs(batches):
        hashes, sizes = shingle_sets(texts, k)
        nodes = _identity(hashes, sizes)
        fresh = np.zeros(len(nodes), bool)  # a task hands on each set once, as far as it remembers
        for i, node in enumerate(nodes.tolist()):
            fresh[i] = sizes[i] > 0 and node not in seen
            seen.add(node)
        if len(seen) > REMEMBERED:
            seen.clear()
        owner = np.repeat(np.arange(len(sizes)), sizes)
        level = ranks[(hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
        order = np.lexsort((level, owner))  # stable: equal classes stay in the order of their hashes
        place = np.arange(len(hashes)) - (np.cumsum(sizes) - sizes)[owner]
        reach = most_unlike(sizes + 100 * sizes // percent, percent)
        reach = np.where(fresh & (reach > 0), reach, -1)
        first = order[place <= reach[owner]]
        places = np.concatenate([[0], np.cumsum(np.where(reach >= 0, np.minimum(reach + 1, sizes), 0))]).astype(np.int32)
        spread = 1 << np.maximum(level[first].astype(np.int32) - SPLIT_CLASS, 0)
        bitmaps, lengths = parity_bits(hashes, sizes)
        bitmaps = pa.Array.from_buffers(pa.binary(), len(sizes), [
            None, pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.py_buffer(bitmaps.tobytes())])
        yield pa.RecordBatch.from_arrays([
            rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes),
            pa.ListArray.from_arrays(places, pa.StructArray.from_arrays(
                [pa.array(hashes[first].view(np.int64)), pa.array(spread.astype(np.int32))], ["token", "parts"])),
            pa.array([b if f else None for b, f in zip(bitmaps.to_pylist(), reach >= 0)], pa.binary()),
        ], ["doc_id", "n_shingles", "node", "tokens", "bitmap"])


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables of whole groups, each with the first row of every group and the number of rows."""
    kept: list[pa.RecordBatch] = []

    def begins(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for key in keys:
            values = table[key].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([*kept, batch])
        starts = begins(table)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
        kept = table.slice(starts[-1]).combine_chunks().to_batches()
    if kept:
        table = pa.Table.from_batches(kept)
        yield table, np.append(begins(table), table.num_rows)


def _lists(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Index rows without repeats that have a partner in their list, as far as sizes and positions tell.

    Rows of a list that is dealt to several tasks are all kept.
    """
    for table, starts in _groups(batches, "token", "part"):
        node = table["node"].to_numpy()
        fresh = np.ones(len(node), bool)
        fresh[1:] = node[1:] != node[:-1]
        fresh[starts[:-1]] = True
        group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[fresh]
        table = table.filter(pa.array(fresh))
        pos, n, keep = table["pos"].to_numpy(), table["n"].to_numpy(), table["parts"].to_numpy() > 1
        sizes = np.where(keep[np.searchsorted(group, np.arange(len(starts) - 1))], 0, np.bincount(group, minlength=len(starts) - 1))
        first = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=len(starts) - 1))])
        for i, j in _pairs(first[:-1], sizes, pos, n, percent):
            ok = _may_link(pos, n, i, j, percent)
            keep[i[ok]] = keep[j[ok]] = True
        yield from table.select(["token", "node", "n", "pos"]).filter(pa.array(keep)).combine_chunks().to_batches()


def _may_link(pos: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and positions leave a link of rows i and j possible."""
    alike = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    return alike & (pos[i] + pos[j] <= most_unlike(n[i] + n[j], percent))


def _fold(bitmaps: np.ndarray) -> np.ndarray:
    """Bitmaps of half as many bits."""
    half = bitmaps.shape[1] // 2
    return bitmaps[:, :half] ^ bitmaps[:, half:]


def _unlike_bits(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Unlike parity bits of each two bitmaps, the longer one folded to the length of the shorter."""
    out = np.zeros(len(left), np.int64)
    sizes = np.array([[len(a), len(b)] for a, b in zip(left, right)], np.int64).reshape(-1, 2)
    for small, large in np.unique(np.sort(sizes, axis=1), axis=0):
        for swap in (False, True) if small != large else (False,):
            some = np.flatnonzero((sizes[:, swap * 1] == small) & (sizes[:, 1 - swap * 1] == large))
            for lo in range(0, len(some), max(1, (1 << 24) // int(large))):
                part = some[lo:lo + max(1, (1 << 24) // int(large))]
                pick = lambda side, size: np.frombuffer(b"".join(side[i] for i in part), np.uint64).reshape(len(part), size // 8)  # noqa: E731,B023
                short, long = (pick(right, small), pick(left, large)) if swap else (pick(left, small), pick(right, large))
                while long.shape[1] > short.shape[1]:
                    long = _fold(long)
                out[part] = np.bitwise_count(short ^ long).sum(axis=1)
    return out


def _tiles(pos: np.ndarray, n: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one list, ordered by position and cut to tiles; tiles are skipped by least positions and by sizes."""
    order = np.lexsort((n, pos))
    parts = [order[i:i + TILE] for i in range(0, len(order), TILE)]
    low, small, large = (np.array([f(x[p]) for p in parts]) for f, x in ((np.min, pos), (np.min, n), (np.max, n)))
    for a in range(len(parts)):
        for b in range(a, len(parts)):
            if low[a] + low[b] > most_unlike(large[a] + large[b], percent):
                break  # the positions of all later tiles are no smaller
            if 100 * large[a] < percent * small[b] or 100 * large[b] < percent * small[a]:
                continue
            i, j = np.triu_indices(len(parts[a]), 1) if a == b else (x.ravel() for x in np.indices((len(parts[a]), len(parts[b]))))
            yield parts[a][i], parts[b][j]


def _pairs(starts: np.ndarray, sizes: np.ndarray, pos: np.ndarray, n: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within each group: those of many small groups at once, those of a large one by tiles."""
    for g in np.flatnonzero(sizes > TILE):
        own = slice(starts[g], starts[g] + sizes[g])
        for i, j in _tiles(pos[own], n[own], percent):
            yield starts[g] + i, starts[g] + j
    for size in np.unique(sizes[(sizes > 1) & (sizes <= TILE)]):
        i, j = np.triu_indices(size, 1)
        begins = starts[sizes == size]
        for lo in range(0, len(begins), max(1, STEP_PAIRS // len(i))):
            part = begins[lo:lo + max(1, STEP_PAIRS // len(i)), None]
            yield (part + i).ravel(), (part + j).ravel()


def _open_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows of open lists that may be linked with a row of another component in the same list."""
    for table, starts in _groups(batches, "token", "lo", "hi"):
        pos, n, component = (table[c].to_numpy() for c in ("pos", "n", "component"))
        unlike = table["unlike"].fill_null(-1).to_numpy()
        bitmaps, found = table["bitmap"].to_pylist(), np.zeros(table.num_rows, bool)
        for i, j in _pairs(starts[:-1], np.diff(starts), pos, n, percent):
            most = most_unlike(n[i] + n[j], percent)
            known = (unlike[i] >= 0) & (unlike[j] >= 0)
            ok = (component[i] != component[j]) & _may_link(pos, n, i, j, percent)
            ok &= ~known | (np.abs(unlike[i] - unlike[j]) <= most)
            i, j, most = i[ok], j[ok], most[ok]
            close = _unlike_bits([bitmaps[x] for x in i], [bitmaps[x] for x in j]) <= most
            found[i[close]] = found[j[close]] = True
        yield from table.select(["token", "lo", "hi", "node", "component"]).filter(pa.array(found)).combine_chunks().to_batches()


def _confirm(group: pa.Table, percent: int) -> pa.Table:
    """A spanning forest of the links between components of a group, from every set's difference to the first one."""
    group = group.sort_by("node")
    sets = [np.frombuffer(x, np.int64) for x in group["shingles"].to_pylist()]
    n, component = np.array([len(s) for s in sets]), group["component"].to_numpy()
    unlike = [np.setxor1d(sets[0], s, assume_unique=True) for s in sets]
    sizes = np.array([len(u) for u in unlike])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(unlike), return_inverse=True, return_counts=True)
    useful = count[column] > 1
    owner, column = owner[useful], np.unique(column[useful], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, STEP_COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + STEP_COLUMNS])
        held = np.zeros((len(sets), STEP_COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - lo] = 1
        both += held @ held.T
    apart = sizes[:, None] + sizes[None, :] - 2 * both.astype(np.int64)
    i, j = np.nonzero(np.triu(apart <= most_unlike(n[:, None] + n[None, :], percent), 1))
    cross = component[i] != component[j]
    i, j = i[cross], j[cross]
    keep = forest(component[i], component[j])
    node = group["node"].to_numpy()
    return pa.table({"a": pa.array(node[i[keep]], pa.int64()), "b": pa.array(node[j[keep]], pa.int64())})


def _list_sets(batches: Iterator[pa.RecordBatch], wanted: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    kept = (b.filter(pa.array((wanted[(slot := b.column("slot").to_numpy()) >> 3] >> (slot & 7) & 1).astype(bool))) for b in batches)
    for _, texts in slabs(kept):
        hashes, sizes = shingle_sets(texts, k)
        nodes, stops = _identity(hashes, sizes), np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays([
            pa.array(nodes), pa.array([hashes[e - s:e].tobytes() for s, e in zip(sizes, stops)], pa.binary())], ["node", "shingles"])


def _sets_of(source: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of the wanted (node, doc_id); a filter of fixed size keeps most other texts out of the shuffle."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << WANTED_BITS))
    words = wanted.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    bits = np.zeros((1 << WANTED_BITS) // 8 + 4096, np.uint8)  # buckets are numbered from 1, and slot 0 is in bucket 0
    for r in words:
        bits[r["bucket"] * 4096:(r["bucket"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    shared = source.sparkSession.sparkContext.broadcast(bits)
    slots = source.select("text", _bit_place(slot).alias("slot"))
    listed = slots.mapInArrow(lambda batches: _list_sets(batches, shared.value, k), "node long, shingles binary")
    return settle(listed.join(wanted.select("node"), "node").groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")


def _bit_place(slot: Column) -> Column:
    """The bit of a slot in the concatenated bitmaps."""
    return F.bitmap_bucket_number(slot) * 32768 + F.bitmap_bit_position(slot)


def _close_pairs(lists: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b) of each list's first set with the others, where positions, sizes and parity bits allow a link."""
    hub = lists.groupBy("token").agg(F.min(F.struct("node", "n", "pos")).alias("hub"), F.count("*").alias("held")).where("held > 1")
    total = F.col("n") + F.col("hub.n")
    pairs = lists.join(hub, "token").where(F.col("node") != F.col("hub.node")).where(
        F.least("n", "hub.n") * 100 >= F.greatest("n", "hub.n") * percent).where(
        F.col("pos") + F.col("hub.pos") <= _most_unlike(total, percent)).select(
        F.col("hub.node").alias("a"), F.col("node").alias("b"), total.alias("total")).distinct()

    @F.arrow_udf("boolean")
    def close(x: pa.Array, y: pa.Array, total: pa.Array) -> pa.Array:
        return pa.array(_unlike_bits(x.to_pylist(), y.to_pylist()) <= most_unlike(total.to_numpy(), percent))

    side = lambda name: nodes.select(F.col("node").alias(name), F.col("bitmap").alias(f"bitmap_{name}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").where(close("bitmap_a", "bitmap_b", "total")).select("a", "b")


def _answers(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, unlike): in how many shingles the full sets differ."""
    @F.arrow_udf("long")
    def unlike(x: pa.Array, y: pa.Array) -> pa.Array:
        both = zip(x.to_pylist(), y.to_pylist())
        return pa.array([len(np.setxor1d(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), assume_unique=True)) for a, b in both], pa.int64())

    side = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"set_{name}"))
    size = lambda name: (F.octet_length(f"set_{name}") / 8).cast("long").alias(f"n_{name}")
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", size("a"), size("b"), unlike("set_a", "set_b").alias("unlike"))


def _open_rows(lists: DataFrame, nodes: DataFrame, labels: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows of lists of several components, each with its component, its difference from the list's first set, and its blocks."""
    labelled = lists.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = labelled.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("node").alias("first"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("low <> high").drop("low", "high")
    known = answers.select(F.col("a").alias("first"), F.col("b").alias("node"), "unlike")
    rows = labelled.join(several, "token").join(known, ["first", "node"], "left").withColumn(
        "unlike", F.when(F.col("first") == F.col("node"), 0).otherwise(F.col("unlike"))).join(nodes.select("node", "bitmap"), "node")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "token", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "n", "pos", "component", "unlike", "bitmap")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its set size and the smallest doc_id of its component.

    A set holds the distinct shingles of ``k`` words of the whole text, lower-cased in A-Z; fewer words are one shingle; no words or
    no text give an empty set, which is linked with nothing. Sets that share at least ``percent`` of their union are linked,
    exactly. Rows with one doc_id are documents of their own; a row without a doc_id links others and gets their smallest
    id, null if none has one. No rows give no rows; other columns are ignored.
    """
    source = small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    ranks = source.sparkSession.sparkContext.broadcast(shingle_ranks(source, k))
    described = settle(source.mapInArrow(
        lambda batches: _describe(batches, ranks.value, percent, k),
        "doc_id long, n_shingles long, node long, tokens array<struct<token: long, parts: int>>, bitmap binary"), "described")
    indexed = described.where("bitmap is not null")
    nodes = settle(indexed.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("bitmap").alias("bitmap"), F.first("doc_id").alias("doc_id")), "nodes")
    entries = indexed.select("node", F.col("n_shingles").cast("int").alias("n"), F.posexplode("tokens").alias("pos", "t")).select(
        "t.token", F.pmod("node", "t.parts").cast("int").alias("part"), "t.parts", "node", "n", "pos")
    lists = settle(entries.repartition("token", "part").sortWithinPartitions("token", "part", "node").mapInArrow(
        lambda batches: _lists(batches, percent), "token long, node long, n int, pos int"), "lists")

    pairs = settle(_close_pairs(lists, nodes, percent), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _sets_of(source, ends.join(nodes.select("node", "doc_id"), "node"), k)
    answers = settle(_answers(pairs, sets), "answers")
    discard(sets)
    links = answers.where(F.col("unlike") <= _most_unlike(F.col("n_a") + F.col("n_b"), percent)).select("a", "b")
    labels = connected_components(links)

    rest = settle(_open_rows(lists, nodes, labels, answers).repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi").mapInArrow(
        lambda batches: _open_pairs(batches, percent), "token long, lo int, hi int, node long, component long"), "rest")
    ends = rest.select("node").distinct()
    sets = _sets_of(source, ends.join(nodes.select("node", "doc_id"), "node"), k)
    more = settle(rest.join(sets, "node").groupBy("token", "lo", "hi").applyInArrow(
        lambda group: _confirm(group, percent), "a long, b long").distinct(), "links")
    if not more.isEmpty():
        labels = connected_components(links.unionByName(more))
    for table in (sets, lists):
        discard(table)
    return _named(described, labels)


def _named(described: DataFrame, labels: DataFrame) -> DataFrame:
    """Components under the smallest doc_id of their rows."""
    classes = described.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("low")).join(labels, "node", "left").select(
        "node", "low", F.coalesce("component", "node").alias("component"))
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    names = classes.join(lowest, "component").select("node", "component_id", F.lit(True).alias("named"))
    return described.select("doc_id", "n_shingles", "node").join(names, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
