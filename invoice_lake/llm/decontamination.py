"""Benchmark decontamination by winnowing: texts meet on thinned fingerprints, and each meeting is extended to shared words.

Of all gram hashes in each run of ``window - GRAM + 1`` grams the smallest is kept (the last one among equals), so any
``window`` words that a document shares with an item have the same gram kept in both. Each kept gram is a row once, with the
words around it that a window over it may reach. Documents and items are joined on the fingerprint alone; each hit is
extended to left and right as long as the words agree, and counts if it spans a window. Items shorter than a
window have one gram, of all their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from invoice_lake.llm.storage import ROW, numbered, settle, small_batches, with_fields
from invoice_lake.llm.words import ALNUM_WORDS, LOWER, constants, grams, mix, rows_of, slabs

WINDOW, GRAM = 10, 7
#: Words on either side of a gram that a window over it may reach.
AROUND = WINDOW - GRAM
#: Bits of the filter of item fingerprints (16 MB, always used); when it fills up, more grams are joined than needed.
_FILTER_BITS = 27
_BEFORE, _AFTER = ([f"{side}{i}" for i in range(1, AROUND + 1)] for side in ("before", "after"))
_GRAM_FIELDS = ", ".join(["fingerprint: long", "place: long", "length: int", *[f"{n}: long" for n in (*_BEFORE, *_AFTER)]])


def fingerprints(words: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(fingerprint, place, begin, hash) of every window of each text.

    Each window has one fingerprint: the smallest of its gram hashes. ``place`` is the window's fingerprint
    place, ``begin`` the window's first word, ``hash`` the hash of the window's words.
    """
    hashes, begins = grams(words, first, window)
    smallest, _ = grams(words, first, gram)
    if len(begins) == 0:
        return smallest[:0], begins, begins, hashes
    at = np.full(len(words), -1, np.int64)
    at[_places(first, gram, len(words))] = np.arange(len(smallest))
    low, place = smallest[at[begins]].copy(), begins.copy()
    for j in range(1, window - gram + 1):
        value = smallest[at[begins + j]]
        better = value <= low
        low[better], place[better] = value[better], (begins + j)[better]
    return low, place, begins, hashes


def _places(first: np.ndarray, k: int, n: int) -> np.ndarray:
    owner = rows_of(first)
    return np.flatnonzero(owner[: n - k + 1] == owner[k - 1:]) if n >= k else np.empty(0, np.int64)


def _tag(fingerprint: np.ndarray, length: int) -> np.ndarray:
    """Grams of different lengths never meet."""
    return mix(fingerprint + constants(1, 9000 + length))


def kept_grams(words: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, place) of the winnowed grams of windows of ten words, each once, or of all grams of a lesser ``length``."""
    if length == WINDOW:
        low, place, _, _ = fingerprints(words, first)
        place, at = np.unique(place, return_index=True)
        return _tag(low[at], length), place
    hashes, begins = grams(words, first, length)
    return _tag(hashes, length), begins


def _gram_columns(words: np.ndarray, first: np.ndarray, owner: np.ndarray, prints: np.ndarray, places: np.ndarray, length: int):
    """Arrow arrays of ``_GRAM_FIELDS``: places within the text, lengths of grams, and the words around, null beyond the text."""
    size, who = (GRAM, owner[places]) if length == WINDOW else (length, owner[places])
    around = []
    for step in (*range(-1, -AROUND - 1, -1), *range(size, size + AROUND)):
        at = places + step
        beyond = (at < first[who]) | (at >= first[who + 1]) | (length < WINDOW)
        around.append(pa.array(words[np.clip(at, 0, len(words) - 1)].view(np.int64), mask=beyond))
    return [pa.array(prints.view(np.int64)), pa.array(places - first[who]), pa.array(np.full(len(places), size, np.int32)), *around]


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in slabs(batches):
        words, first = texts.words(ALNUM_WORDS, LOWER)
        sizes, owner = np.minimum(np.diff(first), WINDOW), rows_of(first)
        for length in np.unique(sizes[sizes > 0]).tolist():
            prints, places = kept_grams(words, first, length)
            mine = sizes[owner[places]] == length
            prints, places = prints[mine], places[mine]
            yield pa.RecordBatch.from_arrays(
                [rows.column("item_id").take(pa.array(owner[places])), pa.array(np.full(len(places), length, np.int32)),
                 *_gram_columns(words, first, owner, prints, places, length)],
                ["item_id", "window", "fingerprint", "place", "length", *_BEFORE, *_AFTER])


def _document_rows(batches: Iterator[pa.RecordBatch], windows: list[int], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    row_base = TaskContext.get().partitionId() << 40
    for rows, texts in slabs(batches):
        words, first = texts.words(ALNUM_WORDS, LOWER)
        owner, who, parts = rows_of(first), [np.empty(0, np.int64)], []
        for length in windows:
            prints, places = kept_grams(words, first, length)
            slot = prints & np.uint64((1 << _FILTER_BITS) - 1)
            keep = np.flatnonzero(wanted[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
            if len(keep):
                who.append(owner[places[keep]])
                parts.append(pa.StructArray.from_arrays(
                    _gram_columns(words, first, owner, prints[keep], places[keep], length),
                    ["fingerprint", "place", "length", *_BEFORE, *_AFTER]))
        who = np.concatenate(who)
        kind = pa.struct([(f, pa.int32() if f == "length" else pa.int64()) for f in ("fingerprint", "place", "length", *_BEFORE, *_AFTER)])
        found = pa.concat_arrays(parts) if parts else pa.array([], kind)
        counts = np.bincount(who, minlength=len(texts))
        yield pa.RecordBatch.from_arrays([
            pa.array(row_base + np.arange(len(texts))), rows.column("doc_id"), pa.array(np.diff(first)),
            pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), found.take(pa.array(np.argsort(who, kind="stable")))),
        ], ["row", "doc_id", "n_words", "grams"])
        row_base += len(texts)


def _filter_of(items: DataFrame) -> np.ndarray:
    """A bit per slot of the items' fingerprints, put together in pieces of 4 KB: 16 MB at most, however many items there are."""
    slot = F.col("fingerprint").bitwiseAND((1 << _FILTER_BITS) - 1) + 1
    pieces = items.groupBy(F.bitmap_bucket_number(slot).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    wanted = np.zeros(1 << (_FILTER_BITS - 3), np.uint8)
    for piece, bits in pieces.collect():
        wanted[(piece - 1) * len(bits):piece * len(bits)] = np.frombuffer(bits, np.uint8)
    return wanted


def _agreeing(names: list[str]) -> Column:
    """How many of the words on one side agree, from the gram outwards; a word beyond a text agrees with none."""
    reach = F.lit(len(names))
    for i, name in reversed(list(enumerate(names))):
        reach = F.when(F.col(f"d.{name}") == F.col(f"i.{name}"), reach).otherwise(F.lit(i))
    return reach


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its words, the spans hit by windows of ``benchmark`` (item_id, text), and the items.

    Words are runs of digits, letters a-z (A-Z lower-cased) and all characters beyond ASCII. A window is ten
    consecutive words of an item, or all words of a shorter item. Returns doc_id, n_words, n_hit (words inside any
    occurrence), spans (sorted, disjoint [begin, end) word ranges), item_ids (distinct, sorted as strings).
    Null texts and texts without words have no windows; items without words have none either. Equal items each count.
    An empty benchmark hits nothing; no documents give no rows. Rows with equal doc_id stay separate rows.
    """
    grams_of = ["fingerprint", "length", *_BEFORE, *_AFTER]
    source = benchmark.select("item_id", "text")
    items = settle(
        small_batches(source).mapInArrow(
            _item_rows, with_fields(source.select("item_id").schema, "window int, " + _GRAM_FIELDS.replace(":", ""))
        ).drop("place").distinct(), "items")
    # Items that share a gram and the words around it are met once, whatever their number.
    alike = F.xxhash64("window", *[F.coalesce(name, F.lit(0)) for name in grams_of]).alias("alike")  # a null would leave no trace
    places = items.select("window", *grams_of).distinct().withColumn("alike", alike)
    windows = sorted(r[0] for r in items.select("window").distinct().collect())
    source = docs.select("doc_id", "text")
    shared = source.sparkSession.sparkContext.broadcast((windows, _filter_of(items)))
    schema = with_fields(source.select("doc_id").schema, f"n_words long, grams array<struct<{_GRAM_FIELDS}>>")
    schema.fields.insert(0, T.StructField("row", T.LongType()))
    scanned = settle(
        small_batches(source).mapInArrow(lambda batches: _document_rows(batches, *shared.value), T.StructType(schema.fields)), "scanned")
    seen = scanned.where(F.size("grams") > 0).select("row", F.explode("grams").alias("g")).select("row", "g.*")
    left, right = _agreeing(_BEFORE), _agreeing(_AFTER)
    begin, end = F.col("d.place") - left, F.col("d.place") + F.col("d.length") + right
    hits = settle(
        seen.alias("d").join(places.alias("i"), "fingerprint").where(end - begin >= F.col("i.window")).select(
            "row", begin.alias("begin"), end.alias("end"), "alike"), "hits")
    named = items.select(alike, F.col("item_id").cast("string").alias("item")).distinct()
    found = _spans(hits).join(
        hits.select("row", "alike").distinct().join(named, "alike").select("row", "item").distinct().groupBy("row").agg(
            F.sort_array(F.collect_list("item")).alias("item_ids")), "row")
    none = F.array().cast("array<struct<begin: bigint, end: bigint>>")
    return scanned.select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", none).alias("spans"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def _spans(hits: DataFrame) -> DataFrame:
    """Per row the united word ranges of its hits, and the words in them."""
    in_order = Window.partitionBy("row").orderBy("begin", "end")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    ranges = hits.select("row", "begin", "end").distinct().withColumn("reach", F.max("end").over(earlier))
    opened = ranges.withColumn("span", F.sum(F.coalesce((F.col("begin") > F.col("reach")).cast("long"), F.lit(1))).over(in_order))
    united = opened.groupBy("row", "span").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return united.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"), F.sum(F.col("end") - F.col("begin")).alias("n_hit"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that share a window with the benchmark. Each row is judged by its own text, whatever its doc_id."""
    rows = numbered(docs)
    lost = contamination(rows.select(F.col(ROW).alias("doc_id"), "text"), benchmark).where("n_hit > 0")
    return rows.join(lost.select(F.col("doc_id").alias(ROW)), ROW, "left_anti").select(*docs.columns)
