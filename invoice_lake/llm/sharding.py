"""Random shards by a two-pass external shuffle.

The first pass scatters records over buckets of a memory's size by a seeded hash of their id and text. The second gives the records
of each bucket, in a fixed order, the places of a seeded Fisher-Yates permutation and writes them. All buckets in a row
are one random order of the table; shard s is the s-th of equal stretches of it, so that row counts differ by one at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from invoice_lake.llm.storage import with_fields

SHARDS, SEED = 24, 20_241
#: The least bytes of a bucket, and the buckets beyond which they grow instead: 100 TB are in buckets of 1 GB.
BUCKET_BYTES, BUCKETS = 32 << 20, 100_000


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform permutation of range(n), fixed by seed and bucket."""
    return np.random.Generator(np.random.PCG64([seed, bucket])).permutation(n)


def _place(batches: Iterator[pa.RecordBatch], bases: np.ndarray, shards: int, seed: int) -> Iterator[pa.RecordBatch]:
    total, order, bucket, at = int(bases[-1]), np.empty(0, np.int64), -1, 0
    for batch in batches:
        own = batch.column("bucket").to_numpy()
        places = np.empty(len(own), np.int64)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
        for lo, hi in zip(edges[:-1], edges[1:]):
            if hi == lo:
                continue
            if own[lo] != bucket:
                bucket, at = int(own[lo]), 0
                order = fisher_yates(int(bases[bucket + 1] - bases[bucket]), seed, bucket)
            places[lo:hi] = bases[bucket] + order[at:at + hi - lo]
            at += hi - lo
        shard = places * shards // max(total, 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("record"), pa.array(shard.astype(np.int32)), pa.array(places - -(-shard * total // shards))],
            ["record", "shard", "slot"])


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write all ``docs`` (doc_id, text, any columns) to ``folder/shard=N`` in random order; returns what was written.

    Columns: record (the whole row, so that no name clashes), slot (its place in the shard, gapless from 0), shard. The
    same table and seed give the same shards. Nulls are values like others; only rows that have both
    doc_id and text in common are sure to share a bucket, which needs eight bytes a row, as the sort that orders it may spill. With fewer rows than shards some
    shards are empty; no rows give no rows.
    """
    records = docs.select(F.struct("*").alias("record"))
    size = F.coalesce(F.octet_length("record.text"), F.lit(0)) + 8
    total = records.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // max(bucket_bytes, -(-total // BUCKETS))))
    text_hash = F.xxhash64("record.text")
    bucket = F.pmod(F.xxhash64(F.lit(seed), "record.doc_id", text_hash), F.lit(buckets)).cast("int").alias("bucket")
    counts = np.zeros(buckets, np.int64)
    for row in records.select(bucket).groupBy("bucket").count().toLocalIterator():  # one row per bucket
        counts[row["bucket"]] = row["count"]
    shared = docs.sparkSession.sparkContext.broadcast(np.concatenate([[0], np.cumsum(counts)]))
    scattered = records.select("record", bucket).repartitionById(buckets, "bucket").sortWithinPartitions(
        "bucket", "record.doc_id", text_hash)
    placed = scattered.mapInArrow(
        lambda batches: _place(batches, shared.value, shards, seed), with_fields(records.schema, "shard int, slot long"))
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return read_shards(docs.sparkSession, folder, placed.schema)


def read_shards(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(folder)
