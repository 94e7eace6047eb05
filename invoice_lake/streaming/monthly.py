"""Incremental load as a stream over the landing folder.

The stream sees file names only. Each micro-batch names the periods that got a new archive, and the
batch jobs load those periods whole, so a stream and a batch run give the same tables. No watermark
is needed: duplicates are removed within a period, and a period is always read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from invoice_lake.plans.lake import load_bronze, load_silver
from invoice_lake.sources.landing import ARCHIVE_GLOB, with_periods

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def stream_archives(
    spark: SparkSession, landing_dir: str, root: str, staging: str, checkpoint: str,
    replace: bool = True, **cleaning,
) -> StreamingQuery:
    """Load every archive that has arrived since the last run, then stop.

    A new delivery of a month replaces the month; with ``replace`` off it is ignored. A batch that
    is repeated after a failure writes the same periods again.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        periods = sorted(row.periodo for row in with_periods(batch).select("periodo").collect())
        if not periods:
            return
        loaded = load_bronze(batch.sparkSession, landing_dir, root, staging, replace, only=periods)
        load_silver(batch.sparkSession, root, replace=loaded if replace else (), **cleaning)

    files = (
        spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
        .option("pathGlobFilter", ARCHIVE_GLOB)
        .load(landing_dir)
        .select("path")
    )
    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
