"""Shared scratch tables: results that a later job reads again are written once and read from there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The column of ``numbered``.
ROW = "__row"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local session without that setting gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that no other run uses."""
    return f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a scratch table and read it back, so that lost executors never cost more than this job."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path).withMetadata(df.columns[0], {"scratch": path})


def numbered(df: DataFrame) -> DataFrame:
    """``df`` as a scratch table with a number of its own in ``ROW`` for every row, the same each time it is read."""
    return settle(df.select(F.monotonically_increasing_id().alias(ROW), "*"), "numbered")


def with_fields(schema: StructType, added: str) -> StructType:
    """``schema`` and the fields of a DDL string behind it; field names of any spelling, also inside structs, stay as they are."""
    return StructType([*schema.fields, *StructType.fromDDL(added).fields])


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session hands rows to Python in Arrow batches of about 4 MB unless it sets a size of its own.

    Spark's default of 64 MB is held by the JVM and by each Python worker at once.
    """
    if _BATCH_BYTES not in df.sparkSession.conf.getAll:
        df.sparkSession.conf.set(_BATCH_BYTES, "4m")
    return df


def discard(df: DataFrame) -> None:
    """Delete a settled table that no later step reads."""
    path = df.schema[0].metadata.get("scratch")
    if path:
        spark = df.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
