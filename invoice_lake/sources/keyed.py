"""Tables kept in buckets of a key, a folder per period: sums, distinct rows and joins by that key read them without a shuffle.

The key and the number of buckets are part of the folder's name, so that a table is never read with other buckets than it was
written with. All rows of a key are read by one task; the layout is for keys such as invoice numbers, of which none holds
a large part of the rows. Other keys are better summed by a plain shuffle, which combines rows before it sends them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from invoice_lake.sources.layers import clear_periods, qualified, table_path


def keyed_name(table: str, key: str, buckets: int) -> str:
    return f"{table}_por_{key}_{buckets}"


def _registered(spark: SparkSession, root: str, layer: str, table: str, key: str, buckets: int, schema: T.StructType) -> str:
    """The catalog's name of the table; it is registered when this session's catalog lacks it. The files stay where they are."""
    path = qualified(spark, table_path(root, layer, keyed_name(table, key, buckets)))
    name = f"{table}_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema if field.name != "periodo")
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE `{name}` ({columns}, periodo STRING) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
            f"PARTITIONED BY (periodo) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'")
    spark.sql(f"MSCK REPAIR TABLE `{name}` SYNC PARTITIONS")  # periods that other sessions wrote or removed
    return name


def write_keyed(
    df: DataFrame, root: str, layer: str, table: str, key: str, buckets: int, periods: Sequence[str] = ()
) -> int:
    """Write the periods that ``df`` holds, replacing those only; of ``periods``, those without rows are cleared. Returns the row count.

    One shuffle brings each bucket to one task, which writes one sorted file per period. Repeating a write gives the same table.
    Rows without a key share a bucket. Choose ``buckets`` so that one bucket of all periods suits a task.
    """
    spark = df.sparkSession
    name = _registered(spark, root, layer, table, key, buckets, df.schema)
    present = [column for column in df.columns if column != "periodo"]
    rows = df.select(*[f"`{column}`" for column in present], df["periodo"].cast("string").alias("periodo"))
    rows = rows.select(*[f"`{column}`" for column in spark.table(name).columns])
    seen = Observation()
    per_period = [F.count(F.when(F.col("periodo") == p, F.lit(1))).alias(f"of_{i}") for i, p in enumerate(periods)]
    placed = rows.repartition(buckets, F.col(f"`{key}`")).observe(seen, F.count(F.lit(1)).alias("rows"), *per_period)
    placed.write.insertInto(name, overwrite=True)
    counts = seen.get
    clear_periods(spark, root, layer, keyed_name(table, key, buckets), [p for i, p in enumerate(periods) if counts[f"of_{i}"] == 0])
    return counts["rows"]


def read_keyed(
    spark: SparkSession, root: str, layer: str, table: str, key: str, buckets: int, schema: T.StructType
) -> DataFrame:
    """The table with the columns of ``schema`` and periodo, known to Spark as clustered by ``key``. No rows if never written."""
    name = _registered(spark, root, layer, table, key, buckets, schema)
    spark.catalog.refreshTable(name)
    return spark.table(name)
