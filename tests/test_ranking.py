"""Ranks with hot groups cut into slices equal ranks by plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from invoice_lake.operators.ranking import rank_in_groups, tie_hash
from tests.conftest import plan


@pytest.fixture(scope="module")
def totals(spark):
    random.seed(7)
    rows = []
    for i in range(3000):
        group = random.choice(["hot", "hot", "hot", "small", None])
        value = random.choice([None, "5.00", "5.00", "0.00", "-3.00", f"{random.uniform(0.01, 1e9):.2f}"])
        rows.append((2024 if i % 2 else 2025, group, value, f"d{i}"))
    rows += [(2024, "nulls", None, f"n{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "ano int, g string, v string, d string")
    return df.withColumn("v", F.col("v").cast("decimal(28,2)"))


@pytest.mark.parametrize("hot_rows", [10**6, 500, 10, 0])
def test_hot_groups_rank_like_small_ones(totals, hot_rows):
    ranked = rank_in_groups(totals, ["ano", "g"], "v", ["d"], "r", "t", "p", "pt", hot_rows=hot_rows)
    by_group = Window.partitionBy("ano", "g")
    ordered = by_group.orderBy(F.desc_nulls_last("v"), tie_hash(["d"]), "d")
    expected = (
        totals.withColumn("t", F.sum("v").over(by_group))
        .withColumn("r", F.row_number().over(ordered).cast("bigint"))
        .withColumn("p", F.round(F.try_divide(F.col("v").cast("double"), F.col("t").cast("double")), 4))
        .withColumn("pt", F.sum(F.col("p").cast("decimal(18,4)")).over(by_group).cast("double"))
    )
    names = ["ano", "g", "v", "d", "t", "r", "p", "pt"]
    assert sorted(map(str, ranked.select(names).collect())) == sorted(map(str, expected.select(names).collect()))


@pytest.mark.parametrize("hot_rows, sliced", [(10**6, False), (20, True)])
def test_rows_are_read_once_and_sliced_only_in_hot_groups(spark, tmp_path, totals, hot_rows, sliced):
    path = str(tmp_path / "totais")
    totals.repartition(3).write.parquet(path)
    read = spark.read.parquet(path).groupBy("ano", "g", "d").agg(F.sum("v").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for lists of hot groups too long to broadcast
    try:
        ranked = rank_in_groups(read, ["ano", "g"], "v", ["d"], "r", "t", "p", "pt", hot_rows=hot_rows)
        rows = ranked.collect()
        final = plan(ranked).split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = rank_in_groups(read, ["ano", "g"], "v", ["d"], "r", "t", "p", "pt")
    assert sorted(map(str, rows)) == sorted(map(str, expected.collect()))
    assert final.count("FileScan") == 1
    assert ("_slice" in final) == sliced
