"""Tables in buckets of a key: read without a shuffle, replaced by period, readable by another session."""

import pytest
from pyspark.sql import functions as F

from invoice_lake.operators.cleaning import drop_repeated_rows
from invoice_lake.operators.quality import count_repeated_keys, repeated_keys
from invoice_lake.sources.keyed import read_keyed, write_keyed
from invoice_lake.sources.layers import qualified
from tests.conftest import plan

OF = ("silver", "itens", "chave_de_acesso", 3)


def delivered(spark, *rows):
    return spark.createDataFrame(rows, "chave_de_acesso string, valor double, `dia do mes` int, periodo string")


def contents(df):
    return sorted((str(r.chave_de_acesso), float(r.valor), r["dia do mes"], r.periodo) for r in df.collect())


@pytest.fixture
def lake(spark, tmp_path):
    rows = [(f"K{i % 40}", float(i % 7), i % 28, f"2024-0{1 + i % 3}") for i in range(300)]
    df = delivered(spark, *rows).repartition(5)
    assert write_keyed(df, str(tmp_path), *OF) == 300
    return str(tmp_path), df


def test_grouping_by_the_key_needs_no_exchange(spark, lake):
    root, df = lake
    keyed = read_keyed(spark, root, *OF, df.schema)
    assert contents(keyed) == contents(df)
    for result in (drop_repeated_rows(keyed), repeated_keys(keyed, value="valor"), keyed.join(keyed.groupBy("chave_de_acesso").count(), "chave_de_acesso")):
        assert "Exchange" not in plan(result.hint("merge"))
    assert plan(count_repeated_keys(keyed)).count("Exchange") == 1  # the one count
    assert contents(drop_repeated_rows(keyed)) == contents(df.distinct())
    wanted = repeated_keys(df, value="valor").collect()
    assert sorted(map(str, repeated_keys(keyed, value="valor").collect())) == sorted(map(str, wanted))


def test_periods_are_replaced_and_cleared(spark, lake):
    root, df = lake
    again = delivered(spark, ("K1", 5.0, 1, "2024-02"), (None, 6.0, 2, "2024-02"))
    assert write_keyed(again, root, *OF, periods=["2024-02", "2024-03"]) == 2
    expected = contents(df.where("periodo = '2024-01'").unionByName(again))
    assert contents(read_keyed(spark, root, *OF, df.schema)) == expected
    write_keyed(again, root, *OF, periods=["2024-02"])
    assert contents(read_keyed(spark, root, *OF, df.schema)) == expected


def test_columns_in_another_order(spark, lake):
    root, df = lake
    turned = df.where("periodo = '2024-01'").select("periodo", "dia do mes", "valor", "chave_de_acesso")
    write_keyed(turned.withColumn("valor", F.col("valor") + 1), root, *OF)
    got = contents(read_keyed(spark, root, *OF, df.schema).where("periodo = '2024-01'"))
    assert got == sorted((k, v + 1, d, p) for k, v, d, p in contents(df) if p == "2024-01")


def test_a_session_that_does_not_know_the_table(spark, lake):
    root, df = lake
    read_keyed(spark, root, *OF, df.schema)
    for table in spark.catalog.listTables():
        if table.name.startswith("itens_"):
            spark.sql(f"DROP TABLE `{table.name}`")  # leaves the files
    assert contents(read_keyed(spark, root, *OF, df.schema)) == contents(df)


def test_a_table_never_written(spark, tmp_path):
    empty = delivered(spark)
    assert read_keyed(spark, str(tmp_path), *OF, empty.schema).count() == 0
    assert write_keyed(empty, str(tmp_path), *OF) == 0
    assert read_keyed(spark, str(tmp_path), *OF, empty.schema).count() == 0


def test_a_cluster_takes_local_paths_below_its_shared_folders_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://other:7077")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    assert qualified(spark, f"{warehouse}/lago-1").startswith("file:/")
    for other in (f"{warehouse}-not", f"{warehouse}/../other", str(tmp_path)):
        with pytest.raises(ValueError):
            qualified(spark, other)
