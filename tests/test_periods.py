import datetime

import pytest
from pyspark.sql import functions as F

from invoice_lake.functions import periods
from invoice_lake.sources import layers
from tests.conftest import column


@pytest.mark.parametrize(
    "first, last, expected",
    [
        ("202201", "202203", ["202201", "202202", "202203"]),
        ("202211", "202302", ["202211", "202212", "202301", "202302"]),
        ("202601", "202601", ["202601"]),
        ("202603", "202601", []),
    ],
)
def test_month_range(spark, first, last, expected):
    df = periods.month_range(spark, first, last)
    assert column(df, "periodo_raw") == expected
    assert column(df, "periodo") == [f"{p[:4]}-{p[4:]}" for p in expected]


def test_missing_periods_keep_their_order(spark):
    expected = periods.month_range(spark, "202201", "202203")
    landed = spark.createDataFrame([("2022-01",), ("2022-01",)], "periodo string")
    assert column(periods.missing_periods(expected, landed), "periodo") == ["2022-02", "2022-03"]
    assert column(periods.missing_periods(expected.limit(1), landed), "periodo") == []


def test_previous_period(spark):
    days = spark.createDataFrame([(datetime.date(2026, 1, 31),), (datetime.date(2026, 3, 31),)], "d date")
    assert column(days.select(periods.previous_period(F.col("d")).alias("x")), "x") == ["202512", "202602"]


def test_in_years(spark):
    stamps = ["2021-12-31 23:59:59", "2022-01-01 00:00:00", "2023-12-31 23:59:59", "2024-05-05 00:00:00", "2025-01-01 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    found = column(df.filter(periods.in_years(F.col("t"), [2025, 2022, 2023])), "t")
    assert [t.year for t in found] == [2022, 2023, 2025]
    assert df.filter(periods.in_years(F.col("t"), [])).count() == 0


def test_no_table_has_no_periods(spark, tmp_path):
    assert layers.loaded_periods(spark, str(tmp_path), "silver", "itens").count() == 0


def test_append_accumulates_by_name(spark, tmp_path):
    first = spark.createDataFrame([("1", "x", "2024-01")], "a string, b string, periodo string")
    second = spark.createDataFrame([("y", "2", "2024-02")], "b string, a string, periodo string")
    root = str(tmp_path)
    assert layers.write_periods(first, root, "bronze", "t") == 1
    assert layers.write_periods(second, root, "bronze", "t", rebalance=True) == 1
    rows = layers.read_table(spark, root, "bronze", "t").select("a", "b", "periodo").collect()
    assert sorted(map(tuple, rows)) == [("1", "x", "2024-01"), ("2", "y", "2024-02")]
    layers.write_periods(second, root, "bronze", "t")
    assert layers.read_table(spark, root, "bronze", "t").count() == 2
    assert sorted(column(layers.loaded_periods(spark, root, "bronze", "t"), "periodo")) == ["2024-01", "2024-02"]
