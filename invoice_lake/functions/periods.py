"""Monthly periods: 'YYYYMM' in file names, 'YYYY-MM' in tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def dashed_period(raw: Column) -> Column:
    """'202501' -> '2025-01'"""
    return F.concat_ws("-", F.substring(raw, 1, 4), F.substring(raw, 5, 2))


def previous_period(day: Column) -> Column:
    """'YYYYMM' of the month before ``day``."""
    return F.date_format(F.add_months(day, -1), "yyyyMM")


def in_years(day: Column, years: Sequence[int]) -> Column:
    """Whether ``day`` lies in one of ``years``, as ranges of the column itself.

    A range lets the Parquet scan skip row groups by their minimum and maximum; YEAR(day) = .. does not.
    """
    def start(y: int) -> Column:
        return F.lit(f"{y:04d}-01-01").cast("timestamp_ntz")

    wanted = sorted(set(years))
    firsts = [y for y in wanted if y - 1 not in wanted]
    lasts = [y for y in wanted if y + 1 not in wanted]
    ranges = [(day >= start(first)) & (day < start(last + 1)) for first, last in zip(firsts, lasts)]
    return reduce(or_, ranges, F.lit(False))


def expand_months(bounds: DataFrame, first: str = "inicio", last: str = "fim") -> DataFrame:
    """All months from ``first`` to ``last`` ('YYYYMM' columns), inclusive; none if last < first."""
    start = F.to_date(F.col(first), "yyyyMM")
    end = F.to_date(F.col(last), "yyyyMM")
    # A descending sequence is an error in Spark, so empty ranges leave before it.
    months = F.explode(F.sequence(start, F.greatest(start, end), F.expr("INTERVAL 1 MONTH")))
    return (
        bounds.filter(start <= end)
        .select(months.alias("mes"))
        .select(F.date_format("mes", "yyyyMM").alias("periodo_raw"))
        .withColumn("periodo", dashed_period(F.col("periodo_raw")))
    )


def month_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    """``expand_months`` for two given months."""
    bounds = spark.range(1).select(F.lit(first).alias("inicio"), F.lit(last).alias("fim"))
    return expand_months(bounds).orderBy("periodo_raw")


def missing_periods(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Periods of ``expected`` that ``present`` lacks, in order."""
    return expected.join(present.select("periodo").distinct(), "periodo", "left_anti").orderBy("periodo")
