"""Duplicate and consistency checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeated_keys(df: DataFrame, key: str = "chave_de_acesso", value: str = "valor_nota_fiscal") -> DataFrame:
    """Keys with more than one row: number of rows and their value."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("registros"), F.sum(value).alias("total"))
        .filter("registros > 1")
    )


def repeated_rows_by(df: DataFrame, by: str) -> DataFrame:
    """Rows before and after full-row deduplication per value of ``by``, in one pass."""
    return (
        df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
        .groupBy(by).agg(F.sum("_n").alias("n_antes"), F.count("*").alias("n_depois"))
    )


def count_repeated_keys(df: DataFrame, key: str = "chave_de_acesso") -> DataFrame:
    repeated = df.groupBy(key).agg(F.count("*").alias("registros")).filter("registros > 1")
    return repeated.agg(F.count("*").alias("chaves_repetidas"))


def is_consistent() -> Column:
    """quantity x unit price = line total; NULL where one of them is missing."""
    return F.col("quantidade") * F.col("valor_unitario") == F.col("valor_total")


def consistency_counts(items: DataFrame) -> DataFrame:
    return items.groupBy(is_consistent().alias("consistente")).agg(F.count("*").alias("qtd_itens"))


def inconsistent_items(items: DataFrame, order: Sequence[str], limit: int = 100) -> DataFrame:
    """The first ``limit`` inconsistent items in ``order``, with the quantity their price implies."""
    implied = F.try_divide(F.col("valor_total").cast("double"), F.col("valor_unitario").cast("double"))
    return (
        items.filter(~is_consistent())
        .withColumn("qtd_inferida", implied)
        .withColumn("valor_calculado", F.col("quantidade") * F.col("valor_unitario"))
        .orderBy(*[F.asc_nulls_last(name) for name in order])
        .limit(limit)
    )
