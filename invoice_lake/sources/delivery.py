"""CSV deliverables. Each is a folder of part files with headers, written in parallel."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"


@contextmanager
def _any_charset(spark: SparkSession):
    """Spark refuses windows-1252 unless this setting is on; with it, unmappable characters become '?'."""
    name = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _plain_number(value: Column, kind: T.DataType) -> Column:
    """A number as text without exponent; a double keeps at least one decimal."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = F.regexp_replace(value.cast("decimal(38,10)").cast("string"), "0+$", "")
        return F.when(text.endswith("."), F.concat(text, F.lit("0"))).otherwise(text)
    return value.cast("string")


def regional_text(df: DataFrame) -> DataFrame:
    """Numbers with a decimal comma and booleans as True/False, all as text."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            value = F.translate(_plain_number(value, field.dataType), ".", ",")
        elif isinstance(field.dataType, T.BooleanType):
            value = F.initcap(value.cast("string"))
        elif isinstance(field.dataType, T.ArrayType):
            value = F.concat(F.lit("["), F.array_join(value, ", "), F.lit("]"))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def write_regional_csv(df: DataFrame, path: str, encoding: str = "windows-1252") -> None:
    """Semicolons, decimal commas, a Windows charset: what a pt-BR spreadsheet opens directly."""
    with _any_charset(df.sparkSession):
        (
            regional_text(df).write.mode("overwrite")
            .options(sep=";", header=True, quote='"', escape='"', emptyValue="", encoding=encoding)
            .option("timestampNTZFormat", _TIMESTAMP)
            .csv(path)
        )


def write_plain_csv(df: DataFrame, path: str) -> None:
    """UTF-8, commas, decimal points."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = _plain_number(value, field.dataType)
        elif isinstance(field.dataType, T.ArrayType):
            value = F.concat(F.lit("["), F.array_join(value, ", "), F.lit("]"))
        columns.append(value.alias(field.name))
    (
        df.select(*columns).write.mode("overwrite")
        .options(header=True, quote='"', escape='"', emptyValue="")
        .option("timestampNTZFormat", _TIMESTAMP)
        .csv(path)
    )
