"""Mapping files and the fixed tables that ship with the reports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from invoice_lake import schemas

# Product types of group A and their eight-digit codes.
GROUP_A = (
    ("Etileno", "39011020"),
    ("Etileno", "39011030"),
    ("Etileno", "39012011"),
    ("Etileno", "39012019"),
    ("Etileno", "39012021"),
    ("Etileno", "39012029"),
    ("Etileno", "39013010"),
    ("Etileno", "39013090"),
    ("Etileno", "39014000"),
    ("Etileno", "39019010"),
    ("Etileno", "39019020"),
    ("Etileno", "39019030"),
    ("Etileno", "39019040"),
    ("Etileno", "39019050"),
    ("Etileno", "39019090"),
    ("Etileno", "39161000"),
    ("Etileno", "39172100"),
    ("Etileno", "39173210"),
    ("Etileno", "39173230"),
    ("Etileno", "39201091"),
    ("Etileno", "39201099"),
    ("Etileno", "39219012"),
    ("Etileno", "39219013"),
    ("Etileno", "39219020"),
    ("Estireno", "39031110"),
    ("Estireno", "39031120"),
    ("Estireno", "39031900"),
    ("Estireno", "39032000"),
    ("Estireno", "39033010"),
    ("Estireno", "39033020"),
    ("Estireno", "39039010"),
    ("Estireno", "39039020"),
    ("Estireno", "39039090"),
    ("Estireno", "39152000"),
    ("Estireno", "39203000"),
    ("Estireno", "39211100"),
    ("PVC", "39162000"),
    ("PVC", "39041020"),
    ("PVC", "39041090"),
    ("PVC", "39042100"),
    ("PVC", "39042200"),
    ("PVC", "39043000"),
    ("PVC", "39044010"),
    ("PVC", "39044090"),
    ("PVC", "39045010"),
    ("PVC", "39045090"),
    ("PVC", "39046110"),
    ("PVC", "39046190"),
    ("PVC", "39046910"),
    ("PVC", "39046990"),
    ("PVC", "39049010"),
    ("PVC", "39049090"),
    ("PVC", "39153000"),
    ("PVC", "39172300"),
    ("PVC", "39181000"),
    ("PVC", "39191020"),
    ("PVC", "39199020"),
    ("PVC", "39204310"),
    ("BR", "40022010"),
    ("BR", "40022091"),
    ("BR", "40022099"),
    ("SBR", "40021110"),
    ("SBR", "40021120"),
    ("SBR", "40021911"),
    ("SBR", "40021912"),
    ("SBR", "40021920"),
    ("Obras de Plástico ou Borracha", "39221000"),
    ("Obras de Plástico ou Borracha", "39222000"),
    ("Obras de Plástico ou Borracha", "39229000"),
    ("Obras de Plástico ou Borracha", "39231010"),
    ("Obras de Plástico ou Borracha", "39231090"),
    ("Obras de Plástico ou Borracha", "39232110"),
    ("Obras de Plástico ou Borracha", "39232190"),
    ("Obras de Plástico ou Borracha", "39232910"),
    ("Obras de Plástico ou Borracha", "39232990"),
    ("Obras de Plástico ou Borracha", "39233010"),
    ("Obras de Plástico ou Borracha", "39233090"),
    ("Obras de Plástico ou Borracha", "39234000"),
    ("Obras de Plástico ou Borracha", "39235000"),
    ("Obras de Plástico ou Borracha", "39239010"),
    ("Obras de Plástico ou Borracha", "39239090"),
    ("Obras de Plástico ou Borracha", "39241000"),
    ("Obras de Plástico ou Borracha", "39249000"),
    ("Obras de Plástico ou Borracha", "39251000"),
    ("Obras de Plástico ou Borracha", "39252000"),
    ("Obras de Plástico ou Borracha", "39253000"),
    ("Obras de Plástico ou Borracha", "39259010"),
    ("Obras de Plástico ou Borracha", "39259090"),
    ("Obras de Plástico ou Borracha", "39261000"),
    ("Obras de Plástico ou Borracha", "39262000"),
    ("Obras de Plástico ou Borracha", "39263000"),
    ("Obras de Plástico ou Borracha", "39264000"),
    ("Obras de Plástico ou Borracha", "39269010"),
    ("Obras de Plástico ou Borracha", "39269021"),
    ("Obras de Plástico ou Borracha", "39269022"),
    ("Obras de Plástico ou Borracha", "39269061"),
    ("Obras de Plástico ou Borracha", "40112010"),
    ("Obras de Plástico ou Borracha", "40112090"),
    ("Obras de Plástico ou Borracha", "40113000"),
    ("Obras de Plástico ou Borracha", "40115000"),
    ("Obras de Plástico ou Borracha", "40114000"),
    ("Obras de Plástico ou Borracha", "40118010"),
    ("Obras de Plástico ou Borracha", "40118020"),
    ("Obras de Plástico ou Borracha", "40118090"),
    ("Obras de Plástico ou Borracha", "40119010"),
    ("Obras de Plástico ou Borracha", "40119090"),
    ("Obras de Plástico ou Borracha", "40117010"),
    ("Obras de Plástico ou Borracha", "40117090"),
)

# Keywords of group B and their abbreviations.
GROUP_B = (
    ("Polietileno", "PE"),
    ("Policloreto de Vinila", "PVC"),
    ("Poliestireno", "PS"),
    ("Polibutadieno", "BR"),
    ("Estireno-Butadieno", "SBR"),
    ("Pneus", None),
    ("Embalagem Plástica", None),
    ("TUBO PVC", None),
    ("Embalagem PET", None),
    ("Poliéster", None),
    ("Plástica", None),
    ("Plástico", None),
)

# Steel groups and their codes of four, six or eight digits.
STEEL_GROUPS = (
    ("7216", "Barras e perfis"),
    ("7228", "Barras e perfis"),
    ("7214", "Barras e perfis"),
    ("7222", "Barras e perfis"),
    ("7215", "Barras e perfis"),
    ("7217", "Fio-máquina e fios"),
    ("7213", "Fio-máquina e fios"),
    ("7227", "Fio-máquina e fios"),
    ("7229", "Fio-máquina e fios"),
    ("72230000", "Fio-máquina e fios"),
    ("72210000", "Fio-máquina e fios"),
    ("7218", "Formas primárias"),
    ("7206", "Formas primárias"),
    ("7224", "Formas primárias"),
    ("7208", "Laminados planos"),
    ("7210", "Laminados planos"),
    ("7219", "Laminados planos"),
    ("7225", "Laminados planos"),
    ("7212", "Laminados planos"),
    ("7209", "Laminados planos"),
    ("7211", "Laminados planos"),
    ("7220", "Laminados planos"),
    ("7226", "Laminados planos"),
    ("7207", "Semimanufaturados"),
    ("7304", "Tubos, perfis ocos e acessórios"),
    ("7307", "Tubos, perfis ocos e acessórios"),
    ("7306", "Tubos, perfis ocos e acessórios"),
    ("7305", "Tubos, perfis ocos e acessórios"),
    ("830710", "Tubos, perfis ocos e acessórios"),
    ("94062000", "Construções pré-fabricadas (estrutura em ferro/aço)"),
    ("94069020", "Construções pré-fabricadas (estrutura em ferro/aço)"),
)


def group_a(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(GROUP_A, schemas.GROUP_A_SCHEMA)


def steel_groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STEEL_GROUPS, schemas.PREFIX_GROUP_SCHEMA)


def keywords() -> tuple[list[str], list[str]]:
    """Group B keywords, and their normalised forms to look for in normalised descriptions."""
    words = [word for word, _ in GROUP_B]
    return words, [normalized_keyword(word) for word in words]


def normalized_keyword(word: str) -> str:
    """Trimmed, lower case, hyphens to spaces: ``functions.text.normalize_keyword`` for a Python string."""
    return re.sub(r"[\t\n\f\r ]+", " ", word.strip(" ").lower().replace("-", " "), count=1)


def read_group_a(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header tipo,ncm. Codes stay text; types are trimmed, repeated rows dropped."""
    rows = spark.read.schema(schemas.GROUP_A_SCHEMA).option("header", True).csv(path)
    return tidy_group_a(rows)


def tidy_group_a(rows: DataFrame) -> DataFrame:
    """Trimmed types and codes, each pair once."""
    return rows.select(F.trim("tipo").alias("tipo"), F.trim("ncm").alias("ncm")).distinct()


def read_group_b(spark: SparkSession, path: str) -> list[str]:
    """Keywords of a CSV with header Palavras Chaves,Abreviação: a short list that people edit."""
    rows = spark.read.schema(schemas.GROUP_B_SCHEMA).option("header", True).csv(path)
    return [row[0] for row in rows.select(F.trim("palavra_chave")).collect() if row[0]]


def read_prefix_groups(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header ncm_cod,grupo and codes of four, six or eight digits; other codes are an error."""
    rows = spark.read.schema(schemas.PREFIX_GROUP_SCHEMA).option("header", True).csv(path)
    _refuse(rows, ~F.coalesce(F.col("ncm_cod").rlike("^([0-9]{4}|[0-9]{6}|[0-9]{8})$"), F.lit(False)), "ncm_cod", path)
    _refuse_repeated(rows, "ncm_cod", path)
    return rows


def read_chain_map(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table of production chains with their code prefixes; a prefix of another length than stated is an error."""
    rows = spark.read.schema(schemas.CHAIN_MAP_SCHEMA).parquet(path)
    fits = F.col("tamanho_prefixo").between(1, 8) & (F.length("prefixo_sh") == F.col("tamanho_prefixo"))
    _refuse(rows, ~F.coalesce(fits, F.lit(False)), "prefixo_sh", path)
    return rows


def read_presence(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table of companies with a presence abroad, by company root; a repeated root is an error."""
    rows = spark.read.schema(schemas.PRESENCE_SCHEMA).parquet(path)
    _refuse_repeated(rows, "cnpj_basico", path)
    return rows


def read_signs(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header cfop,sinal: +1 or -1 of each operation code; a repeated code is an error."""
    rows = spark.read.schema("cfop bigint, sinal int").option("header", True).csv(path)
    _refuse(rows, ~F.coalesce(F.col("sinal").isin(1, -1), F.lit(False)), "cfop", path)
    _refuse_repeated(rows, "cfop", path)
    return rows


def _refuse(rows: DataFrame, wrong: Column, column: str, path: str) -> None:
    """Raise an error that shows some of the wrong rows, if there are any."""
    shown = [str(row[0]) for row in rows.filter(wrong).select(column).limit(5).collect()]
    if shown:
        raise ValueError(f"{path}: {column} is wrong, for instance {', '.join(shown)}")


def _refuse_repeated(rows: DataFrame, column: str, path: str) -> None:
    repeated = rows.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")
    _refuse(repeated, F.lit(True), column, path)
