"""Raw text tables to typed, deduplicated ones."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoice_lake.functions.codes import pad_product_code
from invoice_lake.functions.parsing import parse_br_decimal, parse_br_int, parse_br_timestamp
from invoice_lake.schemas import TABLE_TYPES

# (mixed column, masked personal id, company id)
TAX_ID_COLUMNS = (("CPF/CNPJ Emitente", "CPF Emitente", "CNPJ Emitente"),)

# Fixed value: a key found invalid on the public invoice portal.
INVALID_KEYS = ("12250804034484000140558910000282551122697618",)


def split_tax_id(df: DataFrame, columns: Sequence[tuple[str, str, str]] = TAX_ID_COLUMNS) -> DataFrame:
    """Replace a mixed taxpayer column by two: ids with '*' are masked personal ids."""
    for mixed, personal, company in columns:
        if mixed not in df.columns:
            continue
        masked = F.col(f"`{mixed}`").contains("*")
        parts = []
        for name in df.columns:
            value = F.col(f"`{name}`")
            if name == mixed:
                parts += [F.when(masked, value).alias(personal), F.when(~masked, value).alias(company)]
            else:
                parts.append(value)
        df = df.select(*parts)
    return df


def apply_types(
    df: DataFrame, types: dict[str, str], keep_sign: bool = False, match_case: bool = True
) -> DataFrame:
    """Type the columns that ``types`` names, in one projection.

    Other columns stay as they are; names the frame lacks are ignored. Headers whose letter case
    differs from the dictionary stay text unless ``match_case`` is off.
    """
    if not match_case:
        types = {name.casefold(): kind for name, kind in types.items()}

    def typed(name: str):
        value = F.col(f"`{name}`")
        kind = types.get(name if match_case else name.casefold())
        if kind == "timestamp":
            return parse_br_timestamp(value)
        if kind == "integer":
            return parse_br_int(value)
        if kind == "decimal":
            return parse_br_decimal(value, keep_sign)
        return value

    return df.select(*[typed(name).alias(name) for name in df.columns])


def snake_case(name: str) -> str:
    """'DESCRIÇÃO DO PRODUTO/SERVIÇO' -> 'descricao_do_produto_servico'"""
    ascii_name = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub(r"[^a-z0-9]+", "_", ascii_name.lower()).strip("_")


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(name) for name in df.columns])


def pad_codes(df: DataFrame, column: str = "codigo_ncm_sh") -> DataFrame:
    return df.withColumn(column, pad_product_code(F.col(column)))


def exclude_keys(
    df: DataFrame, excluded: Sequence[str] | DataFrame, key: str = "chave_de_acesso"
) -> DataFrame:
    """Drop the rows with an excluded key. Rows without a key go too, as under SQL's <>."""
    known = df.filter(F.col(key).isNotNull())
    if isinstance(excluded, DataFrame):
        return known.join(excluded.select(key), key, "left_anti")
    return known.filter(~F.col(key).isin(*excluded))


def drop_repeated_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct. The period is a column, so equal rows of two periods both stay.

    Copies collapse in the map-side aggregate, so a row with very many copies does not pile up in
    one reducer.
    """
    return df.dropDuplicates()


def clean_table(
    raw: DataFrame,
    table: str,
    invalid_keys: Sequence[str] | DataFrame = INVALID_KEYS,
    keep_sign: bool = False,
    match_case: bool = True,
) -> DataFrame:
    """All cleaning steps of one fact table, from raw headers to the typed table."""
    df = apply_types(split_tax_id(raw), TABLE_TYPES[table], keep_sign, match_case)
    if table in ("itens", "nf"):
        df = drop_repeated_rows(df)
    df = snake_case_columns(df)
    if table == "itens":
        df = pad_codes(df)
    return exclude_keys(df, invalid_keys)
