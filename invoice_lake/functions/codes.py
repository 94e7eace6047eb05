"""Product codes, fiscal operation codes and taxpayer identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_product_code(code: Column) -> Column:
    """Eight digits, left-padded with zeros; '-1' marks a missing code."""
    return F.when(code == "-1", F.lit("00000000")).otherwise(F.lpad(code, 8, "0"))


def operation_digit(cfop: Column) -> Column:
    """First digit of the four-digit operation code; 3 and 7 are imports and exports."""
    return F.floor(cfop / 1000).cast("bigint")


def supplier_id(cnpj: Column | str = "cnpj_emitente", cpf: Column | str = "cpf_emitente") -> Column:
    """Company id as text, else the masked personal id.

    Two people behind the same mask count as one supplier.
    """
    cnpj = F.col(cnpj) if isinstance(cnpj, str) else cnpj
    cpf = F.col(cpf) if isinstance(cpf, str) else cpf
    return F.coalesce(cnpj.cast("string"), cpf)


def taxpayer_root(tax_id: Column) -> Column:
    """First eight characters: the company, without branch and check digits."""
    return F.substring(tax_id, 1, 8)
