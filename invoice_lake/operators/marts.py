"""Aggregates behind the published tables: types, production chains, keywords, code groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from invoice_lake.functions.codes import supplier_id
from invoice_lake.functions.periods import in_years
from invoice_lake.functions.text import normalize_text, word_flags
from invoice_lake.operators.matching import (
    LINK, ChainLinks, code_map, first_per, join_any_prefix, join_codes, join_keywords,
)
from invoice_lake.operators.ranking import rank_in_groups
from invoice_lake.schemas import ITEM_KEY

# Flag column -> pattern tested on the normalised description.
KEYWORD_PATTERNS = {
    "polietileno_encontrado": "polietileno",
    "policloreto de vinila_encontrado": "policloreto de vinila",
    "poliestireno_encontrado": "poliestireno",
    "polibutadieno_encontrado": "polibutadieno",
    "estireno_butadieno_encontrado": "estireno butadieno",
    "pneus_encontrado": "pneus?",
    "embalagem_plastica_encontrada": "embalagem plástica",
    "tubo_pvc_encontrado": "tubo pvc",
    "embalagem_pet_encontrada": "embalagem pet",
    "poliester_encontrado": "poliéster",
    "plastica_encontrada": "plástica",
    "plastico_encontrada": "plástico",
    "pe_encontrado": "pe",
    "pvc_encontrado": "pvc",
    "ps_encontrado": "ps",
    "br_encontrado": "br",
    "sbr_encontrado": "sbr",
}
ABBREVIATION_PATTERNS = {
    name: KEYWORD_PATTERNS[name]
    for name in ("pe_encontrado", "pvc_encontrado", "ps_encontrado", "br_encontrado", "sbr_encontrado")
}
UNMAPPED = "Não Mapeado"
OTHER_PRODUCTS = "TODOS OS DEMAIS PRODUTOS"

CHAIN_KEY = ("codigo_cadeia", "cadeia", "missao", "nome_missao")
DETAIL_CHAIN = (*CHAIN_KEY, "cnae", "desc_cnae", "criterio", "icp")
DETAIL_ITEM = ("codigo_ncm_sh", "ncm_sh_tipo_de_produto", "descricao_do_produto_servico")
DETAIL_KEY = (*DETAIL_CHAIN, *DETAIL_ITEM)
CNAE_KEY = (
    "missao", "nome_missao", "codigo_cadeia", "cadeia", "cnae", "desc_cnae", "criterio", "missoes",
    "icp", "secao_cnae", "sh_correspondente",
)


def year() -> Column:
    return F.year("data_emissao").cast("bigint")


def _year_values(years: Sequence[int]) -> list[Column]:
    """Value per year as columns valor_YYYY; a year without rows is 0, as in SUM(CASE .. ELSE 0)."""
    of_year = F.year("data_emissao")
    return [
        F.sum(F.when(of_year == y, F.col("valor_total")).otherwise(0)).alias(f"valor_{y}") for y in years
    ]


# --- product types (exact codes) ---------------------------------------------------------------


def _per_invoice(items: DataFrame, *keys: str) -> DataFrame:
    """Value per keys, year, invoice and supplier: distinct counts then expand invoices, not items."""
    return items.groupBy(*keys, year().alias("ano"), "chave_de_acesso", supplier_id().alias("_fornecedor")).agg(
        F.sum("valor_total").alias("_valor")
    )


def _money(items: DataFrame) -> str:
    """Type of a sum of values, however many steps it is summed in."""
    value = items.schema["valor_total"].dataType
    return f"decimal({min(value.precision + 10, 38)},{value.scale})" if isinstance(value, T.DecimalType) else "double"


def _distinct_totals(items: DataFrame) -> list[Column]:
    return [
        F.sum("_valor").cast(_money(items)).alias("valor_total"),
        F.count_distinct("_fornecedor").alias("fornecedores_distintos"),
        F.count_distinct("chave_de_acesso").alias("notas_distintas"),
    ]


def type_year_totals(items: DataFrame, mapping: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Value, distinct suppliers and distinct invoices per product type and year."""
    if years is not None:
        items = items.filter(in_years(F.col("data_emissao"), years))
    return (
        _per_invoice(join_codes(items, mapping), "tipo")
        .groupBy("tipo", "ano")
        .agg(*_distinct_totals(items))
    )


def type_year_pivot(totals: DataFrame, years: Sequence[int]) -> DataFrame:
    """``type_year_totals`` with years as columns; a type without rows in a year is NULL there."""
    pivoted = (
        totals.groupBy("tipo").pivot("ano", list(years))
        .agg(
            F.sum("valor_total").cast("double").alias("valor"),
            F.sum("fornecedores_distintos").cast("bigint").alias("fornecedores"),
            F.sum("notas_distintas").cast("bigint").alias("notas"),
        )
    )
    labels = (("Valor Total", "valor"), ("Fornecedores", "fornecedores"))
    wide = pivoted.select(
        "tipo",
        *[F.col(f"{y}_{name}").alias(f"{label} {y}") for y in years for label, name in labels],
        *[F.col(f"{y}_notas").alias(f"Notas Distintas {y}") for y in years],
    )
    return wide.orderBy(sum_of_years(years).desc(), F.asc("tipo"))


def sum_of_years(years: Sequence[int], prefix: str = "Valor Total ") -> Column:
    total = F.lit(0.0)
    for y in years:
        total = total + F.coalesce(F.col(f"`{prefix}{y}`"), F.lit(0))
    return total


def type_totals_by_year(items: DataFrame, mapping: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Totals per year over all types; suppliers and invoices are distinct across types."""
    if years is not None:
        items = items.filter(in_years(F.col("data_emissao"), years))
    # Semi join: an item counts once, whatever number of types its code has.
    codes = code_map(mapping).select(F.col("ncm").alias("codigo_ncm_sh")).distinct()
    return (
        _per_invoice(items.join(codes, "codigo_ncm_sh", "left_semi"))
        .groupBy("ano")
        .agg(*_distinct_totals(items))
    )


def items_by_code(items: DataFrame, mapping: DataFrame, only_year: int | None = None) -> DataFrame:
    """Value per year, code, type and description; unmapped codes stay, flagged."""
    if only_year is not None:
        items = items.filter(in_years(F.col("data_emissao"), [only_year]))
    totals = items.groupBy(
        year().alias("ano"), "codigo_ncm_sh", F.col("descricao_do_produto_servico").alias("descricao")
    ).agg(F.sum("valor_total").alias("total"))
    return typed_codes(totals, mapping)


def typed_codes(totals: DataFrame, mapping: DataFrame) -> DataFrame:
    """Sums per year, code and description (ano, codigo_ncm_sh, descricao, total) with the code's type."""
    return join_codes(totals, mapping, "left").select(
        "ano",
        F.col("codigo_ncm_sh").alias("ncm"),
        F.col("tipo").alias("tipo_ncm"),
        F.col("tipo").isNotNull().alias("ncm_mapeada"),
        "descricao",
        "total",
    )


# --- production chains -------------------------------------------------------------------------


def _chain_rows(chain_items: DataFrame | ChainLinks, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows to add up, and the columns that stand for ``keys`` in them."""
    if isinstance(chain_items, ChainLinks):
        return chain_items.items, [LINK]
    return chain_items, list(keys)


def _named(chain_items: DataFrame | ChainLinks, sums: DataFrame) -> DataFrame:
    return chain_items.named(sums) if isinstance(chain_items, ChainLinks) else sums


def _values_of_years(years: Sequence[int]) -> list[Column]:
    """``_year_values`` from sums per year (ano, _valor)."""
    return [F.sum(F.when(F.col("ano") == y, F.col("_valor")).otherwise(0)).alias(f"valor_{y}") for y in years]


def chain_summary(chain_items: DataFrame | ChainLinks, years: Sequence[int], focus_year: int) -> DataFrame:
    """One row per chain: value, suppliers, items, the same for ``focus_year``, value per year.

    The items are added up per chain, supplier and year first, so that distinct suppliers are plain counts and
    the rows that meet per supplier are narrow.
    """
    rows, keys = _chain_rows(chain_items, CHAIN_KEY)
    money = _money(rows)
    focused = F.col("ano") == focus_year
    names = [f"valor_{y}" for y in years]
    per_year = rows.groupBy(*keys, supplier_id().alias("_fornecedor"), F.year("data_emissao").alias("ano")).agg(
        F.sum("valor_total").alias("_valor"), F.count("*").alias("_itens"))
    per_supplier = per_year.groupBy(*keys, "_fornecedor").agg(
        F.sum("_valor").alias("_valor"),
        F.sum("_itens").alias("_itens"),
        F.sum(F.when(focused, F.col("_itens")).otherwise(0)).alias("_itens_foco"),
        *_values_of_years(years),
    )
    sums = per_supplier.groupBy(*keys).agg(
        F.sum("_valor").cast(money).alias("valor_total_adquirido"),
        F.count("_fornecedor").alias("fornecedores_distintos"),
        F.sum("_itens").alias("quantidade_itens"),
        F.count(F.when(F.col("_itens_foco") > 0, F.col("_fornecedor"))).alias(f"fornecedores_{focus_year}"),
        F.sum("_itens_foco").alias(f"quantidade_itens_{focus_year}"),
        *[F.sum(name).cast(money).alias(name) for name in names],
    )
    return (
        _named(chain_items, sums)
        .select(*CHAIN_KEY, *[c for c in sums.columns if c not in keys])
        .orderBy(F.desc_nulls_last("valor_total_adquirido"), "codigo_cadeia")
    )


def chain_detail(chain_items: DataFrame | ChainLinks, years: Sequence[int], limit: int | None = 2000) -> DataFrame:
    """The ``limit`` largest groups of chain, CNAE, code and description, largest first; all of them, unordered, for None.

    One shuffle brings the rows of a group together; suppliers and groups are added up behind it.
    """
    rows, chain = _chain_rows(chain_items, DETAIL_CHAIN)
    keys = [*chain, *DETAIL_ITEM]
    narrow = rows.select(
        *keys, supplier_id().alias("_fornecedor"), F.year("data_emissao").alias("ano"), F.col("valor_total").alias("_valor"), "quantidade")
    per_supplier = narrow.repartition(*keys).groupBy(*keys, "_fornecedor").agg(
        F.sum("_valor").alias("valor_total"), F.sum("quantidade").alias("quantidade_total"), F.count("*").alias("registros"),
        *_values_of_years(years))
    money = _money(rows)
    groups = per_supplier.groupBy(*keys).agg(
        F.sum("valor_total").cast(money).alias("valor_total"),
        F.count("_fornecedor").alias("fornecedores_distintos"),
        F.sum("quantidade_total").alias("quantidade_total"),
        F.sum("registros").alias("registros"),
        *[F.sum(f"valor_{y}").cast(money).alias(f"valor_{y}") for y in years],
    )
    whole = _named(chain_items, groups).select(*DETAIL_KEY, *[c for c in groups.columns if c not in keys])
    if limit is None:
        return whole
    return whole.orderBy(F.desc_nulls_last("valor_total"), *[F.asc_nulls_last(c) for c in DETAIL_KEY]).limit(limit)


def largest_per_chain(groups: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` largest groups of every chain; each task hands on no more than that of any chain."""
    order = [F.desc_nulls_last("valor_total"), *[F.asc_nulls_last(c) for c in DETAIL_KEY]]
    place = F.row_number().over(Window.partitionBy("codigo_cadeia").orderBy(*order))
    return groups.withColumn("_place", place).filter(F.col("_place") <= limit).drop("_place")


def chain_by_cnae(chain_items: DataFrame | ChainLinks, years: Sequence[int]) -> DataFrame:
    """One row per chain and CNAE. Build the input with dedup=("codigo_cadeia", "cnae").

    Suppliers, and items within invoices, are made distinct by sums of their own, which combine before the shuffle.
    """
    rows, keys = _chain_rows(chain_items, CNAE_KEY)
    money = _money(rows)
    names = [f"valor_{y}" for y in years]
    of = rows.select(*keys, supplier_id().alias("_fornecedor"), F.year("data_emissao").alias("ano"), F.col("valor_total").alias("_valor"))
    per_supplier = of.groupBy(*keys, "_fornecedor").agg(F.sum("_valor").alias("_valor"), *_values_of_years(years))
    totals = per_supplier.groupBy(*keys).agg(
        F.sum("_valor").cast(money).alias("valor_total"), F.count("_fornecedor").alias("fornecedores"),
        *[F.sum(name).cast(money).alias(name) for name in names])
    known = reduce(and_, [F.col(c).isNotNull() for c in ITEM_KEY])
    if not isinstance(chain_items, ChainLinks):  # linked items stand once per chain
        rows = rows.groupBy(*keys, *ITEM_KEY).agg(F.lit(1).alias("_um"))
    per_invoice = rows.groupBy(*keys, "chave_de_acesso").agg(F.count(F.when(known, F.lit(1))).alias("_itens"))
    counts = per_invoice.groupBy(*keys).agg(F.count("chave_de_acesso").alias("notas"), F.sum("_itens").alias("itens"))
    renamed = counts.withColumnsRenamed({c: f"_de_{c}" for c in keys})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_de_{c}")) for c in keys])
    whole = _named(chain_items, totals.join(renamed, same))
    return whole.select(*CNAE_KEY, "valor_total", "fornecedores", "notas", "itens", *names)


def chain_global_totals(chain_items: DataFrame | ChainLinks, focus_year: int) -> DataFrame:
    """Value, suppliers and items with every item counted once across chains."""
    if isinstance(chain_items, ChainLinks):
        once = chain_items.once
    else:
        rest = sorted(set(chain_items.columns) - set(ITEM_KEY))
        once = first_per(chain_items, ITEM_KEY, [F.asc_nulls_last(c) for c in rest])
    focused, money = F.year("data_emissao") == focus_year, _money(once)
    per_supplier = once.groupBy(supplier_id().alias("_fornecedor")).agg(
        F.sum("valor_total").alias("_valor"), F.count("*").alias("_itens"),
        F.sum(F.when(focused, F.col("valor_total"))).alias("_valor_foco"), F.count(F.when(focused, F.lit(1))).alias("_itens_foco"))
    none = F.lit(0).cast("long")
    return per_supplier.agg(
        F.sum("_valor").cast(money).alias("valor_total_global"),
        F.count("_fornecedor").alias("fornecedores_global"),
        F.coalesce(F.sum("_itens"), none).alias("itens_global"),
        F.sum("_valor_foco").cast(money).alias(f"valor_total_{focus_year}"),
        F.count(F.when(F.col("_itens_foco") > 0, F.col("_fornecedor"))).alias(f"fornecedores_{focus_year}"),
        F.coalesce(F.sum("_itens_foco"), none).alias(f"itens_{focus_year}"),
    )


# --- keywords ----------------------------------------------------------------------------------


def keyword_mart(
    items: DataFrame, mapping: DataFrame, patterns: dict[str, str] = KEYWORD_PATTERNS
) -> DataFrame:
    """Value per year, code and description, with the product type and a flag per keyword.

    The patterns run once per distinct description and code, after the aggregation.
    """
    return flagged(items_by_code(items, mapping), patterns)


def flagged(totals: DataFrame, patterns: dict[str, str] = KEYWORD_PATTERNS) -> DataFrame:
    """The sums of ``items_by_code`` with a flag per keyword found in the description."""
    totals = totals.withColumn("_texto", normalize_text(F.col("descricao")))
    flags = word_flags(F.col("_texto"), patterns)
    return totals.select("ano", "ncm", "tipo_ncm", "ncm_mapeada", *flags, "descricao", "total")


def keyword_type_pivot(mart: DataFrame, years: Sequence[int], flag: str | None = None) -> DataFrame:
    """Value per product type with years as columns, for all descriptions or those with a flag."""
    if flag is not None:
        mart = mart.filter(F.col(f"`{flag}`"))
    pivoted = (
        mart.groupBy(F.coalesce("tipo_ncm", F.lit(UNMAPPED)).alias("grupo"))
        .pivot("ano", list(years))
        .agg(F.sum("total").cast("double"))
    )
    wide = pivoted.select("grupo", *[F.col(str(y)).alias(f"Valor Total {y}") for y in years])
    return wide.orderBy(sum_of_years(years).desc_nulls_last(), "grupo")


def keyword_hits(
    items: DataFrame,
    keywords: Sequence[str],
    needles: Sequence[str] | None = None,
    patterns: dict[str, str] = ABBREVIATION_PATTERNS,
) -> DataFrame:
    """Value per year, keyword found in the description, abbreviation flags and description.

    Descriptions without a keyword stay, with keyword NULL and ``chave_encontrada`` NULL. The text
    work runs once per distinct description and year.
    """
    totals = items.groupBy(
        year().alias("ano"), F.col("descricao_do_produto_servico").alias("descricao")
    ).agg(F.sum("valor_total").alias("total"))
    texts = totals.withColumns(
        {"_minusculas": F.lower("descricao"), "_texto": normalize_text(F.col("descricao"))}
    )
    flags = word_flags(F.col("_minusculas"), patterns)
    flagged = texts.select("ano", *flags, "_texto", "descricao", "total")
    hits = join_keywords(flagged, F.col("_texto"), keywords, needles, "tipo_de_produto")
    found = F.when(F.col("tipo_de_produto").isNotNull(), F.lit(True))
    return hits.withColumn("chave_encontrada", found).drop("_texto")


# --- ranks within a group ----------------------------------------------------------------------


def ranked_by_code(items: DataFrame, **options) -> DataFrame:
    """Descriptions ranked within year and product code, with shares of the code's value."""
    totals = items.groupBy(
        year().alias("ano"),
        F.col("codigo_ncm_sh").alias("ncm_cod"),
        F.col("ncm_sh_tipo_de_produto").alias("ncm_descr"),
        F.col("descricao_do_produto_servico").alias("descricao"),
    ).agg(F.sum("valor_total").alias("total"))
    return rank_in_groups(
        totals, ["ano", "ncm_cod"], "total", ["ncm_descr", "descricao"],
        rank="ranking_no_ncm", total="total_do_ncm", share="pct_no_ncm",
        share_total="pct_total_das_descricoes_exibidas", **options,
    )


def ranked_by_type(items: DataFrame, mapping: DataFrame, **options) -> DataFrame:
    """Codes and descriptions ranked within year and product type."""
    totals = items.groupBy(
        year().alias("ano"),
        "codigo_ncm_sh",
        F.col("ncm_sh_tipo_de_produto").alias("ncm_descr"),
        F.col("descricao_do_produto_servico").alias("descricao"),
    ).agg(F.sum("valor_total").alias("total"))
    typed = join_codes(totals, mapping).select(
        "ano", F.col("tipo").alias("tipo_de_produto"), F.col("codigo_ncm_sh").alias("ncm_cod"),
        "ncm_descr", "descricao", "total",
    )
    return rank_in_groups(
        typed, ["ano", "tipo_de_produto"], "total", ["ncm_cod", "ncm_descr", "descricao"],
        rank="ranking_no_tipo_de_produto", total="total_do_tipo_de_produto",
        share="pct_no_tipo_de_produto", **options,
    )


def ranked_keyword_hits(hits: DataFrame, **options) -> DataFrame:
    """``keyword_hits`` ranked within year and keyword."""
    return rank_in_groups(
        hits, ["ano", "tipo_de_produto"], "total", ["descricao"],
        rank="ranking_no_tipo_de_produto", total="total_do_tipo_de_produto", share="pct_no_grupo", **options,
    )


# --- code groups by prefix ---------------------------------------------------------------------


def buyers_by_code_group(items: DataFrame, groups: DataFrame) -> DataFrame:
    """Per year, code group and buyer: matched codes, value and rows.

    ``groups`` has (ncm_cod, grupo) with codes of 8, 6 or 4 digits. Items are summed per year, buyer
    and code before they meet the groups.
    """
    totals = items.groupBy(
        year().alias("ano"), "cnpj_destinatario", F.col("nome_destinatario").alias("orgao_comprador"),
        F.col("codigo_ncm_sh").alias("_codigo"),
    ).agg(F.sum("valor_total").alias("_total"), F.count("*").alias("_linhas"))
    joined = join_any_prefix(totals, groups, "_codigo")
    matched = F.when(F.col("ncm_cod").isNotNull(), F.col("_codigo"))
    return joined.groupBy(
        "ano", F.coalesce("grupo", F.lit(OTHER_PRODUCTS)).alias("grupo"), "orgao_comprador"
    ).agg(
        F.array_sort(F.collect_set(matched)).alias("ncms_encontradas"),
        F.sum("_total").alias("total"),
        F.sum("_linhas").alias("qtd_nfs"),
    )
