"""One-off questions about invoices and items, as functions with parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from invoice_lake.functions.codes import operation_digit, taxpayer_root
from invoice_lake.functions.periods import in_years
from invoice_lake.functions.text import contains_any, first_category, label_override, matches_any
from invoice_lake.operators.marts import year
from invoice_lake.operators.matching import join_supplier_presence
from invoice_lake.operators.ranking import ratio

# Words and labels of the published reports.
FOREIGN_WORDS = ("import", "exterior", "internacional")
FOREIGN_DESTINATION = "3 - OPERAÇÃO COM EXTERIOR"
FOREIGN_SUPPLIER_PREFIX = "EX"
PRODUCT_WORDS = (
    "vacina", "eculizumabe", "dolutegravir", "insulina", "elexacaftor", "adalimumabe",
    "imunoglobulina", "lamivudina", "pertuzumabe", "burosumabe",
)
OTHER_PRODUCTS = "Todos os demais produtos"
PLASTIC_WORDS = ("plastico", "plástico", "polimero", "polímero")
YEAR_LABELS = {2025: "2025 (até 30/09)"}


def _in_year(df: DataFrame, only_year: int | None) -> DataFrame:
    return df if only_year is None else df.filter(in_years(F.col("data_emissao"), [only_year]))


def value_by_year(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(year().alias("ano")).agg(F.sum("valor_nota_fiscal").alias("valor"))


def value_by_state(invoices: DataFrame, state: str, only_year: int | None = None) -> DataFrame:
    """Invoice value per state; ``state`` is uf_emitente or uf_destinatario."""
    return (
        _in_year(invoices, only_year).groupBy(state)
        .agg(F.sum("valor_nota_fiscal").alias("valor"))
        .orderBy(F.asc_nulls_last("valor"), state)
    )


def invoice_counts(invoices: DataFrame, years: Sequence[int]) -> DataFrame:
    """Rows and distinct invoices of the given years."""
    return invoices.filter(in_years(F.col("data_emissao"), years)).agg(
        F.count("*").alias("qtd_notas"), F.count_distinct("chave_de_acesso").alias("qtd_notas_distintas")
    )


def nature_share(invoices: DataFrame, words: Sequence[str] = FOREIGN_WORDS, only_year: int | None = None) -> DataFrame:
    """Invoices whose nature mentions one of ``words``: value, and its share of all invoices' value."""
    total = invoices.agg(F.sum("valor_nota_fiscal").alias("total")).scalar()
    return (
        _in_year(invoices, only_year)
        .filter(contains_any(F.col("natureza_da_operacao"), words))
        .groupBy(year().alias("ano"), "natureza_da_operacao")
        .agg(F.sum("valor_nota_fiscal").alias("valor"), F.count("*").alias("qtd_notas"))
        .withColumn("total", total)
        .withColumn("valor_pct", ratio("valor", "total"))
        .orderBy("ano", F.desc("qtd_notas"), F.desc("valor"), "natureza_da_operacao")
    )


def _with_sign(items: DataFrame, signs: DataFrame) -> DataFrame:
    """Items with ``sinal`` of their operation code; a code without a sign gives NULL."""
    return items.join(signs.select("cfop", "sinal"), "cfop", "left")


def signed_totals(items: DataFrame, signs: DataFrame, only_year: int | None = None) -> DataFrame:
    """Value and item count, plain and with the sign (+1/-1) of the operation code.

    Items are summed per code before they meet the signs.
    """
    per_code = _in_year(items, only_year).groupBy("cfop").agg(
        F.sum("valor_total").alias("_valor"), F.count("*").alias("_itens")
    )
    return _with_sign(per_code, signs).agg(
        F.sum("_valor").alias("valor_total"),
        F.sum(F.col("_valor") * F.col("sinal")).alias("valor_total_com_descontos"),
        F.sum(F.col("_itens") * F.col("sinal")).alias("qtd_itens_comprados"),
        F.sum("_itens").alias("qtd_itens"),
    )


def signed_by_product_type(items: DataFrame, signs: DataFrame, only_year: int | None = None) -> DataFrame:
    """Items, signed quantity and signed value per product type text."""
    per_code = (
        _in_year(items, only_year).groupBy(F.col("ncm_sh_tipo_de_produto").alias("ncm"), "cfop")
        .agg(
            F.count("*").alias("_itens"), F.sum("quantidade").alias("_qtd"), F.sum("valor_total").alias("_valor")
        )
    )
    return (
        _with_sign(per_code, signs).groupBy("ncm")
        .agg(
            F.sum("_itens").alias("qtd_itens"),
            F.sum(F.col("_qtd") * F.col("sinal")).alias("qtd_com_sinal"),
            F.sum(F.col("_valor") * F.col("sinal")).alias("total_com_sinal"),
        )
        .orderBy(F.desc_nulls_last("qtd_com_sinal"), "ncm")
    )


def operation_digit_counts(items: DataFrame) -> DataFrame:
    """Items per year and first digit of the operation code."""
    return (
        items.groupBy(year().alias("ano"), operation_digit(F.col("cfop")).alias("cfop_primeiro_digito"))
        .agg(F.count("*").alias("qtd_itens"))
        .orderBy("ano", F.asc_nulls_last("cfop_primeiro_digito"))
    )


def foreign_operations(
    items: DataFrame, digits: Sequence[int] = (3, 7), destination: str | None = None
) -> DataFrame:
    """Import and export operations by year, code, destination and product, with an example key."""
    chosen = items.filter(operation_digit(F.col("cfop")).isin(*digits))
    if destination is not None:
        chosen = chosen.filter(F.col("destino_da_operacao") == destination)
    keys = ["ano", "cfop", "destino_da_operacao", "codigo_ncm_sh"]
    return (
        chosen.withColumn("ano", year()).groupBy(*keys)
        .agg(
            F.count("*").alias("qtd_itens"),
            F.sum("valor_total").alias("valor_total"),
            F.min("chave_de_acesso").alias("chave_acesso_exemplo"),
        )
        .orderBy(*[F.asc_nulls_last(c) for c in keys])
    )


def product_categories(
    items: DataFrame, words: Sequence[str] = PRODUCT_WORDS, default: str = OTHER_PRODUCTS
) -> DataFrame:
    """Items by the first product word in their description, with example key and description.

    Descriptions are tested once each: items are summed per year and description first.
    """
    text = "descricao_do_produto_servico"
    per_text = items.groupBy(year().alias("ano"), text).agg(
        F.count("*").alias("_itens"),
        F.sum("valor_total").alias("_valor"),
        F.min("chave_de_acesso").alias("_chave"),
    )
    return (
        per_text.groupBy("ano", first_category(F.col(text), words, default).alias("produto_identificado"))
        .agg(
            F.sum("_itens").alias("qtd_itens"),
            F.sum("_valor").alias("valor_total"),
            F.min("_chave").alias("chave_exemplo"),
            F.min(text).alias("produto_exemplo"),
        )
        .orderBy("ano", F.desc_nulls_last("valor_total"), "produto_identificado")
    )


def supplier_presence(invoices: DataFrame, presence: DataFrame) -> DataFrame:
    """Invoices by the issuer company's presence abroad.

    Invoices are summed per year and company root before the join, so a supplier with very many
    invoices is one row in it.
    """
    root = taxpayer_root(F.col("cpf_cnpj_emitente")).alias("cpf_cnpj_emitente")
    per_root = invoices.groupBy(year().alias("ano_emissao"), root).agg(
        F.count("*").alias("_notas"),
        F.sum("valor_nota_fiscal").alias("_valor"),
        F.min("cpf_cnpj_emitente").alias("_cnpj"),
        F.min("chave_de_acesso").alias("_chave"),
    )
    keys = ["ano_emissao", "cnpj_disponivel", "tipo_matriz", "presenca_internacional", "presenca_nacional"]
    return (
        join_supplier_presence(per_root, presence).groupBy(*keys)
        .agg(
            F.sum("_notas").alias("qtd_notas"),
            F.sum("_valor").alias("total_pago"),
            F.min("_cnpj").alias("cnpj_exemplo"),
            F.min("_chave").alias("chave_acesso_exemplo"),
        )
        .orderBy(*[F.asc_nulls_last(c) for c in keys])
    )


def suppliers_with_prefix(invoices: DataFrame, prefix: str = FOREIGN_SUPPLIER_PREFIX) -> DataFrame:
    """Suppliers whose id starts with ``prefix``, with their number of invoices."""
    chosen = invoices.filter(F.col("cpf_cnpj_emitente").startswith(prefix))
    return chosen.groupBy("cpf_cnpj_emitente").agg(F.count("*").alias("qtd_notas"))


def invoices_of_root(invoices: DataFrame, root: str) -> DataFrame:
    """All invoices of one company. A prefix test reaches the Parquet scan; LEFT(..) = .. does not."""
    return invoices.filter(F.col("cpf_cnpj_emitente").startswith(root))


def supplier_profile(
    invoices: DataFrame,
    root: str,
    keys: Sequence[str] = ("razao_social_emitente", "uf_emitente", "uf_destinatario"),
) -> DataFrame:
    """One company's invoices by year and ``keys``."""
    return (
        invoices_of_root(invoices, root).groupBy(year().alias("ano"), *keys)
        .agg(F.count("*").alias("qtd_notas"), *_profile_values())
        .orderBy("ano", F.desc_nulls_last("valor_total"), *keys)
    )


def supplier_totals(invoices: DataFrame, root: str) -> DataFrame:
    return invoices_of_root(invoices, root).agg(*_profile_values())


def _profile_values() -> list[Column]:
    return [
        F.count_distinct("chave_de_acesso").alias("qtd_notas_distintas"),
        F.sum("valor_nota_fiscal").alias("valor_total"),
        F.min("chave_de_acesso").alias("chave_acesso_exemplo"),
    ]


def by_key(df: DataFrame, key: str) -> DataFrame:
    """All rows of one invoice."""
    return df.filter(F.col("chave_de_acesso") == key)


def keyword_rows(
    ranked: DataFrame, words: Sequence[str] = PLASTIC_WORDS, labels: dict[int, str] | None = None
) -> DataFrame:
    """Rows of ``ranked_by_code`` whose code text or description has one of ``words``."""
    ranked = ranked.drop("pct_total_das_descricoes_exibidas")
    in_code = matches_any(F.col("ncm_descr"), words)
    in_text = matches_any(F.col("descricao"), words)
    rest = [c for c in ranked.columns if c != "ano"]
    return ranked.filter(in_code | in_text).select(
        in_code.alias("ncm_contem_palavras_chave"),
        in_text.alias("produto_contem_palavras_chave"),
        label_override(F.col("ano"), YEAR_LABELS if labels is None else labels).alias("ano"),
        *rest,
    )


def code_descriptions(items: DataFrame, code: str, only_year: int) -> DataFrame:
    """Distinct product type texts of one code in one year."""
    chosen = _in_year(items, only_year).filter(F.col("codigo_ncm_sh") == code)
    return chosen.select(F.col("ncm_sh_tipo_de_produto").alias("ncm_descr")).distinct()


def state_ranks(items: DataFrame) -> DataFrame:
    """Destination states ranked by value within each year, in millions.

    The window runs over the aggregate: at most one row per state and year.
    """
    totals = items.groupBy(year().alias("ano"), F.col("uf_destinatario").alias("uf_destino")).agg(
        F.sum("valor_total").alias("_total")
    )
    order = Window.partitionBy("ano").orderBy(F.desc_nulls_last("_total"), F.asc_nulls_last("uf_destino"))
    return (
        totals.withColumn("ranking_no_ano", F.row_number().over(order).cast("bigint"))
        .select(
            "ano", "uf_destino",
            (F.col("_total").cast("double") / 1e6).alias("valor_total_milhoes"), "ranking_no_ano",
        )
        .orderBy("ano", "ranking_no_ano")
    )
