"""The three batch jobs: archives to bronze, bronze to silver, silver to gold.

Every job handles all new periods at once and can be run again at any time.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from invoice_lake.operators import marts, states
from invoice_lake.operators.cleaning import TAX_ID_COLUMNS, clean_table
from invoice_lake.operators.matching import chain_items
from invoice_lake.plans import inquiries
from invoice_lake.plans.reports import label_cnae
from invoice_lake.schemas import TABLES
from invoice_lake.sources import delivery, landing, layers, mappings

log = logging.getLogger(__name__)


def load_bronze(
    spark: SparkSession, landing_dir: str, root: str, staging: str, replace: bool = False,
    only: Sequence[str] | None = None,
) -> list[str]:
    """Load the archives of periods bronze lacks; returns those periods.

    ``replace`` loads periods again that are there already, ``only`` restricts the periods looked
    at. Archives without exactly one file per table, and records with a wrong number of fields, are
    noted in bronze/rejeitados, once however often the job runs. The rows written must be as many as
    the records staged. A period counts as loaded when it stands in bronze/carregados.
    """
    landing_dir, root, staging = (layers.qualified(spark, path) for path in (landing_dir, root, staging))
    archives = landing.list_archives(spark, landing_dir)
    if only is not None:
        archives = archives.filter(F.col("periodo").isin(*only))
    if not replace:
        archives = archives.join(layers.loaded_periods(spark, root, "bronze", "carregados"), "periodo", "left_anti")
    members, rejects = landing.split_members(landing.list_members(archives).collect())
    if rejects:
        noted = spark.createDataFrame([(r.periodo, r.archive, r.motivo, None, None) for r in rejects], landing.REJECT_SCHEMA)
        layers.write_periods(noted, root, "bronze", "rejeitados")
        for row in rejects:
            log.error("%s: %s", row.periodo, row.motivo)
    if not members:
        log.info("bronze is up to date")
        return []
    periods = sorted({row.periodo for row in members})
    own = f"{staging.rstrip('/')}/{uuid.uuid4().hex}"
    staged = landing.unpack(spark, members, own)
    layers.write_periods(landing.read_rejects(spark, own), root, "bronze", "rejeitados", periods=periods)
    for table in TABLES:
        rows = layers.write_periods(
            landing.read_staged(spark, staged, own, table), root, "bronze", table, periods=periods
        )
        expected = sum(row.records for row in staged if row.tabela == table)
        if rows != expected:
            layers.clear_periods(spark, root, "bronze", table, periods)
            raise RuntimeError(f"bronze {table}: {expected} records staged, {rows} rows read")
        log.info("bronze %s: %d rows", table, rows)
    done = spark.createDataFrame([(row.periodo, row.archive) for row in members], "periodo string, archive string").distinct()
    layers.write_periods(done, root, "bronze", "carregados")
    layers.delete_folder(spark, own)
    return periods


def load_silver(spark: SparkSession, root: str, replace: Sequence[str] = (), **cleaning) -> dict[str, int]:
    """Clean the bronze periods that silver lacks, and those of ``replace``; returns rows per table.

    A period of ``replace`` without rows in bronze is emptied in silver.
    """
    written = {}
    for table in TABLES:
        in_bronze = {row.periodo for row in layers.loaded_periods(spark, root, "bronze", table).collect()}
        in_silver = {row.periodo for row in layers.loaded_periods(spark, root, "silver", table).collect()}
        layers.clear_periods(spark, root, "silver", table, sorted((set(replace) & in_silver) - in_bronze))
        periods = sorted((in_bronze - in_silver) | (set(replace) & in_bronze))
        if not periods:
            log.info("silver %s is up to date", table)
            continue
        chosen = layers.read_periods(spark, root, "bronze", table, periods)
        # Removing duplicates mixes the periods, so a run over several sorts them out again.
        written[table] = layers.write_periods(
            clean_table(chosen, table, **cleaning), root, "silver", table, rebalance=len(periods) > 1, periods=periods
        )
        log.info("silver %s: %d rows", table, written[table])
    return written


def item_years(items: DataFrame) -> list[int]:
    """Years in which items were issued: one pass over the date column."""
    years = items.select(F.year("data_emissao").alias("ano")).distinct().collect()
    return sorted(row.ano for row in years if row.ano is not None)


def gold_tables(
    items: DataFrame, group_a: DataFrame, years: Sequence[int], keyword_patterns: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Marts by product type and keyword."""
    totals = marts.type_year_totals(items, group_a, years)
    patterns = marts.KEYWORD_PATTERNS if keyword_patterns is None else keyword_patterns
    return {
        "resumo_grupo_a": marts.type_year_pivot(totals, years),
        "totais_grupo_a": marts.type_totals_by_year(items, group_a, years),
        "itens_grupo_a": marts.items_by_code(items, group_a, max(years)),
        "itens_grupo_b_regex": marts.keyword_mart(items, group_a, patterns),
    }


def chain_tables(
    spark: SparkSession, root: str, items: DataFrame, chain_map: DataFrame, years: Sequence[int]
) -> dict[str, DataFrame]:
    """Marts by production chain. The chain items are written first, so the marts scan them, not the join.

    ``detalhe_por_cadeia`` has all groups of every chain, a folder per chain; ``detalhado_cadeia`` is the published cut of all.
    """
    def stored(name: str, dedup: tuple[str, ...]) -> DataFrame:
        layers.write_table(chain_items(items, chain_map, years, dedup), root, "gold", name)
        return layers.read_table(spark, root, "gold", name)

    by_chain = stored("itens_cadeia", ("codigo_cadeia",))
    layers.write_table(marts.chain_detail(by_chain, years, limit=None), root, "gold", "detalhe_por_cadeia", "codigo_cadeia")
    by_cnae = stored("itens_cadeia_cnae", ("codigo_cadeia", "cnae"))
    return {
        "resumo_cadeia": marts.chain_summary(by_chain, years, max(years)),
        "detalhado_cadeia": marts.chain_detail(by_chain, years),
        "totais_globais": marts.chain_global_totals(by_chain, max(years)),
        "cnae_cadeia": label_cnae(marts.chain_by_cnae(by_cnae, years)),
    }


def build_gold(
    spark: SparkSession, root: str, group_a: DataFrame, chain_map: DataFrame | None = None,
    years: Sequence[int] | None = None,
) -> dict[str, int]:
    """Write the marts and their CSV deliverables from silver; returns rows per mart."""
    items = layers.read_table(spark, root, "silver", "itens", schema=layers.silver_schema("itens"))
    if items is None:
        return {}
    years = list(years) if years is not None else item_years(items)
    tables = gold_tables(items, group_a, years)
    if chain_map is not None:
        tables |= chain_tables(spark, root, items, chain_map, years)
    return publish(spark, root, tables)


#: Tables of states, and of the numbers that keys have in them.
STATES = ("estado_tipos_somas", "estado_tipos_conjuntos", "estado_codigos")
VALUES = "valores_a_somar"  # there only during a run; after a failure the next run writes it anew
NUMBERS = {"numeros_fornecedores": states.supplier_keys, "numeros_notas": states.invoice_keys}


def update_states(spark: SparkSession, root: str, group_a: DataFrame, replace: Sequence[str] = ()) -> list[str]:
    """Write the states of the silver periods that have none, and of those of ``replace``; returns these periods.

    Only these periods are read. A period's state is written whole, the sums of codes last, and it counts as there when those
    stand; running the job again after a failure gives the same states. With another mapping, replace all periods.
    """
    in_silver = {row.periodo for row in layers.loaded_periods(spark, root, "silver", "itens").collect()}
    done = {row.periodo for row in layers.loaded_periods(spark, root, "gold", STATES[-1]).collect()}
    gone = sorted(done - in_silver)
    for table in STATES:
        layers.clear_periods(spark, root, "gold", table, gone)
    periods = sorted((in_silver - done) | (set(replace) & in_silver))
    if not periods:
        log.info("states are up to date")
        return []
    items = layers.read_periods(spark, root, "silver", "itens", periods).withColumn("periodo", F.col("periodo").cast("string"))
    numbers = {}
    for table, keys in NUMBERS.items():
        known = layers.read_table(spark, root, "gold", table)
        layers.append_rows(states.new_numbers(keys(items), known), root, "gold", table)
        numbers[table] = layers.read_table(spark, root, "gold", table)
    # The sums and both sets are made of the same values, written once.
    layers.write_table(states.typed_values(items, group_a, "periodo"), root, "gold", VALUES)
    values = layers.read_table(spark, root, "gold", VALUES)
    sets = states.key_sets(values, {
        "fornecedores_distintos": ("fornecedor", numbers["numeros_fornecedores"]),
        "notas_distintas": ("chave_de_acesso", numbers["numeros_notas"])}, "periodo")
    for table, state in zip(STATES, (states.sums(values, "periodo"), sets, states.code_sums(items, "periodo"))):
        layers.write_periods(state, root, "gold", table, rebalance=True, periods=periods)
    layers.delete_folder(spark, layers.table_path(root, "gold", VALUES))
    return periods


def state_totals(spark: SparkSession, root: str, years: Sequence[int] | None = None) -> DataFrame:
    """Value, suppliers and invoices per type and year and per year, merged from the states of all periods."""
    somas, conjuntos, _ = (layers.read_table(spark, root, "gold", name) for name in STATES)
    return states.merged_totals(somas, conjuntos, years)


def update_gold(
    spark: SparkSession, root: str, group_a: DataFrame, years: Sequence[int] | None = None, replace: Sequence[str] = (),
    keyword_patterns: dict[str, str] | None = None,
) -> dict[str, int]:
    """The marts by type and keyword like ``build_gold``, from states: a month's run reads the items of that month only."""
    update_states(spark, root, group_a, replace)
    codes = layers.read_table(spark, root, "gold", STATES[-1])
    if codes is None:
        return {}
    totals = state_totals(spark, root)
    if years is None:
        years = sorted(row.ano for row in totals.select("ano").where("ano is not null").distinct().collect())
    typed = marts.typed_codes(states.merged_code_sums(codes), group_a)
    patterns = marts.KEYWORD_PATTERNS if keyword_patterns is None else keyword_patterns
    chosen = totals.where(F.col("ano").isin(*years))
    return publish(spark, root, {
        "resumo_grupo_a": marts.type_year_pivot(states.by_type(chosen), years),
        "totais_grupo_a": states.by_year(chosen),
        "itens_grupo_a": typed.where(F.col("ano") == max(years, default=0)),
        "itens_grupo_b_regex": marts.flagged(typed, patterns),
    })


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> dict[str, int]:
    """Write reports as gold tables, and from those as CSV deliverables; returns rows per report."""
    written = {}
    for name, table in tables.items():
        written[name] = layers.write_table(table, root, "gold", name)
        log.info("gold %s: %d rows", name, written[name])
        stored = layers.read_table(spark, root, "gold", name)
        delivery.write_regional_csv(stored, layers.table_path(root, "entrega", f"{name}.csv"))
        delivery.write_plain_csv(stored, layers.table_path(root, "entrega", f"{name}_utf8.csv"))
    return written


def item_reports(
    spark: SparkSession, items: DataFrame, group_a: DataFrame, words: Sequence[str] | None = None,
    steel: DataFrame | None = None, signs: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Further reports over the silver items, ready to ``publish``; without tables of the user, the built-in ones."""
    words = mappings.keywords()[0] if words is None else list(words)
    needles = [mappings.normalized_keyword(word) for word in words]
    ranked = marts.ranked_by_code(items)
    tables = {
        "aco_totais_por_grupo_e_orgao": marts.buyers_by_code_group(items, mappings.steel_groups(spark) if steel is None else steel),
        "totais_com_agregacao_das_descricoes": ranked,
        "totais_palavras_chave": inquiries.keyword_rows(ranked),
        "totais_por_tipo": marts.ranked_by_type(items, group_a),
        "totais_por_palavra_chave": marts.ranked_keyword_hits(marts.keyword_hits(items, words, needles)),
    }
    if signs is not None:
        tables["totais_com_sinal"] = inquiries.signed_totals(items, signs)
        tables["tipos_com_sinal"] = inquiries.signed_by_product_type(items, signs)
    return tables


def invoice_reports(
    invoices: DataFrame, presence: DataFrame | None = None, raw: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Reports over the silver invoice headers, ready to ``publish``.

    Silver keeps company ids as numbers, so the suppliers with a foreign id come from ``raw``, the bronze headers.
    """
    tables = {
        "valor_por_ano": inquiries.value_by_year(invoices),
        "valor_por_uf_emitente": inquiries.value_by_state(invoices, "uf_emitente"),
        "valor_por_uf_destinatario": inquiries.value_by_state(invoices, "uf_destinatario"),
        "natureza_exterior": inquiries.nature_share(invoices),
    }
    mixed = TAX_ID_COLUMNS[0][0]
    if raw is not None and mixed in raw.columns:
        issued = raw.select("CHAVE DE ACESSO", F.col(f"`{mixed}`").alias("cpf_cnpj_emitente")).distinct()
        tables["fornecedores_exterior"] = inquiries.suppliers_with_prefix(issued)
    if presence is not None:
        company = F.lpad(F.col("cnpj_emitente").cast("decimal(18,0)").cast("string"), 14, "0")
        named = invoices.withColumn("cpf_cnpj_emitente", F.coalesce(company, "cpf_emitente"))
        tables["fornecedores_presenca"] = inquiries.supplier_presence(named, presence)
    return tables
