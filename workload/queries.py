"""One callable (spark, sf_dir) -> DataFrame per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from invoice_lake.functions import codes, parsing, periods, text
from invoice_lake.operators import cleaning, marts, matching, quality, states
from invoice_lake.plans import inquiries, lake, reports
from invoice_lake.session import shared_folder
from invoice_lake.sources import delivery, keyed, layers, mappings
from invoice_lake.streaming.monthly import stream_archives
from workload import archives, views

Query = Callable[[SparkSession, str], DataFrame]
YEARS = (1997, 1998, 1999, 2000)
FOCUS = 2000
DOCUMENT_WORDS = ("la", "que", "re", "ou", "et")
DOCUMENT_KEYS = ("la", "eaux", "que", "tion", "zzz")
ITEM_PATTERNS = {
    "widget_encontrado": "widget",
    "ring_encontrado": "rings?",
    "red_encontrado": "red",
    "small_rod_encontrado": "small rod",
}
ITEM_KEYWORDS = ("widget", "gear", "re", "old")
CATEGORY_WORDS = ("widget", "gear", "bolt", "ring", "rod")
CODE = "39010001"

REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and integers as bigint, to compare with other engines."""
    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            value = value.cast("bigint")
        return value.alias(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def month_counts(df: DataFrame, name: str = "n") -> DataFrame:
    return df.groupBy("periodo").agg(F.count("*").alias(name))


# --- periods -----------------------------------------------------------------------------------


def _calendar(spark: SparkSession, sf: str) -> DataFrame:
    bounds = views.items(spark, sf, "data_emissao").agg(
        F.date_format(F.min("data_emissao"), "yyyyMM").alias("inicio"),
        F.date_format(F.max("data_emissao"), "yyyyMM").alias("fim"),
    )
    return periods.expand_months(bounds)


@register
def period_calendar(spark, sf):
    return _calendar(spark, sf)


@register
def period_gaps(spark, sf):
    landed = views.invoices(spark, sf, "periodo").distinct()
    return periods.missing_periods(_calendar(spark, sf).select("periodo"), landed)


@register
def periods_loaded(spark, sf):
    return views.items(spark, sf, "periodo").distinct()


@register
def incremental_periods(spark, sf):
    """Rows of the periods that the other table lacks."""
    new = periods.missing_periods(
        views.items(spark, sf, "periodo").distinct(), views.invoices(spark, sf, "periodo")
    )
    return month_counts(views.items(spark, sf, "periodo").join(new, "periodo", "left_semi"))


@register
def previous_period(spark, sf):
    days = views.items(spark, sf, "periodo", "data_emissao")
    return days.select("periodo", periods.previous_period(F.col("data_emissao")).alias("anterior")).distinct()


@register
def union_periods(spark, sf):
    """Items and invoices appended by column name; columns one side lacks are NULL."""
    lines = views.items(spark, sf, "periodo", "chave_de_acesso", "quantidade")
    heads = views.invoices(spark, sf, "chave_de_acesso", "periodo")
    whole = layers.append_periods([lines, heads])
    return whole.groupBy("periodo").agg(
        F.count("*").alias("n"), F.count("quantidade").alias("n_itens"), F.sum("quantidade").alias("quantidade")
    )


# --- cleaning ----------------------------------------------------------------------------------


@register
def clean_split_taxid(spark, sf):
    dirty = views.dirty_text(spark, sf).select("l_orderkey", "l_linenumber", "cpf_cnpj")
    return plain(cleaning.split_tax_id(dirty, [("cpf_cnpj", "cpf", "cnpj")]))


@register
def clean_typed(spark, sf):
    types = {"data_txt": "timestamp", "valor_txt": "decimal", "qtd_txt": "integer", "cpf_cnpj": "decimal"}
    typed = cleaning.apply_types(views.dirty_text(spark, sf), types)
    return plain(typed.withColumn("data_txt", F.date_format("data_txt", "yyyy-MM-dd HH:mm:ss")))


@register
def parse_br_datetime(spark, sf):
    value = F.date_format(parsing.parse_br_timestamp(F.col("data_txt")), "yyyy-MM-dd HH:mm:ss")
    return plain(views.dirty_text(spark, sf).select("l_orderkey", "l_linenumber", value.alias("data")))


@register
def parse_br_int(spark, sf):
    value = parsing.parse_br_int(F.col("qtd_txt")).alias("quantidade")
    return plain(views.dirty_text(spark, sf).select("l_orderkey", "l_linenumber", value))


@register
def parse_br_decimal(spark, sf):
    value = parsing.parse_br_decimal(F.col("valor_txt")).alias("valor")
    signed = parsing.parse_br_decimal(F.col("valor_txt"), keep_sign=True).alias("valor_com_sinal")
    return plain(views.dirty_text(spark, sf).select("l_orderkey", "l_linenumber", value, signed))


@register
def ncm_pad(spark, sf):
    raw = F.when(F.col("p_size") == 1, F.lit("-1")).otherwise(F.col("p_partkey").cast("string"))
    return views.table(spark, sf, "part").select(
        "p_partkey", raw.alias("codigo"), codes.pad_product_code(raw).alias("codigo_8")
    )


@register
def exclude_keys(spark, sf):
    """One listed key is dropped, and so are the rows without a key (here every seventh line)."""
    lines = views.items(spark, sf, "chave_de_acesso", "numero_produto", "periodo")
    keyed = lines.withColumn("chave_de_acesso", F.expr("case when numero_produto <> 7 then chave_de_acesso end"))
    return month_counts(cleaning.exclude_keys(keyed, ["0" * 43 + "7"]))


@register
def dedup_rows(spark, sf):
    lines = views.items(spark, sf, "chave_de_acesso", "numero_produto", "periodo")
    return quality.repeated_rows_by(lines, "periodo")


@register
def silver_items(spark, sf):
    """All cleaning steps over raw item rows, some of them delivered twice."""
    typed = cleaning.clean_table(views.raw_items(spark, sf), "itens", invalid_keys=["0" * 43 + "7"])
    return plain(typed.withColumn("data_emissao", F.date_format("data_emissao", "yyyy-MM-dd HH:mm:ss")))


KEYED_BUCKETS = 4


def _keyed_items(spark, sf):
    """Items in buckets of their invoice key, written in two loads; the second delivers some months of the first again."""
    lines = views.items(spark, sf, "chave_de_acesso", "numero_produto", "valor_total", "periodo")
    root, of = shared_folder(spark, "keyed"), ("silver", "itens", "chave_de_acesso", KEYED_BUCKETS)
    keyed.write_keyed(lines.where("periodo < '1999-01'"), root, *of)
    keyed.write_keyed(lines.where("periodo >= '1998-10'"), root, *of)
    return keyed.read_keyed(spark, root, *of, lines.schema)


@register
def keyed_repeated_keys(spark, sf):
    return plain(quality.repeated_keys(_keyed_items(spark, sf), value="valor_total"))


@register
def keyed_repeated_rows(spark, sf):
    lines = _keyed_items(spark, sf).select("chave_de_acesso", "numero_produto", "periodo")
    return quality.repeated_rows_by(lines, "periodo")


# --- archives ----------------------------------------------------------------------------------


INVALID_KEY = "0" * 43 + "7"


def _raw_tables(spark, sf):
    return {"itens": views.raw_items(spark, sf), "nf": archives.raw_invoices(spark, sf), "eventos": archives.raw_events(spark, sf)}


_LAKES: dict[tuple[str, str], tuple[str, dict[str, int]]] = {}


def _delivered(spark, sf):
    """A lake loaded from archives of all months, once per session, and the rows that the load reports per silver table.

    Each month has an older delivery with other texts, and items with a field too many. Archives of two members stand a
    hundred years later.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key in _LAKES:
        return _LAKES[key]
    landing, root, staging = (shared_folder(spark, name) for name in ("entrada", "lago", "descompactados"))
    tables = _raw_tables(spark, sf)
    older = tables | {"itens": tables["itens"].withColumn("DESCRIÇÃO DO PRODUTO/SERVIÇO", F.lit("entrega anterior"))}
    archives.deliver(spark, landing, "NFe_1", older)
    archives.deliver(spark, landing, "NFe_2", tables, archives.broken_items(spark, sf))
    later = F.concat(F.lit("20"), F.substring("periodo", 3, 5))
    archives.deliver(spark, landing, "NFe_1", {
        table: tables[table].where("periodo like '1998-%'").withColumn("periodo", later) for table in ("itens", "nf")})
    lake.load_bronze(spark, landing, root, staging)
    _LAKES[key] = root, lake.load_silver(spark, root, invalid_keys=[INVALID_KEY])
    return _LAKES[key]


@register
def archive_items(spark, sf):
    """Archives to bronze to silver: the items of the latest delivery, cleaned."""
    root, _ = _delivered(spark, sf)
    items = layers.read_table(spark, root, "silver", "itens").withColumn("periodo", F.col("periodo").cast("string"))
    return plain(items.withColumn("data_emissao", F.date_format("data_emissao", "yyyy-MM-dd HH:mm:ss")))


@register
def archive_invoices(spark, sf):
    """Quotes, separators and line breaks inside fields come through the load as they were."""
    bronze = layers.read_table(spark, _delivered(spark, sf)[0], "bronze", "nf")
    return bronze.select("CHAVE DE ACESSO", "NATUREZA DA OPERAÇÃO", "VALOR NOTA FISCAL", "periodo").toDF(
        "chave", "natureza", "valor", "periodo").withColumn("periodo", F.col("periodo").cast("string"))


@register
def archive_rejects(spark, sf):
    """Records with a field too many, and archives without all members, per month."""
    noted = layers.read_table(spark, _delivered(spark, sf)[0], "bronze", "rejeitados")
    return noted.groupBy(F.col("periodo").cast("string").alias("periodo"), "motivo").agg(F.count("*").alias("n"))


@register
def archive_row_counts(spark, sf):
    """Rows that the load reports to have written in silver, and the months that bronze notes as loaded."""
    root, rows = _delivered(spark, sf)
    months = layers.loaded_periods(spark, root, "bronze", "carregados").agg(F.lit("meses").alias("tabela"), F.count("*").alias("n"))
    return spark.createDataFrame(sorted(rows.items()), "tabela string, n bigint").union(months)


@register
def stream_load(spark, sf):
    """Items per month after two runs of the stream: months of returned lines only, then later months and one redelivered whole."""
    landing, root, staging, checkpoint = (shared_folder(spark, n) for n in ("entrada", "lago", "descompactados", "progresso"))
    tables = _raw_tables(spark, sf)
    first = {table: df.where("periodo < '1998-06'") for table, df in tables.items()}
    first["itens"] = first["itens"].where("`CPF/CNPJ Emitente` like '%*%'")
    second = {table: df.where("periodo >= '1998-05'") for table, df in tables.items()}
    for name, delivery_of in (("NFe_1", first), ("NFe_2", second)):
        archives.deliver(spark, landing, name, delivery_of)
        stream_archives(spark, layers.qualified(spark, landing), root, staging, checkpoint, invalid_keys=[INVALID_KEY]).awaitTermination()
    items = layers.read_table(spark, root, "silver", "itens")
    return plain(items.groupBy(F.col("periodo").cast("string").alias("periodo")).agg(
        F.count("*").alias("n"), F.sum("valor_total").alias("valor_total")))


# --- text --------------------------------------------------------------------------------------


@register
def normalize_text(spark, sf):
    value = text.normalize_text(F.col("text"))
    return views.table(spark, sf, "documents").select(
        "doc_id", F.length(value).cast("bigint").alias("tamanho"), F.md5(value).alias("resumo")
    )


@register
def normalize_keyword(spark, sf):
    value = text.normalize_keyword(F.concat(F.lit("  "), "text", F.lit(" ")))
    return views.table(spark, sf, "documents").select(
        "doc_id", F.length(value).cast("bigint").alias("tamanho"), F.md5(value).alias("resumo")
    )


@register
def mapping_trimmed(spark, sf):
    rows = views.table(spark, sf, "part").select(
        F.concat(F.lit(" "), "p_brand", F.lit("  ")).alias("tipo"), F.expr("concat(' ', p_type)").alias("ncm")
    )
    return mappings.tidy_group_a(rows)


def _deliverable(spark, sf):
    return views.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("valor"), F.col("l_discount").cast("double").alias("desconto"),
        (F.col("l_quantity") > 25).alias("acima"), F.array("l_returnflag", "l_linestatus").alias("marcas"),
    )


@register
def regional_text(spark, sf):
    return delivery.regional_text(_deliverable(spark, sf))


def _read_back(spark, path, **options):
    """The rows of a delivered folder by its header, the keys as numbers again."""
    rows = spark.read.options(header=True, quote='"', escape='"', **options).csv(path)
    return rows.withColumns({name: F.col(name).cast("bigint") for name in ("l_orderkey", "l_linenumber")})


@register
def regional_csv(spark, sf):
    """The regional file, written and read back."""
    path = shared_folder(spark, "regional")
    delivery.write_regional_csv(_deliverable(spark, sf), path, encoding="ISO-8859-1")
    return _read_back(spark, path, sep=";", encoding="ISO-8859-1")


@register
def plain_csv(spark, sf):
    """The plain file, written and read back."""
    path = shared_folder(spark, "simples")
    delivery.write_plain_csv(_deliverable(spark, sf), path)
    return _read_back(spark, path)


@register
def header_years(spark, sf):
    """Years found in the header of a delivered pivot."""
    path = shared_folder(spark, "pivo")
    delivery.write_plain_csv(_type_pivot(spark, sf), path)
    found = reports.report_years(spark.read.csv(path, header=True))
    return spark.createDataFrame([(year,) for year in found], "ano bigint")


@register
def keyword_flags(spark, sf):
    patterns = {f"tem_{word}": word for word in DOCUMENT_WORDS} | marts.KEYWORD_PATTERNS
    documents = views.table(spark, sf, "documents").withColumn("texto", text.normalize_text(F.col("text")))
    return documents.select("doc_id", *text.word_flags(F.col("texto"), patterns))


@register
def product_category(spark, sf):
    lines = views.items(
        spark, sf, "data_emissao", "descricao_do_produto_servico", "valor_total", "chave_de_acesso"
    )
    return plain(inquiries.product_categories(lines, CATEGORY_WORDS, "other"))


@register
def like_any_share(spark, sf):
    heads = views.invoices(spark, sf, "data_emissao", "natureza_da_operacao", "valor_nota_fiscal")
    return plain(inquiries.nature_share(heads, ("urgent", "high"), 1998))


def _ranked_by_code(spark, sf, **options):
    lines = views.items(
        spark, sf, "data_emissao", "codigo_ncm_sh", "ncm_sh_tipo_de_produto",
        "descricao_do_produto_servico", "valor_total",
    )
    return marts.ranked_by_code(lines, **options)


@register
def keyword_filter_any(spark, sf):
    return plain(inquiries.keyword_rows(_ranked_by_code(spark, sf), ("widget", "gizmo", "promo"), {2001: "2001 (partial)"}))


@register
def year_label(spark, sf):
    label = text.label_override(marts.year(), {2001: "2001 (partial)"}).alias("label")
    return views.items(spark, sf, "data_emissao").groupBy(label).agg(F.count("*").alias("n"))


# --- point queries and checks ------------------------------------------------------------------


@register
def key_lookup(spark, sf):
    lines = views.items(spark, sf, "chave_de_acesso", "numero_produto", "quantidade", "valor_total", "codigo_ncm_sh")
    return plain(inquiries.by_key(lines, "0" * 41 + "100"))


@register
def qty_price_consistency(spark, sf):
    return quality.consistency_counts(views.price_checks(spark, sf))


@register
def inconsistent_sample(spark, sf):
    checks = views.price_checks(spark, sf)
    sample = quality.inconsistent_items(checks, checks.columns)
    return plain(sample.withColumn("qtd_inferida", F.round("qtd_inferida", 4)))


@register
def dup_key_count(spark, sf):
    return quality.count_repeated_keys(views.items(spark, sf, "chave_de_acesso"))


@register
def dup_keys(spark, sf):
    return plain(quality.repeated_keys(views.items(spark, sf, "chave_de_acesso", "valor_total"), value="valor_total"))


# --- joins -------------------------------------------------------------------------------------


def _per_code(spark, sf):
    """Items summed per code, so that a very frequent code is one row in the joins."""
    lines = views.items(spark, sf, "codigo_ncm_sh", "valor_total")
    return lines.groupBy("codigo_ncm_sh").agg(F.count("*").alias("n"), F.sum("valor_total").alias("valor"))


def _sums(joined: DataFrame, *keys) -> DataFrame:
    return plain(joined.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("valor").alias("valor")))


@register
def join_ncm_exact(spark, sf):
    joined = matching.join_codes(_per_code(spark, sf), views.group_a(spark, sf))
    return _sums(joined, "tipo", F.col("tipo").isNotNull().alias("mapeada"))


@register
def join_ncm_left(spark, sf):
    joined = matching.join_codes(_per_code(spark, sf), views.group_a(spark, sf), "left")
    return _sums(joined, "tipo", F.col("tipo").isNotNull().alias("mapeada"))


@register
def join_prefix_any(spark, sf):
    joined = matching.join_any_prefix(_per_code(spark, sf), views.code_groups(spark, sf))
    return _sums(joined, "ncm_cod", "grupo")


def _chain_items(spark, sf, *dedup):
    lines = views.items(spark, sf, *views.ITEM_COLUMNS)
    return matching.chain_items(lines, views.chain_map(spark, sf), YEARS, dedup or ("codigo_cadeia",))


def _chain_links(spark, sf, by, dedup=("codigo_cadeia",), carried=()):
    """The items of ``_chain_items`` with a number for the chain columns that a report is by."""
    lines = views.items(spark, sf, *views.ITEM_COLUMNS)
    return matching.chain_links(lines, views.chain_map(spark, sf), YEARS, dedup, by, carried)


@register
def join_chain_dedup(spark, sf):
    return plain(
        _chain_links(spark, sf, ("codigo_cadeia",)).items.groupBy("codigo_cadeia", "tamanho_prefixo")
        .agg(F.count("*").alias("n"), F.sum("valor_total").alias("valor"))
    )


@register
def join_keyword_contains(spark, sf):
    documents = views.table(spark, sf, "documents")
    hits = matching.join_keywords(documents, text.normalize_text(F.col("text")), DOCUMENT_KEYS, out="chave")
    return hits.groupBy("chave").agg(F.count("*").alias("n"), F.sum("n_chars").alias("caracteres"))


@register
def join_keyword_table(spark, sf):
    """All words of the benchmark as keywords, looked up in all documents."""
    words = views.table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias("agulha")).where("agulha <> ''").distinct()
    docs = views.table(spark, sf, "documents").select(F.lower("text").alias("texto"), "n_chars")
    joined = matching.join_keyword_table(docs, "texto", words.withColumn("tamanho", F.length("agulha").cast("bigint")))
    return joined.groupBy("agulha", "tamanho").agg(F.count("*").alias("n"), F.sum("n_chars").alias("caracteres"))


@register
def join_supplier_root(spark, sf):
    heads = views.invoices(spark, sf, "data_emissao", "cpf_cnpj_emitente", "valor_nota_fiscal", "chave_de_acesso")
    return plain(inquiries.supplier_presence(heads, views.presence(spark, sf)))


# --- totals ------------------------------------------------------------------------------------


@register
def value_by_year(spark, sf):
    return plain(inquiries.value_by_year(views.invoices(spark, sf, "data_emissao", "valor_nota_fiscal")))


@register
def value_by_uf(spark, sf):
    heads = views.invoices(spark, sf, "data_emissao", "uf_emitente", "uf_destinatario", "valor_nota_fiscal")
    parts = [
        inquiries.value_by_state(heads, name, 1998).select(F.lit(name).alias("lado"), F.col(name).alias("uf"), "valor")
        for name in ("uf_emitente", "uf_destinatario")
    ]
    return plain(layers.append_periods(parts))


@register
def invoice_counts(spark, sf):
    return inquiries.invoice_counts(views.items(spark, sf, "data_emissao", "chave_de_acesso"), (1997, 1998, 1999))


@register
def signed_totals(spark, sf):
    lines = views.items(spark, sf, "data_emissao", "cfop", "valor_total")
    return plain(inquiries.signed_totals(lines, views.operation_signs(spark, sf), 1998))


@register
def top_ncm_signed(spark, sf):
    lines = views.items(spark, sf, "data_emissao", "ncm_sh_tipo_de_produto", "cfop", "quantidade", "valor_total")
    return plain(inquiries.signed_by_product_type(lines, views.operation_signs(spark, sf), 1998))


@register
def cfop_first_digit(spark, sf):
    return inquiries.operation_digit_counts(views.items(spark, sf, "data_emissao", "cfop"))


@register
def cfop_foreign_detail(spark, sf):
    lines = views.items(
        spark, sf, "data_emissao", "cfop", "destino_da_operacao", "codigo_ncm_sh", "valor_total", "chave_de_acesso"
    )
    return plain(inquiries.foreign_operations(lines, destination=inquiries.FOREIGN_DESTINATION))


@register
def supplier_prefix_count(spark, sf):
    return inquiries.suppliers_with_prefix(views.invoices(spark, sf, "cpf_cnpj_emitente"), "0000000")


@register
def supplier_profile(spark, sf):
    return plain(inquiries.supplier_profile(views.invoices(spark, sf), "00000100"))


@register
def supplier_totals(spark, sf):
    return plain(inquiries.supplier_totals(views.invoices(spark, sf), "00000100"))


@register
def code_descriptions(spark, sf):
    lines = views.items(spark, sf, "data_emissao", "codigo_ncm_sh", "ncm_sh_tipo_de_produto")
    return inquiries.code_descriptions(lines, CODE, 2000)


@register
def uf_rank_year(spark, sf):
    ranked = inquiries.state_ranks(views.items(spark, sf, "data_emissao", "uf_destinatario", "valor_total"))
    return ranked.withColumn("valor_total_milhoes", F.round("valor_total_milhoes", 6))


# --- product types -----------------------------------------------------------------------------


def _type_items(spark, sf):
    return views.items(
        spark, sf, "data_emissao", "codigo_ncm_sh", "valor_total", "cnpj_emitente", "cpf_emitente", "chave_de_acesso"
    )


def _type_totals(spark, sf):
    return marts.type_year_totals(_type_items(spark, sf), views.group_a(spark, sf), YEARS)


def _type_pivot(spark, sf):
    return marts.type_year_pivot(_type_totals(spark, sf), YEARS)


def _year_totals(spark, sf):
    return marts.type_totals_by_year(_type_items(spark, sf), views.group_a(spark, sf), YEARS)


@register
def type_year_long(spark, sf):
    return plain(_type_totals(spark, sf))


@register
def type_year_pivot(spark, sf):
    """The flagship table: value, suppliers and invoices per type, a column per year."""
    names = {"Valor Total": "valor", "Fornecedores": "fornecedores", "Notas Distintas": "notas"}
    labels = {f"{label} {y}": f"{name}_{y}" for label, name in names.items() for y in YEARS}
    return _type_pivot(spark, sf).withColumnsRenamed(labels)


@register
def type_totals_year(spark, sf):
    return plain(_year_totals(spark, sf))


def _two_loads(spark, sf):
    """A lake whose silver items came in two loads, each turned to states on its own."""
    root = shared_folder(spark, "cargas")
    lines = views.items(
        spark, sf, "periodo", "data_emissao", "codigo_ncm_sh", "valor_total", "cnpj_emitente", "cpf_emitente", "chave_de_acesso",
        "descricao_do_produto_servico")
    early = F.col("periodo") < "1998-06"
    for load in (lines.where(early), lines.where(~early)):
        layers.write_periods(load, root, "silver", "itens", rebalance=True)
        lake.update_states(spark, root, views.group_a(spark, sf))
    return root


@register
def incremental_type_year(spark, sf):
    """The mart by type and year from the states of two loads, merged."""
    return plain(states.by_type(lake.state_totals(spark, _two_loads(spark, sf), YEARS)))


@register
def incremental_totals_year(spark, sf):
    return plain(states.by_year(lake.state_totals(spark, _two_loads(spark, sf), YEARS)))


@register
def incremental_items(spark, sf):
    sums = layers.read_table(spark, _two_loads(spark, sf), "gold", lake.STATES[-1])
    return plain(marts.typed_codes(states.merged_code_sums(sums).where("ano = 2000"), views.group_a(spark, sf)))


@register
def items_group_a(spark, sf):
    lines = views.items(spark, sf, "data_emissao", "codigo_ncm_sh", "descricao_do_produto_servico", "valor_total")
    return plain(marts.items_by_code(lines, views.group_a(spark, sf), 2000))


@register
def distinct_types(spark, sf):
    return reports.distinct_types(matching.code_map(views.group_a(spark, sf)))


@register
def kpi_type(spark, sf):
    """Card for all types and card for one type."""
    pivot, totals = _type_pivot(spark, sf), _year_totals(spark, sf)
    everything = reports.type_card(pivot, totals, FOCUS).select(F.lit("*").alias("tipo"), "*")
    one = reports.type_card(pivot, totals, FOCUS, "Brand#7").select(F.lit("Brand#7").alias("tipo"), "*")
    return everything.unionByName(one)


@register
def top20_series(spark, sf):
    series = reports.yearly_series(_type_pivot(spark, sf), "tipo", YEARS)
    return series.withColumn("valor", F.round("valor", 6))


# --- production chains -------------------------------------------------------------------------


def _chain_summary(spark, sf):
    return marts.chain_summary(_chain_links(spark, sf, marts.CHAIN_KEY), YEARS, FOCUS)


def _chain_detail(spark, sf, **options):
    return marts.chain_detail(_chain_links(spark, sf, marts.DETAIL_CHAIN), YEARS, **options)


def _chain_by_cnae(spark, sf):
    return marts.chain_by_cnae(_chain_links(spark, sf, marts.CNAE_KEY, ("codigo_cadeia", "cnae")), YEARS)


def _countable(spark, sf):
    """Items to be counted per chain and, once each, for all chains."""
    return _chain_links(spark, sf, marts.CHAIN_KEY, carried=("cadeia", "cnae"))


@register
def chain_summary(spark, sf):
    return plain(_chain_summary(spark, sf))


@register
def chain_detail_topk(spark, sf):
    return plain(_chain_detail(spark, sf))


@register
def chain_cnae_report(spark, sf):
    return plain(_chain_by_cnae(spark, sf))


@register
def chain_global_totals(spark, sf):
    return plain(marts.chain_global_totals(_countable(spark, sf), FOCUS))


@register
def kpi_global(spark, sf):
    linked = _countable(spark, sf)
    return reports.global_card(marts.chain_global_totals(linked, FOCUS), marts.chain_summary(linked, YEARS, FOCUS), FOCUS)


@register
def kpi_chain(spark, sf):
    return reports.chain_card(_chain_summary(spark, sf), "C1", FOCUS)


@register
def chain_table_filtered(spark, sf):
    one = _chain_items(spark, sf).filter("codigo_cadeia = 'C1'")
    table = reports.chain_table(marts.chain_detail(one, YEARS, limit=None), "valor_total")
    return plain(table.select("codigo_cadeia", "cnae", "codigo_ncm_sh", "descricao_do_produto_servico", "valor_total"))


@register
def chain_table_by_folder(spark, sf):
    """One chain of the gold detail, which has a folder per chain."""
    root = shared_folder(spark, "cadeias")
    layers.write_table(_chain_detail(spark, sf, limit=None), root, "gold", "detalhe_por_cadeia", "codigo_cadeia")
    table = reports.detail_of_chain(spark, root, "C1")
    return plain(table.select("codigo_cadeia", "cnae", "codigo_ncm_sh", "descricao_do_produto_servico", "valor_total"))


@register
def chain_detail_per_chain(spark, sf):
    """The 100 largest groups of every chain."""
    groups = _chain_detail(spark, sf, limit=None)
    return plain(marts.largest_per_chain(groups, 100).select(
        "codigo_cadeia", "cnae", "codigo_ncm_sh", "descricao_do_produto_servico", "valor_total", "registros"))


@register
def cnae_table(spark, sf):
    report = reports.label_cnae(_chain_by_cnae(spark, sf))
    names = {v: k for k, v in reports.CNAE_LABELS.items()}
    return plain(reports.cnae_table(report, "C1").withColumnsRenamed(names).select("codigo_cadeia", "cnae", "valor_total", "fornecedores", "notas", "itens"))


@register
def type_table(spark, sf):
    one = reports.type_table(_type_pivot(spark, sf), "Brand#7")
    return plain(one.withColumnsRenamed({f"Valor Total {y}": f"valor_{y}" for y in YEARS}).select("tipo", *[f"valor_{y}" for y in YEARS]))


@register
def chain_labels(spark, sf):
    return reports.chain_labels(_chain_summary(spark, sf))


@register
def chain_series(spark, sf):
    series = reports.yearly_series(_chain_summary(spark, sf), "cadeia", YEARS, "valor_", unit=1e9)
    return series.withColumn("valor", F.round("valor", 9))


# --- keywords ----------------------------------------------------------------------------------


def _keyword_mart(spark, sf):
    lines = views.items(spark, sf, "data_emissao", "codigo_ncm_sh", "descricao_do_produto_servico", "valor_total")
    return marts.keyword_mart(lines, views.group_a(spark, sf), ITEM_PATTERNS)


@register
def keyword_mart(spark, sf):
    return plain(_keyword_mart(spark, sf))


@register
def keyword_pivot(spark, sf):
    """By type, for descriptions with one flag."""
    pivot = marts.keyword_type_pivot(_keyword_mart(spark, sf), YEARS, "widget_encontrado")
    return pivot.withColumnsRenamed({f"Valor Total {y}": f"valor_{y}" for y in YEARS})


@register
def keyword_series(spark, sf):
    pivot = marts.keyword_type_pivot(_keyword_mart(spark, sf), YEARS, "ring_encontrado")
    return reports.yearly_series(pivot, "grupo", YEARS).withColumn("valor", F.round("valor", 6))


def _keyword_hits(spark, sf):
    lines = views.items(spark, sf, "data_emissao", "descricao_do_produto_servico", "valor_total")
    return marts.keyword_hits(lines, ITEM_KEYWORDS, patterns=ITEM_PATTERNS)


@register
def keyword_hits(spark, sf):
    return plain(_keyword_hits(spark, sf))


@register
def keyword_hits_ranked(spark, sf):
    return plain(marts.ranked_keyword_hits(_keyword_hits(spark, sf)))


# --- ranks and code groups ---------------------------------------------------------------------


@register
def rank_within_ncm(spark, sf):
    return plain(_ranked_by_code(spark, sf))


def _ranked_by_type(spark, sf, **options):
    lines = views.items(
        spark, sf, "data_emissao", "codigo_ncm_sh", "ncm_sh_tipo_de_produto",
        "descricao_do_produto_servico", "valor_total",
    )
    return marts.ranked_by_type(lines, views.group_a(spark, sf), **options)


@register
def rank_within_type(spark, sf):
    return plain(_ranked_by_type(spark, sf))


@register
def rank_within_ncm_sliced(spark, sf):
    """As ``rank_within_ncm``, with every group above one row taken for a hot one."""
    return plain(_ranked_by_code(spark, sf, hot_rows=1))


@register
def rank_within_type_sliced(spark, sf):
    """As ``rank_within_type``, with every group above 20 rows taken for a hot one."""
    return plain(_ranked_by_type(spark, sf, hot_rows=20))


@register
def prefix_group_buyer(spark, sf):
    lines = views.items(spark, sf, "data_emissao", "cnpj_destinatario", "nome_destinatario", "codigo_ncm_sh", "valor_total")
    report = marts.buyers_by_code_group(lines, views.code_groups(spark, sf))
    return plain(report.withColumn("ncms_encontradas", F.array_join("ncms_encontradas", ",")))
