"""Independent SQL for the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

_CODE = "lpad(CAST(39000000 + ({part} % 600000) * 100 + {line} AS VARCHAR), 8, '0')"
_PART_CODE = _CODE.format(part="p_partkey", line="1")

ITEMS = f"""itens AS (
  SELECT lpad(CAST(l_orderkey AS VARCHAR), 44, '0') AS chave_de_acesso, l_orderkey AS numero,
    CAST(l_linenumber AS BIGINT) AS numero_produto, l_shipdate AS data_emissao,
    CAST(year(l_shipdate) AS BIGINT) AS ano, strftime(l_shipdate, '%Y-%m') AS periodo,
    CASE WHEN s_acctbal >= 0 THEN CAST(100000000000 + l_suppkey AS DECIMAL(18,2)) END AS cnpj_emitente,
    CASE WHEN s_acctbal < 0 THEN '***.' || lpad(CAST(l_suppkey AS VARCHAR), 3, '0') || '.***-**' END AS cpf_emitente,
    CAST(200000000000 + o_custkey AS DECIMAL(18,2)) AS cnpj_destinatario,
    c_name AS nome_destinatario, n_name AS uf_destinatario,
    CASE l_returnflag WHEN 'R' THEN '3 - OPERAÇÃO COM EXTERIOR' ELSE '1 - OPERAÇÃO INTERNA' END AS destino_da_operacao,
    {_CODE.format(part="l_partkey", line="l_linenumber")} AS codigo_ncm_sh,
    p_type AS ncm_sh_tipo_de_produto, p_name AS descricao_do_produto_servico,
    CAST(l_linenumber * 1000 + 101 AS BIGINT) AS cfop, CAST(l_quantity AS BIGINT) AS quantidade,
    CAST(p_retailprice AS DECIMAL(18,2)) AS valor_unitario, CAST(l_extendedprice AS DECIMAL(18,2)) AS valor_total
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey)"""

INVOICES = """nf AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS chave_de_acesso, o_orderdate AS data_emissao,
    CAST(year(o_orderdate) AS BIGINT) AS ano, strftime(o_orderdate, '%Y-%m') AS periodo,
    o_orderpriority AS natureza_da_operacao,
    lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '000195' AS cpf_cnpj_emitente, c_name AS razao_social_emitente,
    c_mktsegment AS uf_emitente, n_name AS uf_destinatario, CAST(o_totalprice AS DECIMAL(18,2)) AS valor_nota_fiscal
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

DIRTY = """bruto AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
    strftime(l_shipdate, '%d/%m/%Y') || CASE l_linenumber WHEN 2 THEN ' 14:30:00' WHEN 3 THEN ' x' ELSE '' END AS data_txt,
    CASE l_linenumber WHEN 4 THEN 'R$ ' WHEN 5 THEN '-' ELSE '' END
      || replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS valor_txt,
    CASE l_linenumber WHEN 1 THEN '1.234' WHEN 2 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ',5000'
      WHEN 3 THEN 'abc' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS qtd_txt,
    CASE WHEN l_returnflag = 'A' THEN '***.910.688-**' ELSE lpad(CAST(l_suppkey AS VARCHAR), 14, '0') END AS cpf_cnpj
  FROM lineitem)"""

_DATE = "COALESCE(try_strptime({c}, '%d/%m/%Y %H:%M:%S'), try_strptime({c}, '%d/%m/%Y'))"
_DATE_TEXT = "strftime(" + _DATE + ", '%Y-%m-%d %H:%M:%S')"
_INT = "TRY_CAST(replace(replace({c}, '.', ''), ',', '.') AS BIGINT)"
_DECIMAL = (
    "TRY_CAST(nullif(regexp_replace(replace(replace({c}, '.', ''), ',', '.'), '[^0-9.]', '', 'g'), '')"
    " AS DECIMAL(18,2))"
)

GROUP_A = f"""mapa_a AS (
  SELECT {_PART_CODE} AS ncm, min(p_brand || ' ') AS tipo FROM part WHERE p_type IN ('PROMO', 'SMALL') GROUP BY 1)"""

CODE_GROUPS = f"""grupos AS (
  SELECT DISTINCT left({_PART_CODE}, n) AS ncm_cod, 'grupo ' || CAST(n AS VARCHAR) AS grupo
  FROM (SELECT *, CASE WHEN p_size <= 24 THEN 8 WHEN p_size <= 48 THEN 6 ELSE 4 END AS n FROM part) p
  WHERE p_type = 'ECONOMY')"""

CHAINS = f"""mapa_cadeia AS (
  SELECT DISTINCT 'C' || CAST(p_size % 5 AS VARCHAR) AS codigo_cadeia, 'Cadeia ' || CAST(p_size % 5 AS VARCHAR) AS cadeia,
    CASE WHEN p_size % 5 < 2 THEN 'M1' ELSE 'M2' END AS missao,
    CASE WHEN p_size % 5 < 2 THEN 'Missao 1' ELSE 'Missao 2' END AS nome_missao,
    left({_PART_CODE}, n) AS prefixo_sh, n AS tamanho_prefixo, p_brand AS cnae, 'CNAE ' || p_brand AS desc_cnae,
    p_type AS criterio, substr(p_brand, 7) AS icp, 'M1; M2' AS missoes, substr(p_brand, 7, 1) AS secao_cnae,
    left({_PART_CODE}, 4) AS sh_correspondente
  FROM (SELECT *, CASE WHEN p_size <= 20 THEN 8 WHEN p_size <= 35 THEN 6 WHEN p_size <= 45 THEN 5 ELSE 4 END AS n FROM part) p
  WHERE p_type IN ('ECONOMY', 'LARGE'))"""

YEARS = (1997, 1998, 1999, 2000)
_IN_YEARS = "ano IN (1997, 1998, 1999, 2000)"
_SUPPLIER = "COALESCE(CAST(cnpj_emitente AS VARCHAR), cpf_emitente)"


def _chain_items(*dedup: str) -> str:
    keys = ", ".join(dedup)
    pairs = " UNION ALL ".join(
        f"SELECT * FROM itens JOIN mapa_cadeia ON tamanho_prefixo = {n} AND left(codigo_ncm_sh, {n}) = prefixo_sh"
        f" WHERE {_IN_YEARS}"
        for n in (8, 6, 5, 4)
    )
    return f"""{ITEMS}, {CHAINS}, pares AS ({pairs}), itens_cadeia AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
        PARTITION BY chave_de_acesso, numero, numero_produto, {keys}
        ORDER BY tamanho_prefixo DESC, prefixo_sh, cadeia, cnae, codigo_cadeia, criterio, desc_cnae, icp, missao,
          missoes, nome_missao, secao_cnae, sh_correspondente, cnpj_emitente, codigo_ncm_sh, cpf_emitente,
          data_emissao, descricao_do_produto_servico, ncm_sh_tipo_de_produto, quantidade, valor_total) AS vez
    FROM pares) z
  WHERE vez = 1)"""


CHAIN_ITEMS = _chain_items("codigo_cadeia")
CHAIN_CNAE_ITEMS = _chain_items("codigo_cadeia", "cnae")

_YEAR_VALUES = ", ".join(
    f"CAST(SUM(CASE WHEN ano = {y} THEN valor_total ELSE 0 END) AS DOUBLE) AS valor_{y}" for y in YEARS
)
SUMMARY = f"""resumo AS (
  SELECT codigo_cadeia, cadeia, missao, nome_missao, CAST(SUM(valor_total) AS DOUBLE) AS valor_total_adquirido,
    COUNT(DISTINCT {_SUPPLIER}) AS fornecedores_distintos, COUNT(*) AS quantidade_itens,
    COUNT(DISTINCT CASE WHEN ano = 2000 THEN {_SUPPLIER} END) AS fornecedores_2000,
    COUNT(CASE WHEN ano = 2000 THEN 1 END) AS quantidade_itens_2000, {_YEAR_VALUES}
  FROM itens_cadeia GROUP BY 1, 2, 3, 4)"""
GLOBAL = f"""globais AS (
  SELECT CAST(SUM(valor_total) AS DOUBLE) AS valor_total_global, COUNT(DISTINCT {_SUPPLIER}) AS fornecedores_global,
    COUNT(*) AS itens_global, CAST(SUM(CASE WHEN ano = 2000 THEN valor_total END) AS DOUBLE) AS valor_total_2000,
    COUNT(DISTINCT CASE WHEN ano = 2000 THEN {_SUPPLIER} END) AS fornecedores_2000,
    COUNT(CASE WHEN ano = 2000 THEN 1 END) AS itens_2000
  FROM (SELECT *, row_number() OVER (
          PARTITION BY chave_de_acesso, numero, numero_produto
          ORDER BY cadeia, cnae, cnpj_emitente, codigo_cadeia, codigo_ncm_sh, cpf_emitente, criterio, data_emissao,
            desc_cnae, descricao_do_produto_servico, icp, missao, missoes, ncm_sh_tipo_de_produto, nome_missao,
            prefixo_sh, quantidade, secao_cnae, sh_correspondente, tamanho_prefixo, valor_total) AS unica
        FROM itens_cadeia) z
  WHERE unica = 1)"""
_DETAIL_KEY = (
    "codigo_cadeia, cadeia, missao, nome_missao, cnae, desc_cnae, criterio, icp, codigo_ncm_sh, "
    "ncm_sh_tipo_de_produto, descricao_do_produto_servico"
)
DETAIL = f"""detalhe AS (
  SELECT {_DETAIL_KEY}, CAST(SUM(valor_total) AS DOUBLE) AS valor_total,
    COUNT(DISTINCT {_SUPPLIER}) AS fornecedores_distintos, CAST(SUM(quantidade) AS BIGINT) AS quantidade_total,
    COUNT(*) AS registros, {_YEAR_VALUES}
  FROM itens_cadeia GROUP BY ALL ORDER BY SUM(itens_cadeia.valor_total) DESC, {_DETAIL_KEY} LIMIT 2000)"""

TYPE_LONG = f"""tipos AS (
  SELECT trim(m.tipo) AS tipo, ano, SUM(valor_total) AS valor_total,
    COUNT(DISTINCT {_SUPPLIER}) AS fornecedores_distintos, COUNT(DISTINCT chave_de_acesso) AS notas_distintas
  FROM itens JOIN mapa_a m ON m.ncm = codigo_ncm_sh WHERE {_IN_YEARS} GROUP BY 1, 2)"""
_PIVOT = ", ".join(
    f"CAST(SUM(CASE WHEN ano = {y} THEN {column} END) AS {kind}) AS {name}_{y}"
    for column, name, kind in (
        ("valor_total", "valor", "DOUBLE"),
        ("fornecedores_distintos", "fornecedores", "BIGINT"),
        ("notas_distintas", "notas", "BIGINT"),
    )
    for y in YEARS
)
TYPE_PIVOT = f"largo AS (SELECT tipo, {_PIVOT} FROM tipos GROUP BY tipo)"
YEAR_TOTALS = f"""anuais AS (
  SELECT ano, CAST(SUM(valor_total) AS DOUBLE) AS valor_total,
    COUNT(DISTINCT {_SUPPLIER}) AS fornecedores_distintos, COUNT(DISTINCT chave_de_acesso) AS notas_distintas
  FROM itens JOIN mapa_a m ON m.ncm = codigo_ncm_sh WHERE {_IN_YEARS} GROUP BY 1)"""

NORMALIZED = "regexp_replace(replace(lower({c}), '-', ' '), '\\s+', ' ')"
_ITEM_FLAGS = ", ".join(
    f"regexp_matches(d, '\\b{pattern}\\b') AS {name}_encontrado"
    for name, pattern in (("widget", "widget"), ("ring", "rings?"), ("red", "red"), ("small_rod", "small rod"))
)
KEYWORD_MART = f"""palavras AS (
  SELECT ano, codigo_ncm_sh AS ncm, trim(m.tipo) AS tipo_ncm, m.tipo IS NOT NULL AS ncm_mapeada, {_ITEM_FLAGS},
    descricao_do_produto_servico AS descricao, SUM(valor_total) AS total
  FROM (SELECT *, {NORMALIZED.format(c="descricao_do_produto_servico")} AS d FROM itens) i
    LEFT JOIN mapa_a m ON m.ncm = i.codigo_ncm_sh
  GROUP BY ALL)"""
KEYWORD_HITS = f"""achados AS (
  SELECT ano, k.chave AS tipo_de_produto, d LIKE '%' || k.chave || '%' AS chave_encontrada, {_ITEM_FLAGS},
    descricao_do_produto_servico AS descricao, SUM(valor_total) AS total
  FROM (SELECT *, {NORMALIZED.format(c="descricao_do_produto_servico")} AS d FROM itens) i
    LEFT JOIN (VALUES ('widget'), ('gear'), ('re'), ('old')) k(chave) ON i.d LIKE '%' || k.chave || '%'
  GROUP BY ALL)"""
_KEYWORD_PIVOT = ", ".join(f"CAST(SUM(CASE WHEN ano = {y} THEN total END) AS DOUBLE) AS valor_{y}" for y in YEARS)

_PCT = "round(CAST(total AS DOUBLE) / CAST({whole} AS DOUBLE), 4)"
RANK_NCM = f"""totais AS (
  SELECT ano, codigo_ncm_sh AS ncm_cod, ncm_sh_tipo_de_produto AS ncm_descr, descricao_do_produto_servico AS descricao,
    SUM(valor_total) AS total
  FROM itens GROUP BY 1, 2, 3, 4),
posicoes AS (
  SELECT *, SUM(total) OVER (PARTITION BY ano, ncm_cod) AS total_do_ncm,
    row_number() OVER (PARTITION BY ano, ncm_cod ORDER BY total DESC,
      left(md5(concat_ws('|', ncm_descr, descricao)), 3), ncm_descr, descricao) AS ranking_no_ncm
  FROM totais),
ranking AS (SELECT *, {_PCT.format(whole="total_do_ncm")} AS pct_no_ncm FROM posicoes)"""

RAW_ITEMS = """bruto_itens AS (
  SELECT lpad(CAST(l_orderkey AS VARCHAR), 44, '0') AS chave, CAST(l_orderkey AS VARCHAR) AS numero,
    strftime(l_shipdate, '%d/%m/%Y') AS emissao,
    CASE WHEN l_returnflag = 'A' THEN '***.910.688-**' ELSE lpad(CAST(l_suppkey AS VARCHAR), 14, '0') END AS id,
    CAST(l_linenumber AS VARCHAR) AS linha, p_name AS descricao,
    CASE WHEN p_size = 1 THEN '-1' ELSE CAST(l_partkey AS VARCHAR) END AS codigo,
    replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS valor,
    strftime(l_shipdate, '%Y-%m') AS periodo
  FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R') l
    JOIN part ON l_partkey = p_partkey)"""

CHECKS = """precos AS (
  SELECT chave_de_acesso, numero_produto, descricao_do_produto_servico,
    CASE WHEN numero_produto = 1 THEN 1 ELSE quantidade END AS quantidade,
    CASE numero_produto WHEN 1 THEN valor_total WHEN 2 THEN NULL ELSE valor_unitario END AS valor_unitario, valor_total
  FROM itens)"""
SIGNS = "sinais AS (SELECT DISTINCT cfop, CASE WHEN cfop < 3000 THEN -1 ELSE 1 END AS sinal FROM itens)"
PRESENCE = """presenca AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_mktsegment AS tipo_matriz,
    c_acctbal >= 5000 AS presenca_internacional, c_acctbal < 8000 AS presenca_nacional
  FROM customer WHERE c_acctbal >= 0)"""
CALENDAR = """calendario AS (
  SELECT strftime(mes, '%Y%m') AS periodo_raw, strftime(mes, '%Y-%m') AS periodo
  FROM (SELECT unnest(generate_series(date_trunc('month', MIN(l_shipdate)), date_trunc('month', MAX(l_shipdate)),
    INTERVAL 1 MONTH)) AS mes FROM lineitem) m)"""

# Patterns of the published keyword flags, as column name and pattern.
# Fixed values.
# The published keyword flags.
_PUBLISHED_FLAGS = (
    ("polietileno_encontrado", "polietileno"),
    ("policloreto de vinila_encontrado", "policloreto de vinila"),
    ("poliestireno_encontrado", "poliestireno"),
    ("polibutadieno_encontrado", "polibutadieno"),
    ("estireno_butadieno_encontrado", "estireno butadieno"),
    ("pneus_encontrado", "pneus?"),
    ("embalagem_plastica_encontrada", "embalagem plástica"),
    ("tubo_pvc_encontrado", "tubo pvc"),
    ("embalagem_pet_encontrada", "embalagem pet"),
    ("poliester_encontrado", "poliéster"),
    ("plastica_encontrada", "plástica"),
    ("plastico_encontrada", "plástico"),
    ("pe_encontrado", "pe"),
    ("pvc_encontrado", "pvc"),
    ("ps_encontrado", "ps"),
    ("br_encontrado", "br"),
    ("sbr_encontrado", "sbr"),
)


def _with(*parts: str) -> str:
    """WITH the given definitions, then the last part."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def _series(table: str, group: str, column: str, unit: str, digits: int) -> str:
    total = " + ".join(f"COALESCE({column}{y}, 0)" for y in YEARS)
    rows = " UNION ALL ".join(
        f"SELECT {group}, CAST({y} AS BIGINT) AS ano, round(COALESCE({column}{y}, 0) / {unit}, {digits}) AS valor FROM maiores"
        for y in YEARS
    )
    return f"maiores AS (SELECT * FROM {table} ORDER BY {total} DESC, {group} LIMIT 20) {rows}"


def _with_series(*parts: str, series: str) -> str:
    return "WITH " + ",\n".join(parts) + ",\n" + series


def statements() -> dict[str, str]:
    """One SQL statement per registered query."""
    found = _statements()
    cleaned = found["silver_items"]
    lines = "(SELECT strftime(l_shipdate, '%Y-%m') AS periodo, * FROM lineitem)"
    months = ("SELECT strftime(l_shipdate, '%Y-%m') AS periodo FROM lineitem"
              " UNION SELECT strftime(o_orderdate, '%Y-%m') FROM orders")
    item_months = months.replace("UNION", "WHERE year(l_shipdate) = 1998 UNION") + " WHERE year(o_orderdate) = 1998"
    columns = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber"
    return found | {
        "archive_items": cleaned,
        "archive_invoices": (
            "SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS chave, strftime(o_orderdate, '%Y-%m') AS periodo,"
            " o_orderpriority || '; \"' || o_orderstatus || '\"' || chr(10) || 'fim' AS natureza,"
            " replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS valor FROM orders"
        ),
        "archive_rejects": (
            "SELECT periodo, 'itens: expected 8 fields, found 9' AS motivo,"
            f" CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END) AS BIGINT) AS n FROM {lines} l WHERE l_linenumber = 1 GROUP BY 1"
            f" UNION ALL SELECT '20' || substr(periodo, 3), 'expected 3 files, found 2', 1 FROM ({item_months}) m"
        ),
        "archive_row_counts": (
            f"SELECT 'itens' AS tabela, COUNT(*) AS n FROM ({cleaned}) c"
            " UNION ALL SELECT 'nf', COUNT(*) FROM orders WHERE o_orderkey <> 7"
            " UNION ALL SELECT 'eventos', 2 * COUNT(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey <> 7"
            f" UNION ALL SELECT 'meses', COUNT(*) FROM ({months}) m"
        ),
        "stream_load": (
            f"SELECT periodo, COUNT(*) AS n, CAST(SUM(CAST(valor_total AS DECIMAL(18,2))) AS DOUBLE) AS valor_total FROM ({cleaned}) c"
            " WHERE periodo >= '1998-05' OR cpf_emitente IS NOT NULL GROUP BY 1"
        ),
        "regional_csv": found["regional_text"],
        "plain_csv": (
            f"SELECT {columns}, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS valor,"
            " regexp_replace(regexp_replace(CAST(CAST(l_discount AS DECIMAL(38,10)) AS VARCHAR), '0+$', ''), '\\.$', '.0')"
            " AS desconto, CASE WHEN l_quantity > 25 THEN 'true' WHEN l_quantity <= 25 THEN 'false' END AS acima,"
            " '[' || concat_ws(', ', l_returnflag, l_linestatus) || ']' AS marcas FROM lineitem"
        ),
        "header_years": _with(ITEMS, f"SELECT DISTINCT ano FROM itens WHERE {_IN_YEARS}"),
    }


def _statements() -> dict[str, str]:
    pivoted = (ITEMS, GROUP_A, TYPE_LONG, TYPE_PIVOT)
    document = NORMALIZED.format(c="text")
    keyword = NORMALIZED.format(c="trim('  ' || text || ' ')")
    flags = ", ".join(
        f"regexp_matches({document}, '\\b{word}\\b') AS tem_{word}" for word in ("la", "que", "re", "ou", "et")
    )
    published = ", ".join(
        f"regexp_matches({document}, '\\b{pattern}\\b') AS \"{name}\"" for name, pattern in _PUBLISHED_FLAGS
    )
    category = " ".join(
        f"WHEN regexp_matches(lower(descricao_do_produto_servico), '\\b{word}\\b') THEN '{word}'"
        for word in ("widget", "gear", "bolt", "ring", "rod")
    )
    by_code = _with(
        ITEMS, RANK_NCM,
        "SELECT ano, ncm_cod, ncm_descr, descricao, CAST(total AS DOUBLE) AS total,"
        " CAST(total_do_ncm AS DOUBLE) AS total_do_ncm, ranking_no_ncm, pct_no_ncm,"
        " CAST(SUM(CAST(pct_no_ncm AS DECIMAL(10,4))) OVER (PARTITION BY ano, ncm_cod) AS DOUBLE)"
        " AS pct_total_das_descricoes_exibidas FROM ranking",
    )
    by_type = _with(
        ITEMS, GROUP_A,
        "totais AS (SELECT ano, trim(m.tipo) AS tipo_de_produto, codigo_ncm_sh AS ncm_cod,"
        " ncm_sh_tipo_de_produto AS ncm_descr, descricao_do_produto_servico AS descricao, SUM(valor_total) AS total"
        " FROM itens JOIN mapa_a m ON m.ncm = codigo_ncm_sh GROUP BY 1, 2, 3, 4, 5)",
        "z AS (SELECT *, SUM(total) OVER (PARTITION BY ano, tipo_de_produto) AS soma FROM totais)",
        "SELECT ano, tipo_de_produto, ncm_cod, ncm_descr, descricao, CAST(total AS DOUBLE) AS total,"
        " CAST(soma AS DOUBLE) AS total_do_tipo_de_produto,"
        " row_number() OVER (PARTITION BY ano, tipo_de_produto ORDER BY z.total DESC,"
        " left(md5(concat_ws('|', ncm_cod, ncm_descr, descricao)), 3), ncm_cod, ncm_descr, descricao)"
        f" AS ranking_no_tipo_de_produto, {_PCT.format(whole='soma')} AS pct_no_tipo_de_produto FROM z",
    )
    return {
        "period_calendar": _with(CALENDAR, "SELECT * FROM calendario"),
        "period_gaps": _with(
            CALENDAR, INVOICES, "SELECT periodo FROM calendario WHERE periodo NOT IN (SELECT periodo FROM nf)"
        ),
        "periods_loaded": _with(ITEMS, "SELECT DISTINCT periodo FROM itens"),
        "incremental_periods": _with(
            ITEMS, INVOICES,
            "SELECT periodo, COUNT(*) AS n FROM itens WHERE periodo NOT IN (SELECT periodo FROM nf) GROUP BY 1",
        ),
        "previous_period": _with(
            ITEMS,
            "SELECT DISTINCT periodo, strftime(data_emissao - INTERVAL 1 MONTH, '%Y%m') AS anterior FROM itens",
        ),
        "union_periods": _with(
            ITEMS, INVOICES,
            "SELECT periodo, COUNT(*) AS n, COUNT(quantidade) AS n_itens, CAST(SUM(quantidade) AS BIGINT) AS quantidade FROM"
            " (SELECT periodo, quantidade FROM itens UNION ALL SELECT periodo, NULL FROM nf) u GROUP BY 1",
        ),
        "clean_split_taxid": _with(
            DIRTY,
            "SELECT l_orderkey, l_linenumber, CASE WHEN cpf_cnpj LIKE '%*%' THEN cpf_cnpj END AS cpf,"
            " CASE WHEN cpf_cnpj NOT LIKE '%*%' THEN cpf_cnpj END AS cnpj FROM bruto",
        ),
        "clean_typed": _with(
            DIRTY,
            f"SELECT l_orderkey, l_linenumber, {_DATE_TEXT.format(c='data_txt')} AS data_txt,"
            f" CAST({_DECIMAL.format(c='valor_txt')} AS DOUBLE) AS valor_txt, {_INT.format(c='qtd_txt')} AS qtd_txt,"
            f" CAST({_DECIMAL.format(c='cpf_cnpj')} AS DOUBLE) AS cpf_cnpj FROM bruto",
        ),
        "parse_br_datetime": _with(
            DIRTY, f"SELECT l_orderkey, l_linenumber, {_DATE_TEXT.format(c='data_txt')} AS data FROM bruto"
        ),
        "parse_br_int": _with(
            DIRTY, f"SELECT l_orderkey, l_linenumber, {_INT.format(c='qtd_txt')} AS quantidade FROM bruto"
        ),
        "parse_br_decimal": _with(
            DIRTY,
            f"SELECT l_orderkey, l_linenumber, CAST({_DECIMAL.format(c='valor_txt')} AS DOUBLE) AS valor,"
            f" CAST({_DECIMAL.format(c='valor_txt')} AS DOUBLE) * CASE WHEN l_linenumber = 5 THEN -1 ELSE 1 END"
            " AS valor_com_sinal FROM bruto",
        ),
        "ncm_pad": (
            "SELECT p_partkey, codigo, CASE WHEN codigo = '-1' THEN '00000000' ELSE lpad(codigo, 8, '0') END AS codigo_8"
            " FROM (SELECT p_partkey, CASE WHEN p_size = 1 THEN '-1' ELSE CAST(p_partkey AS VARCHAR) END AS codigo FROM part) p"
        ),
        "exclude_keys": _with(
            ITEMS,
            "SELECT periodo, COUNT(*) AS n FROM"
            " (SELECT periodo, CASE WHEN numero_produto <> 7 THEN chave_de_acesso END AS chave FROM itens) k"
            " WHERE chave <> lpad('7', 44, '0') GROUP BY 1",
        ),
        "keyed_repeated_keys": _with(
            ITEMS,
            "SELECT chave_de_acesso, COUNT(*) AS registros, CAST(SUM(valor_total) AS DOUBLE) AS total FROM itens"
            " GROUP BY 1 HAVING COUNT(*) > 1",
        ),
        "keyed_repeated_rows": _with(
            ITEMS,
            "SELECT periodo, COUNT(*) AS n_antes, COUNT(DISTINCT (chave_de_acesso, numero_produto)) AS n_depois"
            " FROM itens GROUP BY 1",
        ),
        "dedup_rows": _with(
            ITEMS,
            "SELECT periodo, COUNT(*) AS n_antes, COUNT(DISTINCT (chave_de_acesso, numero_produto)) AS n_depois"
            " FROM itens GROUP BY 1",
        ),
        "silver_items": _with(
            RAW_ITEMS,
            f"SELECT DISTINCT chave AS chave_de_acesso, {_INT.format(c='numero')} AS numero,"
            f" {_DATE_TEXT.format(c='emissao')} AS data_emissao, CASE WHEN id LIKE '%*%' THEN id END AS cpf_emitente,"
            f" CAST({_DECIMAL.format(c='''CASE WHEN id NOT LIKE '%*%' THEN id END''')} AS DOUBLE) AS cnpj_emitente,"
            f" {_INT.format(c='linha')} AS numero_produto, descricao AS descricao_do_produto_servico,"
            " CASE WHEN codigo = '-1' THEN '00000000' ELSE lpad(codigo, 8, '0') END AS codigo_ncm_sh,"
            f" CAST({_DECIMAL.format(c='valor')} AS DOUBLE) AS valor_total, periodo FROM bruto_itens"
            " WHERE chave <> lpad('7', 44, '0')",
        ),
        "normalize_text": f"SELECT doc_id, length({document}) AS tamanho, md5({document}) AS resumo FROM documents",
        "normalize_keyword": f"SELECT doc_id, length({keyword}) AS tamanho, md5({keyword}) AS resumo FROM documents",
        "mapping_trimmed": "SELECT DISTINCT trim(' ' || p_brand || '  ') AS tipo, trim(' ' || p_type) AS ncm FROM part",
        "regional_text": (
            "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,"
            " replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS valor,"
            " regexp_replace(regexp_replace(replace(CAST(CAST(l_discount AS DECIMAL(38,10)) AS VARCHAR), '.', ','), '0+$', ''),"
            " ',$', ',0') AS desconto, CASE WHEN l_quantity > 25 THEN 'True' WHEN l_quantity <= 25 THEN 'False' END AS acima,"
            " '[' || concat_ws(', ', l_returnflag, l_linestatus) || ']' AS marcas FROM lineitem"
        ),
        "keyword_flags": f"SELECT doc_id, {flags}, {published} FROM documents",
        "product_category": _with(
            ITEMS,
            f"SELECT ano, CASE {category} ELSE 'other' END AS produto_identificado, COUNT(*) AS qtd_itens,"
            " CAST(SUM(valor_total) AS DOUBLE) AS valor_total, MIN(chave_de_acesso) AS chave_exemplo,"
            " MIN(descricao_do_produto_servico) AS produto_exemplo FROM itens GROUP BY 1, 2",
        ),
        "like_any_share": _with(
            INVOICES,
            "SELECT ano, natureza_da_operacao, CAST(SUM(valor_nota_fiscal) AS DOUBLE) AS valor, COUNT(*) AS qtd_notas,"
            " CAST(total AS DOUBLE) AS total,"
            " round(CAST(SUM(valor_nota_fiscal) AS DOUBLE) / CAST(total AS DOUBLE), 4) AS valor_pct"
            " FROM nf, (SELECT SUM(valor_nota_fiscal) AS total FROM nf) t"
            " WHERE ano = 1998 AND (lower(natureza_da_operacao) LIKE '%urgent%' OR lower(natureza_da_operacao) LIKE '%high%')"
            " GROUP BY ano, natureza_da_operacao, total",
        ),
        "keyword_filter_any": _with(
            ITEMS, RANK_NCM,
            "SELECT regexp_matches(lower(ncm_descr), 'widget|gizmo|promo') AS ncm_contem_palavras_chave,"
            " regexp_matches(lower(descricao), 'widget|gizmo|promo') AS produto_contem_palavras_chave,"
            " CASE WHEN ano = 2001 THEN '2001 (partial)' ELSE CAST(ano AS VARCHAR) END AS ano, ncm_cod, ncm_descr,"
            " descricao, CAST(total AS DOUBLE) AS total, CAST(total_do_ncm AS DOUBLE) AS total_do_ncm, ranking_no_ncm,"
            " pct_no_ncm FROM ranking WHERE regexp_matches(lower(ncm_descr), 'widget|gizmo|promo')"
            " OR regexp_matches(lower(descricao), 'widget|gizmo|promo')",
        ),
        "year_label": _with(
            ITEMS,
            "SELECT CASE WHEN ano = 2001 THEN '2001 (partial)' ELSE CAST(ano AS VARCHAR) END AS label, COUNT(*) AS n"
            " FROM itens GROUP BY 1",
        ),
        "key_lookup": _with(
            ITEMS,
            "SELECT chave_de_acesso, numero_produto, quantidade, CAST(valor_total AS DOUBLE) AS valor_total, codigo_ncm_sh"
            " FROM itens WHERE chave_de_acesso = lpad('100', 44, '0')",
        ),
        "qty_price_consistency": _with(
            ITEMS, CHECKS,
            "SELECT quantidade * valor_unitario = valor_total AS consistente, COUNT(*) AS qtd_itens FROM precos GROUP BY 1",
        ),
        "inconsistent_sample": _with(
            ITEMS, CHECKS,
            "SELECT chave_de_acesso, numero_produto, descricao_do_produto_servico, quantidade,"
            " CAST(valor_unitario AS DOUBLE) AS valor_unitario, CAST(valor_total AS DOUBLE) AS valor_total,"
            " round(CAST(valor_total AS DOUBLE) / CAST(valor_unitario AS DOUBLE), 4) AS qtd_inferida,"
            " CAST(quantidade * valor_unitario AS DOUBLE) AS valor_calculado FROM precos p"
            " WHERE quantidade * valor_unitario <> valor_total ORDER BY chave_de_acesso, numero_produto,"
            " descricao_do_produto_servico, quantidade, p.valor_unitario, p.valor_total LIMIT 100",
        ),
        "dup_key_count": _with(
            ITEMS,
            "SELECT COUNT(*) AS chaves_repetidas FROM (SELECT chave_de_acesso FROM itens GROUP BY 1 HAVING COUNT(*) > 1) k",
        ),
        "dup_keys": _with(
            ITEMS,
            "SELECT chave_de_acesso, COUNT(*) AS registros, CAST(SUM(valor_total) AS DOUBLE) AS total FROM itens"
            " GROUP BY 1 HAVING COUNT(*) > 1",
        ),
        "join_ncm_exact": _with(
            ITEMS, GROUP_A,
            "SELECT trim(tipo) AS tipo, tipo IS NOT NULL AS mapeada, COUNT(*) AS n, CAST(SUM(valor_total) AS DOUBLE) AS valor"
            " FROM itens JOIN mapa_a ON ncm = codigo_ncm_sh GROUP BY 1, 2",
        ),
        "join_ncm_left": _with(
            ITEMS, GROUP_A,
            "SELECT trim(tipo) AS tipo, tipo IS NOT NULL AS mapeada, COUNT(*) AS n, CAST(SUM(valor_total) AS DOUBLE) AS valor"
            " FROM itens LEFT JOIN mapa_a ON ncm = codigo_ncm_sh GROUP BY 1, 2",
        ),
        "join_prefix_any": _with(
            ITEMS, CODE_GROUPS,
            "SELECT ncm_cod, grupo, COUNT(*) AS n, CAST(SUM(valor_total) AS DOUBLE) AS valor FROM itens LEFT JOIN grupos"
            " ON codigo_ncm_sh = ncm_cod OR left(codigo_ncm_sh, 6) = ncm_cod OR left(codigo_ncm_sh, 4) = ncm_cod"
            " GROUP BY 1, 2",
        ),
        "join_chain_dedup": _with(
            CHAIN_ITEMS,
            "SELECT codigo_cadeia, CAST(tamanho_prefixo AS BIGINT) AS tamanho_prefixo, COUNT(*) AS n,"
            " CAST(SUM(valor_total) AS DOUBLE) AS valor FROM itens_cadeia GROUP BY 1, 2",
        ),
        "join_keyword_contains": (
            "SELECT k.chave, COUNT(*) AS n, CAST(SUM(n_chars) AS BIGINT) AS caracteres"
            f" FROM (SELECT *, {document} AS d FROM documents) t"
            " LEFT JOIN (VALUES ('la'), ('eaux'), ('que'), ('tion'), ('zzz')) k(chave) ON t.d LIKE '%' || k.chave || '%'"
            " GROUP BY 1"
        ),
        "join_keyword_table": (
            "SELECT agulha, CAST(length(agulha) AS BIGINT) AS tamanho, COUNT(*) AS n, CAST(SUM(n_chars) AS BIGINT) AS caracteres"
            " FROM (SELECT lower(text) AS d, n_chars FROM documents) t LEFT JOIN (SELECT DISTINCT w AS agulha FROM"
            " (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM benchmark) WHERE w <> '') k"
            " ON t.d LIKE '%' || k.agulha || '%' GROUP BY 1, 2"
        ),
        "join_supplier_root": _with(
            INVOICES, PRESENCE,
            "SELECT ano AS ano_emissao, p.cnpj_basico IS NOT NULL AS cnpj_disponivel, tipo_matriz, presenca_internacional,"
            " presenca_nacional, COUNT(*) AS qtd_notas, CAST(SUM(valor_nota_fiscal) AS DOUBLE) AS total_pago,"
            " MIN(cpf_cnpj_emitente) AS cnpj_exemplo, MIN(chave_de_acesso) AS chave_acesso_exemplo"
            " FROM nf LEFT JOIN presenca p ON left(cpf_cnpj_emitente, 8) = p.cnpj_basico GROUP BY 1, 2, 3, 4, 5",
        ),
        "value_by_year": _with(
            INVOICES, "SELECT ano, CAST(SUM(valor_nota_fiscal) AS DOUBLE) AS valor FROM nf GROUP BY 1"
        ),
        "value_by_uf": _with(
            INVOICES,
            "SELECT 'uf_emitente' AS lado, uf_emitente AS uf, CAST(SUM(valor_nota_fiscal) AS DOUBLE) AS valor FROM nf"
            " WHERE ano = 1998 GROUP BY 1, 2 UNION ALL SELECT 'uf_destinatario', uf_destinatario,"
            " CAST(SUM(valor_nota_fiscal) AS DOUBLE) FROM nf WHERE ano = 1998 GROUP BY 1, 2",
        ),
        "invoice_counts": _with(
            ITEMS,
            "SELECT COUNT(*) AS qtd_notas, COUNT(DISTINCT chave_de_acesso) AS qtd_notas_distintas FROM itens"
            " WHERE ano IN (1997, 1998, 1999)",
        ),
        "signed_totals": _with(
            ITEMS, SIGNS,
            "SELECT CAST(SUM(valor_total) AS DOUBLE) AS valor_total,"
            " CAST(SUM(valor_total * sinal) AS DOUBLE) AS valor_total_com_descontos,"
            " CAST(SUM(sinal) AS BIGINT) AS qtd_itens_comprados, COUNT(*) AS qtd_itens"
            " FROM itens LEFT JOIN sinais USING (cfop) WHERE ano = 1998",
        ),
        "top_ncm_signed": _with(
            ITEMS, SIGNS,
            "SELECT ncm_sh_tipo_de_produto AS ncm, COUNT(*) AS qtd_itens,"
            " CAST(SUM(quantidade * sinal) AS BIGINT) AS qtd_com_sinal,"
            " CAST(SUM(valor_total * sinal) AS DOUBLE) AS total_com_sinal"
            " FROM itens LEFT JOIN sinais USING (cfop) WHERE ano = 1998 GROUP BY 1",
        ),
        "cfop_first_digit": _with(
            ITEMS, "SELECT ano, cfop // 1000 AS cfop_primeiro_digito, COUNT(*) AS qtd_itens FROM itens GROUP BY 1, 2"
        ),
        "cfop_foreign_detail": _with(
            ITEMS,
            "SELECT ano, cfop, destino_da_operacao, codigo_ncm_sh, COUNT(*) AS qtd_itens,"
            " CAST(SUM(valor_total) AS DOUBLE) AS valor_total, MIN(chave_de_acesso) AS chave_acesso_exemplo FROM itens"
            " WHERE cfop // 1000 IN (3, 7) AND destino_da_operacao = '3 - OPERAÇÃO COM EXTERIOR' GROUP BY 1, 2, 3, 4",
        ),
        "supplier_prefix_count": _with(
            INVOICES,
            "SELECT cpf_cnpj_emitente, COUNT(*) AS qtd_notas FROM nf WHERE cpf_cnpj_emitente LIKE '0000000%' GROUP BY 1",
        ),
        "supplier_profile": _with(
            INVOICES,
            "SELECT ano, razao_social_emitente, uf_emitente, uf_destinatario, COUNT(*) AS qtd_notas,"
            " COUNT(DISTINCT chave_de_acesso) AS qtd_notas_distintas, CAST(SUM(valor_nota_fiscal) AS DOUBLE) AS valor_total,"
            " MIN(chave_de_acesso) AS chave_acesso_exemplo FROM nf WHERE left(cpf_cnpj_emitente, 8) = '00000100'"
            " GROUP BY 1, 2, 3, 4",
        ),
        "supplier_totals": _with(
            INVOICES,
            "SELECT COUNT(DISTINCT chave_de_acesso) AS qtd_notas_distintas,"
            " CAST(SUM(valor_nota_fiscal) AS DOUBLE) AS valor_total, MIN(chave_de_acesso) AS chave_acesso_exemplo"
            " FROM nf WHERE left(cpf_cnpj_emitente, 8) = '00000100'",
        ),
        "code_descriptions": _with(
            ITEMS,
            "SELECT ncm_sh_tipo_de_produto AS ncm_descr FROM itens WHERE ano = 2000 AND codigo_ncm_sh = '39010001' GROUP BY 1",
        ),
        "uf_rank_year": _with(
            ITEMS,
            "SELECT ano, uf_destinatario AS uf_destino, round(CAST(SUM(valor_total) AS DOUBLE) / 1e6, 6) AS valor_total_milhoes,"
            " row_number() OVER (PARTITION BY ano ORDER BY SUM(valor_total) DESC, uf_destinatario) AS ranking_no_ano"
            " FROM itens GROUP BY 1, 2",
        ),
        "type_year_long": _with(
            ITEMS, GROUP_A, TYPE_LONG,
            "SELECT tipo, ano, CAST(valor_total AS DOUBLE) AS valor_total, fornecedores_distintos, notas_distintas FROM tipos",
        ),
        "incremental_type_year": _with(
            ITEMS, GROUP_A, TYPE_LONG,
            "SELECT tipo, ano, CAST(valor_total AS DOUBLE) AS valor_total, fornecedores_distintos, notas_distintas FROM tipos",
        ),
        "incremental_totals_year": _with(ITEMS, GROUP_A, YEAR_TOTALS, "SELECT * FROM anuais"),
        "incremental_items": _with(
            ITEMS, GROUP_A,
            "SELECT ano, codigo_ncm_sh AS ncm, trim(tipo) AS tipo_ncm, tipo IS NOT NULL AS ncm_mapeada,"
            " descricao_do_produto_servico AS descricao, CAST(SUM(valor_total) AS DOUBLE) AS total"
            " FROM itens LEFT JOIN mapa_a ON ncm = codigo_ncm_sh WHERE ano = 2000 GROUP BY ALL",
        ),
        "type_table": _with(*pivoted, f"SELECT tipo, {', '.join(f'valor_{y}' for y in YEARS)} FROM largo WHERE tipo = 'Brand#7'"),
        "type_year_pivot": _with(*pivoted, "SELECT * FROM largo"),
        "type_totals_year": _with(ITEMS, GROUP_A, YEAR_TOTALS, "SELECT * FROM anuais"),
        "items_group_a": _with(
            ITEMS, GROUP_A,
            "SELECT ano, codigo_ncm_sh AS ncm, trim(tipo) AS tipo_ncm, tipo IS NOT NULL AS ncm_mapeada,"
            " descricao_do_produto_servico AS descricao, CAST(SUM(valor_total) AS DOUBLE) AS total"
            " FROM itens LEFT JOIN mapa_a ON ncm = codigo_ncm_sh WHERE ano = 2000 GROUP BY ALL",
        ),
        "distinct_types": _with(GROUP_A, "SELECT DISTINCT trim(tipo) AS tipo FROM mapa_a"),
        "kpi_type": _with(
            *pivoted, YEAR_TOTALS,
            "SELECT '*' AS tipo, valor_total AS total, CAST(fornecedores_distintos AS DOUBLE) AS fornecedores,"
            " CAST(notas_distintas AS DOUBLE) AS notas FROM anuais WHERE ano = 2000 UNION ALL"
            " SELECT 'Brand#7', SUM(COALESCE(valor_2000, 0)), CAST(SUM(fornecedores_2000) AS DOUBLE),"
            " CAST(SUM(notas_2000) AS DOUBLE) FROM largo WHERE tipo = 'Brand#7'",
        ),
        "top20_series": _with_series(*pivoted, series=_series("largo", "tipo", "valor_", "1e6", 6)),
        "chain_summary": _with(CHAIN_ITEMS, SUMMARY, "SELECT * FROM resumo"),
        "chain_detail_topk": _with(CHAIN_ITEMS, DETAIL, "SELECT * FROM detalhe"),
        "chain_cnae_report": _with(
            CHAIN_CNAE_ITEMS,
            "SELECT missao, nome_missao, codigo_cadeia, cadeia, cnae, desc_cnae, criterio, missoes, icp, secao_cnae,"
            f" sh_correspondente, CAST(SUM(valor_total) AS DOUBLE) AS valor_total, COUNT(DISTINCT {_SUPPLIER}) AS fornecedores,"
            " COUNT(DISTINCT chave_de_acesso) AS notas, COUNT(DISTINCT chave_de_acesso || '-' || CAST(numero AS VARCHAR)"
            f" || '-' || CAST(numero_produto AS VARCHAR)) AS itens, {_YEAR_VALUES} FROM itens_cadeia GROUP BY"
            " missao, nome_missao, codigo_cadeia, cadeia, cnae, desc_cnae, criterio, missoes, icp, secao_cnae,"
            " sh_correspondente",
        ),
        "chain_global_totals": _with(CHAIN_ITEMS, GLOBAL, "SELECT * FROM globais"),
        "kpi_global": _with(
            CHAIN_ITEMS, GLOBAL, SUMMARY,
            "SELECT valor_total_2000 AS total, CAST(fornecedores_2000 AS DOUBLE) AS fornecedores,"
            " CAST(itens_2000 AS DOUBLE) AS itens, (SELECT CAST(COUNT(*) AS DOUBLE) FROM resumo) AS ncadeias FROM globais",
        ),
        "kpi_chain": _with(
            CHAIN_ITEMS, SUMMARY,
            "SELECT COALESCE(SUM(valor_2000), 0) AS total, CAST(COALESCE(SUM(fornecedores_2000), 0) AS DOUBLE) AS fornecedores,"
            " CAST(COALESCE(SUM(quantidade_itens_2000), 0) AS DOUBLE) AS itens, CAST(COUNT(*) AS DOUBLE) AS ncadeias"
            " FROM resumo WHERE codigo_cadeia = 'C1'",
        ),
        "chain_table_filtered": _with(
            CHAIN_ITEMS, DETAIL.replace(" LIMIT 2000)", ")"),
            "SELECT codigo_cadeia, cnae, codigo_ncm_sh, descricao_do_produto_servico, valor_total FROM detalhe"
            " WHERE codigo_cadeia = 'C1'",
        ),
        "chain_table_by_folder": _with(
            CHAIN_ITEMS, DETAIL.replace(" LIMIT 2000)", ")"),
            "SELECT codigo_cadeia, cnae, codigo_ncm_sh, descricao_do_produto_servico, valor_total FROM detalhe"
            " WHERE codigo_cadeia = 'C1'",
        ),
        "chain_detail_per_chain": _with(
            CHAIN_ITEMS, DETAIL.replace(" LIMIT 2000)", ")"),
            "SELECT codigo_cadeia, cnae, codigo_ncm_sh, descricao_do_produto_servico, valor_total, registros FROM (SELECT *,"
            f" row_number() OVER (PARTITION BY codigo_cadeia ORDER BY valor_total DESC, {_DETAIL_KEY}) AS lugar FROM detalhe)"
            " WHERE lugar <= 100",
        ),
        "cnae_table": _with(
            CHAIN_CNAE_ITEMS,
            f"SELECT codigo_cadeia, cnae, CAST(SUM(valor_total) AS DOUBLE) AS valor_total, COUNT(DISTINCT {_SUPPLIER}) AS fornecedores,"
            " COUNT(DISTINCT chave_de_acesso) AS notas, COUNT(DISTINCT chave_de_acesso || '-' || CAST(numero AS VARCHAR)"
            " || '-' || CAST(numero_produto AS VARCHAR)) AS itens FROM itens_cadeia WHERE codigo_cadeia = 'C1' GROUP BY"
            " missao, nome_missao, codigo_cadeia, cadeia, cnae, desc_cnae, criterio, missoes, icp, secao_cnae,"
            " sh_correspondente",
        ),
        "chain_labels": _with(
            CHAIN_ITEMS, SUMMARY, "SELECT DISTINCT codigo_cadeia || ' — ' || cadeia AS label, codigo_cadeia AS value FROM resumo"
        ),
        "chain_series": _with_series(CHAIN_ITEMS, SUMMARY, series=_series("resumo", "cadeia", "valor_", "1e9", 9)),
        "keyword_mart": _with(ITEMS, GROUP_A, KEYWORD_MART, "SELECT * REPLACE (CAST(total AS DOUBLE) AS total) FROM palavras"),
        "keyword_pivot": _with(
            ITEMS, GROUP_A, KEYWORD_MART,
            f"SELECT COALESCE(tipo_ncm, 'Não Mapeado') AS grupo, {_KEYWORD_PIVOT} FROM palavras WHERE widget_encontrado GROUP BY 1",
        ),
        "keyword_series": _with_series(
            ITEMS, GROUP_A, KEYWORD_MART,
            f"por_grupo AS (SELECT COALESCE(tipo_ncm, 'Não Mapeado') AS grupo, {_KEYWORD_PIVOT} FROM palavras"
            " WHERE ring_encontrado GROUP BY 1)",
            series=_series("por_grupo", "grupo", "valor_", "1e6", 6),
        ),
        "keyword_hits": _with(ITEMS, KEYWORD_HITS, "SELECT * REPLACE (CAST(total AS DOUBLE) AS total) FROM achados"),
        "keyword_hits_ranked": _with(
            ITEMS, KEYWORD_HITS,
            "z AS (SELECT *, SUM(total) OVER (PARTITION BY ano, tipo_de_produto) AS soma FROM achados)",
            "SELECT * EXCLUDE (soma) REPLACE (CAST(total AS DOUBLE) AS total),"
            " CAST(soma AS DOUBLE) AS total_do_tipo_de_produto,"
            " row_number() OVER (PARTITION BY ano, tipo_de_produto ORDER BY z.total DESC, left(md5(descricao), 3),"
            f" descricao) AS ranking_no_tipo_de_produto, {_PCT.format(whole='soma')} AS pct_no_grupo FROM z",
        ),
        "rank_within_ncm": by_code,
        "rank_within_ncm_sliced": by_code,
        "rank_within_type": by_type,
        "rank_within_type_sliced": by_type,
        "prefix_group_buyer": _with(
            ITEMS, CODE_GROUPS,
            "SELECT ano, COALESCE(grupo, 'TODOS OS DEMAIS PRODUTOS') AS grupo, nome_destinatario AS orgao_comprador,"
            " COALESCE(array_to_string(list_sort(list_distinct(list(CASE WHEN ncm_cod IS NOT NULL THEN codigo_ncm_sh END))), ','), '')"
            " AS ncms_encontradas, CAST(SUM(valor_total) AS DOUBLE) AS total, COUNT(*) AS qtd_nfs"
            " FROM itens LEFT JOIN grupos"
            " ON codigo_ncm_sh = ncm_cod OR left(codigo_ncm_sh, 6) = ncm_cod OR left(codigo_ncm_sh, 4) = ncm_cod"
            " GROUP BY 1, 2, 3",
        ),
    }
