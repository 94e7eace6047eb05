"""The driver's tables dressed as invoice data.

Each view takes the columns a query needs and joins only the tables those come from: every foreign
key of the source tables has its row, so a join that adds no column changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM_COLUMNS = (
    "chave_de_acesso", "numero", "numero_produto", "data_emissao", "codigo_ncm_sh", "valor_total",
    "cnpj_emitente", "cpf_emitente", "ncm_sh_tipo_de_produto", "descricao_do_produto_servico", "quantidade",
)
# Product codes are eight digits, so their number is bounded however many parts there are.
_CODE = "lpad(cast(39000000 + ({part} % 600000) * 100 + {line} as string), 8, '0')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Item lines of invoices."""
    expressions = {
        "chave_de_acesso": "lpad(cast(l_orderkey as string), 44, '0')",
        "numero": "l_orderkey",
        "numero_produto": "cast(l_linenumber as bigint)",
        "data_emissao": "l_shipdate",
        "periodo": "date_format(l_shipdate, 'yyyy-MM')",
        "cnpj_emitente": "case when s_acctbal >= 0 then cast(100000000000 + l_suppkey as decimal(18,2)) end",
        "cpf_emitente": (
            "case when s_acctbal < 0 then concat('***.', lpad(cast(l_suppkey as string), 3, '0'), '.***-**') end"
        ),
        "cnpj_destinatario": "cast(200000000000 + o_custkey as decimal(18,2))",
        "nome_destinatario": "c_name",
        "uf_destinatario": "n_name",
        "destino_da_operacao": "case l_returnflag when 'R' then '3 - OPERAÇÃO COM EXTERIOR' else '1 - OPERAÇÃO INTERNA' end",
        "codigo_ncm_sh": _CODE.format(part="l_partkey", line="l_linenumber"),
        "ncm_sh_tipo_de_produto": "p_type",
        "descricao_do_produto_servico": "p_name",
        "cfop": "cast(l_linenumber * 1000 + 101 as bigint)",
        "quantidade": "cast(l_quantity as bigint)",
        "valor_unitario": "cast(p_retailprice as decimal(18,2))",
        "valor_total": "cast(l_extendedprice as decimal(18,2))",
    }
    chosen = {name: expressions[name] for name in columns or expressions}
    text = " ".join(chosen.values())
    df = table(spark, sf_dir, "lineitem")
    if "p_" in text:
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "s_acctbal" in text:
        df = df.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    if "o_" in text or "c_" in text or "n_name" in text:
        df = df.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if "c_name" in text or "n_name" in text:
        df = df.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if "n_name" in text:
        df = df.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return df.select(*[F.expr(expression).alias(name) for name, expression in chosen.items()])


def invoices(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Invoice headers."""
    expressions = {
        "chave_de_acesso": "lpad(cast(o_orderkey as string), 44, '0')",
        "data_emissao": "o_orderdate",
        "periodo": "date_format(o_orderdate, 'yyyy-MM')",
        "natureza_da_operacao": "o_orderpriority",
        "cpf_cnpj_emitente": "concat(lpad(cast(o_custkey as string), 8, '0'), '000195')",
        "razao_social_emitente": "c_name",
        "uf_emitente": "c_mktsegment",
        "uf_destinatario": "n_name",
        "valor_nota_fiscal": "cast(o_totalprice as decimal(18,2))",
    }
    chosen = {name: expressions[name] for name in columns or expressions}
    text = " ".join(chosen.values())
    df = table(spark, sf_dir, "orders")
    if "c_" in text or "n_name" in text:
        df = df.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if "n_name" in text:
        df = df.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return df.select(*[F.expr(expression).alias(name) for name, expression in chosen.items()])


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item fields as the text of a raw file: odd dates, currency signs, thousands, masked ids."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "concat(date_format(l_shipdate, 'dd/MM/yyyy'),"
        " case l_linenumber when 2 then ' 14:30:00' when 3 then ' x' else '' end) as data_txt",
        "concat(case l_linenumber when 4 then 'R$ ' when 5 then '-' else '' end,"
        " replace(cast(cast(l_extendedprice as decimal(18,2)) as string), '.', ',')) as valor_txt",
        "case l_linenumber when 1 then '1.234' when 2 then concat(cast(cast(l_quantity as bigint) as string), ',5000')"
        " when 3 then 'abc' else cast(cast(l_quantity as bigint) as string) end as qtd_txt",
        "case when l_returnflag = 'A' then '***.910.688-**' else lpad(cast(l_suppkey as string), 14, '0') end as cpf_cnpj",
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows under the raw file's headers; returned lines are delivered twice."""
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.unionByName(lines.filter("l_returnflag = 'R'"))
    part = table(spark, sf_dir, "part")
    expressions = {
        "CHAVE DE ACESSO": "lpad(cast(l_orderkey as string), 44, '0')",
        "NÚMERO": "cast(l_orderkey as string)",
        "DATA EMISSÃO": "date_format(l_shipdate, 'dd/MM/yyyy')",
        "CPF/CNPJ Emitente": (
            "case when l_returnflag = 'A' then '***.910.688-**' else lpad(cast(l_suppkey as string), 14, '0') end"
        ),
        "NÚMERO PRODUTO": "cast(l_linenumber as string)",
        "DESCRIÇÃO DO PRODUTO/SERVIÇO": "p_name",
        "CÓDIGO NCM/SH": "case when p_size = 1 then '-1' else cast(l_partkey as string) end",
        "VALOR TOTAL": "replace(cast(cast(l_extendedprice as decimal(18,2)) as string), '.', ',')",
        "periodo": "date_format(l_shipdate, 'yyyy-MM')",
    }
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(*[F.expr(expression).alias(name) for name, expression in expressions.items()])


def group_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact codes with a type that has a trailing space."""
    code = F.expr(_CODE.format(part="p_partkey", line="1"))
    chosen = table(spark, sf_dir, "part").filter("p_type in ('PROMO', 'SMALL')")
    return chosen.groupBy(code.alias("ncm")).agg(F.min(F.expr("concat(p_brand, ' ')")).alias("tipo"))


def code_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of eight, six and four digits with their group."""
    code = _CODE.format(part="p_partkey", line="1")
    length = "case when p_size <= 24 then 8 when p_size <= 48 then 6 else 4 end"
    return table(spark, sf_dir, "part").filter("p_type = 'ECONOMY'").selectExpr(
        f"substr({code}, 1, {length}) as ncm_cod", f"concat('grupo ', cast({length} as string)) as grupo"
    ).distinct()


def chain_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production chains with prefixes of eight, six, five and four digits."""
    code = _CODE.format(part="p_partkey", line="1")
    length = "case when p_size <= 20 then 8 when p_size <= 35 then 6 when p_size <= 45 then 5 else 4 end"
    return table(spark, sf_dir, "part").filter("p_type in ('ECONOMY', 'LARGE')").selectExpr(
        "concat('C', cast(p_size % 5 as string)) as codigo_cadeia",
        "concat('Cadeia ', cast(p_size % 5 as string)) as cadeia",
        "case when p_size % 5 < 2 then 'M1' else 'M2' end as missao",
        "case when p_size % 5 < 2 then 'Missao 1' else 'Missao 2' end as nome_missao",
        f"substr({code}, 1, {length}) as prefixo_sh",
        f"{length} as tamanho_prefixo",
        "p_brand as cnae",
        "concat('CNAE ', p_brand) as desc_cnae",
        "p_type as criterio",
        "substr(p_brand, 7) as icp",
        "'M1; M2' as missoes",
        "substr(p_brand, 7, 1) as secao_cnae",
        f"substr({code}, 1, 4) as sh_correspondente",
    ).distinct()


def operation_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sign per operation code: test data, the real rule is the user's table."""
    codes = items(spark, sf_dir, "cfop").distinct()
    return codes.selectExpr("cfop", "cast(case when cfop < 3000 then -1 else 1 end as bigint) as sinal")


def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies with a known presence abroad: those with a positive balance."""
    return table(spark, sf_dir, "customer").filter("c_acctbal >= 0").selectExpr(
        "lpad(cast(c_custkey as string), 8, '0') as cnpj_basico",
        "c_mktsegment as tipo_matriz",
        "c_acctbal >= 5000 as presenca_internacional",
        "c_acctbal < 8000 as presenca_nacional",
    )


def price_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a price that fits in the first line and is missing in the second."""
    names = ("chave_de_acesso", "numero_produto", "descricao_do_produto_servico", "quantidade", "valor_unitario", "valor_total")
    return items(spark, sf_dir, *names).withColumns(
        {
            "quantidade": F.expr("case when numero_produto = 1 then cast(1 as bigint) else quantidade end"),
            "valor_unitario": F.expr(
                "case numero_produto when 1 then valor_total when 2 then null else valor_unitario end"
            ),
        }
    )
