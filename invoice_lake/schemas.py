"""Column typing of the three fact tables, keyed by the header of the raw file."""

from __future__ import annotations

from pyspark.sql import types as T

TABLES = ("itens", "nf", "eventos")

# Headers and types of the published monthly files.
ITEM_TYPES = {
    "CHAVE DE ACESSO": "text",
    "MODELO": "text",
    "SÉRIE": "integer",
    "NÚMERO": "integer",
    "NATUREZA DA OPERAÇÃO": "text",
    "DATA EMISSÃO": "timestamp",
    "CPF Emitente": "text",
    "CNPJ Emitente": "decimal",
    "RAZÃO SOCIAL EMITENTE": "text",
    "INSCRIÇÃO ESTADUAL EMITENTE": "integer",
    "UF EMITENTE": "text",
    "MUNICÍPIO EMITENTE": "text",
    "CPF Destinatário": "text",
    "CNPJ Destinatário": "decimal",
    "NOME DESTINATÁRIO": "text",
    "UF DESTINATÁRIO": "text",
    "INDICADOR IE DESTINATÁRIO": "text",
    "DESTINO DA OPERAÇÃO": "text",
    "CONSUMIDOR FINAL": "text",
    "PRESENÇA DO COMPRADOR": "text",
    "NÚMERO PRODUTO": "integer",
    "DESCRIÇÃO DO PRODUTO/SERVIÇO": "text",
    "CÓDIGO NCM/SH": "text",
    "NCM/SH (TIPO DE PRODUTO)": "text",
    "CFOP": "integer",
    "QUANTIDADE": "integer",
    "UNIDADE": "text",
    "VALOR UNITÁRIO": "decimal",
    "VALOR TOTAL": "decimal",
    "periodo": "text",
}
INVOICE_TYPES = {
    "CHAVE DE ACESSO": "text",
    "MODELO": "text",
    "SÉRIE": "integer",
    "NÚMERO": "integer",
    "NATUREZA DA OPERAÇÃO": "text",
    "DATA EMISSÃO": "timestamp",
    "EVENTO MAIS RECENTE": "text",
    "DATA/HORA EVENTO MAIS RECENTE": "timestamp",
    "CPF Emitente": "text",
    "CNPJ Emitente": "decimal",
    "RAZÃO SOCIAL EMITENTE": "text",
    "INSCRIÇÃO ESTADUAL EMITENTE": "integer",
    "UF EMITENTE": "text",
    "MUNICÍPIO EMITENTE": "text",
    "CPF Destinatário": "text",
    "CNPJ Destinatário": "decimal",
    "NOME DESTINATÁRIO": "text",
    "UF DESTINATÁRIO": "text",
    "INDICADOR IE DESTINATÁRIO": "text",
    "DESTINO DA OPERAÇÃO": "text",
    "CONSUMIDOR FINAL": "text",
    "PRESENÇA DO COMPRADOR": "text",
    "VALOR NOTA FISCAL": "decimal",
    "periodo": "text",
}
EVENT_TYPES = {
    "CHAVE DE ACESSO": "text",
    "MODELO": "text",
    "SÉRIE": "integer",
    "NÚMERO": "integer",
    "NATUREZA DA OPERAÇÃO": "text",
    "DATA EMISSÃO": "timestamp",
    "EVENTO": "text",
    "DATA/HORA EVENTO": "timestamp",
    "DESCRIÇÃO EVENTO": "text",
    "MOTIVO EVENTO": "text",
    "periodo": "text",
}
TABLE_TYPES = {"itens": ITEM_TYPES, "nf": INVOICE_TYPES, "eventos": EVENT_TYPES}

SPARK_TYPES = {
    "text": T.StringType(),
    "integer": T.LongType(),
    "decimal": T.DecimalType(18, 2),
    "timestamp": T.TimestampNTZType(),
}

# Mapping tables. Product codes stay text: a numeric code would lose its leading zeros.
GROUP_A_SCHEMA = T.StructType(
    [T.StructField("tipo", T.StringType()), T.StructField("ncm", T.StringType())]
)
GROUP_B_SCHEMA = T.StructType(
    [T.StructField("palavra_chave", T.StringType()), T.StructField("abreviacao", T.StringType())]
)
PREFIX_GROUP_SCHEMA = T.StructType(
    [T.StructField("ncm_cod", T.StringType()), T.StructField("grupo", T.StringType())]
)
CHAIN_MAP_SCHEMA = T.StructType(
    [
        T.StructField("codigo_cadeia", T.StringType()),
        T.StructField("cadeia", T.StringType()),
        T.StructField("missao", T.StringType()),
        T.StructField("nome_missao", T.StringType()),
        T.StructField("prefixo_sh", T.StringType()),
        T.StructField("tipo_match", T.StringType()),
        T.StructField("tamanho_prefixo", T.IntegerType()),
        T.StructField("cnae", T.StringType()),
        T.StructField("desc_cnae", T.StringType()),
        T.StructField("criterio", T.StringType()),
        T.StructField("icp", T.StringType()),
        T.StructField("missoes", T.StringType()),
        T.StructField("secao_cnae", T.StringType()),
        T.StructField("sh_correspondente", T.StringType()),
    ]
)
PRESENCE_SCHEMA = T.StructType(
    [
        T.StructField("cnpj_basico", T.StringType()),
        T.StructField("tipo_matriz", T.StringType()),
        T.StructField("presenca_internacional", T.BooleanType()),
        T.StructField("presenca_nacional", T.BooleanType()),
    ]
)

# One product line of one invoice. A number leads: sorts compare it first, and the access keys share
# long beginnings.
ITEM_KEY = ("numero", "numero_produto", "chave_de_acesso")
