import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from invoice_lake.functions import codes, parsing
from invoice_lake.operators import cleaning
from tests.conftest import column


def one_column(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"`{name}` string")


@pytest.mark.parametrize(
    "text, expected",
    [("1", 1), ("1.234", 1234), ("56.789", 56789), ("abc", None), ("2,5", 3), ("", None), (" 7 ", 7), (None, None), ("-2,5", -3)],
)
def test_parse_br_int(spark, text, expected):
    assert column(one_column(spark, [text]).select(parsing.parse_br_int(F.col("v")).alias("x")), "x") == [expected]


@pytest.mark.parametrize(
    "text, expected, signed",
    [
        ("09094142000130", "9094142000130.00", "9094142000130.00"),
        ("1.234,56", "1234.56", "1234.56"),
        ("R$ 10,00", "10.00", "10.00"),
        ("-5,00", "5.00", "-5.00"),
        ("1,2,3", None, None),
        ("***.***.***/****-**", None, None),
        (None, None, None),
    ],
)
def test_parse_br_decimal(spark, text, expected, signed):
    row = one_column(spark, [text]).select(
        parsing.parse_br_decimal(F.col("v")), parsing.parse_br_decimal(F.col("v"), keep_sign=True)
    ).first()
    assert row == tuple(None if v is None else Decimal(v) for v in (expected, signed))


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_parse_br_timestamp_in_any_session_zone(spark, zone):
    texts = ["01/03/2026", "15/12/2025", "01/03/2026 14:30:00", "1/3/2026", "nao_e_data", "31/02/2026", "04/11/2018",
             "2026-03-01", "01/03/2026 x", None]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = column(one_column(spark, texts).select(parsing.parse_br_timestamp(F.col("v")).alias("x")), "x")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    day = datetime.datetime
    # 2018-11-04 00:00 did not exist in Sao Paulo
    assert values == [day(2026, 3, 1), day(2025, 12, 15), day(2026, 3, 1, 14, 30), day(2026, 3, 1), None, None,
                      day(2018, 11, 4), None, None, None]


def test_pad_product_code(spark):
    df = one_column(spark, ["-1", "123", "39011020", None, "123456789"])
    values = column(df.select(codes.pad_product_code(F.col("v")).alias("x")), "x")
    assert values == ["00000000", "00000123", "39011020", None, "12345678"]


def test_supplier_text_form_of_a_company_id(spark):
    df = spark.sql("select cast(9094142000130 as decimal(18,2)) cnpj_emitente, '***' cpf_emitente union all select null, '***'")
    assert sorted(column(df.select(codes.supplier_id().alias("x")), "x")) == ["***", "9094142000130.00"]


def test_split_tax_id(spark):
    df = one_column(spark, ["***.910.688-**", "12345678000195", None], "CPF/CNPJ Emitente").withColumn("n", F.lit(1))
    result = cleaning.split_tax_id(df)
    assert result.columns == ["CPF Emitente", "CNPJ Emitente", "n"]
    assert [tuple(r)[:2] for r in result.collect()] == [("***.910.688-**", None), (None, "12345678000195"), (None, None)]
    other = one_column(spark, ["x"], "OUTRA COLUNA")
    assert cleaning.split_tax_id(other).columns == ["OUTRA COLUNA"]


def test_apply_types(spark):
    df = spark.createDataFrame(
        [("***.910.688-**", "1.234", "01/03/2026", "abc")], "`CPF/CNPJ` string, `SÉRIE` string, `DATA EMISSÃO` string, livre string"
    )
    types = {"CPF/CNPJ": "text", "SÉRIE": "integer", "DATA EMISSÃO": "timestamp", "AUSENTE": "integer"}
    result = cleaning.apply_types(df, types)
    assert result.dtypes == [("CPF/CNPJ", "string"), ("SÉRIE", "bigint"), ("DATA EMISSÃO", "timestamp_ntz"), ("livre", "string")]
    assert tuple(result.first()) == ("***.910.688-**", 1234, datetime.datetime(2026, 3, 1), "abc")


def test_header_case_is_an_option(spark):
    df = one_column(spark, ["12"], "CNPJ DESTINATÁRIO")
    types = {"CNPJ Destinatário": "decimal"}
    assert cleaning.apply_types(df, types).dtypes[0][1] == "string"
    assert cleaning.apply_types(df, types, match_case=False).dtypes[0][1] == "decimal(18,2)"


@pytest.mark.parametrize(
    "header, name",
    [
        ("NATUREZA DA OPERAÇÃO", "natureza_da_operacao"),
        ("DESCRIÇÃO DO PRODUTO/SERVIÇO", "descricao_do_produto_servico"),
        ("NCM/SH (TIPO DE PRODUTO)", "ncm_sh_tipo_de_produto"),
        ("CPF/CNPJ Emitente", "cpf_cnpj_emitente"),
        ("periodo", "periodo"),
    ],
)
def test_snake_case(header, name):
    assert cleaning.snake_case(header) == name


def test_exclude_keys_drops_rows_without_key(spark):
    df = one_column(spark, ["a", "b", None], "chave_de_acesso")
    assert column(cleaning.exclude_keys(df, ["a"]), "chave_de_acesso") == ["b"]
    table = one_column(spark, ["a", "a"], "chave_de_acesso")
    assert column(cleaning.exclude_keys(df, table), "chave_de_acesso") == ["b"]


def test_duplicates_are_dropped_within_a_period_only(spark):
    df = spark.createDataFrame([("k", "2024-01"), ("k", "2024-01"), ("k", "2024-02")], "chave string, periodo string")
    assert sorted(column(cleaning.drop_repeated_rows(df), "periodo")) == ["2024-01", "2024-02"]


def test_events_keep_duplicates(spark):
    event = spark.createDataFrame([("k", "E", "2024-01")] * 2, "`CHAVE DE ACESSO` string, EVENTO string, periodo string")
    assert cleaning.clean_table(event, "eventos").count() == 2
    assert cleaning.clean_table(event, "nf").count() == 1
