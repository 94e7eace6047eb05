from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from invoice_lake.operators import marts, matching, quality
from invoice_lake.plans import inquiries, reports
from tests.conftest import column, plan

YEARS = (2022, 2023, 2024, 2025)


@pytest.fixture
def chain_rows(make_items, make_chains):
    """Items of two chains: C1 gets 100 + 200 of two suppliers, C2 gets 500."""
    items = make_items(
        {"chave_de_acesso": "A", "valor_total": 100, "cnpj_emitente": 111, "codigo_ncm_sh": "11110000"},
        {"chave_de_acesso": "B", "valor_total": 200, "cnpj_emitente": 222, "codigo_ncm_sh": "11110000", "data_emissao": "2025-02-01"},
        {"chave_de_acesso": "C", "valor_total": 500, "cnpj_emitente": 111, "codigo_ncm_sh": "22220000"},
    )
    return matching.chain_items(items, make_chains(("C1", "1111"), ("C2", "2222")), YEARS)


def test_chain_summary(chain_rows):
    rows = marts.chain_summary(chain_rows, YEARS, 2025).collect()
    assert [(r.codigo_cadeia, r.valor_total_adquirido, r.fornecedores_distintos, r.quantidade_itens) for r in rows] == [
        ("C2", 500, 1, 1), ("C1", 300, 2, 2)
    ]
    c2, c1 = rows
    # a year without rows is 0 here
    assert (c1.fornecedores_2025, c1.quantidade_itens_2025, c1.valor_2024, c1.valor_2025, c2.valor_2025) == (1, 1, 100, 200, 0)


def test_global_totals_count_an_item_once_across_chains(make_items, make_chains):
    items = make_items({"valor_total": 500, "cnpj_emitente": 111})
    both = matching.chain_items(items, make_chains(("C1", "8806"), ("C2", "8806")), YEARS)
    assert both.count() == 2
    row = marts.chain_global_totals(both, 2025).first()
    assert (row.valor_total_global, row.fornecedores_global, row.itens_global) == (500, 1, 1)
    assert (row.valor_total_2025, row.itens_2025) == (None, 0)


def test_global_totals_of_two_items(chain_rows):
    row = marts.chain_global_totals(chain_rows, 2025).first()
    assert (row.valor_total_global, row.fornecedores_global, row.itens_global, row.valor_total_2025) == (800, 2, 3, 200)


def test_chain_detail(make_items, make_chains):
    same = {"ncm_sh_tipo_de_produto": "Drones", "descricao_do_produto_servico": "Drone"}
    items = make_items(
        same | {"chave_de_acesso": "A", "valor_total": 1000, "quantidade": 2, "cnpj_emitente": 111},
        same | {"chave_de_acesso": "B", "valor_total": 500, "quantidade": 1, "cnpj_emitente": 222},
        {"chave_de_acesso": "C", "codigo_ncm_sh": "85420000", "valor_total": 9},
    )
    chains = matching.chain_items(items, make_chains(("C1", "8806"), ("C1", "8542")), YEARS)
    rows = marts.chain_detail(chains, YEARS).collect()
    assert [(r.valor_total, r.quantidade_total, r.registros, r.fornecedores_distintos) for r in rows] == [
        (1500, 3, 2, 2), (9, 1, 1, 1)
    ]
    assert marts.chain_detail(chains, YEARS, limit=1).count() == 1


def test_cnae_report_labels(make_items, make_chains):
    chains = matching.chain_items(
        make_items(), make_chains(("C2", "8806", "X"), ("C1", "8806", "Y")), YEARS, ("codigo_cadeia", "cnae")
    )
    report = reports.label_cnae(marts.chain_by_cnae(chains, YEARS))
    assert report.columns == [
        "Número da Missão", "Nome da Missão", "Código da Cadeia", "Cadeia Prioritária", "CNAE", "Descrição da CNAE",
        "Critério", "Missões", "ICP", "Seção CNAE", "SH Correspondente", "Valor Total", "Número de Fornecedores",
        "Número de Notas Fiscais", "Número de Itens", "valor_2022", "valor_2023", "valor_2024", "valor_2025",
    ]
    assert column(report, "Código da Cadeia") == ["C1", "C2"]
    assert reports.cnae_table(report, "C2").first()["Número de Itens"] == 1


def test_item_without_full_key_is_not_counted(make_items, make_chains):
    chains = matching.chain_items(make_items({"numero": None}), make_chains(("C1", "8806")), YEARS)
    assert marts.chain_by_cnae(chains, YEARS).first().itens == 0


def test_type_pivot_keeps_null_for_years_without_rows(spark, make_items):
    mapping = spark.createDataFrame([("A ", "11111111"), ("B", "22222222")], "tipo string, ncm string")
    items = make_items(
        {"codigo_ncm_sh": "11111111", "data_emissao": "2024-01-01", "valor_total": 5},
        {"codigo_ncm_sh": "22222222", "data_emissao": "2025-01-01", "valor_total": 7, "cnpj_emitente": None, "cpf_emitente": "***"},
    )
    totals = marts.type_year_totals(items, mapping)
    pivot = marts.type_year_pivot(totals, [2024, 2025])
    assert pivot.columns == [
        "tipo", "Valor Total 2024", "Fornecedores 2024", "Valor Total 2025", "Fornecedores 2025",
        "Notas Distintas 2024", "Notas Distintas 2025",
    ]
    assert [tuple(r) for r in pivot.collect()] == [("B", None, None, 7.0, 1, None, 1), ("A", 5.0, 1, None, None, 1, None)]
    assert reports.report_years(pivot) == [2024, 2025]
    assert column(reports.distinct_types(pivot), "tipo") == ["A", "B"]
    # an invoice with two types counts once per year
    year_totals = marts.type_totals_by_year(items.withColumn("data_emissao", F.lit("2025-01-01").cast("timestamp_ntz")), mapping)
    row = year_totals.first()
    assert (row.valor_total, row.fornecedores_distintos, row.notas_distintas) == (12, 2, 1)
    card = reports.type_card(pivot, year_totals, 2025, "A").first()
    assert (card.total, card.fornecedores) == (0.0, None)
    assert tuple(reports.type_card(pivot, year_totals, 2025).first()) == (12.0, 2.0, 1.0)
    series = reports.yearly_series(pivot, "tipo", [2024, 2025], unit=1).collect()
    assert sorted(map(tuple, series)) == [("A", 2024, 5.0), ("A", 2025, 0.0), ("B", 2024, 0.0), ("B", 2025, 7.0)]


def test_chain_cards_and_labels(chain_rows):
    summary = marts.chain_summary(chain_rows, YEARS, 2025)
    assert column(reports.chain_labels(summary), "label") == ["C1 — Cadeia C1", "C2 — Cadeia C2"]
    assert tuple(reports.chain_card(summary, "C1", 2025).first()) == (200.0, 1.0, 1.0, 1.0)
    assert tuple(reports.chain_card(summary, "??", 2025).first()) == (0.0, 0.0, 0.0, 0.0)
    globals_ = marts.chain_global_totals(chain_rows, 2025)
    assert tuple(reports.global_card(globals_, summary, 2025).first()) == (200.0, 1.0, 1.0, 2.0)
    assert column(reports.chain_table(summary, "valor_total_adquirido", limit=1), "codigo_cadeia") == ["C2"]


def test_keyword_mart_and_pivot(spark, make_items):
    mapping = spark.createDataFrame([("PVC", "39172300")], "tipo string, ncm string")
    items = make_items(
        {"codigo_ncm_sh": "39172300", "descricao_do_produto_servico": "TUBO-PVC 20mm", "valor_total": 3},
        {"codigo_ncm_sh": "39172300", "descricao_do_produto_servico": "TUBO-PVC 20mm", "valor_total": 4},
        {"descricao_do_produto_servico": "papel pe", "valor_total": 1},
    )
    mart = marts.keyword_mart(items, mapping)
    assert len(mart.columns) == 4 + 17 + 2
    tube = mart.filter("ncm_mapeada").first()
    assert (tube.tubo_pvc_encontrado, tube.pvc_encontrado, tube.pe_encontrado, tube.total) == (True, True, False, 7)
    pivot = marts.keyword_type_pivot(mart, [2024])
    assert [tuple(r) for r in pivot.collect()] == [("PVC", 7.0), ("Não Mapeado", 1.0)]
    assert column(marts.keyword_type_pivot(mart, [2024], "pe_encontrado"), "grupo") == ["Não Mapeado"]


def test_keyword_hits_without_match_have_null_flag(make_items):
    items = make_items({"descricao_do_produto_servico": "pneu novo pe"}, {"descricao_do_produto_servico": "papel"})
    rows = {r.descricao: r for r in marts.keyword_hits(items, ["Pneu"], ["pneu"]).collect()}
    assert (rows["pneu novo pe"].tipo_de_produto, rows["pneu novo pe"].chave_encontrada) == ("Pneu", True)
    assert rows["pneu novo pe"].pe_encontrado
    assert (rows["papel"].tipo_de_produto, rows["papel"].chave_encontrada) == (None, None)


def test_buyers_by_code_group(spark, make_items):
    groups = spark.createDataFrame([("7216", "Barras"), ("83071000", "Tubos")], "ncm_cod string, grupo string")
    items = make_items(
        {"codigo_ncm_sh": "72163100"}, {"codigo_ncm_sh": "72163200"}, {"codigo_ncm_sh": "72163200"}, {"codigo_ncm_sh": "11111111"}
    ).withColumns({"cnpj_destinatario": F.lit(1), "nome_destinatario": F.lit("Órgão")})
    rows = {r.grupo: r for r in marts.buyers_by_code_group(items, groups).collect()}
    assert (rows["Barras"].ncms_encontradas, rows["Barras"].total, rows["Barras"].qtd_nfs) == (["72163100", "72163200"], 3000, 3)
    assert rows["TODOS OS DEMAIS PRODUTOS"].ncms_encontradas == []


def test_consistency(spark):
    items = spark.createDataFrame(
        [("a", 2, Decimal(5), Decimal(10)), ("b", 2, Decimal(5), Decimal(11)), ("c", 1, Decimal(0), Decimal(3)), ("d", 1, None, Decimal(3))],
        "chave_de_acesso string, quantidade long, valor_unitario decimal(18,2), valor_total decimal(18,2)",
    )
    assert {r.consistente: r.qtd_itens for r in quality.consistency_counts(items).collect()} == {True: 1, False: 2, None: 1}
    rows = quality.inconsistent_items(items, ["chave_de_acesso"]).collect()
    assert [(r.chave_de_acesso, r.qtd_inferida) for r in rows] == [("b", 2.2), ("c", None)]


def test_repeated_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "chave_de_acesso string, valor_nota_fiscal long")
    assert [tuple(r) for r in quality.repeated_keys(df).collect()] == [("a", 2, 3)]
    assert quality.count_repeated_keys(df).first()[0] == 1


def test_share_is_of_all_years(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01' data_emissao, 'Importação' natureza_da_operacao, cast(25 as decimal(18,2)) valor_nota_fiscal"
        " union all select timestamp_ntz'2023-01-01', 'Venda', 75"
    )
    row = inquiries.nature_share(df, only_year=2024).first()
    assert (row.ano, row.valor, row.total, row.valor_pct, row.qtd_notas) == (2024, 25, 100, 0.25, 1)


def test_signed_totals(spark, make_items):
    items = make_items({"valor_total": 10}, {"valor_total": 4}, {"valor_total": 1}).withColumn(
        "cfop", F.when(F.col("valor_total") == 10, 5102).when(F.col("valor_total") == 4, 1202)
    )
    signs = spark.createDataFrame([(5102, 1), (1202, -1)], "cfop int, sinal int")
    row = inquiries.signed_totals(items, signs).first()
    assert tuple(row) == (15, 6, 0, 3)


def test_foreign_suppliers(spark):
    df = spark.createDataFrame([("EX123",), ("EX123",), ("12EX",)], "cpf_cnpj_emitente string")
    assert [tuple(r) for r in inquiries.suppliers_with_prefix(df).collect()] == [("EX123", 2)]


def test_reports_from_linked_items_are_those_from_chain_items(make_items, make_chains):
    """Copies of an item key with other codes, values and suppliers, unset keys and CNAEs."""
    codes = ("88062100", "84244100", "84240000", "99990000")
    items = make_items(*[
        {"chave_de_acesso": f"K{i % 7}" if i % 5 else None, "numero": i % 2, "numero_produto": i % 3 or None,
         "codigo_ncm_sh": codes[i % 4], "valor_total": 10 + i, "cnpj_emitente": 100 + i % 6 if i % 6 else None,
         "cpf_emitente": "***" if i % 4 else None, "data_emissao": f"{2023 + i % 3}-01-01", "descricao_do_produto_servico": f"d{i % 2}"}
        for i in range(80)])
    chains = make_chains(("C1", "8806", "X"), ("C1", "84", "Y"), ("C1", "84244100"), ("C2", "8424", "X"), ("C2", "88", "Z"))

    def linked(by, dedup=("codigo_cadeia",), **options):
        return matching.chain_links(items, chains, YEARS, dedup, by, **options)

    def rows(df):
        return sorted(map(str, df.collect()))

    whole, cnae = (matching.chain_items(items, chains, YEARS, dedup) for dedup in (("codigo_cadeia",), ("codigo_cadeia", "cnae")))
    assert whole.count() == linked(("codigo_cadeia",)).items.count() > 0
    assert rows(marts.chain_summary(linked(marts.CHAIN_KEY), YEARS, 2025)) == rows(marts.chain_summary(whole, YEARS, 2025))
    assert rows(marts.chain_detail(linked(marts.DETAIL_CHAIN), YEARS)) == rows(marts.chain_detail(whole, YEARS))
    by_cnae = linked(marts.CNAE_KEY, ("codigo_cadeia", "cnae"))
    assert rows(marts.chain_by_cnae(by_cnae, YEARS)) == rows(marts.chain_by_cnae(cnae, YEARS))
    both = linked(marts.CHAIN_KEY, carried=("cadeia", "cnae"))
    assert rows(marts.chain_global_totals(both, 2025)) == rows(marts.chain_global_totals(whole, 2025))


def test_items_pass_their_shuffles_before_they_stand_once_per_chain(make_items, make_chains):
    found = matching.chain_items(make_items(), make_chains(("C1", "8806"), ("C2", "8806")), YEARS)
    lines = plan(found).splitlines()
    expanded = [i for i, line in enumerate(lines) if "inline(" in line]
    dealt = [i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line and "numero" in line]
    assert expanded and dealt and expanded[0] < dealt[0]
    assert "Expand" not in plan(found) and found.count() == 2


def test_chain_reports_deal_the_items_by_key_once(spark, tmp_path, make_items, make_chains):
    """The rows of single keys and of copies, and all sums of a report, read one shuffle of the items; small mappings are broadcast."""
    path = str(tmp_path / "itens")
    rows = [{"chave_de_acesso": f"K{i}", "numero": i, "codigo_ncm_sh": code, "valor_total": value, "descricao_do_produto_servico": text}
            for i, code, value, text in ((1, "84240001", 1, "a"), (2, "84240001", 2, "a"), (2, "84240001", 3, "b"), (2, "84990001", 5, "a"), (3, "11110001", 9, "a"))]
    make_items(*rows).write.parquet(path)
    chains = make_chains(("C1", "8424", "x"), ("C1", "84", "y"), ("C2", "8499", "x"), ("C3", "99", "x"))
    links = matching.chain_links(spark.read.parquet(path), chains, [2024], ("codigo_cadeia", "cnae"), marts.CNAE_KEY)
    report = marts.chain_by_cnae(links, [2024])
    assert sorted((r.codigo_cadeia, r.cnae, r.valor_total, r.notas, r.itens) for r in report.collect()) == [
        ("C1", "x", 3, 2, 2), ("C1", "y", 3, 2, 2), ("C2", "x", 5, 1, 1)]
    final = plan(report).split("== Initial Plan ==")[0]
    dealt = [line for line in final.splitlines() if "Exchange hashpartitioning(numero" in line and "ReusedExchange" not in line]
    assert len(dealt) == 1


def test_codes_are_cut_to_the_mappings_lengths(spark, make_chains):
    codes = spark.createDataFrame([("84240001",), ("8424",), ("",), (None,)], "codigo_ncm_sh string")
    found = matching.match_chains(codes, make_chains(("C1", "842400"), ("C2", "8424")).select("prefixo_sh", "tamanho_prefixo", "codigo_cadeia"))
    assert sorted((r.codigo_ncm_sh, r.codigo_cadeia) for r in found.collect()) == [("8424", "C2"), ("84240001", "C1"), ("84240001", "C2")]
    assert matching.match_chains(codes, make_chains().select("prefixo_sh", "tamanho_prefixo", "codigo_cadeia")).count() == 0
    assert "sequence(1" not in plan(found)
