"""Archives to deliverables, as a batch and as a stream."""

import os
import subprocess
import sys
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from invoice_lake.__main__ import main
from invoice_lake.plans import lake
from invoice_lake.sources import delivery, landing, layers, mappings
from invoice_lake.streaming.monthly import stream_archives
from tests.conftest import column
from workload import archives

ITEM_HEADER = (
    "CHAVE DE ACESSO;NÚMERO;DATA EMISSÃO;CPF/CNPJ Emitente;NÚMERO PRODUTO;DESCRIÇÃO DO PRODUTO/SERVIÇO;CÓDIGO NCM/SH;"
    "NCM/SH (TIPO DE PRODUTO);CFOP;QUANTIDADE;VALOR UNITÁRIO;VALOR TOTAL"
)


def item_line(key, day="15/06/2024", code="39011020", value="1.000,00", text='"Tubo; ""PVC"" rígido"', supplier="11111111000100"):
    return f"{key};1;{day};{supplier};1;{text};{code};Polímeros;5102;2;500,00;{value}"


def put_archive(folder, period, items, name="NFe", members=3, item_name="Item", issuers=None):
    folder.mkdir(exist_ok=True)
    keys = [line.split(";")[0] for line in items]
    invoices = "CHAVE DE ACESSO;VALOR NOTA FISCAL\n" + "".join(f"{key};10,00\n" for key in keys)
    if issuers:
        invoices = "CHAVE DE ACESSO;CPF/CNPJ Emitente;VALOR NOTA FISCAL\n" + "".join(f"{key};{issuers[key]};10,00\n" for key in keys)
    files = {
        f"{period}_NF.csv": invoices,
        f"{period}_{item_name}.csv": "\r\n".join([ITEM_HEADER, *items]) + "\r\n",
        f"{period}_Eventos.csv": "CHAVE DE ACESSO;EVENTO\nA;Autorização\nA;Autorização\n",
    }
    with zipfile.ZipFile(folder / f"{period}_{name}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for member in list(files)[:members]:
            archive.writestr(member, files[member].encode("latin-1"))


@pytest.fixture
def places(tmp_path):
    return tmp_path / "landing", str(tmp_path / "lake"), str(tmp_path / "staging")


def test_missing_landing_folder(spark):
    assert landing.list_archives(spark, "/nao/existe").count() == 0


def test_archive_listing(spark, places):
    folder = places[0]
    put_archive(folder, "202501", [item_line("A")], "NFe_1")
    put_archive(folder, "202501", [item_line("A")], "NFe_2")
    (folder / "readme.txt").write_text("x")
    (folder / "sub").mkdir()
    (folder / "sub" / "202502_NFe.zip").write_text("x")
    rows = landing.list_archives(spark, str(folder)).collect()
    assert [(r.arquivo, r.periodo_raw, r.periodo) for r in rows] == [("202501_NFe_2.zip", "202501", "2025-01")]


def test_member_roles(spark):
    names = spark.createDataFrame([("202501_NF.csv",), ("202501_ITEM.csv",), ("202501_eventos.csv",)], "n string")
    assert column(names.select(landing.classify_member(F.col("n")).alias("t")), "t") == ["nf", "itens", "eventos"]


def test_delimited_text_is_read_as_text(spark, tmp_path):
    (tmp_path / "f.csv").write_text('chave;valor\n001;"a ""b"";c"\n002;""\n', encoding="latin-1")
    rows = landing.read_delimited(spark, [str(tmp_path / "f.csv")], ["chave", "valor"], str(tmp_path)).collect()
    assert [(r.chave, r.valor) for r in rows] == [("001", 'a "b";c'), ("002", None)]


def test_bronze_to_gold(spark, places, make_chains):
    folder, root, staging = places
    put_archive(folder, "202406", [item_line("A"), item_line("A"), item_line("B", code="-1", supplier="***.910.688-**")])
    put_archive(folder, "202407", [item_line("C", "01/07/2024 10:00:00", value="-5,00"), item_line(lake_invalid())])
    put_archive(folder, "202408", [item_line("D")], members=2)
    put_archive(folder, "202409", [item_line("E")], item_name="Outro")
    assert lake.load_bronze(spark, str(folder), root, staging) == ["2024-06", "2024-07"]
    bronze = layers.read_table(spark, root, "bronze", "itens")
    assert {kind for _, kind in bronze.dtypes} == {"string"}
    assert bronze.filter("periodo = '2024-06'").first()["DESCRIÇÃO DO PRODUTO/SERVIÇO"] == 'Tubo; "PVC" rígido'
    rejects = spark.read.parquet(layers.table_path(root, "bronze", "rejeitados")).collect()
    assert sorted((r.periodo, r.motivo) for r in rejects) == [
        ("2024-08", "expected 3 files, found 2"), ("2024-09", "no file for itens")
    ]

    assert lake.load_silver(spark, root) == {"itens": 3, "nf": 3, "eventos": 4}
    silver = layers.read_table(spark, root, "silver", "itens")
    rows = {r.chave_de_acesso: r for r in silver.collect()}
    assert sorted(rows) == ["A", "B", "C"]
    assert (rows["B"].codigo_ncm_sh, rows["B"].cpf_emitente, rows["B"].cnpj_emitente) == ("00000000", "***.910.688-**", None)
    assert (rows["C"].valor_total, rows["C"].data_emissao.hour, rows["C"].periodo) == (5, 10, "2024-07")
    types = dict(silver.dtypes)
    known = {field.name: field.dataType.simpleString() for field in layers.silver_schema("itens")}
    assert all(types[name] == known[name] for name in types)

    # everything again: nothing new
    assert lake.load_bronze(spark, str(folder), root, staging) == []
    assert lake.load_silver(spark, root) == {}
    assert layers.read_table(spark, root, "silver", "itens").count() == 3

    counts = lake.build_gold(spark, root, mappings.group_a(spark), make_chains(("C1", "3901"), ("C2", "39011020")))
    assert counts["resumo_grupo_a"] == 1 and counts["resumo_cadeia"] == 2 and counts["cnae_cadeia"] == 2
    pivot = layers.read_table(spark, root, "gold", "resumo_grupo_a").first()
    assert (pivot["tipo"], pivot["Valor Total 2024"], pivot["Notas Distintas 2024"]) == ("Etileno", 1005.0, 2)
    reports = lake.item_reports(spark, layers.read_table(spark, root, "silver", "itens").withColumns(
        {"cnpj_destinatario": F.lit(1), "nome_destinatario": F.lit("x")}
    ), mappings.group_a(spark))
    assert lake.publish(spark, root, reports) == {
        "aco_totais_por_grupo_e_orgao": 1, "totais_com_agregacao_das_descricoes": 2, "totais_palavras_chave": 2,
        "totais_por_tipo": 1, "totais_por_palavra_chave": 1,
    }
    summary = spark.read.options(sep=";", header=True, encoding="ISO-8859-1").csv(
        layers.table_path(root, "entrega", "resumo_grupo_a.csv")
    )
    assert summary.first()["Valor Total 2024"] == "1005,0"


def lake_invalid():
    from invoice_lake.operators.cleaning import INVALID_KEYS

    return INVALID_KEYS[0]


def test_quoted_line_breaks_and_wrong_field_counts(spark, places):
    folder, root, staging = places
    broken = item_line("B") + ";surplus"
    put_archive(folder, "202406", [item_line("A", text='"Tubo\r\nlongo; com ""aspas"""'), broken, item_line("C", text='5" de tubo')])
    for _ in range(2):
        lake.load_bronze(spark, str(folder), root, staging, replace=True)
        rows = {r["CHAVE DE ACESSO"]: r for r in layers.read_table(spark, root, "bronze", "itens").collect()}
        assert sorted(rows) == ["A", "C"]
        assert rows["A"]["DESCRIÇÃO DO PRODUTO/SERVIÇO"] == 'Tubo\r\nlongo; com "aspas"'
        assert rows["C"]["DESCRIÇÃO DO PRODUTO/SERVIÇO"] == '5" de tubo'
        assert (rows["A"]["VALOR TOTAL"], rows["C"]["VALOR TOTAL"]) == ("1.000,00", "1.000,00")
        rejects = layers.read_table(spark, root, "bronze", "rejeitados").collect()
        assert [(r.motivo, r.registro, r.texto.endswith("surplus")) for r in rejects] == [
            ("itens: expected 12 fields, found 13", 2, True)
        ]
    from pathlib import Path

    assert not [p for p in Path(staging).rglob("*") if p.is_file()]


def test_redelivery_without_rows_leaves_none(spark, places):
    folder, root, staging = places
    put_archive(folder, "202406", [item_line("A")])
    put_archive(folder, "202407", [item_line("B")])
    assert lake.load_bronze(spark, str(folder), root, staging) == ["2024-06", "2024-07"]
    lake.load_silver(spark, root)
    put_archive(folder, "202407", [], "NFe_v2")
    assert lake.load_bronze(spark, str(folder), root, staging, replace=True, only=["2024-07"]) == ["2024-07"]
    lake.load_silver(spark, root, replace=["2024-07"])
    for layer, key in (("bronze", "CHAVE DE ACESSO"), ("silver", "chave_de_acesso")):
        assert column(layers.read_table(spark, root, layer, "itens"), key) == ["A"]
    assert lake.load_bronze(spark, str(folder), root, staging) == []


def test_months_with_other_columns(spark, places):
    folder, root, staging = places
    put_archive(folder, "202406", [item_line("A")])
    lake.load_bronze(spark, str(folder), root, staging)
    with zipfile.ZipFile(folder / "202407_NFe.zip", "w") as archive:
        archive.writestr("Item.csv", "NOVA;CHAVE DE ACESSO\nx;B\n")
        archive.writestr("Evento.csv", "CHAVE DE ACESSO;EVENTO\nB;x\n")
        archive.writestr("NF.csv", "CHAVE DE ACESSO;VALOR NOTA FISCAL\nB;1\n")
    assert lake.load_bronze(spark, str(folder), root, staging) == ["2024-07"]
    rows = layers.read_table(spark, root, "bronze", "itens", merge_columns=True).collect()
    assert sorted((r["CHAVE DE ACESSO"], r["NOVA"], r["CFOP"]) for r in rows) == [("A", None, "5102"), ("B", "x", None)]


def run_stream(spark, places, tmp_path, **options):
    folder, root, staging = places
    query = stream_archives(spark, str(folder), root, staging, str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()
    return sorted(column(layers.read_table(spark, root, "silver", "itens"), "chave_de_acesso"))


def test_stream_equals_batch_and_takes_redeliveries(spark, places, tmp_path):
    folder, root, staging = places
    put_archive(folder, "202406", [item_line("A"), item_line("A")])
    put_archive(folder, "202407", [item_line("B")])
    assert run_stream(spark, places, tmp_path) == ["A", "B"]
    assert run_stream(spark, places, tmp_path) == ["A", "B"]

    batch_root = root + "-batch"
    lake.load_bronze(spark, str(folder), batch_root, staging)
    lake.load_silver(spark, batch_root)
    for table in ("itens", "nf", "eventos"):
        rows = [sorted(map(str, layers.read_table(spark, r, "silver", table).collect())) for r in (root, batch_root)]
        assert rows[0] == rows[1]

    put_archive(folder, "202407", [item_line("C")], "NFe_v2")
    assert run_stream(spark, places, tmp_path) == ["A", "C"]
    put_archive(folder, "202407", [item_line("D")], "NFe_v3")
    assert run_stream(spark, places, tmp_path, replace=False) == ["A", "C"]


def test_regional_csv(spark, tmp_path):
    df = spark.sql(
        "select cast(1234.5 as decimal(18,2)) a, cast(12345678.25 as double) b, true c, cast(3 as bigint) d,"
        " 'água; €' e, timestamp_ntz'2024-06-15 10:00:00' f, cast(null as double) g, '→' h, array('x', 'y') i"
    )
    delivery.write_regional_csv(df, str(tmp_path / "r"))
    text = b"".join(p.read_bytes() for p in (tmp_path / "r").glob("part-*.csv")).decode("cp1252")
    assert text.splitlines() == ["a;b;c;d;e;f;g;h;i", '1234,50;12345678,25;True;3;"água; €";2024-06-15 10:00:00;;?;[x, y]']
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"
    delivery.write_plain_csv(df.drop("i"), str(tmp_path / "p"))
    text = b"".join(p.read_bytes() for p in (tmp_path / "p").glob("part-*.csv")).decode("utf-8")
    assert text.splitlines()[1] == "1234.50,12345678.25,true,3,água; €,2024-06-15 10:00:00,,→"


def test_command_line_from_another_folder(spark, places, tmp_path):
    folder, root, staging = places
    put_archive(folder, "202406", [item_line("A"), item_line("B", code="72163100"), item_line("C")],
                issuers={"A": "11111111000100", "B": "11111111000281", "C": "EX7"})
    load = [sys.executable, "-m", "invoice_lake", "load", "--landing", str(folder), "--root", root, "--staging", staging]
    env = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parent.parent)}
    subprocess.run(load, cwd=tmp_path, env=env, check=True, timeout=300)

    (tmp_path / "signs.csv").write_text("cfop,sinal\n5102,-1\n")
    (tmp_path / "b.csv").write_text("Palavras Chaves,Abreviação\nTubo,\n", encoding="utf-8")
    presence = "cnpj_basico string, tipo_matriz string, presenca_internacional boolean, presenca_nacional boolean"
    spark.createDataFrame([("11111111", "M", True, True)], presence).write.parquet(str(tmp_path / "presence"))
    main(["reports", "--root", root, "--signs", str(tmp_path / "signs.csv"), "--group-b", str(tmp_path / "b.csv"),
          "--presence", str(tmp_path / "presence")])
    report = lambda name: layers.read_table(spark, root, "gold", name)
    assert report("valor_por_ano").count() == 1
    assert {r.grupo for r in report("aco_totais_por_grupo_e_orgao").collect()} == {"Barras e perfis", "TODOS OS DEMAIS PRODUTOS"}
    assert report("totais_com_sinal").count() == 1
    assert [(r.qtd_notas, r.cnpj_disponivel) for r in report("fornecedores_presenca").orderBy("qtd_notas").collect()] == [(1, False), (2, True)]
    assert [tuple(r) for r in report("fornecedores_exterior").collect()] == [("EX7", 1)]


def test_a_large_member_becomes_several_compressed_files(spark, places, monkeypatch):
    folder, root, staging = places
    put_archive(folder, "202406", [item_line("A", text='"uma\r\nquebra"'), item_line("B"), item_line("C") + ";surplus", item_line("D") + ";surplus"])
    put_archive(folder, "202407", [])
    members, _ = landing.split_members(landing.list_members(landing.list_archives(spark, str(folder))).collect())

    def small_parts(row, target, rejects, copy=landing._copy_member):
        landing.PART_BYTES = 10
        return copy(row, target, rejects)

    monkeypatch.setattr(landing, "_copy_member", small_parts)
    staged = landing.unpack(spark, members, staging)
    rows = sorted((r.periodo, r.records, r.rejected) for r in staged if r.tabela == "itens")
    assert rows == [("2024-06", 1, 0), ("2024-06", 1, 2), ("2024-07", 0, 0)]
    files = [p for p in Path(staging).rglob("*") if p.is_file()]
    assert files and all(p.read_bytes()[:2] == b"\x1f\x8b" for p in files)
    found = landing.read_staged(spark, staged, staging, "itens")
    assert sorted(column(found, "DESCRIÇÃO DO PRODUTO/SERVIÇO")) == ['Tubo; "PVC" rígido', "uma\r\nquebra"]
    assert sorted(r.registro for r in landing.read_rejects(spark, staging).collect()) == [3, 4]


def test_deliveries_leave_only_the_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "shared_folder", lambda spark, name: str(tmp_path / "shared" / name))
    rows = spark.createDataFrame([("A", "ação", "2024-06"), ("B", None, "2024-07")], "chave string, texto string, periodo string")
    archives.deliver(spark, str(tmp_path / "in"), "NFe", {"nf": rows})
    assert not [p for p in (tmp_path / "shared").rglob("*") if p.is_file()]
    with zipfile.ZipFile(tmp_path / "in" / "202406_NFe.zip") as archive:
        assert archive.read("202406_NFe_NotaFiscal.csv").decode("latin-1") == '"chave";"texto"\r\n"A";"ação"\r\n'


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    def shuffled():
        local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {p for folder in local for p in Path(folder).rglob("shuffle_*.data")}

    rows = spark.range(1000).selectExpr("id % 7 as k", "'2024-06' as periodo")
    before = shuffled()
    layers.write_periods(rows.groupBy("k", "periodo").count(), str(tmp_path), "silver", "t", rebalance=True)
    layers.write_table(rows.groupBy("k").count(), str(tmp_path), "gold", "t")
    assert not shuffled() - before
    assert layers.read_table(spark, str(tmp_path), "gold", "t").count() == 7
