import hashlib
import re

import pytest
from pyspark.sql import functions as F

from invoice_lake.operators import marts, matching
from invoice_lake.sources import mappings
from tests.conftest import column, plan

YEARS = (2022, 2023, 2024, 2025)


@pytest.fixture
def chained():
    def build(items, chains, **options):
        return matching.chain_items(items, chains, YEARS, **options)

    return build


@pytest.mark.parametrize(
    "code, prefix, n",
    [("88062100", "88062100", 1), ("85010000", "8501", 1), ("84244100", "84244", 1), ("85176100", "851761", 1),
     ("99999999", "88062100", 0)],
)
def test_chain_prefixes(chained, make_items, make_chains, code, prefix, n):
    assert chained(make_items({"codigo_ncm_sh": code}), make_chains(("C1", prefix))).count() == n


def test_chain_years(chained, make_items, make_chains):
    days = ("2021-12-31", "2022-01-01", "2025-06-15", "2026-03-01")
    items = make_items(*[
        {"chave_de_acesso": f"K{i}", "data_emissao": day, "valor_total": 100 * (i + 1)} for i, day in enumerate(days)
    ])
    result = chained(items, make_chains(("C1", "88062100")))
    assert sorted(column(result, "valor_total")) == [200, 300]


@pytest.mark.parametrize(
    "chains, expected",
    [
        ([("C1", "84244100"), ("C1", "84244")], [("C1", 8)]),
        ([("C1", "8424"), ("C1", "84244100"), ("C1", "84244")], [("C1", 8)]),
        ([("C11", "8424"), ("C12", "8424")], [("C11", 4), ("C12", 4)]),
        ([("C1", "84244100"), ("C1", "84244"), ("C1", "8424"), ("C2", "84244100")], [("C1", 8), ("C2", 8)]),
    ],
)
def test_item_once_per_chain(chained, make_items, make_chains, chains, expected):
    result = chained(make_items({"codigo_ncm_sh": "84244100"}), make_chains(*chains))
    assert sorted((r.codigo_cadeia, r.tamanho_prefixo) for r in result.collect()) == expected
    assert {r.cadeia for r in result.collect()} == {f"Cadeia {c}" for c, _ in expected}


def test_one_item_key_with_two_codes_stands_once(chained, make_items, make_chains):
    items = make_items({"codigo_ncm_sh": "84240000"}, {"codigo_ncm_sh": "84244100"})
    result = chained(items, make_chains(("C1", "8424"), ("C1", "84244")))
    assert [r.codigo_ncm_sh for r in result.collect()] == ["84244100"]


def test_cnae_rows_survive_on_request(chained, make_items, make_chains):
    chains = make_chains(("C1", "8806", "X"), ("C1", "880621", "Y"))
    assert chained(make_items(), chains).count() == 1
    assert sorted(column(chained(make_items(), chains, dedup=("codigo_cadeia", "cnae")), "cnae")) == ["X", "Y"]


def test_any_prefix_join_equals_the_or_condition(spark):
    items = spark.createDataFrame([(c,) for c in ("72163100", "83071000", "94062000", "11111111", "7216")], "codigo_ncm_sh string")
    groups = mappings.steel_groups(spark)
    found = matching.join_any_prefix(items, groups)
    code, prefix = F.col("codigo_ncm_sh"), F.col("ncm_cod")
    condition = (code == prefix) | (F.substring(code, 1, 6) == prefix) | (F.substring(code, 1, 4) == prefix)
    wanted = items.join(groups, condition, "left")
    names = ["codigo_ncm_sh", "ncm_cod", "grupo"]
    assert sorted(map(tuple, found.select(names).collect()), key=str) == sorted(map(tuple, wanted.select(names).collect()), key=str)
    assert "NestedLoop" not in plan(found)


def test_types_are_trimmed_and_unmapped_items_stay(spark, make_items):
    mapping = spark.createDataFrame([("Etileno ", "39011020"), ("Etileno ", "39011020")], "tipo string, ncm string")
    items = make_items({"codigo_ncm_sh": "39011020"}, {"codigo_ncm_sh": "00000123"})
    assert column(matching.join_codes(items, mapping), "tipo") == ["Etileno"]
    rows = marts.items_by_code(items, mapping).collect()
    assert sorted((r.ncm, r.tipo_ncm, r.ncm_mapeada) for r in rows) == [("00000123", None, False), ("39011020", "Etileno", True)]


def test_fixed_tables(spark, tmp_path):
    assert mappings.group_a(spark).select("ncm").distinct().count() == 108
    assert mappings.steel_groups(spark).count() == 31
    (tmp_path / "a.csv").write_text("tipo,ncm\nEtileno ,01011020\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("Palavras Chaves,Abreviação\nPolietileno,PE\nPneus ,\n", encoding="utf-8")
    assert tuple(mappings.read_group_a(spark, str(tmp_path / "a.csv")).first()) == ("Etileno", "01011020")
    assert mappings.read_group_b(spark, str(tmp_path / "b.csv")) == ["Polietileno", "Pneus"]


@pytest.mark.parametrize("lines, shown", [
    ("7216,a", None), ("7216,a\n72163,b", "72163"), ("7216,a\n7216,b", "7216"), (",a", "None"), ("", None)])
def test_prefix_groups_are_checked(spark, tmp_path, lines, shown):
    (tmp_path / "g.csv").write_text("ncm_cod,grupo\n" + lines + "\n", encoding="utf-8")
    if shown is None:
        assert mappings.read_prefix_groups(spark, str(tmp_path / "g.csv")).count() == len(lines.splitlines())
    else:
        with pytest.raises(ValueError, match=shown):
            mappings.read_prefix_groups(spark, str(tmp_path / "g.csv"))


@pytest.mark.parametrize("prefix, length, good", [("3901", 4, True), ("3901", 6, False), ("390110201", 9, False), (None, 4, False)])
def test_chain_prefixes_are_checked(spark, tmp_path, prefix, length, good):
    path = str(tmp_path / "chains")
    spark.createDataFrame([("C1", prefix, length)], "codigo_cadeia string, prefixo_sh string, tamanho_prefixo int").write.parquet(path)
    if good:
        assert mappings.read_chain_map(spark, path).count() == 1
    else:
        with pytest.raises(ValueError, match="prefixo_sh"):
            mappings.read_chain_map(spark, path)


def test_repeated_company_roots_are_refused(spark, tmp_path):
    path = str(tmp_path / "presence")
    spark.createDataFrame([("1", "M"), ("1", "F")], "cnpj_basico string, tipo_matriz string").write.parquet(path)
    with pytest.raises(ValueError, match="cnpj_basico"):
        mappings.read_presence(spark, path)


def test_supplier_presence(spark):
    invoices = spark.createDataFrame([("12345678000195",), ("99999999000100",)], "cpf_cnpj_emitente string")
    presence = spark.createDataFrame([("12345678", "MATRIZ")], "cnpj_basico string, tipo_matriz string")
    rows = matching.join_supplier_presence(invoices, presence).collect()
    assert sorted((r.cnpj_basico, r.cnpj_disponivel, r.tipo_matriz) for r in rows) == [
        ("12345678", True, "MATRIZ"), ("99999999", False, None)
    ]


def test_needles_within_a_word_are_looked_up_in_distinct_words(spark):
    texts = ["pet azul", "tampa\tpet", "tubo de pvc", "PET", "", None, "a b pet azul", "de", "x" * 50 + " azul"]
    words = ["pet", "azul", "pet azul", "bo de", "a", "e p", " ", "", None, "x" * 40, "%", "t\tp", "a\tp"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, texto string")
    table = spark.createDataFrame([(w,) for w in words], "agulha string")
    expected = sorted((i, w) for i, t in enumerate(texts) for w in words if t is not None and w and w in t)
    joined = matching.join_keyword_table(df, "texto", table)
    assert sorted((r.n, r.agulha) for r in joined.where("agulha is not null").collect()) == expected


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_found_needles_pass_one_shuffle_by_text(spark, threshold):
    """Needles are dealt by text as a word's array; no shuffle has a row per text and needle, and none has the words' runs if needles are few."""
    df = spark.createDataFrame([(1, "pet azul pet"), (2, "azul"), (3, None)], "n int, texto string")
    table = spark.createDataFrame([("pet",), ("e",), ("a",), ("t a",)], "agulha string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = matching.match_keyword_table(df, "texto", table, "agulha")
        steps, rows = plan(found), found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((bytes(r.text_id).hex(), r.agulha) for r in rows) == sorted(
        (hashlib.md5(t.encode()).hexdigest(), w) for t, w in (
            ("pet azul pet", "pet"), ("pet azul pet", "e"), ("pet azul pet", "a"), ("pet azul pet", "t a"), ("azul", "a")))
    assert not re.search(r"Exchange hashpartitioning\(text_id[^,]*, agulha", steps)
    assert len(re.findall(r"Exchange hashpartitioning\(text_id[^\n]*REPARTITION", steps)) == 1
    assert ("BroadcastHashJoin [_trecho" in steps) == (threshold == "10m")
