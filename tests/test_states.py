"""Incremental marts from mergeable states, keyword tables by index, and chain tables by folder."""

import datetime
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from invoice_lake.operators import marts, matching, states
from invoice_lake.plans import lake, reports
from invoice_lake.sources import layers
from tests.conftest import column, plan

MAP = [("11", "A "), ("22", "B"), ("22", "C")]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def group_a(spark):
    return spark.createDataFrame(MAP, "ncm string, tipo string")


@pytest.fixture
def lines(spark):
    def build(*rows):
        full = [(p, datetime.datetime.fromisoformat(f"{p}-03"), code, Decimal(value), Decimal(company) if company else None, person, invoice, text)
                for p, code, value, company, person, invoice, text in rows]
        return spark.createDataFrame(full, (
            "periodo string, data_emissao timestamp_ntz, codigo_ncm_sh string, valor_total decimal(18,2), "
            "cnpj_emitente decimal(18,2), cpf_emitente string, chave_de_acesso string, descricao_do_produto_servico string"))

    return build


JANUARY = [("2024-01", "11", 5, 1, None, "n1", "tubo pvc"), ("2024-01", "11", 7, 1, None, "n2", None), ("2024-01", "22", 1, None, "***", "n2", "pe"),
           ("2024-01", "33", 9, 3, None, "n3", "x"), ("2024-01", "11", 2, None, None, None, "x")]
FEBRUARY = [("2024-02", "11", 4, 1, None, "n1", "tubo pvc"), ("2024-02", "22", 3, 2, None, "n4", "pe"), ("2024-02", "22", 3, None, "***", "n5", "pe")]


def load(df, spark, root, mapping, replace=()):
    layers.write_periods(df, root, "silver", "itens")
    return lake.update_states(spark, root, mapping, replace)


def check(spark, root, items, mapping):
    totals = lake.state_totals(spark, root)
    names = ["tipo", "ano", "valor_total", "fornecedores_distintos", "notas_distintas"]
    assert rows_of(states.by_type(totals).select(names)) == rows_of(marts.type_year_totals(items, mapping).select(names))
    assert rows_of(states.by_year(totals).select(names[1:])) == rows_of(marts.type_totals_by_year(items, mapping).select(names[1:]))
    sums = states.merged_code_sums(layers.read_table(spark, root, "gold", lake.STATES[-1]))
    assert rows_of(marts.typed_codes(sums, mapping)) == rows_of(marts.items_by_code(items, mapping))


def test_two_loads_equal_one(spark, tmp_path, lines, group_a, monkeypatch):
    root, read = str(tmp_path), []
    periods = layers.read_periods
    monkeypatch.setattr(layers, "read_periods", lambda *x: read.append(list(x[-1])) or periods(*x))
    assert load(lines(*JANUARY), spark, root, group_a) == ["2024-01"]
    before = rows_of(layers.read_table(spark, root, "gold", "numeros_notas"))
    assert load(lines(*FEBRUARY), spark, root, group_a) == ["2024-02"]
    assert read == [["2024-01"], ["2024-02"]]  # the second load reads its own month only
    after = rows_of(layers.read_table(spark, root, "gold", "numeros_notas"))
    assert set(before) < set(after) and len({n for _, n in after}) == len({k for k, _ in after}) == 5
    check(spark, root, lines(*JANUARY, *FEBRUARY), group_a)
    assert lake.update_states(spark, root, group_a) == []


def test_a_month_delivered_again_replaces_its_state(spark, tmp_path, lines, group_a):
    root = str(tmp_path)
    load(lines(*JANUARY, *FEBRUARY), spark, root, group_a)
    assert load(lines(FEBRUARY[1]), spark, root, group_a, replace=["2024-02"]) == ["2024-02"]
    check(spark, root, lines(*JANUARY, FEBRUARY[1]), group_a)
    layers.clear_periods(spark, root, "silver", "itens", ["2024-02"])
    assert lake.update_states(spark, root, group_a) == []
    check(spark, root, lines(*JANUARY), group_a)


def test_gold_from_states_equals_gold_from_items(spark, tmp_path, lines, group_a):
    root = str(tmp_path)
    for month in (JANUARY, FEBRUARY):
        load(lines(*month), spark, root, group_a)
    written = lake.update_gold(spark, root, group_a)
    expected = lake.gold_tables(lines(*JANUARY, *FEBRUARY), group_a, [2024])
    for name, table in expected.items():
        stored = layers.read_table(spark, root, "gold", name)
        assert written[name] == table.count() and sorted(stored.columns) == sorted(table.columns)
        assert rows_of(stored.select(table.columns)) == rows_of(table), name
    assert lake.update_gold(spark, str(tmp_path / "empty"), group_a) == {}


def test_counts_come_without_expand(spark, tmp_path, lines, group_a):
    root = str(tmp_path)
    load(lines(*JANUARY), spark, root, group_a)
    assert "Expand" not in plan(lake.state_totals(spark, root))
    values = states.typed_values(lines(*JANUARY), group_a)
    numbers = spark.createDataFrame([("n1", 3), ("n2", 40_000)], "chave string, numero long")
    sets = states.key_sets(values, {"notas_distintas": ("chave_de_acesso", numbers)})
    assert "Expand" not in plan(sets)
    assert {r.balde for r in sets.collect()} == {1, 2}


def test_values_come_from_one_read_of_the_items(spark, tmp_path, lines, group_a):
    path = str(tmp_path / "itens")
    lines(*JANUARY, *FEBRUARY).write.parquet(path)
    values = states.typed_values(spark.read.parquet(path), group_a, "periodo")
    assert plan(values).count("FileScan") == 1
    found = rows_of(values.groupBy("escopo", "tipo").agg(F.sum("valor").cast("int")))
    assert found == sorted([("tipo", "A", 18), ("tipo", "B", 7), ("tipo", "C", 7), ("todos", None, 25)], key=str)


def test_invoices_are_numbered_by_period(spark, lines):
    rows = [(month, "11", 1, 1, None, f"n{i}", "x") for i in range(200) for month in (("2024-01", "2024-02")[i % 2], "2024-03")]
    keys = states.invoice_keys(lines(*rows).repartition(3))
    numbers = {row.chave: row.numero for row in states.new_numbers(keys, None).collect()}
    assert len(set(numbers.values())) == 200
    assert max(numbers[f"n{i}"] for i in range(0, 200, 2)) < min(numbers[f"n{i}"] for i in range(1, 200, 2))


def test_keyword_table(spark):
    texts = ["tubo pvc 50%", "a_b", "ção é", "pvc", None, "", "TUBO", "xy" * 3000 + "pvc", "tubo pvc 50%", "😀pe"]
    words = ["pvc", "50%", "_", "ção", "o", "", None, "zzz", "tubo pvc 50%", "pvc", "😀p", "xyxyxyx", "é"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, texto string").repartition(3)
    table = spark.createDataFrame([(w, f"g{i % 2}") for i, w in enumerate(words)], "agulha string, grupo string").distinct()
    joined = matching.join_keyword_table(df, "texto", table)
    assert set(joined.columns) == {"texto", "n", "agulha", "grupo"}
    expected = []
    for i, t in enumerate(texts):
        found = [(i, w, g) for w, g in {(w, f"g{k % 2}") for k, w in enumerate(words)} if w and t and w in t]
        expected += found or [(i, None, None)]
    assert rows_of(joined.select("n", "agulha", "grupo")) == sorted(expected, key=str)
    assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)
    assert rows_of(matching.join_keyword_table(df, "texto", table.limit(0)).select("n", "agulha")) == sorted(((i, None) for i in range(len(texts))), key=str)


def test_chain_detail_is_complete_and_reads_one_folder(spark, tmp_path, make_items, make_chains):
    root = str(tmp_path)
    items = make_items(*[{"chave_de_acesso": f"K{i}", "codigo_ncm_sh": code, "valor_total": 10 + i, "descricao_do_produto_servico": f"d{i}"}
                         for i in range(30) for code in ("84240001", "88060001")])
    chains = make_chains(("C1", "8424"), ("2", "8806"))
    lake.chain_tables(spark, root, items, chains, [2024])
    assert reports.detail_of_chain(spark, str(tmp_path / "none")) is None
    one = reports.detail_of_chain(spark, root, "C1")
    assert one.count() == 30 and set(column(one, "codigo_cadeia")) == {"C1"}
    assert re.search(r"PartitionFilters: \[[^\]]*codigo_cadeia[^\]]* = C1", plan(one))
    assert reports.detail_of_chain(spark, root, "2", limit=3).count() == 3
    largest = marts.largest_per_chain(reports.detail_of_chain(spark, root), 4)
    assert sorted(column(largest, "codigo_cadeia")) == ["2"] * 4 + ["C1"] * 4 and "WindowGroupLimit" in plan(largest)


def test_new_numbers_of_nothing(spark):
    none = spark.createDataFrame([], "chave string")
    assert states.new_numbers(none, None).count() == 0
    first = states.new_numbers(spark.createDataFrame([("a",), ("a",), (None,)], none.schema), None)
    assert column(first.select("chave"), "chave") == ["a"]
    known = spark.createDataFrame([("a", 5)], "chave string, numero long")
    more = states.new_numbers(spark.createDataFrame([("a",), ("b",)], none.schema), known).collect()
    assert [r.chave for r in more] == ["b"] and more[0].numero >= states.TASK_NUMBERS


def test_chain_reports_come_without_expand(make_items, make_chains):
    items = matching.chain_items(make_items(), make_chains(("C1", "8806", "x")), [2024], ("codigo_cadeia", "cnae"))
    for report in (marts.chain_by_cnae(items, [2024]), marts.chain_global_totals(items, 2024), marts.chain_summary(items, [2024], 2024)):
        assert "Expand" not in plan(report) and report.count() == 1
    nothing = marts.chain_global_totals(items.limit(0), 2024).first()
    assert (nothing.itens_global, nothing.itens_2024, nothing.fornecedores_global, nothing.valor_total_global) == (0, 0, 0, None)
