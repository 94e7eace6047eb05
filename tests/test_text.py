import re

import pytest
from pyspark.sql import functions as F

from invoice_lake.functions import text
from invoice_lake.operators import matching
from invoice_lake.sources import mappings
from tests.conftest import column

SAMPLES = ["Tubo-PVC  rígido  20mm", "EMBALAGEM\t\tPLÁSTICA", "sem nada", None]


def frame(spark, values=SAMPLES):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_normalize_collapses_first_run_only(spark):
    values = column(frame(spark).select(text.normalize_text(F.col("v")).alias("x")), "x")
    assert values == ["tubo pvc  rígido  20mm", "embalagem plástica", "sem nada", None]
    every = column(frame(spark).select(text.normalize_text(F.col("v"), collapse_all=True).alias("x")), "x")
    assert every[0] == "tubo pvc rígido 20mm"


@pytest.mark.parametrize("pattern", ["la", "pneus?", "tubo pvc", "plástica", "é", "a|b", "ab*"])
def test_word_boundaries_are_ascii(spark, pattern):
    texts = ["la", "là la", "ola", "pneu novo", "pneus", "pneumático", "tubo pvc", "tubo pvcx", "plástica!", "éla", "xé", "é",
             "a b", "_la_", "la-la", "abbb", "a", ""]
    expected = [re.search(rf"\b(?:{pattern})\b", t, re.ASCII) is not None for t in texts]
    found = column(frame(spark, texts).select(text.has_word(F.col("v"), pattern).alias("x")), "x")
    assert found == expected


def test_category_is_the_first_in_word_order(spark):
    df = frame(spark, ["Insulina e vacina", "insulina", "vacinas", None])
    values = column(df.select(text.first_category(F.col("v"), ["vacina", "insulina"], "outros").alias("x")), "x")
    assert values == ["vacina", "insulina", "outros", "outros"]


def test_contains_and_alternation(spark):
    df = frame(spark, ["IMPORTAÇÃO direta", "venda", "a.b", None])
    assert column(df.select(text.contains_any(F.col("v"), ["import", "exterior"]).alias("x")), "x") == [True, False, False, None]
    assert column(df.select(text.matches_any(F.col("v"), ["a.b", "xyz"]).alias("x")), "x") == [False, False, True, None]


def test_label_override(spark):
    df = spark.createDataFrame([(2024,), (2025,), (None,)], "ano long")
    values = column(df.select(text.label_override(F.col("ano"), {2025: "2025 (até 30/09)"}).alias("x")), "x")
    assert values == ["2024", "2025 (até 30/09)", None]


def test_keyword_join_keeps_texts_without_hit(spark):
    df = frame(spark, ["red widget gear", "bolt", None])
    rows = matching.join_keywords(df, F.col("v"), ["Widget", "Gear", "zzz"], ["widget", "gear", "zzz"]).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("red widget gear", "Widget"), ("red widget gear", "Gear"), ("bolt", None), (None, None)], key=str
    )


def test_keyword_wildcards_are_refused(spark):
    with pytest.raises(ValueError):
        matching.join_keywords(frame(spark), F.col("v"), ["10%"])


def test_published_keywords_match_their_normal_form(spark):
    words, needles = mappings.keywords()
    df = frame(spark, words).withColumn("n", text.normalize_keyword(F.col("v")))
    assert column(df, "n") == needles
    assert needles[4] == "estireno butadieno"
