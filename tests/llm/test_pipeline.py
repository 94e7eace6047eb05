"""The corpus pipeline, stage by stage and on odd rows."""

import corpus_pipeline
from invoice_lake.llm.decontamination import contamination
from invoice_lake.llm.minhash_dedup import near_duplicates
from tests.conftest import SF_DIR


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR).cache()
        assert after.columns == docs.columns and 0 < after.count() <= before.count(), name
        before = after
    assert near_duplicates(before).where("not kept").count() == 0
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert contamination(before, benchmark).where("n_hit > 0").count() == 0
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}


def test_near_copies_from_80_percent_are_linked(spark):
    texts = []
    for base in range(12):
        words = [f"w{base}x{i}" for i in range(104)]
        texts += [" ".join(words[:104 - k] + [f"v{base}x{k}x{i}" for i in range(k)]) for k in (0, 7 + base % 7)]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    alike = [a for a in range(len(sets)) if any(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for b in range(a))]
    between = [a for a in alike if all(100 * len(sets[a] & sets[b]) < 85 * len(sets[a] | sets[b]) for b in range(a))]
    assert len(between) >= 5 and len(alike) < 12
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], spark.read.parquet(f"{SF_DIR}/documents.parquet").schema)
    kept = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(texts))) - set(alike))


def test_rows_with_null_or_shared_ids_are_judged_one_by_one(spark):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").where("size(split(trim(text), ' ')) >= 12").first().text
    rows = [(None, f"before {item} after", "x"), (None, "nothing to see", "a"), (7, item, "x"), (7, "other words", "b"), (8, "last", "c")]
    docs = spark.createDataFrame([(i, t, "en", mark, len(t)) for i, t, mark in rows], schema)
    clean = corpus_pipeline.decontamination(spark, docs, SF_DIR)
    assert clean.schema == docs.schema and sorted(r.source for r in clean.collect()) == ["a", "b", "c"]
    rows = [(5, "one two"), (5, "one two"), (None, "one two"), (3, "one two"), (None, "three"), (None, "three"), (5, "four"), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema).repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert kept.schema == docs.schema
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [
        ("3", "one two"), ("5", "four"), ("None", ""), ("None", "None"), ("None", "three")]


def test_columns_named_like_results_stay(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    marked = docs.selectExpr("*", "-doc_id as n_words", "doc_id as lang_score", "'x' as quality_kept", "doc_id % 7 as __kept")
    for name, stage in corpus_pipeline.STAGES[:2]:
        plain, out = stage(spark, docs, SF_DIR), stage(spark, marked, SF_DIR)
        assert out.schema.names == marked.schema.names
        rows = out.select("doc_id", "n_words", "lang_score", "quality_kept", "__kept").collect()
        assert all(tuple(r) == (r[0], -r[0], r[0], "x", r[0] % 7) for r in rows), name
        assert sorted(r[0] for r in rows) == sorted(r.doc_id for r in plain.select("doc_id").collect()), name


def test_empty_and_null_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = spark.createDataFrame([(None, None, None, None, None), (-5, "", "en", "x", 0), (-6, None, None, None, None)], docs.schema)
    for table in (docs.limit(0), extra):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, SF_DIR)
        assert table.count() == 0
