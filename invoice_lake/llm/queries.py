"""The registered queries of the text operators: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from invoice_lake.llm import (
    chat, decontamination, jaccard_join, language_id, lexical_search, minhash_dedup, packing, prefix_trie, quality_classifier,
    quality_rules, sharding, token_counts, token_files,
)
from invoice_lake.llm.learning import held_out
from invoice_lake.llm.storage import scratch_path, settle

WORD_TOKENIZER, BYTE_TOKENIZER = (public_tokenizers.path(f"{name}.json") for name in ("word_bpe_49k", "byte_bpe_50k"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_classifier.fit_neighbours(docs, _table(spark, sf_dir, "labels"))
    return quality_classifier.score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_predicted").alias("predicted"))


def differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = sharding.write_shards(_table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "shards"))
    text = F.coalesce("record.text", F.lit(""))
    return written.select(
        "record.doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def resynchronised_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, BYTE_TOKENIZER).drop("text")


def typed_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    messages = rows.unionByName(added).select("conv_id", "turn", "role", chat.text_parts())
    return chat.read_back(settle(chat.format_chats(messages), "chats"))


def arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    index = token_files.write_token_files(docs, scratch_path(spark, "tokens"), WORD_TOKENIZER)
    return token_files.read_token_files(index)


def minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def ngram_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_rules.fit_quality(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs.select("doc_id", "text"), model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("quality_kept").alias("kept"), F.col("quality_probability").alias("probability"))


def language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit_languages(docs.where(~held_out()))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def peeled_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.regrown_paths(_table(spark, sf_dir, "conversations")))


def shared_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def skipping_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


REGISTRY = {
    "op1_quality_neighbours": quality_neighbours,
    "op2_differencing_packing": differencing_packing,
    "op3_external_shuffle": external_shuffle,
    "op4_winnowing": winnowing,
    "op5_resynchronised_token_counts": resynchronised_token_counts,
    "op6_typed_chats": typed_chats,
    "op7_arrow_token_files": arrow_token_files,
    "op8_minhash": minhash,
    "op9_ngram_quality_rules": ngram_quality_rules,
    "op10_language_centroids": language_centroids,
    "op11_peeled_trie": peeled_trie,
    "op12_shared_search": shared_search,
    "op13_skipping_jaccard": skipping_jaccard,
}
