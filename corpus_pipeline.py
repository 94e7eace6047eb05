"""A training-corpus pipeline: language, quality, near copies, benchmark overlap, packing.

Each stage takes the Parquet that the one before wrote and returns a DataFrame; all but the last return the columns of
``documents``. A null or empty text is rejected by the first stage. An empty table passes through empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from invoice_lake.llm.decontamination import drop_contaminated
from invoice_lake.llm.language_id import fit_languages, identify
from invoice_lake.llm.learning import held_out
from invoice_lake.llm.minhash_dedup import drop_near_duplicates
from invoice_lake.llm.packing import pack
from invoice_lake.llm.quality_rules import fit_quality, judge
from invoice_lake.llm.storage import settle

#: Near copies share 80 % of their shingles; 40 bands of 5 minima miss a pair at 0.80 with a chance of 1.3e-7.
NEAR_COPIES = {"percent": 80, "bands": 40, "band_rows": 5}


def _unchanged(docs: DataFrame, decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``decide`` keeps, with all columns as they were, also those named like a column that ``decide`` adds."""
    others = [name for name in docs.columns if name != "text"]
    kept = decide(docs.select("text", F.struct(*others).alias("record")))
    return kept.select(*["text" if name == "text" else F.col("record").getField(name).alias(name) for name in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with enough certainty."""
    model = fit_languages(docs.where(~held_out()))
    return _unchanged(docs, lambda rows: identify(rows, model).where("not lang_rejected"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules and the calibrated model keep."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _unchanged(docs, lambda rows: judge(rows, model).where("quality_kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, which are linked from a Jaccard similarity of 0.80."""
    return drop_near_duplicates(docs, **NEAR_COPIES)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in token windows."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Two stages use learned models and one a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
