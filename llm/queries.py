"""One query per operator, over whole tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import (
    alignment,
    decontamination,
    fingerprints,
    line_dedup,
    lm_scoring,
    ngram_join,
    packing,
    pii,
    quality,
    sharding,
    spelling,
    substring_dedup,
    suffix_array_dedup,
)
from llm.oracle import ORACLE as ORACLE  # registered with the queries

Query = Callable[[SparkSession, str], DataFrame]

# Shares of tokens that named sources get in each window while they last; the others share the rest.
MIXTURE = {"src0": 0.2, "src1": 0.1, "src2": 0.025}

# Not a secret here: a real key comes from the caller's key store.
PSEUDONYM_KEY = "op7-demonstration-key"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer(name: str) -> str:
    """Where a vocabulary file of the installed public tokenizers is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_common_lines(documents(spark, sf_dir).select("doc_id", "text"), any_order=True)
    return out.select("doc_id", "n_lines", "n_removed", "text")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated_words(documents(spark, sf_dir)).drop("kept")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_scoring.score_documents(documents(spark, sf_dir))
    rounded = {"log_score": F.round("log_score", 4), "mean_log_score": F.round("mean_log_score", 6)}
    return scores.withColumns(rounded)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), targets=MIXTURE)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_similar(documents(spark, sf_dir)).drop("doc")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.find_leaks(documents(spark, sf_dir), benchmark)


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(documents(spark, sf_dir).select("doc_id", "text"), PSEUDONYM_KEY)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(documents(spark, sf_dir))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score_quality(docs, labels).drop("text")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup.remove_repeated_bytes(documents(spark, sf_dir)).drop("kept")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_level, pieces = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    return alignment.align_documents(documents(spark, sf_dir), byte_level, pieces)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    name: value for name, value in list(globals().items()) if name.startswith("op") and name[2].isdigit()
}
