"""A corpus pipeline: good documents, without common lines, near duplicates and leaks, packed.

Each stage takes all that the one before kept and returns the columns of ``documents``; the last
returns pieces of sequences. Stages are written between, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.decontamination import drop_leaking
from llm.line_dedup import remove_common_lines
from llm.ngram_join import keep_one_of_each
from llm.packing import pack_documents
from llm.quality import keep_good
from llm.queries import MIXTURE, tokenizer
from llm.storage import written

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines shared with an earlier document go; the document stays with the rest."""
    return remove_common_lines(docs, any_order=True).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences in the target mixture of sources."""
    return pack_documents(docs, tokenizer("word_bpe_49k.json"), targets=MIXTURE)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

# A learned model, alignments and a tokenizer are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
