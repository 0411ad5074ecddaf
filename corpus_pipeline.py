"""The training-data pipeline: stages over documents, each written as Parquet and read again.

1. ``toxicity``: documents that the chain scores at its threshold or above go.
2. ``near_duplicates``: of each class of linked documents, the one with the smallest doc_id stays.
3. ``repeated_passages``: words of passages that occur earlier go; documents of which nothing is left go.
4. ``decontamination``: documents that overlap a benchmark item go.
5. ``encoding``: the ids of every remaining text, with digests of the ids and of the decoded text.

All stages but the last return the columns of their input. Rows with equal doc_id and text are one
document (the second stage keeps one of them); a null doc_id is a value like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citylake.llm import bpe, common, decontaminate, jaccard_join, substring_dedup, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    labels = common.prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.fit(docs, labels))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked documents."""
    common.prepared(spark)
    return jaccard_join.one_of_each(docs)


def repeated_passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier."""
    common.prepared(spark)
    return substring_dedup.without_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    items = common.prepared(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminated(docs, items)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digests of the ids and of the decoded text."""
    common.prepared(spark)
    return bpe.encoded_with_digests(docs, bpe.tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("repeated_passages", repeated_passages_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]
#: SQL cannot express the learned and hashed stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; each stage reads what its predecessor wrote."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
