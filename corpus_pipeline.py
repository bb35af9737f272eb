"""A training corpus from ``documents``, in stages that each call one operator.

Every stage works on all rows of the stage before it, and all but the last
return the columns of ``documents``: quality rules drop what the production
policy rejects, near-duplicate detection keeps one document of each group,
decontamination drops documents that hold a benchmark item, personal data are
replaced by their kind, and the texts that remain are packed into sequences.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from matchmart.llm import decontaminate, near, packing, pii, quality
from matchmart.session import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs, pii.train_table(pii.labelled_by_hand(spark)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs).checkpoint())


#: (name, function); each function takes (spark, docs, sf_dir).
STAGES = [
    ("quality rules", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("best-fit packing", packing_stage),
]

#: SQL cannot express the sampling, the random field or the tokenizer; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each stage's rows are written as Parquet and read again."""
    base = f"{ensure_checkpoint_dir(spark)}/corpus-{os.urandom(6).hex()}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
