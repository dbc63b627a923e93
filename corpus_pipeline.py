"""Training-data pipeline over ``documents``: quality, near-duplicates, benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the
shared folder and read again as the next stage's docs. All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewheel.llm import chunk_bpe, decontaminate, near_copies, quality, secrets
from tidewheel.plans.storage import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more) the document with the smallest id stays."""
    return near_copies.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document that is left."""
    return chunk_bpe.encode_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", near_dup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("bpe encoding", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Null text counts as empty, but stays null; an empty table gives no rows.

    Null ids pass each stage; repeated rows are one document after the second stage. Without
    labels of both kinds, or without benchmark items, those stages let every document through.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: No SQL: the classifier, the components and the encoding are beyond it; tests compare with brute force.
ORACLE_SQL = None
