"""From raw documents to packed training sequences, stage by stage over whatever the stage before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontaminate, minhash, packing, secrets, toxicity
from orderlens.llm.common import Workspace


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is learned from those of the labelled ones that are here."""
    return toxicity.acceptable(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a similarity of 0.8 or more the one with the smallest id stays, once. Rows without id stay."""
    judged = minhash.near_duplicates(docs, percent=80)
    kept = judged.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns).union(docs.where("doc_id IS NULL"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of the secrets in their texts."""
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Training, signatures and packing are beyond SQL; tests hold the stages against plain models.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over sf_dir's documents; each result is written before the next stage reads it."""
    space, docs = Workspace(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        before, docs = docs, space.store(stage(spark, docs, sf_dir))
        if hasattr(before, "stored_at"):
            space.drop(before)
    return docs
