"""The corpus pipeline: documents to packed sequences in five stages.

Each stage takes all that the stage before it kept and returns a DataFrame, which is written as Parquet and read again,
so a lost executor costs no more than the stage that it was lost in. All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexloom.llm.exact_dedup import drop_exact
from codexloom.llm.packing import pack_documents
from codexloom.llm.secrets import redact
from codexloom.llm.simhash import drop_near
from codexloom.llm.toxicity import drop_toxic, trained_on
from codexloom.session import let_workers_import, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model is trained on the labels of the tables in sf_dir."""
    return drop_toxic(docs, trained_on(let_workers_import(spark), sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, the one with the largest doc_id."""
    return drop_exact(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints, the one with the smallest doc_id. Shingles have five words."""
    return drop_near(docs, words=5)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts and n_chars counted anew."""
    out = redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2,048 tokens."""
    return pack_documents(docs).withColumnRenamed("_id", "doc_id")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("secrets", secrets), ("packing", packing)]

#: Dictionary compression, fingerprints and token ids have no SQL form; tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(let_workers_import(spark), docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
