"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lifespans.llm import decontaminate, mixing, near_copies, storage, tokens, toxicity
from lifespans.llm.queries import MIX, TOXIC_FROM
from lifespans.llm.storage import Scratch


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below the threshold."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TOXIC_FROM)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard similarity 0.8 or more."""
    return near_copies.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents mixed to target weights; a document comes once for every pass that takes it."""
    return mixing.mixed_documents(docs, MIX)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' index: doc_id, start, n_tokens, ids_crc32."""
    return tokens.token_files(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_ids", token_ids),
]

#: Trained weights, fingerprints and tokenizer ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``; a stage's table and scratch go when the next one's table is written.

    The last stage's files stay: they are the output.
    """
    scratch, before = Scratch(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        held = storage.made()
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        if name != STAGES[-1][0]:
            storage.release(held)
        before = name
    return docs
