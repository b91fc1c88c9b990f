"""A bounded sample of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, use: Column | None = None, positive: float = 0.5) -> DataFrame:
    """(doc_id, text, label): at most about ``max_rows`` labelled documents, up to a share of ``positive`` with label 1.

    The labels are thinned by a hash of doc_id, at a rate for each class that follows from its count, so the texts of
    the sample alone meet the labels: the broadcast side is bounded by ``max_rows``.  Null labels and ids are left out;
    of repeated labels of an id the larger counts, of repeated documents the smallest text.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")) if use is None else (
        known.where(use).groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in known.where("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    rate = F.lit(0.0)
    for value, n in sizes.items():
        rate = F.when(F.col("label") == value, F.lit(min(1.0, max_rows * (positive if value else 1 - positive) / max(n, 1)))).otherwise(rate)
    drawn = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(label)), F.lit(1_000_000)) < rate * 1_000_000)
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(drawn), "doc_id")
