"""Queries over the training-text operators with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, decontaminate, infill, licences, media, minhash, mixing, oracle, pseudo_lm, quality, simhash, tokens, toxicity, urlgraph

RULES = [
    urlgraph.Rule("allow", "org", "/"),
    urlgraph.Rule("block", "example.org", "/es/"),
    urlgraph.Rule("block", "example.org", "/en/1"),
    urlgraph.Rule("allow", "com", "/fr/"),
    urlgraph.Rule("block", "com", "/de/"),
]
TOXIC_FROM = 0.5
MIX = mixing.Target(repeats=2.0)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature",
        "width", "height",
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = quality.fit(docs, _read(spark, sf_dir, "labels"), use=~quality.held_out())
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"))
    return toxicity.severity(docs, model).select("doc_id", "severity", (F.col("severity") >= TOXIC_FROM).alias("toxic"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlgraph.judge_urls(_read(spark, sf_dir, "pages"), RULES)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_read(spark, sf_dir, "documents"), MIX)


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licences.scan(docs.select("doc_id", path.alias("path"), "text"))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_files(_read(spark, sf_dir, "documents"))


def op10_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_lm.pseudo_likelihood(_read(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.fill_in_middle(_read(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_fingerprints(_read(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash, op2_decontamination, op3_media, op4_quality, op5_toxicity, op6_urls, op7_mixing, op8_licences, op9_tokens,
        op10_pseudo_likelihood, op11_fill_in_middle, op12_fingerprints, op13_alignment,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": oracle.DECONTAMINATION, "op6_urls": oracle.urls(RULES), "op7_mixing": oracle.mixing(MIX.repeats),
        "op8_licences": oracle.licences(licences.TEMPLATES, licences.whole_texts()),
        "op11_fill_in_middle": oracle.INFILL,
    }
