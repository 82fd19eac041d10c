"""The corpus pipeline: ``documents`` through the stages below, each on what its predecessor kept.

Every stage but the last returns the columns of ``documents``; the last returns each
document's id with its tokens and the text decoded from them. What a stage does with nulls,
empty or very long texts, ties, repeated rows and empty tables is stated in its operator's
module. ``documents`` is taken with the columns in ``COLUMNS``; others are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varframe.llm import bpe, decontaminate, exact_dedup, language_id, near_dedup
from varframe.llm.common import ready, staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text or no letters) go."""
    ready(spark)
    docs = docs.select(*COLUMNS)
    return language_id.identify(docs, language_id.learn(docs)).filter("lang_pred <> 'und'").select("doc.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    ready(spark)
    return exact_dedup.drop_exact_copies(docs).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a class of near-duplicates the largest doc_id stays."""
    ready(spark)
    return near_dedup.drop_near_copies(docs).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark windows go."""
    ready(spark)
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).filter("not contaminated").select("doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and the digest of the text decoded from the ids."""
    ready(spark)
    return bpe.encode_documents(docs, bpe.tokenizer_file()).select(
        "doc.doc_id", "doc.lang", "doc.source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", benchmark),
    ("bpe", tokens),
]

# language profiles, near-duplicate classes and tokens have no SQL form: tests/llm compares run() with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
