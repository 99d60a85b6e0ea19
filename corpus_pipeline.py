"""Corpus pipeline: quality rules, line dedup, near-dedup, secret scan and packing, one after the other.

Every stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read again as the next
stage's ``docs``. All but the last keep the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import neardup, packing, quality, secrets, templates
from tabloom.sources.passengers import table
from tabloom.sources.shared import TEXT_CODEC, discard, materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go. Cutoffs are set on the labelled documents among ``docs``."""
    measured = materialize(quality.measure(docs), codec=TEXT_CODEC)
    cutoffs = quality.thresholds(measured, table(spark, sf_dir, "labels"))
    return quality.judge(measured, cutoffs).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; ``n_chars`` follows the text, and documents left without one go."""
    cut = templates.drop_templates(docs).where(F.length("text") > 0)
    chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", chars).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), codec=TEXT_CODEC)
    # By row number, so that of repeated rows one stays, too; the smallest is the first as stored.
    kept = neardup.near_duplicates(rows, key="_row").where("kept").select("_row")
    return rows.join(materialize(kept).hint("merge"), "_row", "left_semi").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blotted out, except widely copied examples; ``n_chars`` follows the text."""
    clean = secrets.redact(secrets.find(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences that they are packed into."""
    filled = packing.fill_windows(docs, public_tokenizers.path("byte_bpe_50k.json"))
    digested = filled.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.merge_leftovers(materialize(digested))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("secret scan", secret_scan),
    ("packing", pack),
]

# Near-dedup and packing can't be put in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), codec=TEXT_CODEC)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
