"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import codebooks, divergence, embeddings, language, licenses, neardup, packing, pieces, quality, secrets, suffixes, templates
from tabloom.llm.oracles import OP6_SQL, OP7_SQL, OP10_SQL, OP11_SQL, OP12_SQL
from tabloom.llm.sharding import shard
from tabloom.sources.passengers import table
from tabloom.sources.shared import materialize


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op1_mixture_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(F.col("doc_id").isNotNull() & ~_held_out()))
    return language.identify(docs, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = secrets.find(docs, drop_text=True)
    base = F.filter("findings", lambda x: x["kind"].isin(*secrets.BASE))

    def number(field: str, value: str) -> Column:
        return F.size(F.filter("findings", lambda x: x[field] == value)).cast("long").alias(f"n_{value}")

    return found.select(
        "doc_id",
        *[number("kind", kind) for kind in secrets.BASE],
        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("findings")).alias("spans"),
        *[number("class", name) for name in ("live", "example", "weak")],
    )


def op4_bounded_space_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = packing.fill_windows(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    digested = filled.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.merge_leftovers(materialize(digested))


def op5_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard(rows, ["doc_id", "size", "text_crc32"], 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    measured = materialize(quality.measure(docs).drop("text"))
    cutoffs = quality.thresholds(measured, table(spark, sf_dir, "labels"))
    return quality.judge(measured, cutoffs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_log_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return templates.drop_templates(docs).select("doc_id", "n_lines", "n_dropped", kept)


def _piece_digest(ids, decoded: str) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def op8_agenda_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        digest=_piece_digest,
        digest_schema="n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def op9_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.train(docs), drop_text=True)
    place = lambda x: F.concat_ws(":", x["line"].cast("string"), x["family"])
    return found.select(
        "doc_id",
        F.size("licences").cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform("licences", place), ",").alias("places"),
        F.array_min(F.transform("licences", lambda x: x["probability"])).alias("least_probability"),
    )


def op10_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_grid_cell_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = codebooks.compress(table(spark, sf_dir, "embeddings"))
    digits = F.transform("code", lambda index: F.lpad(F.lower(F.hex(index)), 2, "0"))
    digest = F.lit(codebooks.books_digest(books)).alias("codebooks_sha256")
    return found.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", digest)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_front_coded_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.cut_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_mixture_language": op1_mixture_language,
    "op2_order_minhash": op2_order_minhash,
    "op3_secret_ownership": op3_secret_ownership,
    "op4_bounded_space_packing": op4_bounded_space_packing,
    "op5_feistel_sharding": op5_feistel_sharding,
    "op6_risk_controlled_rules": op6_risk_controlled_rules,
    "op7_log_templates": op7_log_templates,
    "op8_agenda_pieces": op8_agenda_pieces,
    "op9_licence_paragraphs": op9_licence_paragraphs,
    "op10_rotation_codes": op10_rotation_codes,
    "op11_grid_cell_codes": op11_grid_cell_codes,
    "op12_source_divergence": op12_source_divergence,
    "op13_front_coded_suffixes": op13_front_coded_suffixes,
}

ORACLES = {
    "op6_risk_controlled_rules": OP6_SQL,
    "op7_log_templates": OP7_SQL,
    "op10_rotation_codes": OP10_SQL,
    "op11_grid_cell_codes": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
}
