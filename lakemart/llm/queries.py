"""The thirteen operators as registered queries, with oracle SQL for DuckDB where
SQL can express the result. Each applies its operator, with production
parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..registry import register
from ..sources.tables import load
from . import decontaminate, divergence, licenses, lines, mixing, oracles, phrases, pii, quality, sharding, simhash, substrings, toxicity, warc


@register("op1_warc")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC records written from ``pages`` and read back by byte ranges."""
    r = warc.archive_pages(load(spark, sf_dir, "pages"))
    return r.select(warc.page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    warc.page_number(F.col("refers_to")).alias("refers_to"))


@register("op2_decontaminate", oracles.DECONTAMINATE)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.judge(decontaminate.find_phrases(docs, load(spark, sf_dir, "benchmark")))
    items = F.array_join(F.sort_array("decon.items"), ",")
    return found.select("doc_id", F.col("decon.n_words").alias("n_words"), F.col("decon_hit").alias("n_hit"),
                        F.size("decon.items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"),
                        F.col("decon_contaminated").alias("contaminated"))


@register("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.train(docs, load(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


@register("op5_quality", oracles.QUALITY)
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.score_quality(docs, load(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select("doc_id", *[F.col(f"q_{c}").alias(c) for c in names])


@register("op6_substrings", oracles.SUBSTRINGS)
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup_substrings(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("sub_n_words").alias("n_words"), F.col("sub_n_removed").alias("n_removed"),
                        F.col("sub_sha256").alias("kept_sha256"))


@register("op7_sharding", oracles.SHARDING)
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(load(spark, sf_dir, "documents"))


@register("op8_mixing", oracles.MIXING)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(load(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                       F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"))


@register("op9_lines", oracles.LINES)
def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.remove_boilerplate(load(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", F.col("line_n").alias("n_lines"), F.col("line_removed").alias("n_removed"),
                        F.sha2(F.coalesce("line_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@register("op10_licenses", oracles.LICENSES)
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("lic_n_words").alias("n_words"), F.col("lic_n_base").alias("n_base"),
                        F.col("lic_first_word").alias("first_word"), F.col("lic_last_word").alias("last_word"),
                        F.array_join("lic_base_labels", ",").alias("base_labels"), F.array_join("lic_labels", ",").alias("labels"),
                        F.col("lic_score").alias("score"))


@register("op11_divergence", oracles.DIVERGENCE)
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(load(spark, sf_dir, "documents").select("text", "lang", "source"))


@register("op12_phrases", oracles.PHRASES)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(load(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@register("op13_pii")
def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.train(docs))
    base = F.filter("pii_spans", lambda s: s["base"])
    counts = [F.size(F.filter("pii_spans", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("pii_spans")).alias("spans"))
