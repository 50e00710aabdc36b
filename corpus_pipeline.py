"""The corpus pipeline: five operators applied one after the other.

``STAGES`` holds (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's ``docs``. All but the last return the columns of
``documents``; the last returns the shard digest of every remaining row.
``ORACLE_SQL`` is None: XXH64 SimHash classes cannot be written in SQL, so
tests/llm holds the pipeline against a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import decontaminate, mixing, quality, sharding, simhash
from lakemart.llm.common import keep_columns
from lakemart.session import checkpoint_dir
from lakemart.sources.tables import load


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    labels = load(spark, sf_dir, "labels")
    return keep_columns(docs, ("doc_id", "text"), lambda d: quality.score_quality(d, labels).filter("q_kept"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark passages go; others stay as they are."""
    benchmark = load(spark, sf_dir, "benchmark")
    return keep_columns(docs, ("doc_id", "text"), lambda d: decontaminate.judge(decontaminate.find_phrases(d, benchmark)).filter("not decon_contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return keep_columns(docs, ("doc_id", "text", "source"), mixing.mix)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("simhash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables are written to a
    new folder beside the shared checkpoints."""
    out = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{k}")
        docs = spark.read.parquet(f"{out}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
