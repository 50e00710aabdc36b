"""Every row counts in the quality model, copies share one weight."""
from pyspark.sql import functions as F

from lakemart.llm import quality


def _weights(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, good boolean")
    got = quality.class_weights(docs, F.col("good")).collect()
    return {" ".join(r.words): (r.raw, r.target) for r in got}


def test_different_texts_of_one_class_all_count(spark):
    """The four words of least hash in both texts make them one class; the
    words that only one of them has count all the same."""
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(1, shared + " alpha", True), (2, shared + " beta gamma", False), (3, " ".join(f"o{i}" for i in range(30)), False)]
    got = _weights(spark, rows)
    assert got[rows[0][1]] == (quality.UNIT // 2, quality.UNIT)
    assert got[rows[1][1]] == (quality.UNIT // 2, 0)
    assert got[rows[2][1]] == (quality.UNIT, 0)


def test_a_word_of_a_later_copy_moves_its_weight(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    docs = spark.createDataFrame([(1, shared + " alpha", True), (2, shared + " beta", False)], "doc_id long, text string, good boolean")
    weights = quality.gram_weights(docs, F.col("good")).first().weights
    bucket = docs.sparkSession.range(1).select(F.crc32(F.lit("beta").cast("binary")) % quality.BUCKETS).first()[0]
    assert weights[bucket] < 0
