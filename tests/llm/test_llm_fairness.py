"""Verdicts and mixes that copies and repeated rows must not tilt."""
import pytest
from pyspark.sql import functions as F

from lakemart.llm import mixing, quality
from llm_fixtures import prose  # noqa: F401

DOCS = "doc_id long, text string"


def test_different_words_of_one_crc_do_not_repeat(spark):
    """plumless and buckeroo have the same CRC-32."""
    head = [f"w{i}" for i in range(8)]

    def text(a, b):
        return " ".join([*head[:4], a, *head[4:], "x", "y", *head[:4], b, *head[4:], "z", "zz"])
    df = spark.createDataFrame([(1, text("plumless", "buckeroo")), (2, text("plumless", "other")), (3, text("same", "same"))], DOCS)
    got = {r.doc_id: r.n for r in df.select("doc_id", quality.repeated_words(quality.split_words(F.col("text"))).alias("n")).collect()}
    assert got == {1: 0, 2: 0, 3: 18}


@pytest.fixture(scope="module")
def base(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


@pytest.mark.parametrize("n", [20, 100, 2000])
def test_copies_do_not_cost_a_clean_text(spark, base, n):
    """Exact and near copies of clean texts that nobody labelled."""
    docs, labels = base
    clean = docs.join(labels.filter("quality = 1").select("doc_id"), "doc_id", "left_semi").filter(F.size(F.split("text", " ")) > 150)
    a, b = (r for r in clean.orderBy("doc_id").limit(2).collect())
    words = b.text.split(" ")
    more = [(10**7 + i, a.text) for i in range(n)] + [(2 * 10**7 + i, " ".join([*words[:i % 140], f"x{i}q", *words[i % 140 + 1:]])) for i in range(n)]
    rest = docs.filter(~F.col("doc_id").isin(a.doc_id, b.doc_id))
    found = quality.score_quality(rest.unionByName(spark.createDataFrame(more, DOCS).repartition(8)), labels)
    assert found.filter("doc_id >= 10000000 and not q_kept").count() == 0


def test_a_tenth_of_the_labels_decides_alike(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    few = labels.filter("quality = 0 or pmod(hash(doc_id), 10) = 0")
    kept = quality.score_quality(docs.select("doc_id", "text"), few).filter("not q_base_failed").join(labels.select("doc_id", "quality").distinct(), "doc_id")
    got = {r.quality: r.share for r in kept.groupBy("quality").agg(F.avg(F.col("q_kept").cast("double")).alias("share")).collect()}
    assert got[1] > 0.97 and got[0] < 0.03


@pytest.mark.parametrize("case", ["one_id", "equal_rows"])
def test_rows_that_share_an_id_come_near_the_target(spark, case):
    rows = [(7, f"{'t' if case == 'equal_rows' else i} a b c d", "a") for i in range(1000)] + [(10**6 + i, f"{i} b c", "b") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    plan = mixing.mixing_plan(df)
    for r in plan.groupBy("source").agg(F.sum(F.col("mix_size") * F.col("mix_copies")).alias("taken"), F.max("mix_target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 0.05 * r.target, r
    if case == "equal_rows":
        again = mixing.mixing_plan(df.repartition(3))
        count = lambda p: sorted((tuple(r) for r in p.groupBy("doc_id", "mix_copies").count().collect()))
        assert count(plan) == count(again)
        assert abs(sum(r.taken - r.target for r in plan.filter("source = 'a'").groupBy().agg(F.sum(F.col("mix_size") * F.col("mix_copies")).alias("taken"), F.max("mix_target").alias("target")).collect())) <= 5
