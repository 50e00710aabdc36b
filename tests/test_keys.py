"""Surrogate-key strategies and simple sinks."""
from pyspark.sql import functions as F

from lakemart.operators.io import append_table, refresh
from lakemart.operators.keys import continue_keys, dense_key, hash_key, monotonic_key, uuid_key


def test_key_strategies(spark):
    df = spark.createDataFrame([(100, 1), (100, 2), (200, 1), (300, 1), (300, 2), (400, 1)],
                               "product_id long, version int")
    dense = {(r.product_id, r.version): r.sk for r in dense_key(df, ["product_id", "version"], "sk").collect()}
    assert sorted(dense.values()) == [1, 2, 3, 4, 5, 6] and dense[(100, 1)] == 1 and dense[(400, 1)] == 6
    hashed = hash_key(df, ["product_id", "version"], "hk").collect()
    assert len({r.hk for r in hashed}) == 6
    again = {(r.product_id, r.version): r.hk for r in hash_key(df, ["product_id", "version"], "hk").collect()}
    assert again == {(r.product_id, r.version): r.hk for r in hashed}       # stable across runs
    assert monotonic_key(df, "m").select("m").distinct().count() == 6
    assert uuid_key(df, "u").select(F.length("u").alias("n")).distinct().first().n == 36


def test_continue_keys(spark):
    existing = spark.createDataFrame([(1,), (7,), (3,)], "sk long")
    new = spark.createDataFrame([("b",), ("a",)], "name string")
    got = {r.name: r.sk for r in continue_keys(existing, new, ["name"], "sk").collect()}
    assert got == {"a": 8, "b": 9}


def test_append_and_refresh(spark, tmp_path):
    p = str(tmp_path / "t")
    append_table(spark.range(3), p)
    append_table(spark.range(2), p)
    assert spark.read.parquet(p).count() == 5
    assert refresh(spark, spark.range(4), p).count() == 4
