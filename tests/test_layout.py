"""File layout: clustering on several columns, compaction by file size."""
import os

import pytest
from pyspark.sql import functions as F

from lakemart.operators.io import compact_small, finish_compaction, pack, write_clustered, write_zordered


def files_hit(spark, path, col, value):
    """Files whose min / max range of ``col`` holds ``value``, of all."""
    per = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min(col).alias("lo"), F.max(col).alias("hi")).collect()
    return sum(r.lo is not None and r.lo <= value <= r.hi for r in per), len(per)


@pytest.mark.parametrize("second", ["number", "string"])
def test_zorder_skips_files_on_either_column(spark, tmp_path, second):
    b = F.pmod(F.xxhash64(F.col("id") + 7), F.lit(500))
    df = spark.range(20000).select(F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(60)).cast("int")).alias("day"),
                                   (b if second == "number" else F.lpad(b.cast("string"), 4, "0")).alias("product"), "id")
    df = df.unionByName(spark.createDataFrame([(None, None, -1)], df.schema))
    write_zordered(df, str(tmp_path / "z"), ["day", "product"], 16)
    write_clustered(df, str(tmp_path / "c"), ["day", "product"], 16)
    back = spark.read.parquet(str(tmp_path / "z"))
    assert back.count() == 20001 and back.agg(F.sum("id")).first()[0] == df.agg(F.sum("id")).first()[0]
    import datetime as dt
    value = 250 if second == "number" else "0250"
    for col, v in (("day", dt.date(2024, 1, 31)), ("product", value)):
        hit, n = files_hit(spark, str(tmp_path / "z"), col, v)
        assert n >= 12 and hit <= n // 2, (col, hit, n)
    hit, n = files_hit(spark, str(tmp_path / "c"), "product", value)
    assert hit > n * 0.8                                     # range clustering helps the first column only


def test_packing():
    bins = pack([("a", 60), ("b", 50), ("c", 40), ("d", 30), ("e", 200), ("f", 20)], 100)
    assert sorted(map(sorted, bins)) == [["a", "c"], ["b", "d", "f"], ["e"]]


def test_compaction_rewrites_small_files_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(6000).select("id", F.when(F.col("id") < 4000, "x").when(F.col("id") < 5999, "y").otherwise("z").alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    df.filter("p = 'x'").repartition(9).write.partitionBy("p").parquet(path)
    df.filter("p <> 'x'").coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    names = {d: sorted(f for f in os.listdir(f"{path}/p={d}") if f.endswith(".parquet")) for d in "xyz"}
    size = max(os.path.getsize(f"{path}/p=x/{f}") for f in names["x"])
    want = sorted(map(tuple, spark.read.parquet(path).collect()))
    report = compact_small(spark, path, int(size * 3.2))
    after = {d: sorted(f for f in os.listdir(f"{path}/p={d}") if f.endswith(".parquet")) for d in "xyz"}
    assert report["bins"] == 3 and len(after["x"]) == 3
    assert (after["y"], after["z"]) == (names["y"], names["z"])   # folders without two small files keep theirs
    spark.catalog.refreshByPath(path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == want
    assert compact_small(spark, path, int(size * 3.2))["bins"] == 0
    assert not [f for f in os.listdir(tmp_path) if "compaction" in f]


def test_interrupted_compaction_is_finished(spark, tmp_path, monkeypatch):
    from lakemart.operators import io
    path = str(tmp_path / "t")
    spark.range(900).repartition(6).write.parquet(path)
    done, calls = io.finish_compaction, []

    def stop(*a):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("stop")
        return done(*a)
    monkeypatch.setattr(io, "finish_compaction", stop)
    with pytest.raises(RuntimeError, match="stop"):
        compact_small(spark, path, 1 << 20)
    monkeypatch.undo()
    for _ in range(2):
        finish_compaction(spark, path)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 1
    spark.catalog.refreshByPath(path)
    assert spark.read.parquet(path).agg(F.count("*"), F.sum("id")).first()[:] == (900, 900 * 899 // 2)
