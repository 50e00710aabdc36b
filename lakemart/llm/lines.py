"""Line dedup by distinct-site spread (native).

Lines (split at ``\\n``, ASCII spaces trimmed, blank ones left out of all
counts) are known by 128 bits of hashes. HyperLogLog sketches of the sites of
each line hash merge by aggregation; a line whose estimate is surely at or
above ``min_sites`` is cross-site boilerplate, one surely below is not, and
lines near the threshold (five standard errors) get exact distinct counts.
Boilerplate lines are removed from every document.

Only hashes are shuffled for the counts, with partial counts formed before
the shuffle; lines that occur often enough to matter get a sketch; lines above the threshold join back by hash (splittable), and a
text moves at most once, to meet the numbers of its lines to remove.

Defined cases: a null text has no lines and stays null; a null site is one
site of its own; repeated rows lose the same lines; blank lines stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, apart, let, row_key, sized, without

MIN_SITES = 10
LG_K = 12


def _lines(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, key, site, pos, h1, h2) of non-blank lines."""
    d = docs.select("doc_id", "key", "site", F.posexplode(F.split(F.col(text), "\n")).alias("pos", "raw"))
    d = d.select("doc_id", "key", "site", "pos", F.btrim("raw", F.lit(SPACES)).alias("line")).filter("line <> ''")
    return d.select("doc_id", "key", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"))


def _among(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``lines`` with one of the (h1, h2) ``keys``; a hot line can be split."""
    a, b = (apart(F.col("h1")) == F.col("__1")), (F.col("h2") == F.col("__2"))
    return lines.join(keys.select(apart(F.col("h1")).alias("__1"), F.col("h2").alias("__2")), a & b, "left_semi")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2) of the lines that stand on at least ``min_sites`` sites."""
    margin = 5 * 1.04 / 2 ** (lg_k / 2) * min_sites + 0.5
    # a line that occurs fewer times than min_sites gets no sketch
    often = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_sites)
    spread = (_among(lines, sized(often.select("h1", "h2"))).groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("s"))
              .select("h1", "h2", F.hll_sketch_estimate("s").alias("sites")))
    sure = spread.filter(F.col("sites") > min_sites + margin).select("h1", "h2")
    near = spread.filter(F.col("sites").between(min_sites - margin, min_sites + margin)).select("h1", "h2")
    pairs = _among(lines, near).select("h1", "h2", "site").distinct()
    exact = pairs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= min_sites).select("h1", "h2")
    return sure.unionAll(exact)


def remove_boilerplate(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """``docs`` plus ``line_n`` (non-blank lines), ``line_removed`` and
    ``line_text`` (the text without boilerplate lines)."""
    docs = without(docs, "line_n", "line_removed", "line_text")
    where: Column = F.coalesce(F.concat(F.lit("s:"), F.col(site).cast("string")), F.lit("null"))
    keyed = docs.select("doc_id", row_key(docs, text).alias("key"), where.alias("site"), F.col(text).alias("__t"))
    lines = _lines(keyed, "__t")
    hit = (_among(lines, boilerplate(lines, min_sites, lg_k))
           .groupBy("doc_id", "key").agg(F.collect_set("pos").alias("__gone"))
           .select(F.col("doc_id").alias("__i"), F.col("key").alias("__k"), "__gone"))
    d = docs.select("*", row_key(docs, text).alias("__key"))
    d = d.join(hit, (F.col("__key") == F.col("__k")) & F.col("doc_id").eqNullSafe(F.col("__i")), "left")
    raw = F.split(F.col(text), "\n")
    kept = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(let(raw, lambda r: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(r) - 1), F.col("__gone")), lambda i: F.get(r, i)), "\n")))
    count = F.size(F.filter(raw, lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    return d.select(*docs.columns, F.when(F.col(text).isNull(), 0).otherwise(count).cast("long").alias("line_n"),
                    F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("line_removed"), kept.alias("line_text"))
