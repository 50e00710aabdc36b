"""SimHash near-dedup by pigeonhole blocks.

Fingerprint: 64 majority bits over the XXH64 values of a document's word
shingles. Two fingerprints link if at most ``bits`` bits differ. Cut into
``blocks`` parts, such a pair agrees on at least ``blocks - bits`` whole
parts; so each distinct fingerprint is keyed once for every choice of that
many parts, and only fingerprints that meet under a key are compared
(XOR, bit count).

* Copies: equal fingerprints are one row before any key is made.
* A key shared by up to ``group`` fingerprints is verified in one task that
  returns a spanning forest of the links (at most one edge per fingerprint),
  never all pairs.
* A key shared by more takes the linear way: fingerprints within ``bits`` of
  each other have a common point at half that distance that keeps the key's
  bits. Each fingerprint is sent to all such points (some hundred) and linked
  to the smallest one there. Nothing is dropped and no group is gathered:
  such keys are found by counting, and their fingerprints expand to points
  where they were read.
* Classes: alternating large-star / small-star rounds over the edges,
  checkpointed to the shared folder.

Defined cases: null and wordless texts have fingerprint zero and link like
any other; null ids are never a component id unless all ids of a component
are null; repeated rows are returned as often as they occur.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import annotate, apart, persisted, row_key, sized

SHINGLE = 4
BITS = 4
BLOCKS = 7
GROUP = 4096
SEED = 42
_BLOCK = 1 << 16
# lower-case A-Z, every other ASCII space to a blank
_FOLD = bytes(32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))


def signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of UTF-8 bytes."""
    import re

    import xxhash

    t = (text or b"").translate(_FOLD).strip(b" ")
    if b"  " in t:
        t = re.sub(rb" +", b" ", t)
    if not t:
        return 0
    spaces = np.flatnonzero(np.frombuffer(t, np.uint8) == 32)
    n = max(1, spaces.size + 2 - shingle)
    starts = np.concatenate(([0], spaces + 1))[:n]
    ends = np.concatenate((spaces, [len(t)]))[-n:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        h = np.array([digest(t[s:e], seed) for s, e in zip(starts[at:at + _BLOCK].tolist(), ends[at:at + _BLOCK].tolist())], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, fp): the fingerprint (signed) of every row."""
    def make():
        def run(batch, texts):
            return [pa.array([signed(fingerprint(t, shingle)) for t in texts], pa.int64())]
        return run
    keyed = docs.select("doc_id", row_key(docs, text).alias("key"), F.col(text).alias("__text"))
    return annotate(keyed, "__text", "fp long", make).select("doc_id", "key", "fp")


def _masks(bits: int, blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, blocks - bits)]


def _forest(fps: list[int], bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints."""
    if len(fps) == 2:
        a, b = fps
        return [(a, b)] if ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= bits else []
    left, edges = np.array(fps, np.int64), []
    while left.size > 1:
        todo, left = [left[0]], left[1:]
        while todo and left.size:
            p = todo.pop()
            near = np.bitwise_count((left ^ p).view(np.uint64)) <= bits
            if near.any():
                found = left[near]
                edges += [(int(p), q) for q in found.tolist()]
                todo.extend(found)
                left = left[~near]
    return edges


def links(fps: DataFrame, bits: int = BITS, blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints that a chain of
    links connects. ``fps`` holds distinct values in a column ``fp``."""
    if not 0 < bits < blocks:
        raise ValueError("0 < bits < blocks")
    masks = _masks(bits, blocks)
    keys = F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k")) for i, m in enumerate(masks)])
    keyed = fps.select("fp", F.explode(keys).alias("x")).select("x.c", "x.k", "fp")
    # the keys shared by more than ``group`` are found by partial counts, and
    # joined so that a hot one can be split
    hot = sized(keyed.groupBy("c", "k").count().filter(F.col("count") > group).select(F.col("c").alias("__c"), apart(F.col("k")).alias("__k")))
    on = (F.col("c") == F.col("__c")) & (apart(F.col("k")) == F.col("__k"))
    rest = keyed.join(hot, on, "left_anti")
    met = rest.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("c", "k"))).filter("n > 1")

    def verify(batches):
        for b in batches:
            pairs = [e for fps in b.column(0).to_pylist() for e in _forest(fps, bits)]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])
    few = met.groupBy("c", "k").agg(F.collect_list("fp").alias("fps"))
    small = few.select("fps").mapInArrow(verify, "a long, b long")
    big = keyed.join(hot, on, "left_semi")
    # inner points: within bits // 2 of a fingerprint; outer: the rest of the way
    inner, outer = bits // 2, bits - bits // 2
    free = F.element_at(F.array(*[F.array(*[F.lit(signed(1 << b)) for b in range(64) if not m >> b & 1]) for m in masks]), F.col("c") + 1)
    points = _points(big.select("c", "k", "fp", free.alias("free")), outer)
    at = Window.partitionBy("c", "k", "p")
    hub = F.min(F.when(F.col("r") <= inner, F.col("fp"))).over(at)
    large = points.select(F.col("fp").alias("a"), hub.alias("b")).filter("b is not null and a <> b")
    return small.unionAll(large)


def _points(df: DataFrame, radius: int) -> DataFrame:
    """Rows (c, k, fp, p, r): the points p that differ from fp in r <= radius
    of the free bits (each once)."""
    cur = df.select("c", "k", "fp", "free", F.col("fp").alias("p"), F.lit(0).alias("r"), F.lit(-1).alias("last"))
    out = cur
    for r in range(1, radius + 1):
        nxt = cur.filter(F.col("r") == r - 1).select("c", "k", "fp", "free", "p", "last", F.posexplode("free").alias("i", "bit"))
        cur = (nxt.filter(F.col("i") > F.col("last"))
               .select("c", "k", "fp", "free", F.col("p").bitwiseXOR(F.col("bit")).alias("p"), F.lit(r).alias("r"), F.col("i").alias("last")))
        out = out.unionAll(cur)
    return out.select("c", "k", "fp", "p", "r")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components of the edges (a, b) by alternating
    large-star and small-star rounds; root is the smallest node. Hubs meet
    only aggregates and splittable joins; every round is checkpointed."""
    e = persisted(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = least.select(apart(F.col("u")).alias("__u"), "m")
        large = both.join(least, apart(F.col("u")) == F.col("__u")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        other = least.select(apart(F.col("u")).alias("__u"), "m")
        small = (large.join(other, apart(F.col("u")) == F.col("__u")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        e = persisted(small)
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def cluster(prints: DataFrame, bits: int = BITS, blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """(fp, root, component_id): the class of every distinct fingerprint,
    its smallest fingerprint and the smallest doc_id in it."""
    per = persisted(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(per.select("fp"), bits, blocks, group))
    rooted = per.join(roots, per["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id")).select(apart(F.col("root")).alias("__r"), "component_id")
    return rooted.join(ids, apart(F.col("root")) == F.col("__r")).select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, bits: int = BITS,
                    blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """(doc_id, key, fp, root, component_id), one row per row of ``docs``."""
    prints = persisted(fingerprints(docs, text, shingle))
    return prints.join(cluster(prints, bits, blocks, group), "fp").select("doc_id", "key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, text: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` with one document of each class: the one with
    the smallest id (null ids last; then the smallest key; of rows equal in
    id and text, any one)."""
    found = persisted(near_duplicates(docs, text, **kw))
    best = (found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("b"))
            .select(apart(F.col("root")).alias("__r"), F.col("b.doc_id").alias("__i"), F.col("b.key").alias("__k")))
    same = F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("key") == F.col("__k"))
    kept = (found.join(best, (apart(F.col("root")) == F.col("__r")) & same, "left_semi")
            .groupBy(F.col("doc_id").alias("__i"), F.col("key").alias("__k")).agg(F.count(F.lit(1)).alias("n")))
    keyed = docs.select("*", row_key(docs, text).alias("__key"))
    on = F.col("doc_id").eqNullSafe(F.col("__i")) & (F.col("__key") == F.col("__k"))
    single = keyed.join(kept.filter("n = 1"), on, "left_semi")
    several = keyed.join(kept.filter("n > 1"), on, "left_semi").dropDuplicates(["doc_id", "__key"])
    return single.unionAll(several).select(*docs.columns)
