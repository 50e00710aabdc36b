"""Sharding by jump consistent hashing (native).

The shard of a key among ``n`` is where a pseudo-random sequence seeded by
the key last jumps below ``n`` (Lamping and Veach): no ring table, equal
shares, and with one more shard a key moves only into the new one. The
sequence is the published 64-bit linear congruential generator, seeded with
64 bits of the key's MD5 and computed in exact decimals.

Shards are decided row by row, without a shuffle. Positions in a shard
(``slot``) are numbered in (shard, bucket) groups, spread by further bits of
the id's MD5 and by the text's CRC-32 so that neither ids in a pattern nor one
id with many texts fill few buckets, then shifted by the rows in earlier buckets (at most shards * ``buckets`` counts,
so their broadcast is bounded); equal rows are one row with a count until the
end, so neither a hot key nor a group of copies is numbered in one task.

Defined cases: ids of any type that casts to text (the cast is hashed); a null
doc_id is the key ``null``; equal ids share a shard;
equal rows get distinct slots; null texts have 0 bytes and CRC 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import without

SHARDS = 24
BUCKETS = 512
OVERHEAD = 8
_MULTIPLIER = 2862933555777941757
_STEPS = 64
#: Slots written from one row at a time.
_RUN = 65_536


def jump_hash(key: Column, shards: Column, grown: Column | None = None, most: int = SHARDS + 1) -> Column:
    """Struct (shard, grown): the jump hash of an unsigned 64-bit decimal
    ``key`` among ``shards`` and, from the same sequence, among ``grown``
    (shards < grown <= most)."""
    grown = shards if grown is None else grown
    two64 = F.lit(str(1 << 64)).cast("decimal(38,0)")

    def advance(s: Column, _) -> Column:
        k = ((s["k"] * F.lit(_MULTIPLIER).cast("decimal(19,0)")).cast("decimal(38,0)") + 1) % two64
        r = ((k - k % F.lit(1 << 33)).cast("decimal(20,0)") / F.lit(1 << 33)).cast("double") + 1.0
        j = F.floor((s["j"] + 1) * (F.lit(float(1 << 31)) / r)).cast("long")
        nxt = F.struct(k.cast("decimal(20,0)").alias("k"), j.alias("j"),
                       F.when(j < shards, j).otherwise(s["shard"]).alias("shard"),
                       F.when(j < grown, j).otherwise(s["grown"]).alias("grown"))
        return F.when(s["j"] < grown, nxt).otherwise(s)

    # j starts at -1: the first jump from there lands on 0
    zero = F.lit(0).cast("long")
    start = F.struct(key.cast("decimal(20,0)").alias("k"), zero.alias("j"), zero.alias("shard"), zero.alias("grown"))
    short = F.aggregate(F.sequence(F.lit(1), F.lit(min(most, _STEPS))), start, advance)
    if most > _STEPS:  # a key that has not left the shards after so many jumps goes on
        rest = F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, advance)
        short = F.when(short["j"] < grown, rest).otherwise(short)
    return short


def _digest(column: str) -> Column:
    return F.md5(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary"))


def key_of(column: str = "doc_id") -> Column:
    return F.conv(F.substring(_digest(column), 1, 16), 16, 10).cast("decimal(20,0)")


def spread_of(column: str = "doc_id") -> Column:
    """32 bits of the key's MD5 that ``key_of`` does not use."""
    return F.conv(F.substring(_digest(column), 17, 8), 16, 10).cast("long")


def assign_shards(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """``docs`` plus ``shard`` and ``grown_shard`` (with one shard more)."""
    docs = without(docs, "shard", "grown_shard")
    h = jump_hash(key_of(key), F.lit(shards), F.lit(shards + 1), shards + 1)
    return (docs.withColumn("__h", h)
            .select(*docs.columns, F.col("__h.shard").cast("int").alias("shard"), F.col("__h.grown").cast("int").alias("grown_shard")))


def number_slots(rows: DataFrame, spread: Column, buckets: int = BUCKETS) -> DataFrame:
    """Narrow ``rows`` (with ``shard``) plus ``slot``: 0, 1, ... in each
    shard, ordered by bucket (``spread`` modulo ``buckets``), then value."""
    cols = rows.columns
    same = [F.col(c) for c in cols]
    once = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("__n"))
    once = once.withColumn("__b", F.pmod(spread, F.lit(buckets)))
    inside = Window.partitionBy("shard", "__b").orderBy(*[c.asc_nulls_last() for c in same])
    local = F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    counts = once.groupBy("shard", "__b").agg(F.sum("__n").alias("__m"))
    earlier = F.sum("__m").over(Window.partitionBy("shard").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    shift = F.broadcast(counts.select("shard", "__b", F.coalesce(earlier, F.lit(0)).alias("__s")))
    first = once.withColumn("__l", local).join(shift, ["shard", "__b"]).withColumn("slot", F.col("__l") + F.col("__s"))
    single = first.filter("__n = 1").select(*cols, F.col("slot").cast("long"))
    runs = first.filter("__n > 1").select(*cols, "slot", "__n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(_RUN).cast("long"))).alias("__r"))
    each = F.sequence(F.col("__r"), F.least(F.col("__r") + (_RUN - 1), F.col("__n") - 1))
    copies = runs.repartition(F.col("slot"), F.col("__r")).select(*cols, "slot", F.explode(each).alias("__k"))
    return single.unionAll(copies.select(*cols, (F.col("slot") + F.col("__k")).cast("long").alias("slot")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """doc_id, size (text bytes + 8), text_crc32, law, shard, slot and
    grown_shard of every row."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(body) + OVERHEAD).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    placed = number_slots(assign_shards(narrow, shards), spread_of() + F.col("text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
