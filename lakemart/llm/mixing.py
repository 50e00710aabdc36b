"""Mixing sources to target weights (native).

Tokens are summed per source; targets share all tokens by weight, no target
above ``cap`` times its source (the excess is reshared by weight until none
is above: one water level over the sources). A source's repetition rate is
target / size; each of its documents is emitted floor(rate) times, plus once
more if a draw hashed from the seed, its id and its text's digest is below the
fraction. Of n rows equal in id, text and source, floor(n * fraction) are
emitted once more, and one further by the draw, so that repeated rows come near
their share as well; which of them does not matter.

Per-source sums and (id, digest, source) counts are shuffled (partial
aggregation); texts of rows that stand once never move: rates and repeated keys
join by broadcast up to a checked number, by a splittable shuffle join beyond
it. Repeated rows are numbered within (key, partition) and shifted by the
counts of earlier partitions, so a row that is there very often is not
gathered in one task.

Defined cases: a null or blank text has size 0; a null source is one source
of its own, last in order; a null doc_id is an id of its own; reruns agree in
the rows they give; an empty table gives no rows. Sources of
size 0 have target and rate 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import count_words, persisted, sized, without

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
#: Sources whose rates are broadcast (about 100 bytes each).
MAX_BROADCAST = 100_000


def source_targets(docs: DataFrame, text: str = "text", source: str = "source", weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(mix_source, mix_source_size, mix_target), one row per source."""
    sums = (docs.select(F.col(source).alias("mix_source"), count_words(F.col(text)).alias("n"))
            .groupBy("mix_source").agg(F.sum("n").alias("mix_source_size")))
    # windows over one row per source
    turn = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    s = sums.withColumn("w", weight).withColumn("cap", F.col("mix_source_size") * cap)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("mix_source").asc_nulls_last())
    full = Window.partitionBy()
    before = F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("mix_source_size").over(full) - F.coalesce(before, F.lit(0))).cast("double") / rest
    s = s.withColumn("level", level).withColumn("nth", F.row_number().over(order))
    # the first source, by cap per weight, that the level does not fill
    free = F.when(F.col("level") * F.col("w") < F.col("cap"), F.struct("nth", "level"))
    s = s.withColumn("free", F.min(free).over(full))
    target = F.when(F.col("nth") >= F.col("free.nth"), F.col("free.level") * F.col("w")).otherwise(F.col("cap").cast("double"))
    return s.select("mix_source", "mix_source_size", target.alias("mix_target"))


def draw(digest: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the seed, the id and the text's digest."""
    who = F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), digest)
    return F.conv(F.substring(F.md5(who.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``__j``, 1 to n among those of equal ``keys`` (never
    null). Checkpointed first: the partitions are part of the number."""
    rows = persisted(rows.withColumn("__p", F.spark_partition_id()))
    each = rows.groupBy(*keys, "__p").agg(F.count(F.lit(1)).alias("__c"))
    before = F.sum("__c").over(Window.partitionBy(*keys).orderBy("__p")) - F.col("__c")
    offsets = each.select(*keys, "__p", before.alias("__o"))
    local = F.row_number().over(Window.partitionBy(*keys, "__p").orderBy(F.lit(1)))
    return rows.withColumn("__l", local).join(offsets, [*keys, "__p"]).withColumn("__j", F.col("__l") + F.col("__o")).drop("__l", "__o", "__p")


def mixing_plan(docs: DataFrame, text: str = "text", source: str = "source", seed: str = SEED, **kw) -> DataFrame:
    """``docs`` plus ``mix_size``, ``mix_source_size``, ``mix_target`` and
    ``mix_copies``."""
    docs = without(docs, "mix_source", "mix_size", "mix_source_size", "mix_target", "mix_copies")
    rates = sized(source_targets(docs, text, source, **kw), MAX_BROADCAST)
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    key = F.md5(F.to_json(F.struct(F.col("doc_id"), digest.alias("d"), F.col(source).alias("s"))).cast("binary"))
    d = docs.withColumn("__k", key)
    repeated = sized(d.groupBy("__k").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1"))
    d = d.withColumn("mix_size", count_words(F.col(text))).withColumn("__u", draw(digest, seed))
    once = d.join(repeated, "__k", "left_anti").withColumns({"__n": F.lit(1).cast("long"), "__j": F.lit(1).cast("long")})
    often = _numbered(d.join(repeated, "__k"), ["__k"])
    d = once.unionByName(often)
    d = d.join(rates, d[source].eqNullSafe(rates["mix_source"])).drop("mix_source")
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))
    more = F.col("__n") * (rate - F.floor(rate))
    extra = (F.col("__j") <= F.floor(more) + (F.col("__u") < more - F.floor(more)).cast("long")).cast("int")
    return d.withColumn("mix_copies", (F.floor(rate) + extra).cast("int")).drop("__k", "__n", "__j", "__u")


def mix(docs: DataFrame, text: str = "text", source: str = "source", **kw) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as planned."""
    plan = mixing_plan(docs, text, source, **kw).filter("mix_copies > 0")
    return plan.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("__copy")).drop("__copy")
