"""Window-style operators written so that no step needs one task to hold a
whole table or a whole hot group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import round_half_up
from ..session import checkpoint_dir


def _cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def row_index(df: DataFrame, order, name: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Exact ``row_number() OVER (ORDER BY order)`` (1-based, LONG) without
    a single-partition window.

    1. range-partition on the order keys and sort inside each partition;
    2. checkpoint to the shared checkpoint folder, so partition contents and
       order are fixed even if executors are lost and tasks re-run;
    3. count rows per partition (one small row per partition), prefix-sum
       those counts into offsets (bounded by the partition count, so
       broadcasting them is safe);
    4. row number = offset of the partition + position inside it.

    ``order`` must be a total order (add a unique tie-break column), or
    ties are numbered arbitrarily as with ``row_number``.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    order = _cols(order)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    placed = ranged.select("*", F.spark_partition_id().alias("_ri_pid"),
                           F.monotonically_increasing_id().alias("_ri_mid"))
    counts = placed.groupBy("_ri_pid").agg(F.count(F.lit(1)).alias("_ri_n"))
    offsets = counts.select(
        "_ri_pid",
        (F.sum("_ri_n").over(Window.orderBy("_ri_pid")) - F.col("_ri_n")).alias("_ri_off"))
    local = F.col("_ri_mid") - F.shiftleft(F.col("_ri_pid").cast("long"), 33)
    out = placed.join(F.broadcast(offsets), "_ri_pid")
    return (out.withColumn(name, local + F.col("_ri_off") + 1)
               .drop("_ri_pid", "_ri_mid", "_ri_off"))


def ntile_global(df: DataFrame, order, n: int, name: str = "ntile") -> DataFrame:
    """Exact ``NTILE(n) OVER (ORDER BY order)`` from a global row index and
    the total count (a scalar subquery), without a single-partition window.
    The first ``total % n`` tiles get one extra row, as NTILE does."""
    tmp = f"_nt_rn_{name}"
    indexed = row_index(df, order, tmp)
    # the largest index is the row count; reading it from the checkpointed
    # index keeps the plan small (no second pass over the input lineage)
    total = indexed.select(F.max(tmp)).scalar()
    q = F.floor(total / n)
    rem = total - q * n
    r = F.col(tmp)
    big = rem * (q + 1)
    tile = F.when(r <= big, F.floor((r - 1) / (q + 1)) + 1) \
            .otherwise(rem + F.floor(F.try_divide(r - big - 1, q)) + 1)
    return indexed.withColumn(name, tile.cast("int")).drop(tmp)


def ntiles_global(df: DataFrame, tiles: dict[str, list[str]], n: int) -> DataFrame:
    """Exact ``NTILE(n) OVER (ORDER BY cols)`` for several orders at once
    (name -> ascending columns, the last one unique), with one shuffle and
    one checkpoint in all.

    Every row is laid down once per order (other columns only once); one
    index over (order, its columns) ranks all of them. The rows at which a
    tile begins, at most n - 1 an order, are read back as scalar subqueries,
    and each row counts the cuts at or below it: no index is joined back."""
    names = list(tiles)
    numbered = F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("_nt_m")
    used = {c for cols in tiles.values() for c in cols}
    laid = df.select("*", numbered)
    laid = laid.select(*[F.col(c) if c in used else F.when(F.col("_nt_m") == 0, F.col(c)).alias(c) for c in df.columns], "_nt_m")
    order = [F.col("_nt_m"), *[F.when(F.col("_nt_m") == i, F.col(c)) for i, name in enumerate(names) for c in tiles[name]]]
    indexed = row_index(laid, order, "_nt_i")
    total = indexed.select(F.expr(f"max(_nt_i) div {len(names)}")).scalar()
    rank, q = F.col("_nt_i") - F.col("_nt_m") * F.col("_nt_n"), F.expr(f"_nt_n div {n}")
    first = F.exists(F.sequence(F.lit(1), F.lit(n - 1)) if n > 1 else F.array().cast("array<int>"),
                     lambda t: t * q + F.least(t, F.col("_nt_n") % n) + 1 == rank)
    cuts = indexed.withColumn("_nt_n", total).filter(first)

    def at(name: str) -> Column:
        return F.struct(*[F.col(c).alias(f"k{j}") for j, c in enumerate(tiles[name])])

    below = [cuts.select(F.collect_list(F.when(F.col("_nt_m") == i, at(name)))).scalar() for i, name in enumerate(names)]
    rows = indexed.filter("_nt_m = 0").select(*df.columns, *[b.alias(f"_nt_c{i}") for i, b in enumerate(below)])

    def tile(i: int, name: str) -> Column:
        return (F.size(F.filter(f"_nt_c{i}", lambda c: c <= at(name))) + 1).cast("int").alias(name)

    return rows.select(*df.columns, *[tile(i, name) for i, name in enumerate(names)])


def running_total(df: DataFrame, order, amount: str, name: str, num_partitions: int | None = None) -> DataFrame:
    """``SUM(amount) OVER (ORDER BY order)`` (distinct order values) without
    a single-partition window: range partitions are summed, their offsets
    broadcast (one row per partition), and running sums kept inside each."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    order = _cols(order)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_rt_pid", F.spark_partition_id()).checkpoint(eager=True)
    sums = ranged.groupBy("_rt_pid").agg(F.sum(amount).alias("_rt_n"))
    offsets = sums.select("_rt_pid", (F.sum("_rt_n").over(Window.orderBy("_rt_pid")) - F.col("_rt_n")).alias("_rt_off"))
    inside = F.sum(amount).over(Window.partitionBy("_rt_pid").orderBy(*order))
    return (ranged.withColumn(name, inside).join(F.broadcast(offsets), "_rt_pid")
            .withColumn(name, (F.col(name) + F.col("_rt_off")).cast("long")).drop("_rt_pid", "_rt_off"))


def medians_in(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """(group, name): the exact median of the non-null values of each group
    (mean of the two middle ones), as ``percentile(value, 0.5)`` gives it,
    without a buffer of a group's values: values are counted per (group,
    value), running counts over all groups place them, and the two middle
    values are picked by position."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_md_n"))
    placed = running_total(counts, [F.col(group), F.col(value)], "_md_n", "_md_c")
    bounds = placed.groupBy(group).agg(F.min(F.col("_md_c") - F.col("_md_n")).alias("_md_0"), F.max("_md_c").alias("_md_1")).select(
        F.col(group).alias("_md_g"), "_md_0", (F.col("_md_1") - F.col("_md_0")).alias("_md_all"))
    at = placed.join(bounds, F.col(group).eqNullSafe(F.col("_md_g"))).withColumn("_md_c", F.col("_md_c") - F.col("_md_0"))

    def middle(rank: str) -> Column:
        return F.min(F.when(F.col("_md_c") > F.expr(rank), F.col(value)))

    both = at.groupBy(group).agg(middle("(_md_all - 1) div 2").alias("_md_l"), middle("_md_all div 2").alias("_md_h"))
    return both.select(group, (0.5 * F.col("_md_l") + 0.5 * F.col("_md_h")).alias(name))


def dense_rank_in(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY group ORDER BY value DESC)`` without
    sorting a group in one task: the distinct (group, value) pairs are
    indexed over all groups, a pair's rank is its index less those of
    earlier groups, and rows get it by join."""
    pairs = df.select(group, value).distinct()
    indexed = row_index(pairs, [F.col(group).asc_nulls_last(), F.col(value).desc()], "_dr_i")
    first = indexed.groupBy(group).agg(F.min("_dr_i").alias("_dr_0")).select(F.col(group).alias("_dr_g0"), "_dr_0")
    ranks = indexed.join(first, F.col(group).eqNullSafe(F.col("_dr_g0"))).select(
        F.col(group).alias("_dr_g"), F.col(value).alias("_dr_v"), (F.col("_dr_i") - F.col("_dr_0") + 1).cast("int").alias(name))
    return df.join(ranks, df[group].eqNullSafe(F.col("_dr_g")) & df[value].eqNullSafe(F.col("_dr_v"))).drop("_dr_g", "_dr_v")


def latest_per_key(df: DataFrame, key, order, values: list[str]) -> DataFrame:
    """Values of the row with the greatest ``order`` per ``key`` (the
    ``row_number() ... = 1`` pattern) as a ``max_by`` aggregate: partial
    aggregation runs before the shuffle, so a hot key never lands whole in
    one task."""
    keys = _cols(key)
    order = _cols(order)
    packed = F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(*order)).alias("_lpk")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_lpk.{v}").alias(v) for v in values])


def top_n(df: DataFrame, part, order, n: int, name: str = "rn", keep_rank: bool = False) -> DataFrame:
    """``row_number() OVER (PARTITION BY part ORDER BY order) <= n``;
    Spark plans it with a per-partition group limit before the shuffle."""
    w = Window.partitionBy(*_cols(part)).orderBy(*_cols(order))
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if keep_rank else out.drop(name)


def share(df: DataFrame, col: str, part=None, name: str | None = None, digits: int = 2) -> DataFrame:
    """``round(col * 100 / SUM(col) OVER (PARTITION BY part), digits)``,
    NULL when the group total is 0. Without ``part`` the total is a scalar
    subquery (an aggregate), not a window funnelling every row into one
    partition."""
    total = (F.sum(col).over(Window.partitionBy(*_cols(part))) if part
             else df.select(F.sum(col)).scalar())
    value = round_half_up(F.col(col).cast("double") * 100.0 / F.nullif(total.cast("double"), F.lit(0.0)), digits)
    return df.withColumn(name or f"{col}_share", value)


def row_number_by_time(df: DataFrame, part: str, ts: str, tie: str, name: str = "rn",
                       bucket_s: int = 60) -> DataFrame:
    """``row_number() OVER (PARTITION BY part ORDER BY ts, tie)`` without
    sorting a whole (possibly hot) group in one task: rows are numbered
    inside (part, time bucket) and shifted by the count of the group's rows
    in earlier buckets (a small per-bucket summary with a running sum).
    One task sorts at most what a group holds in one bucket (a minute).

    Rows whose ``part`` or ``ts`` is NULL belong to no group: they are kept
    with a NULL number (and spread over tasks by ``tie``)."""
    bkt = F.floor(F.unix_micros(F.col(ts)) / (bucket_s * 1000000))
    known = F.col(part).isNotNull() & F.col(ts).isNotNull()
    d = df.withColumn("_rb_bkt", F.when(known, bkt))
    spread = F.when(known, F.lit(0)).otherwise(F.pmod(F.xxhash64(tie), F.lit(4096)))
    local = F.row_number().over(Window.partitionBy(part, "_rb_bkt", spread).orderBy(F.col(ts), F.col(tie)))
    d = d.withColumn("_rb_local", local)
    sizes = d.filter(F.col("_rb_bkt").isNotNull()).groupBy(part, "_rb_bkt").agg(F.count(F.lit(1)).alias("_rb_n"))
    wo = Window.partitionBy(part).orderBy("_rb_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, "_rb_bkt", F.coalesce(F.sum("_rb_n").over(wo), F.lit(0)).alias("_rb_off"))
    return (d.join(offsets, [part, "_rb_bkt"], "left")
             .withColumn(name, (F.col("_rb_local") + F.col("_rb_off")).cast("long"))
             .drop("_rb_bkt", "_rb_local", "_rb_off"))


def number_session_buckets(buckets: DataFrame, user: str, gap: int, first: str = "_sz_first",
                           last: str = "_sz_last", bkt: str = "_sz_bkt",
                           out: str = "session_number") -> DataFrame:
    """Session numbers per (user, bucket) from each bucket's first / last
    time (buckets as wide as ``gap``): a bucket opens a session when it is
    the user's first or starts more than ``gap`` after the previous active
    bucket ended. The window sees one row per active bucket."""
    wu = Window.partitionBy(user).orderBy(bkt)
    prev_last = F.lag(last).over(wu)
    opens = F.when(prev_last.isNull() | (F.col(first) - prev_last > gap), 1).otherwise(0)
    return (buckets.withColumn("_sz_open", opens)
            .withColumn(out, F.sum("_sz_open").over(wu.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
            .select(user, bkt, out))


def sessionize(df: DataFrame, user: str = "user_sk", ts: str = "event_time",
               gap_s: int = 1800, out: str = "session_number", unit: str = "s") -> DataFrame:
    """Number each user's sessions: a new session starts at the user's first
    event and whenever the gap to the previous event exceeds ``gap_s``
    (``unit="s"``: whole-second ``unix_timestamp`` differences; ``"us"``:
    microsecond differences, as ``session_window`` measures them).

    Sort-free and skew-safe: time is cut into buckets of ``gap_s``. Two
    events in one bucket are less than ``gap_s`` apart, so a session can
    only start at a bucket's first event. Hence only a per-(user, bucket)
    min/max aggregate is needed (partial aggregation before the shuffle),
    a window over each user's buckets (one row per active bucket, however
    many events a hot user has) decides which buckets open a session and
    numbers them, and a join on (user, bucket) hands the number to the
    events.

    Events without a user or a time are in no session: they are kept with a
    NULL number, so rows out equal rows in.
    """
    scale = 1 if unit == "s" else 1000000
    gap = gap_s * scale
    t = F.unix_timestamp(F.col(ts)) if unit == "s" else F.unix_micros(F.col(ts))
    d = df.withColumn("_sz_t", t).withColumn("_sz_bkt", F.floor(F.col("_sz_t") / gap))
    buckets = d.filter(F.col(user).isNotNull() & F.col("_sz_bkt").isNotNull()).groupBy(user, "_sz_bkt").agg(F.min("_sz_t").alias("_sz_first"),
                                             F.max("_sz_t").alias("_sz_last"))
    numbered = number_session_buckets(buckets, user, gap, out=out)
    return d.join(numbered, [user, "_sz_bkt"], "left").drop("_sz_t", "_sz_bkt")
