"""Sinks and table-layout operators: partitioned / full-refresh / append
writes, mart refresh, compaction (to a file count, or of small files in
place), range- and Z-order-clustered writes, column comments, the
partition report, snapshot comparison and history sampling."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import round_half_up


def _spread(df: DataFrame) -> Column:
    """A hash of the whole row: the second range key that lets a heavy
    first key take several tasks."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Make the finished table at ``new`` the table at ``path``. The old
    table is readable until it is set aside by one rename and is removed
    only after the second rename; a crash in between leaves both complete
    tables beside ``path`` (``<path>.new-*``, ``<path>.old-*``)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target = hadoop(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = hadoop(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(hadoop(new), target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        fs.delete(aside, True)


def partitioned_layout(df: DataFrame, partition_col: str, order_col: str | None = None,
                       num_files: int | None = None) -> DataFrame:
    """Rows laid out for a ``partitionBy(partition_col)`` write: range-
    partitioned on (partition_col, order_col). Spark samples the data for
    the range bounds, so a heavy day gets proportionally more tasks (no
    task writes a whole day), each task writes one contiguous slice (one or
    two partition folders instead of every folder), and files come out
    clustered on ``order_col`` for min/max skipping."""
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    second = F.col(order_col) if order_col else _spread(df)
    return df.repartitionByRange(n, F.col(partition_col), second).sortWithinPartitions(F.col(partition_col), second)


def write_bronze(df: DataFrame, path: str, partition_col: str = "event_date",
                 order_col: str | None = "event_time", num_files: int | None = None) -> None:
    """Overwrite ``path`` as Parquet partitioned by ``partition_col``; only
    the partitions present in ``df`` are replaced (dynamic overwrite), so a
    re-run of one whole day does not drop the other days. For batches that
    hold part of a day use ``merge_bronze``."""
    (partitioned_layout(df, partition_col, order_col, num_files)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col)
       .parquet(path))


def rows_of_days(df: DataFrame, days: DataFrame, col: str = "event_date") -> DataFrame:
    """Rows of ``df`` whose ``col`` is among the values of ``days`` (NULL is
    a value). The values, one a day partition as the file listing itself has,
    become a partition filter, so other partitions are not read."""
    values = [r[0] for r in days.select(col).distinct().collect()]
    some = F.col(col).isin([v for v in values if v is not None])
    return df.filter(some | F.col(col).isNull() if None in values else some)


def merge_bronze(spark: SparkSession, batch: DataFrame, path: str, key: str = "event_id", partition_col: str = "event_date",
                 order_col: str | None = "event_time", num_files: int | None = None) -> None:
    """Load a batch that may hold only part of a day: rows already loaded
    for the batch's days stay unless the batch has their ``key`` (rows without
    a day are a day of their own). Only those days' partitions are read and
    rewritten, and the same batch again changes nothing."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        days = batch.select(partition_col).distinct()
        loaded = rows_of_days(spark.read.parquet(path), days, partition_col)
        batch = loaded.join(batch.select(key), key, "left_anti").unionByName(batch, allowMissingColumns=True)
    write_bronze(batch, path, partition_col, order_col, num_files)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full refresh (new schema replaces the old one): written beside
    ``path``, then swapped in, so a failed write leaves the old table."""
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(new)
    swap_in(df.sparkSession, new, path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table that this library wrote for its own use."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def refresh(spark: SparkSession, df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """CREATE OR REPLACE ... AS: write the mart, return a frame reading it
    back (later counts read the written files instead of recomputing)."""
    write_table(df, path, partition_by)
    return spark.read.parquet(path)


def compact(spark: SparkSession, src: str, dst: str, target_files: int,
            partition_by: list[str] | None = None) -> DataFrame:
    """Rewrite a table with many small files into ``target_files`` files
    (per partition when partitioned) at a new path."""
    df = spark.read.parquet(src)
    # partitioned tables: range over the partition columns and a hash of the
    # row, so a large partition is spread over several tasks and files
    out = (df.repartitionByRange(target_files, *[F.col(c) for c in partition_by], _spread(df)) if partition_by
           else df.repartition(target_files))
    write_table(out, dst, partition_by)
    return spark.read.parquet(dst)


def write_clustered(df: DataFrame, path: str, cols: list[str], num_files: int | None = None,
                    partition_by: list[str] | None = None) -> None:
    """Range-cluster rows on ``cols`` and sort inside files, so Parquet
    min/max statistics let filters on ``cols`` skip files and row groups."""
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    write_table(ordered, path, partition_by)


def _ordinal(df: DataFrame, col: str) -> Column:
    """A number in the order of the column: strings by their first 7 bytes."""
    kind = df.schema[col].dataType.typeName()
    if kind == "date":
        return F.unix_date(col).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    if kind == "string":
        head = F.rpad(F.hex(F.substring(F.encode(F.col(col), "UTF-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("double")
    return F.col(col).cast("double")


def with_z_value(df: DataFrame, cols: list[str], bits: int = 5, name: str = "_z") -> DataFrame:
    """``df`` with the bits of the columns' range ranks, interleaved. A rank
    is the number of the 2^bits - 1 approximate quantiles below the value, so skew
    in a column's values does not crowd the curve; NULL ranks first."""
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(F.struct(*[F.percentile_approx(_ordinal(df, c), cuts).alias(f"q{i}") for i, c in enumerate(cols)]).alias("_b")).scalar()
    def below(x: Column):
        return lambda q: q < x
    z = F.lit(0).cast("long")
    for j, c in enumerate(cols):
        rank = F.coalesce(F.size(F.filter(F.col(f"_zb.q{j}"), below(_ordinal(df, c)))), F.lit(0)).cast("long")
        rank = F.greatest(rank, F.lit(0).cast("long"))
        for i in range(bits):
            z = z + F.shiftleft(F.shiftright(rank, i).bitwiseAND(F.lit(1).cast("long")), i * len(cols) + j)
    return df.withColumn("_zb", bounds).withColumn(name, z).drop("_zb")


def write_zordered(df: DataFrame, path: str, cols: list[str], num_files: int | None = None, bits: int = 5,
                   partition_by: list[str] | None = None) -> None:
    """Cluster rows on several columns at once: files are ranges of the
    Z-order curve over the columns' ranks, so a filter on any of ``cols``
    skips files by their min / max statistics (``write_clustered`` does so
    for its first column only)."""
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    z = with_z_value(df, cols, bits)
    laid = z.repartitionByRange(n, "_z", _spread(df)).sortWithinPartitions("_z").drop("_z")
    write_table(laid, path, partition_by)


def _listed(spark: SparkSession, path: str):
    """File system and (folder, file, bytes) of the data files below."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, it = [], fs.listFiles(root, True)
    while it.hasNext():
        f = it.next()
        name = f.getPath().getName()
        if not name.startswith(("_", ".")):
            found.append((f.getPath().getParent().toString(), f.getPath().toString(), f.getLen()))
    return fs, found


def pack(sizes: list[tuple[str, int]], target: int) -> list[list[str]]:
    """First-fit decreasing: files into bins of at most ``target`` bytes
    (larger files alone)."""
    bins: list[list] = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        home = next((b for b in bins if b[0] + size <= target), None)
        if home is None:
            bins.append([size, [name]])
        else:
            home[0] += size
            home[1].append(name)
    return [b[1] for b in bins]


def compact_small(spark: SparkSession, path: str, target_bytes: int = 128 << 20, small: float = 0.75) -> dict:
    """Merge small files (under ``small`` of ``target_bytes``) of a Parquet
    table in place. The listing alone decides: per folder the small files
    are packed into bins of ``target_bytes``; only bins of two files or more
    are read and rewritten, all in one job, one task and one file a bin.
    Other files, and folders without small files, stay as they are.

    A journal beside the table names new and old files before the first is
    moved, so an interrupted swap is finished by the next call; in between
    rows may be seen twice (table formats have commits for that)."""
    journal = f"{path.rstrip('/')}.compaction"
    finish_compaction(spark, path)
    fs, files = _listed(spark, path)
    by: dict[str, list[tuple[str, int]]] = {}
    for folder, name, size in files:
        if size < small * target_bytes:
            by.setdefault(folder, []).append((name, size))
    bins = [(folder, b) for folder, own in sorted(by.items()) for b in pack(own, target_bytes) if len(b) > 1]
    if not bins:
        return {"bins": 0, "files": len(files)}
    staged = f"{journal}-{uuid.uuid4().hex}"
    where = spark.createDataFrame([(name, i) for i, (_, b) in enumerate(bins) for name in b], "_file string, _bin int")
    rows = spark.read.parquet(*[name for _, b in bins for name in b]).withColumn("_file", F.col("_metadata.file_path"))
    # one row a file: bounded by the listing
    rows.join(F.broadcast(where), "_file").drop("_file").repartition(len(bins), "_bin").write.partitionBy("_bin").parquet(staged)
    moves = [(new, bins[int(folder.rsplit("=", 1)[1])][0]) for folder, new, _ in _listed(spark, staged)[1]]
    lines = [("add", new, f"{folder}/part-compact-{uuid.uuid4().hex}.parquet") for new, folder in moves]
    lines += [("drop", name, "") for _, b in bins for name in b] + [("drop", staged, "")]
    spark.createDataFrame([(i, *x) for i, x in enumerate(lines)], "i int, op string, src string, dst string").coalesce(1).write.parquet(journal)
    finish_compaction(spark, path)
    return {"bins": len(bins), "files": len(_listed(spark, path)[1])}


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Carry out a journal that is there: move new files in, then drop the
    old ones. Steps already done are skipped."""
    hadoop, journal = spark._jvm.org.apache.hadoop.fs.Path, f"{path.rstrip('/')}.compaction"
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop(f"{journal}/_SUCCESS")):
        remove_table(spark, journal)
        return
    for r in spark.read.parquet(journal).orderBy("i").collect():
        if r.op == "add" and fs.exists(hadoop(r.src)):
            fs.rename(hadoop(r.src), hadoop(r.dst))
        elif r.op == "drop":
            fs.delete(hadoop(r.src), True)
    remove_table(spark, journal)


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments as column metadata (kept by Parquet writes)."""
    out = df
    for col, text in comments.items():
        out = out.withMetadata(col, {"comment": text})
    return out


def partition_stats(df: DataFrame, col: str = "event_date") -> DataFrame:
    """One-row partition report: partitions, first/last, min/max/avg rows
    per partition, total rows. The per-partition counts are one row per
    partition value, so the final aggregate is small."""
    per = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.min(col).alias("first_partition"),
        F.max(col).alias("last_partition"),
        F.min("n").alias("min_rows"),
        F.max("n").alias("max_rows"),
        round_half_up(F.avg("n")).alias("avg_rows"),
        F.sum("n").cast("long").alias("total_rows"),
    )


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Compare two versions of a table on ``keys``: one row per key that was
    added, removed or whose ``cols`` differ (NULL-safe), with old and new
    values side by side."""
    o = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in cols]).withColumn("_o", F.lit(True))
    n = new.select(*keys, *[F.col(c).alias(f"new_{c}") for c in cols]).withColumn("_n", F.lit(True))
    j = o.join(n, keys, "full_outer")
    changed = None
    for c in cols:
        d = ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
        changed = d if changed is None else (changed | d)
    kind = (F.when(F.col("_o").isNull(), F.lit("added"))
            .when(F.col("_n").isNull(), F.lit("removed"))
            .when(changed, F.lit("changed")))
    return (j.withColumn("change", kind).filter(F.col("change").isNotNull())
             .select(*keys, "change", *[x for c in cols for x in (f"old_{c}", f"new_{c}")]))


def sample_events(df: DataFrame, since_col: str, since_value, n: int, seed: int = 42) -> DataFrame:
    """Random sample of ``n`` rows with ``since_col >= since_value``
    (``ORDER BY RAND() LIMIT n``; Spark plans it as a distributed top-n)."""
    return df.filter(F.col(since_col) >= since_value).orderBy(F.rand(seed)).limit(n)
