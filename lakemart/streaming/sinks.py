"""Stream sinks and monitoring. Every sink takes a checkpoint location so a
restarted query resumes exactly where the last committed batch ended."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.io import rows_of_days, write_bronze, write_table


def _trigger(writer, processing_time: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer


def start_bronze_stream(df: DataFrame, path: str, checkpoint: str, processing_time: str | None = "10 seconds",
                        available_now: bool = False, partition_by: list[str] | None = None,
                        name: str | None = None) -> StreamingQuery:
    """Append parsed events to a Parquet table (file sink: exactly-once via
    the checkpoint and the sink's own commit log)."""
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return _trigger(w, processing_time, available_now).start(path)


def start_debug_stream(df: DataFrame, mode: str = "update", fmt: str = "console",
                       processing_time: str | None = "10 seconds", available_now: bool = False,
                       checkpoint: str | None = None) -> StreamingQuery:
    """Console (or other debug format) sink, update mode by default."""
    w = df.writeStream.format(fmt).outputMode(mode).option("truncate", False)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return _trigger(w, processing_time, available_now).start()


def start_memory_stream(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """In-memory table sink for tests (``spark.table(name)``)."""
    w = df.writeStream.format("memory").queryName(name).outputMode(mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return _trigger(w, None, available_now).start()


def start_mart_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "complete",
                      processing_time: str | None = "10 seconds", available_now: bool = False) -> StreamingQuery:
    """Maintain a mart table from a streaming aggregate in complete mode:
    every micro-batch's result is the whole table and replaces the last one
    through ``foreachBatch`` (written beside it and swapped in). In append
    and update mode a batch holds some rows only: ``start_upsert_stream``."""
    if mode != "complete":
        raise ValueError(f"{mode} mode gives parts of the table: use start_upsert_stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, path)

    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(w, processing_time, available_now).start()


DAY = "mart_day"


def upsert(batch: DataFrame, path: str, keys: list[str], day_of: str) -> None:
    """Rows of ``batch`` replace the table's rows of equal ``keys`` (NULL
    equals NULL) or join them. The table is partitioned by the date of
    ``day_of``, which the keys must determine; only the days in the batch
    are read and rewritten (dynamic overwrite). The same batch again changes
    nothing."""
    spark = batch.sparkSession
    batch = batch.withColumn(DAY, F.to_date(day_of))
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        loaded = rows_of_days(spark.read.schema(batch.schema).parquet(path), batch, DAY)
        mine = batch.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
        batch = loaded.join(mine, same, "left_anti").unionByName(batch)
    write_bronze(batch, path, DAY, day_of)


def start_upsert_stream(df: DataFrame, path: str, checkpoint: str, keys: list[str], day_of: str = "window_start", mode: str = "append",
                        processing_time: str | None = "10 seconds", available_now: bool = False) -> StreamingQuery:
    """Merge every micro-batch of a streaming aggregate into a mart by key:
    append mode (windows that the watermark closed, exact distinct counts)
    or update mode (windows that changed). A window that comes again, e.g.
    from a second stream over a backfill, replaces its row.

    A ledger beside the table (``<path>.ledger``) names the batches committed,
    by stream and batch id: a batch that is replayed after it was committed
    is left out; one that broke off is written again, with the same result."""
    if mode not in ("append", "update"):
        raise ValueError("append or update mode")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        note = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.ledger/{stream}/{batch_id}")
        fs = note.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        batch = batch.persist()  # read for its days and for its rows
        try:
            # a replayed batch is computed too: its state must be committed
            if batch.count() and not fs.exists(note):
                upsert(batch, path, keys, day_of)
        finally:
            batch.unpersist()
        fs.create(note, True).close()

    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(w, processing_time, available_now).start()


def stream_progress(q: StreamingQuery) -> dict:
    """Batch id, input rows, processing rate and duration of the last batch."""
    p = q.lastProgress or {}
    return {
        "name": q.name,
        "id": str(q.id),
        "active": q.isActive,
        "batch_id": p.get("batchId"),
        "input_rows": p.get("numInputRows"),
        "rows_per_second": p.get("processedRowsPerSecond"),
        "duration_ms": (p.get("durationMs") or {}).get("triggerExecution"),
    }
