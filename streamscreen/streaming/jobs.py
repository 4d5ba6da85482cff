"""Running streams: sinks that survive restarts, and late rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVERY_30_SECONDS = {"processingTime": "30 seconds"}
UNTIL_DRAINED = {"availableNow": True}


def run_to_table(df: DataFrame, path: str, checkpoint: str, *, mode: str = "append",
                 trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Append a stream to Parquet files under ``path``, exactly once through the sink's file log."""
    return (df.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode(mode)
            .trigger(**(trigger or EVERY_30_SECONDS)).start())


def run_idempotent(df: DataFrame, checkpoint: str, path: str, *, mode: str = "append",
                   trigger: Mapping[str, object] | None = None,
                   prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> StreamingQuery:
    """Write each micro-batch to its own sub-folder ``batch=<id>``.

    Input counts as consumed only after the write; a batch repeated after a failure replaces its
    folder, so the output holds every input row once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .outputMode(mode).trigger(**(trigger or EVERY_30_SECONDS)).start())


def run_with_table(stream: DataFrame, table: Callable[[], DataFrame],
                   join: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str, path: str, *,
                   trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Join a stream to a table that changes: ``join(batch, table())`` for each micro-batch.

    ``table`` reads the table anew each time (for example ``current_table``), so a row meets the table as of its
    micro-batch. Sizes are measured per batch too, so the join changes from broadcast to shuffle as the table grows.
    """
    return run_idempotent(stream, checkpoint, path, prepare=lambda batch: join(batch, table()), trigger=trigger)


def drain(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query and raise its error, if any."""
    query.awaitTermination()


def stop_after(query: StreamingQuery, rows: int, seconds: float = 900) -> StreamingQuery:
    """Stop a query that never ends by itself (as with expiring state) once it has read ``rows`` input rows."""
    read: dict[int, int] = {}
    end = time.monotonic() + seconds
    while query.isActive and sum(read.values()) < rows:
        if time.monotonic() > end:
            query.stop()
            raise TimeoutError(f"read {sum(read.values())} of {rows} rows in {seconds} seconds")
        time.sleep(0.2)
        read |= {p["batchId"]: p["numInputRows"] for p in query.recentProgress}
    query.stop()
    return query


def stop_after_batches(query: StreamingQuery, batches: int, seconds: float = 300) -> StreamingQuery:
    """Stop a query that never ends by itself once it has done ``batches`` micro-batches."""
    end = time.monotonic() + seconds
    while query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] < batches - 1):
        if time.monotonic() > end:
            query.stop()
            raise TimeoutError(f"fewer than {batches} micro-batches in {seconds} seconds")
        time.sleep(0.2)
    query.stop()
    return query


def split_late(df: DataFrame, at: str, delay: str, path: str, checkpoint: str, *,
               trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Audit copy of a stream: each row with ``late``, true if it is more than ``delay`` behind the
    newest event time of the micro-batches before its own.

    The newest time so far is kept beside the output, one row per batch, so a restart continues it. A batch reads the
    mark of the one before it only.
    """
    marks = f"{path}/marks"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = spark.read.schema("newest timestamp").parquet(f"{marks}/batch={batch_id - 1}") if batch_id else None
        newest = None if mark is None else mark.first()[0]
        limit = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.lit(False) if newest is None else F.coalesce(F.col(at) < limit, F.lit(False))
        batch.withColumn("late", late).write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        # The rows are read back rather than computed again for their newest time.
        own = spark.read.schema(batch.schema).parquet(f"{path}/rows/batch={batch_id}")
        so_far = F.greatest(F.max(at), F.lit(newest).cast("timestamp"))
        own.agg(so_far.alias("newest")).write.mode("overwrite").parquet(f"{marks}/batch={batch_id}")

    return (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_30_SECONDS)).start())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
