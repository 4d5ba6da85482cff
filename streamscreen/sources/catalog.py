"""Named streams and tables over topics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streamscreen.sources import topics
from streamscreen.sources.kept_table import KeptTable, keep
from streamscreen.sources.topics import Topic
from streamscreen.streaming.jobs import EVERY_30_SECONDS, run_to_table


@dataclass(frozen=True)
class Stream:
    """A declared stream: its topic, row type and, if any, the column held in the record key."""

    topic: Topic
    schema: T.StructType
    key_column: str | None = None


def declare(spark: SparkSession, name: str, stream: Stream, *, streaming: bool = True,
            keep: Sequence[str] = ("timestamp",), max_per_batch: int | None = None) -> DataFrame:
    """Register ``name`` as a view over the topic, so SQL text can use it."""
    records = (topics.read_stream(spark, stream.topic, max_per_batch=max_per_batch) if streaming
               else topics.read_batch(spark, stream.topic))
    rows = topics.parse_json(records, stream.schema, stream.key_column, keep)
    rows.createOrReplaceTempView(name)
    return rows


def persist_stream(df: DataFrame, path: str, checkpoint: str, *, partitions: int | None = None,
                   trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Keep a derived stream as a growing table; ``partitions=1`` as a one-partition topic."""
    return run_to_table(df if partitions is None else df.coalesce(partitions), path, checkpoint, trigger=trigger)


def persist_table(df: DataFrame, keys: Sequence[str], path: str, checkpoint: str, *,
                  trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Keep a derived aggregate: each micro-batch puts down the changed rows, one per key.

    Writing a batch again after a failure replaces it, so a restart leaves no duplicates; the batches are folded
    as the table grows, and :func:`current_table` reads the newest row per key from few runs.
    """
    return keep(df, keys, path, checkpoint, trigger=trigger or EVERY_30_SECONDS)


def current_table(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Snapshot of a persisted table: the newest row of each key."""
    table = KeptTable(spark, path, keys).read()
    if table is None:
        raise ValueError(f"nothing has been kept at {path} yet")
    return table


def push(df: DataFrame, name: str, checkpoint: str | None = None, mode: str = "append") -> StreamingQuery:
    """A continuous query whose rows can be read as the in-memory table ``name``; for small results."""
    writer = df.writeStream.format("memory").queryName(name).outputMode(mode)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
