"""What the operators share: reading tables, held-out rows, bounded samples, what a Python worker remembers."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Memory = TypeVar("Memory")
_REMEMBERED: dict[Hashable, object] = {}


def remembered(owner: Hashable, make: Callable[[], Memory]) -> Memory:
    """What ``owner`` remembers in this Python worker from batch to batch, made where it is missing.

    Workers live on from stage to stage, so what another owner left is forgotten first: a worker holds one at a time.
    """
    if owner not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[owner] = make()
    return _REMEMBERED[owner]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo ``modulus``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_sample(df: DataFrame, key: str, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows of ``df``, the same ones in every run; all rows if there are no more.

    Rows are chosen by a hash of ``key``, so that retries and other partitionings pick the same.
    """
    rows = df.count()
    if rows <= max_rows:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(1_000_000 * max_rows / rows))


#: Rows of (id, a few numbers) that may be broadcast: some 20 MB.
MAX_BROADCAST_ROWS = 500_000


def join_counted(left: DataFrame, right: DataFrame, on: Column, how: str, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join ``left`` with a written, narrow table: by broadcast if it is counted and small, else by shuffle."""
    if right.limit(max_rows + 1).count() <= max_rows:
        right = F.broadcast(right)
    return left.join(right, on, how)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """doc_id, text and ``label`` of at most about ``max_rows`` labelled documents, chosen by a hash of doc_id.

    The labels are sampled before they meet the texts, so the texts are filtered where they are read. A document with
    several labels gets the largest.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label))
    chosen = bounded_sample(known, "doc_id", max_rows).withColumnRenamed("doc_id", "_label_id")
    return join_counted(docs.select("doc_id", "text"), chosen, F.col("doc_id") == F.col("_label_id"), "inner",
                        ).drop("_label_id")
