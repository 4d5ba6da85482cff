"""Equi-joins against a table and within a time interval."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamscreen.functions.units import epoch_ms

MAX_TABLE_ROWS = 200_000
MAX_TABLE_BYTES = 32 * 1024 * 1024
#: Rows of a key and bucket, of either side, above which they are dealt over pieces. A task holds all pairs of one left row with a piece.
PIECE_ROWS = 4096
#: Tasks for each core that make pairs.
TASKS_A_CORE = 8


def small_enough(table: DataFrame, max_rows: int = MAX_TABLE_ROWS,
                 max_bytes: int = MAX_TABLE_BYTES) -> bool:
    """Measure ``table``: does it fit the broadcast limits? Runs one aggregation job."""
    width = F.lit(0)
    for column in table.schema:
        if isinstance(column.dataType, T.StringType | T.BinaryType):
            width = width + F.coalesce(F.octet_length(F.col(column.name)), F.lit(0))
        elif isinstance(column.dataType, T.ArrayType | T.MapType | T.StructType | T.VariantType):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(column.name)))), F.lit(0))
        else:
            width = width + F.lit(16)
    rows, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def lookup_join(stream: DataFrame, table: DataFrame, on: tuple[str, str], *,
                max_rows: int = MAX_TABLE_ROWS, max_bytes: int = MAX_TABLE_BYTES) -> DataFrame:
    """Inner join of a stream to a table with one row per key; rows without a match are dropped.

    The table is broadcast only when measured small. Otherwise the join shuffles, and adaptive
    execution splits the partition of a hot key; the table side has one row per key to copy.
    A streaming input is refused: Spark would plan the table once, so the query would never see it change. Join each
    micro-batch instead (``streaming.jobs.run_with_table``).
    """
    left, right = on
    if stream.isStreaming:
        raise ValueError("a stream meets a table per micro-batch: see streaming.jobs.run_with_table")
    if not table.isStreaming and small_enough(table, max_rows, max_bytes):
        table = F.broadcast(table)
    return stream.join(table, stream[left] == table[right], "inner")


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], *,
                  left_time: str, right_time: str, before_ms: int, after_ms: int) -> DataFrame:
    """Inner join where the keys are equal and
    ``right_time - before_ms <= left_time <= right_time + after_ms``, both ends included.

    The interval also becomes an equality on time buckets, each right row standing in at most two
    of them, so a key holding many rows is spread over its buckets and only rows close in time meet.
    Streaming inputs must carry watermarks; Spark then bounds the join state by the interval, and
    the state of a key is spread over its buckets too.
    """
    width = before_ms + after_ms + 1
    lhs = left.withColumn("_l_ms", epoch_ms(left, left_time)).withColumn(
        "_l_bucket", bucket(F.col("_l_ms"), width))
    rhs = right.withColumn("_r_ms", epoch_ms(right, right_time))
    rhs = rhs.withColumn("_r_bucket", F.explode(buckets_met(F.col("_r_ms"), before_ms, after_ms)))
    close = F.col("_l_ms").between(F.col("_r_ms") - before_ms, F.col("_r_ms") + after_ms)
    if left.isStreaming or right.isStreaming:
        # Written on the watermarked columns, from which Spark derives when state may go.
        close = ((lhs[left_time] >= rhs[right_time] - _interval(before_ms))
                 & (lhs[left_time] <= rhs[right_time] + _interval(after_ms)))
    keys_equal = reduce(lambda a, b: a & b, (lhs[l] == rhs[r] for l, r in on))
    return (lhs.join(rhs, keys_equal & (F.col("_l_bucket") == F.col("_r_bucket")) & close, "inner")
            .drop("_l_ms", "_l_bucket", "_r_ms", "_r_bucket"))


def spread_interval_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], *, left_time: str, right_time: str,
                         before_ms: int, after_ms: int, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """:func:`interval_join` of batch inputs whose pairs are many more than their rows.

    Adaptive execution gives tasks even shares of the rows read, about one for each core, so that the last ones work alone on their
    pairs. Here the number of tasks is fixed by the cores, and a key and bucket of more than ``piece_rows`` rows on a side is a
    grid of pieces: a row stands in each piece of the other side, so every pair still meets once, and no task has all pairs of a hot key.
    """
    spark, keys, width = left.sparkSession, [f"_k{i}" for i in range(len(on))], before_ms + after_ms + 1
    group = [*keys, "_bucket"]
    lhs = left.select("*", *[F.col(l).alias(k) for k, (l, _) in zip(keys, on, strict=True)], epoch_ms(left, left_time).alias("_l_ms"))
    lhs = lhs.withColumn("_bucket", bucket(F.col("_l_ms"), width)).dropna(subset=group)
    rhs = right.select("*", *[F.col(r).alias(k) for k, (_, r) in zip(keys, on, strict=True)], epoch_ms(right, right_time).alias("_r_ms"))
    rhs = rhs.dropna(subset=[*keys, "_r_ms"]).withColumn("_bucket", F.explode(buckets_met(F.col("_r_ms"), before_ms, after_ms)))

    # At most one row for each piece_rows rows of a side.
    large = _pieces(lhs, group, piece_rows, "_lefts").join(_pieces(rhs, group, piece_rows, "_rights"), group, "full")
    large = F.broadcast(large.na.fill(1, ["_lefts", "_rights"]))
    lhs, rhs = _dealt(lhs, large, group, "_lefts", "_rights"), _dealt(rhs, large, group, "_rights", "_lefts")

    meet = [*group, "_lefts", "_rights"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    close = F.col("_l_ms").between(F.col("_r_ms") - before_ms, F.col("_r_ms") + after_ms)
    return (lhs.repartition(tasks, *meet).join(rhs.repartition(tasks, *meet), meet).where(close)
            .drop(*meet, "_l_ms", "_r_ms"))


def _pieces(rows: DataFrame, group: list[str], piece_rows: int, name: str) -> DataFrame:
    """The groups of more than ``piece_rows`` rows with their number of pieces."""
    counted = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > piece_rows)
    return counted.select(*group, F.ceil(F.col("_n") / piece_rows).alias(name))


def _dealt(rows: DataFrame, large: DataFrame, group: list[str], own: str, other: str) -> DataFrame:
    """Rows with one piece of their own side and, once for each, all pieces of the other."""
    # The piece follows from the row itself, so that it is the same in a repeated task.
    columns = [c for c in rows.columns if c not in group]
    piece = F.when(F.col(own) > 1, F.pmod(F.xxhash64(*columns), F.col(own))).otherwise(F.lit(0))
    every = F.sequence(F.lit(0).cast("bigint"), F.coalesce(other, F.lit(1)) - 1)
    return (rows.join(large, group, "left")
            .select(*group, *columns, piece.cast("bigint").alias("_own"), F.explode(every).alias("_other"))
            .withColumnsRenamed({"_own": own, "_other": other}))


def bucket(ms: Column, width: int) -> Column:
    # Integer floor division; a double would lose exactness for far-off times.
    return ((ms - F.pmod(ms, F.lit(width))) / F.lit(width)).cast("long")


def buckets_met(ms: Column, before_ms: int, after_ms: int) -> Column:
    """The one or two buckets of left rows within the interval of a right row."""
    width = before_ms + after_ms + 1
    return F.sequence(bucket(ms - before_ms, width), bucket(ms + after_ms, width))


def _interval(ms: int) -> Column:
    return F.expr(f"make_dt_interval(0, 0, 0, {ms / 1000})")


def chain_interval_joins(streams: Sequence[tuple[DataFrame, str]], key: str, *, time: str,
                         before_ms: int, after_ms: int) -> DataFrame:
    """Join four or more streams on ``key``, each within the interval of the first one's time.

    ``streams`` pairs a DataFrame with a prefix; its other columns come out as ``prefix_name``.
    """
    (first, prefix), *rest = streams
    out = _prefixed(first, prefix, key)
    anchor = f"{prefix}_{time}"
    for df, name in rest:
        right = _prefixed(df, name, key).withColumnRenamed(key, f"_{name}_{key}")
        out = interval_join(out, right, [(key, f"_{name}_{key}")], left_time=anchor,
                            right_time=f"{name}_{time}", before_ms=before_ms,
                            after_ms=after_ms).drop(f"_{name}_{key}")
        if df.isStreaming:
            # A stream may have one event-time column: the first one's leads the next join, this one becomes a plain time.
            own = f"{name}_{time}"
            out = out.withColumn(own, F.timestamp_micros(F.unix_micros(F.col(own))))
    return out


def _prefixed(df: DataFrame, prefix: str, key: str) -> DataFrame:
    return df.select(key, *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c != key])
