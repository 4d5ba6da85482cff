"""Running values per key, exact and spread out even when one key holds most rows.

A plain window sends every row of a key to one task. Here only keys below ``hot_rows`` take
that path. Rows of larger keys are range-partitioned on (key, order), so Spark's sampling cuts
a key into pieces of similar size; each piece is computed on its own and then corrected by a
small table with one row per (key, piece).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamscreen.session import durable

HOT_ROWS = 2_000_000
# Above this many hot keys the key list is written to the shared folder and joined, not broadcast.
MAX_BROADCAST_KEYS = 20_000
CHECK = "check"


@dataclass(frozen=True)
class HotKeys:
    """Keys with more than the allowed number of rows."""

    keys: DataFrame
    rows: int
    small: bool


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> HotKeys | None:
    """Keys of ``df`` with more than ``hot_rows`` rows, or None. Runs one counting job."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    found = counts.take(MAX_BROADCAST_KEYS + 1)
    if not found:
        return None
    if len(found) <= MAX_BROADCAST_KEYS:
        table = df.sparkSession.createDataFrame(found, counts.schema).drop("_rows")
        return HotKeys(table, sum(row["_rows"] for row in found), True)
    table = durable(counts, "hot-keys")
    total = table.agg(F.sum("_rows")).first()[0]
    return HotKeys(table.drop("_rows"), total, False)


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[f"_r_{k}"]) for k in keys))


def _attach(left: DataFrame, right: DataFrame, keys: Sequence[str], small: bool, how: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    if small:
        renamed = F.broadcast(renamed)
    joined = left.join(renamed, _same_key(left, renamed, keys), how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*[f"_r_{k}" for k in keys])


def _within(df: DataFrame, group: Sequence[str], order_by: Sequence[str],
            sums: Mapping[str, Column], previous: Mapping[str, Column]) -> DataFrame:
    ordered = Window.partitionBy(*group).orderBy(*order_by)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return df.select(
        "*",
        *[F.sum(value).over(upto).alias(name) for name, value in sums.items()],
        *[F.last(value, ignorenulls=True).over(before).alias(name) for name, value in previous.items()],
    )


def running(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], *,
            sums: Mapping[str, Column] | None = None,
            previous: Mapping[str, Column] | None = None,
            hot_rows: int = HOT_ROWS, hot: HotKeys | None | str = CHECK) -> DataFrame:
    """Add per-key running columns in ``order_by`` order.

    ``sums``: sum of the value over all rows up to and including this one.
    ``previous``: last non-null value strictly before this row.
    ``order_by`` must be a total order within a key, ascending. ``hot`` passes on an earlier
    :func:`hot_keys` result instead of counting again.
    """
    sums, previous = dict(sums or {}), dict(previous or {})
    if hot == CHECK:
        hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return _within(df, keys, order_by, sums, previous)

    cold = _within(_attach(df, hot.keys, keys, hot.small, "left_anti"),
                   keys, order_by, sums, previous)

    spark = df.sparkSession
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 math.ceil(2 * hot.rows / hot_rows))
    # Written out once: a second evaluation could sample other range bounds.
    cut = durable(
        _attach(df, hot.keys, keys, hot.small, "left_semi")
        .repartitionByRange(pieces, *keys, *order_by)
        .withColumn("_piece", F.spark_partition_id()),
        "pieces")

    position = F.struct(*order_by)
    ends = cut.groupBy(*keys, "_piece").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(v).alias(f"_end_{n}") for n, v in sums.items()],
        *[F.max_by(v, F.when(v.isNotNull(), position)).alias(f"_end_{n}") for n, v in previous.items()],
    )
    earlier = (Window.partitionBy(*keys).orderBy("_piece")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = ends.select(
        *keys, "_piece",
        *[F.sum(f"_end_{n}").over(earlier).alias(f"_carry_{n}") for n in sums],
        *[F.last(f"_end_{n}", ignorenulls=True).over(earlier).alias(f"_carry_{n}") for n in previous],
    )
    local = _within(cut, [*keys, "_piece"], order_by, sums, previous)
    # carry holds a row for each piece and hot key; with many pieces it is joined by shuffle like the keys.
    warm = _attach(local, carry, [*keys, "_piece"], hot.small and pieces <= MAX_BROADCAST_KEYS, "left")
    warm = warm.select(
        *df.columns,
        *[F.when(F.col(n).isNull(), F.col(f"_carry_{n}"))
           .otherwise(F.col(n) + F.coalesce(F.col(f"_carry_{n}"), F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(F.col(n), F.col(f"_carry_{n}")).alias(n) for n in previous],
    )
    return cold.unionByName(warm)


def look_back(df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str], span_ms: int, *,
              sums: Mapping[str, Column] | None = None,
              previous: Mapping[str, Column] | None = None,
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sums over the rows of the same key in ``[time - span_ms, time]`` that come no later than
    this row in (``time``, ``tie``) order, plus ``previous`` values as in :func:`running`.

    Each row enters the sum at ``time`` and leaves it just after ``time + span_ms``; one running
    sum over both kinds of change replaces a range frame, whose cost grows with the frame's size.
    """
    sums, previous = dict(sums or {}), dict(previous or {})
    keep = {*keys, *tie}
    hot = hot_keys(df, keys, max(1, hot_rows // 2))  # every row is ordered twice
    arrival = F.col("_enters") == 1
    changes = (
        df.select("*",
                  *[F.coalesce(v, F.lit(0)).alias(f"_delta_{n}") for n, v in sums.items()],
                  *[v.alias(f"_value_{n}") for n, v in previous.items()])
        .withColumn("_enters", F.explode(F.array(F.lit(0), F.lit(1))))
        .select(
            "_enters",
            F.when(arrival, F.col(time)).otherwise(F.col(time) + span_ms + 1).alias("_at"),
            *[F.col(c) if c in keep else F.when(arrival, F.col(c)).alias(c) for c in df.columns],
            *[F.when(arrival, F.col(f"_delta_{n}")).otherwise(-F.col(f"_delta_{n}")).alias(f"_delta_{n}")
              for n in sums],
            *[F.when(arrival, F.col(f"_value_{n}")).alias(f"_value_{n}") for n in previous],
        ))
    out = running(changes, keys, ["_at", "_enters", *tie],
                  sums={n: F.col(f"_delta_{n}") for n in sums},
                  previous={n: F.col(f"_value_{n}") for n in previous}, hot_rows=hot_rows, hot=hot)
    return out.where(arrival).select(*df.columns, *sums, *previous)


def distinct_look_back(df: DataFrame, keys: Sequence[str], value: str, time: str,
                       tie: Sequence[str], span_ms: int, out: str, *,
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number of distinct non-null ``value`` of the same key in ``[time - span_ms, time]``, counting
    rows no later than this one in (``time``, ``tie``) order.

    A value counts from its row until ``span_ms`` after; a repeat within that time cancels the
    earlier row's leaving, so a running sum of +1/-1 is the number of values present.
    """
    hot = hot_keys(df, keys, max(1, hot_rows // 3))  # a row is ordered up to three times
    seen = running(df, [*keys, value], [time, *tie], previous={"_before": F.col(time)},
                   hot_rows=hot_rows, hot=None if hot is None else CHECK)
    keep = {*keys, *tie}
    leaves = F.col("_before") + span_ms + 1
    still_in = F.col("_before").isNotNull() & (leaves > F.col(time))
    step = F.col("_step")
    counted = F.col(value).isNotNull()
    steps = (
        seen.withColumn("_step", F.explode(
            F.when(counted & still_in, F.array(F.lit(0), F.lit(1), F.lit(2)))
             .when(counted, F.array(F.lit(0), F.lit(1)))
             .otherwise(F.array(F.lit(1)))))
        .select(
            F.when(step == 1, F.lit(1)).otherwise(F.lit(0)).alias("_enters"),
            F.when(step == 0, F.col(time) + span_ms + 1).when(step == 1, F.col(time))
             .otherwise(leaves).alias("_at"),
            F.when(step == 0, F.lit(-1)).when(step == 2, F.lit(1))
             .otherwise((counted & ~still_in).cast("int")).cast("long").alias("_delta"),
            *[F.col(c) if c in keep else F.when(step == 1, F.col(c)).alias(c) for c in df.columns],
        ))
    return (running(steps, keys, ["_at", "_enters", *tie],
                    sums={out: F.col("_delta")}, hot_rows=hot_rows, hot=hot)
            .where(F.col("_enters") == 1).select(*df.columns, out))
