"""Tables derived from streams: latest row per key, counts, and changes between snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_offset(stream: DataFrame, key: str, columns: Sequence[str], order_by: Sequence[str],
                     ignore_nulls: bool = True) -> DataFrame:
    """One row per key with the value of each column at its largest offset.

    With ``ignore_nulls`` a null never replaces an earlier value. A plain aggregate with partial
    results before the shuffle, so a key with many rows costs one row per input partition.
    """
    position = F.struct(*order_by)
    picks = []
    for name in columns:
        at = F.when(F.col(name).isNotNull(), position) if ignore_nulls else position
        picks.append(F.max_by(F.col(name), at).alias(name))
    return stream.groupBy(key).agg(*picks)


def users_table(users: DataFrame, order_by: Sequence[str] = ("user_id",),
                ignore_nulls: bool = True) -> DataFrame:
    """The users stream as a lookup table keyed by city: the latest user of each city."""
    columns = [c for c in ("user_id", "username", "email", "state", "latitude", "longitude")
               if c in users.columns]
    return latest_by_offset(users, "city", columns, order_by, ignore_nulls)


def users_by_city(users: DataFrame) -> DataFrame:
    return users.groupBy("city", "state").agg(F.count(F.lit(1)).alias("user_count"))


def total_users(users: DataFrame) -> DataFrame:
    return users.agg(F.count(F.lit(1)).alias("total_users"))


def snapshot_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Inserted, updated and deleted rows between two snapshots with a unique ``key``.

    ``change`` names the kind; the other columns are the new values, or the old ones of a deleted
    row. Rows are compared field by field inside one equi-join on the key.
    """
    values = [c for c in new.columns if c != key]
    before = old.select(F.col(key).alias("_old_key"), F.struct(*values).alias("_old"))
    after = new.select(F.col(key).alias("_new_key"), F.struct(*values).alias("_new"))
    joined = before.join(after, F.col("_old_key") == F.col("_new_key"), "full_outer")
    change = (F.when(F.col("_old_key").isNull(), "insert")
              .when(F.col("_new_key").isNull(), "delete")
              .when(~F.col("_old").eqNullSafe(F.col("_new")), "update"))
    row = F.when(F.col("_new_key").isNull(), F.col("_old")).otherwise(F.col("_new"))
    return (joined.select(F.coalesce("_new_key", "_old_key").alias(key),
                          change.alias("change"), row.alias("_row"))
            .where(F.col("change").isNotNull())
            .select(key, "change", *[F.col(f"_row.{c}").alias(c) for c in values]))
