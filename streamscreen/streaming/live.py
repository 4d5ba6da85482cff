"""Alert figures that a stream keeps up to date: mergeable state, one small table of figures for each micro-batch.

State is what can be merged: the newest alerts (a fixed number) and the counts of a ring of minutes. A micro-batch adds
its own newest alerts and minute counts, both reduced before they are shuffled, so its cost does not depend on how
many alerts there have been. State and figures are written per batch number; a repeated batch replaces its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streamscreen.operators import stats
from streamscreen.session import durable, temporary_tables
from streamscreen.streaming.carried import CarriedRows
from streamscreen.streaming.jobs import EVERY_30_SECONDS

_MINUTES = T.StructType([T.StructField("minute_ms", T.LongType()), T.StructField("n", T.LongType())])


def _rows(df: DataFrame, figure: str, key: Column, value: str) -> DataFrame:
    return df.select(F.lit(figure).alias("figure"), key.cast("string").alias("key"), F.col(value).cast("double").alias("value"))


def figures(newest: DataFrame, minutes: DataFrame, arrival: Sequence[str], ring: int) -> DataFrame:
    """(figure, key, value) of the newest alerts, and of the last ``ring`` complete minutes before the newest one."""
    none = F.lit("")
    totals, customers = stats.key_figures(newest), stats.top_customers(newest, arrival=arrival)
    now = newest.agg(F.max("alert_time").alias("_now"))
    # One row each: the newest time, and a minute of the ring.
    grid = now.select(F.explode(F.sequence(F.lit(1), F.lit(ring))).alias("_back"), (
        F.col("_now") - F.pmod("_now", F.lit(stats.MINUTE))).alias("_this")).where(F.col("_this").isNotNull()).select(
        (F.col("_this") - F.col("_back") * stats.MINUTE).alias("_minute"))
    counted = grid.join(F.broadcast(minutes), F.col("_minute") == F.col("minute_ms"), "left").select(
        "_minute", F.coalesce("n", F.lit(0)).alias("n"))
    parts = [_rows(totals, name, none, name) for name in ("total_alerts", "avg_risk_score", "high_risk_count")]
    parts += [_rows(stats.alerts_by_rule(newest), "alerts_of_rule", F.col("rule_id"), "alert_count"),
              _rows(stats.flagged_customers(newest), "flagged_customers", none, "flagged_customers"),
              _rows(stats.rules_fired(newest), "rules_fired", none, "rules_fired"),
              _rows(counted, "alerts_in_minute", F.col("_minute"), "n")]
    parts += [_rows(customers, f"customer_{name}", F.col("customer_id"), name) for name in ("alert_count", "max_risk", "avg_risk")]
    return reduce(DataFrame.unionByName, parts)


def run_live_figures(alerts: DataFrame, checkpoint: str, path: str, *, arrival: Sequence[str] = ("alert_time",),
                     keep: int = stats.KEEP_NEWEST, ring: int = 30,
                     trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Keep the figures of a stream of alerts (with ``alert_time``): ``path``/batch=<number> holds those after each micro-batch."""
    spark = alerts.sparkSession
    newest_before = CarriedRows(spark, f"{checkpoint}-state/newest", alerts.schema)
    minutes_before = CarriedRows(spark, f"{checkpoint}-state/minutes", _MINUTES)

    def write(batch: DataFrame, number: int) -> None:
        with temporary_tables(spark):
            rows = durable(batch, "micro-batch")
            newest = durable(stats.newest(newest_before.before(number).unionByName(rows), keep, arrival), "newest")
            at = F.col("alert_time")
            own = rows.where(at.isNotNull()).groupBy((at - F.pmod(at, F.lit(stats.MINUTE))).alias("minute_ms")).agg(
                F.count(F.lit(1)).alias("n"))
            now = newest.agg(F.max("alert_time")).first()[0]
            merged = minutes_before.before(number).unionByName(own).groupBy("minute_ms").agg(F.sum("n").alias("n"))
            # The ring and the minute under way; at most ring + 1 rows.
            minutes = durable(merged.where(F.lit(False) if now is None else F.col("minute_ms").between(
                now - now % stats.MINUTE - ring * stats.MINUTE, now)), "minutes")
            figures(newest, minutes, arrival, ring).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")
            newest_before.leave(number, newest)
            minutes_before.leave(number, minutes)

    return (alerts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_30_SECONDS)).start())
