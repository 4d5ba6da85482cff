"""Alert summaries: key figures, per-rule and per-minute counts, top customers, newest alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamscreen.functions.units import epoch_ms, utc_hh_mm

KEEP_NEWEST = 500
MINUTE = 60_000


def newest(alerts: DataFrame, n: int = KEEP_NEWEST, order_by: Sequence[str] = ("alert_time",)) -> DataFrame:
    """The ``n`` latest alerts in arrival order, newest first."""
    return alerts.orderBy(*[F.desc(c) for c in order_by]).limit(n)


def _risk() -> Column:
    return F.coalesce(F.col("risk_score"), F.lit(0.0))


def key_figures(alerts: DataFrame, high: float = 80) -> DataFrame:
    """Total, average risk and number of high-risk alerts; zeros on empty input."""
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.coalesce(F.round(F.avg(_risk()), 1), F.lit(0.0)).alias("avg_risk_score"),
        F.count_if(_risk() >= high).alias("high_risk_count"))


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy(F.coalesce("rule_id", F.lit("?")).alias("rule_id"))
            .agg(F.count(F.lit(1)).alias("alert_count")))


def alerts_per_minute(alerts: DataFrame, now_ms: Column, minutes: int = 30,
                      fallback: str | None = None) -> DataFrame:
    """Counts of the last ``minutes`` complete minutes before ``now_ms``, zero-filled, oldest first.

    An alert without ``alert_time`` counts at ``fallback`` (a column such as ``event_time``), else now.
    """
    now = now_ms.cast("long")
    this_minute = now - F.pmod(now, F.lit(MINUTE))
    at = F.coalesce(*[F.col(c) for c in ("alert_time", fallback) if c], now)
    counts = (alerts.select((at - F.pmod(at, F.lit(MINUTE))).alias("_minute"))
              .where(F.col("_minute").between(this_minute - minutes * MINUTE, this_minute - MINUTE))
              .groupBy("_minute").agg(F.count(F.lit(1)).alias("_n")))
    grid = alerts.sparkSession.range(minutes).select(
        (this_minute - (F.lit(minutes) - F.col("id")) * MINUTE).alias("minute_ms"))
    # Both sides have at most one row per minute of the report.
    return (grid.join(F.broadcast(counts), grid["minute_ms"] == counts["_minute"], "left")
            .select("minute_ms", utc_hh_mm(F.col("minute_ms")).alias("time"),
                    F.coalesce("_n", F.lit(0)).cast("long").alias("count"))
            .orderBy("minute_ms"))


def top_customers(alerts: DataFrame, n: int = 10, arrival: Sequence[str] = ("alert_time",)) -> DataFrame:
    """Customers by maximum risk, ties in first-seen order."""
    return (alerts.groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("alert_count"),
                 F.round(F.max(_risk()), 1).alias("max_risk"),
                 F.round(F.avg(_risk()), 1).alias("avg_risk"),
                 F.min(F.struct(*arrival)).alias("_first_seen"))
            .orderBy(F.desc("max_risk"), "_first_seen", "customer_id").limit(n).drop("_first_seen"))


def flagged_customers(alerts: DataFrame) -> DataFrame:
    """Number of distinct customers with an alert."""
    return alerts.agg(F.countDistinct("customer_id").alias("flagged_customers"))


def rules_fired(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.countDistinct("rule_id").alias("rules_fired"))


def alerts_per_minute_by_rule(alerts: DataFrame, rules: Sequence[str] = ("R1", "R2", "R3", "R4", "R5"),
                              time: str = "alert_time") -> DataFrame:
    """One row per minute with a count column per rule."""
    minute = F.col(time) - F.pmod(F.col(time), F.lit(MINUTE))
    return (alerts.groupBy(minute.alias("minute_ms"))
            .agg(*[F.count_if(F.coalesce("rule_id", F.lit("?")) == r).alias(r) for r in rules]))


def transactions_by_minute(transactions: DataFrame, time: str = "event_time") -> DataFrame:
    at = F.col(time) if isinstance(transactions.schema[time].dataType, T.LongType) else epoch_ms(transactions, time)
    return (transactions.groupBy((at - F.pmod(at, F.lit(MINUTE))).alias("minute_ms"))
            .agg(F.count(F.lit(1)).alias("transactions")))


def transactions_by_city(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("city").agg(F.count(F.lit(1)).alias("transactions"))
