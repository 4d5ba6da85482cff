"""Card-transaction fraud detection, batch and streaming, with the same rule expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamscreen.operators import rules
from streamscreen.operators.rules import Limits
from streamscreen.sources.topics import record
from streamscreen.sources.validate import parse_transactions
from streamscreen.streaming.carried import run_history
from streamscreen.streaming.jobs import run_to_table
from streamscreen.streaming.processors import with_streaming_history

TRANSACTIONS, ALERTS = "transactions", "fraud-alerts"


def detect(transactions: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """All alerts of a bounded set of transactions (columns of ``parse_transactions``)."""
    complete = transactions.where("complete") if "complete" in transactions.columns else transactions
    return rules.event_alerts(complete, limits).unionByName(rules.spend_alerts(transactions, limits))


def detect_stream(transactions: DataFrame, limits: Limits = Limits(), *,
                  watermark: str = "5 seconds", state_ttl_ms: int | None = 3_600_000) -> DataFrame:
    """All alerts of an unbounded stream, for one query in append mode.

    Per-transaction rules also see late rows; the spend window ignores rows behind the watermark and
    fires once, when the watermark passes its end.
    """
    complete = transactions.where("complete") if "complete" in transactions.columns else transactions
    history = with_streaming_history(complete, limits.velocity_ms, state_ttl_ms)
    per_event = rules.alerts_of(history, [rules.high_value(limits), rules.velocity(limits),
                                          rules.night_owl(limits), rules.escalation(limits)])
    spend = rules.spend_alerts(transactions.withWatermark("event_ts", watermark), limits)
    return per_event.unionByName(spend)


def run_detection(transactions: DataFrame, checkpoint: str, path: str, limits: Limits = Limits(), *,
                  watermark: str = "5 seconds", lateness_ms: int = 0, hot_rows: int | None = None,
                  finish: Callable[[DataFrame], DataFrame] = lambda alerts: alerts,
                  trigger: Mapping[str, object] | None = None) -> list[StreamingQuery]:
    """All alerts of an unbounded stream in which one customer may have most rows.

    Two queries read the stream, each with its checkpoint: the per-transaction rules, whose history lies in tables and
    meets each micro-batch in a join, so no customer is one task's work; and the spend windows, which are partly summed before
    the shuffle. Both write ``finish`` of their alerts below ``path``; ``written_alerts`` reads them.
    """
    complete = transactions.where("complete") if "complete" in transactions.columns else transactions

    def fired(history: DataFrame) -> DataFrame:
        return finish(rules.alerts_of(history, [rules.high_value(limits), rules.velocity(limits),
                                                rules.night_owl(limits), rules.escalation(limits)]))

    spend = finish(rules.spend_alerts(transactions.withWatermark("event_ts", watermark), limits))
    return [run_history(complete, limits.velocity_ms, f"{checkpoint}/events", f"{path}/events", finish=fired,
                        lateness_ms=lateness_ms, hot_rows=hot_rows, trigger=trigger),
            run_to_table(spend, f"{path}/spend", f"{checkpoint}/spend", trigger=trigger)]


def written_alerts(spark: SparkSession, path: str) -> DataFrame:
    """What ``run_detection`` has written so far."""
    events = spark.read.parquet(f"{path}/events").drop("batch")
    return events.unionByName(spark.read.schema(events.schema).parquet(f"{path}/spend"))


def alert_records(alerts: DataFrame, topic: str = ALERTS, now: Column | None = None) -> DataFrame:
    """Stamped alerts as JSON records without a key."""
    stamped = rules.stamp(alerts, now)
    return record(stamped, key=None, value=F.struct(*stamped.columns), topic=topic)


def transactions_of(records: DataFrame) -> DataFrame:
    """Transactions of topic records; the record's own time stands in for an unusable event time."""
    return parse_transactions(records, F.col("value").cast("string"), F.col("timestamp"))
