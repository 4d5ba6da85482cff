"""Card-transaction fraud rules and the alert rows they produce."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamscreen.functions.display import clock_hour, dollars, span, times
from streamscreen.functions.units import capped_score, epoch_ms, exact_sum, from_units, to_units
from streamscreen.operators.history import HOT_ROWS, distinct_look_back, hot_keys, look_back, running
from streamscreen.session import discard, durable

ALERT_COLUMNS = ("transaction_id", "customer_id", "amount", "city", "event_time",
                 "rule_id", "rule_name", "risk_score", "details")
TIE = ("transaction_id",)


# Thresholds and windows here, rule ids, names, scores and texts below.
@dataclass(frozen=True)
class Limits:
    """Thresholds and windows of all rules."""

    high_amount: float = 10_000
    velocity_ms: int = 60_000
    velocity_count: int = 5
    spend_window: str = "10 minutes"
    spend_limit: float = 50_000
    night_first_hour: int = 1
    night_last_hour: int = 4
    night_amount: float = 3_000
    escalation_ratio: float = 3.0


def with_history(transactions: DataFrame, limits: Limits = Limits(), *, tie: Sequence[str] = TIE,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add per-customer history: ``recent_count`` (rows within the velocity window, this one
    included) and ``previous_amount``. One shuffle serves both."""
    return look_back(transactions, ["customer_id"], "event_time", tie, limits.velocity_ms,
                     sums={"recent_count": F.lit(1).cast("long")},
                     previous={"previous_amount": F.col("amount")}, hot_rows=hot_rows)


def _alert(rule_id: str, rule_name: str, risk: Column, details: Column) -> Column:
    return F.struct(F.lit(rule_id).alias("rule_id"), F.lit(rule_name).alias("rule_name"),
                    F.round(risk, 2).alias("risk_score"), details.alias("details"))


def _number(name: str) -> Column:
    """The amount, or null where it is NaN, which would compare as larger than any limit."""
    return F.nanvl(F.col(name), F.lit(None).cast("double"))


def high_value(limits: Limits = Limits()) -> Column:
    amount = _number("amount")
    risk = capped_score(50.0, (amount - limits.high_amount) / 1000)
    text = F.concat(F.lit("Amount "), dollars(amount), F.lit(" exceeds "),
                    F.lit(f"${limits.high_amount:,.0f} threshold"))
    return F.when(amount > limits.high_amount, _alert("R1", "High-Value Transaction", risk, text))


def velocity(limits: Limits = Limits()) -> Column:
    n = F.col("recent_count")
    risk = capped_score(40.0, (n - limits.velocity_count) * 8.0)
    text = F.concat(n.cast("string"), F.lit(f" transactions in the last {limits.velocity_ms // 1000} seconds"))
    return F.when(n > limits.velocity_count, _alert("R2", "High Transaction Velocity", risk, text))


def night_owl(limits: Limits = Limits()) -> Column:
    amount, hour = _number("amount"), F.col("hour")
    text = F.concat(dollars(amount), F.lit(" transaction at "), clock_hour(hour))
    return F.when(hour.between(limits.night_first_hour, limits.night_last_hour)
                  & (amount > limits.night_amount),
                  _alert("R4", "Unusual Hour + High Amount", F.lit(70.0), text))


def escalation(limits: Limits = Limits()) -> Column:
    amount, before = _number("amount"), _number("previous_amount")
    ratio = amount / F.when(before > 0, before)
    risk = capped_score(50.0, ratio * 5)
    text = F.concat(dollars(amount), F.lit(" is "), times(ratio), F.lit("x previous "), dollars(before))
    return F.when(ratio > limits.escalation_ratio,
                  _alert("R5", "Rapid Amount Escalation", risk, text))


def alerts_of(transactions: DataFrame, alerts: Sequence[Column]) -> DataFrame:
    """One row per fired rule, evaluated in a single pass over the transactions."""
    return (transactions
            .select("transaction_id", "customer_id", "amount", "city", "event_time",
                    F.explode(F.array_compact(F.array(*alerts))).alias("_alert"))
            .select("transaction_id", "customer_id", "amount", "city", "event_time", "_alert.*"))


def event_alerts(transactions: DataFrame, limits: Limits = Limits(), *, tie: Sequence[str] = TIE,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Alerts of the four per-transaction rules (R1, R2, R4, R5)."""
    history = with_history(transactions, limits, tie=tie, hot_rows=hot_rows)
    return alerts_of(history, [high_value(limits), velocity(limits), night_owl(limits), escalation(limits)])


def _window_text(window: str) -> str:
    """How a window's length reads in an alert: minutes as ``10-min``, anything else as it is given."""
    number, _, unit = window.partition(" ")
    return f"{number}-min" if unit in ("minute", "minutes") else window


def spend_alerts(transactions: DataFrame, limits: Limits = Limits(), *,
                 order_by: Sequence[str] = ("event_time", "transaction_id"),
                 time: str = "event_ts") -> DataFrame:
    """R3: customers whose total in a tumbling window exceeds the limit.

    The alert carries id, city and time of the window's last row in ``order_by`` order. Sums are
    partial before the shuffle, so a busy customer costs one row per input partition and window.
    On a streaming input (with a watermark on ``time``) use append mode: one alert per closed window.
    """
    last = F.max_by(F.struct("transaction_id", "city", "event_time"), F.struct(*order_by))
    grouped = (transactions.where(F.col("amount").isNotNull())
               .groupBy("customer_id", F.window(time, limits.spend_window).alias("window"))
               .agg(exact_sum(F.col("amount")).alias("_total"),
                    F.count(F.lit(1)).alias("_n"), last.alias("_last"))
               .select("*", F.col("window.start").alias("_start"), F.col("window.end").alias("_end")))
    total = F.col("_total")
    start, end = epoch_ms(grouped, "_start"), epoch_ms(grouped, "_end")
    details = F.concat(
        F.col("_n").cast("string"), F.lit(" transactions totalling "), dollars(total),
        F.lit(f" in {_window_text(limits.spend_window)} window "), span(start, end))
    # NaN compares as larger than any number; a total that is none gives no alert.
    return grouped.where(~F.isnan(total) & (total > limits.spend_limit)).select(
        F.col("_last.transaction_id").alias("transaction_id"), "customer_id",
        total.alias("amount"), F.col("_last.city").alias("city"),
        F.col("_last.event_time").alias("event_time"),
        F.lit("R3").alias("rule_id"), F.lit("High Aggregate Spend").alias("rule_name"),
        capped_score(60.0, (total - limits.spend_limit) / 1000).alias("risk_score"),
        details.alias("details"))


def stamp(alerts: DataFrame, now: Column | None = None) -> DataFrame:
    """Add ``alert_time`` (epoch ms); to be called where alerts leave the job."""
    return alerts.withColumn("alert_time", F.unix_millis(F.current_timestamp()) if now is None else now)


def many_cities(transactions: DataFrame, *, window_ms: int = 30 * 60_000, limit: int = 3,
                tie: Sequence[str] = TIE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """R6: transactions at which a customer has used more than ``limit`` cities within the window."""
    counted = distinct_look_back(transactions, ["customer_id"], "city", "event_time", tie,
                                 window_ms, "city_count", hot_rows=hot_rows)
    return counted.where(F.col("city_count") > limit)


def card_velocity(payments: DataFrame, *, card: str = "card_id", time: str = "event_time",
                  tie: Sequence[str] = ("event_id",), window_ms: int = 600_000,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """R8: per card, count and amount within the look-back window and the country seen before.

    Adds ``recent_count``, ``recent_amount``, ``previous_country`` and ``country_changed``. Amounts
    that are no number or reach 10^18 stay out of ``recent_amount``.
    """
    out = look_back(payments, [card], time, tie, window_ms,
                    sums={"recent_count": F.lit(1).cast("long"), "_units": to_units(F.col("amount"))},
                    previous={"previous_country": F.col("country")}, hot_rows=hot_rows)
    return (out.withColumn("recent_amount", from_units(F.col("_units"))).drop("_units")
            .withColumn("country_changed", F.coalesce(
                F.col("country") != F.col("previous_country"), F.lit(False))))


def cool_off(alerts: DataFrame, *, key: str = "customer_id", time: str = "event_time",
             tie: Sequence[str] = ("transaction_id", "rule_id"), quiet_ms: int = 300_000,
             hot_rows: int = HOT_ROWS) -> DataFrame:
    """R7: keep an alert only if its customer's last kept alert is at least ``quiet_ms`` older.

    A pause of ``quiet_ms`` always restarts the choice, so alerts fall into independent runs and
    the first of each run is kept. Inside a long run the kept times follow from "first time at
    least ``quiet_ms`` later"; those links are doubled, so a run of n kept alerts takes log2(n)
    joins and no task has to walk through a run. The alerts are written once, as counting and ordering both read them.
    """
    alerts = durable(alerts, "cool-off-alerts")
    hot = hot_keys(alerts, [key], max(1, hot_rows // 2))
    marked = running(alerts, [key], [time, *tie], previous={"_before": F.col(time)},
                     hot_rows=hot_rows, hot=hot)
    head = F.col("_before").isNull() | (F.col(time) - F.col("_before") >= quiet_ms)
    first_at_time = F.col("_before").isNull() | (F.col("_before") < F.col(time))
    marked = durable(marked.where(first_at_time).withColumn("_head", head), "cool-off")

    # Next time in the same customer's alerts that is quiet_ms or more later: walk backwards in
    # time, each probe sees the smallest time not before it.
    points = (marked.select(key, F.col(time).alias("_t"))
              .withColumn("_probe", F.explode(F.array(F.lit(0), F.lit(1))))
              .withColumn("_back", -(F.col("_t") + F.col("_probe") * quiet_ms)))
    links = (running(points, [key], ["_back", "_probe", "_t"],
                     previous={"_next": F.when(F.col("_probe") == 0, F.col("_t"))},
                     hot_rows=hot_rows, hot=hot)
             .where((F.col("_probe") == 1) & F.col("_next").isNotNull())
             .select(F.col(key).alias("_key"), F.col("_t").alias("_from"), F.col("_next").alias("_to")))
    heads = marked.where("_head").select(F.col(key).alias("_h_key"), F.col(time).alias("_h_t"))
    # A link into a head adds nothing: heads are kept anyway.
    links = durable(links.join(heads, F.col("_key").eqNullSafe(F.col("_h_key")) & (F.col("_to") == F.col("_h_t")),
                               "left_anti"), "links")
    kept = heads.select(F.col("_h_key").alias("_key"), F.col("_h_t").alias("_t"))
    while not links.isEmpty():
        step = kept.join(links, kept["_key"].eqNullSafe(links["_key"]) & (kept["_t"] == links["_from"])).select(
            kept["_key"], links["_to"].alias("_t"))
        before, kept = kept, durable(kept.unionByName(step), "kept")
        discard(before)
        onward = links.select(F.col("_key").alias("_k2"), F.col("_from").alias("_f2"), F.col("_to").alias("_t2"))
        shorter, links = links, durable(
            links.join(onward, F.col("_key").eqNullSafe(F.col("_k2")) & (F.col("_to") == F.col("_f2")))
            .select("_key", "_from", F.col("_t2").alias("_to")), "links")
        discard(shorter)
    made = (marked.join(kept, marked[key].eqNullSafe(kept["_key"]) & (marked[time] == kept["_t"]), "left_semi")
            .select(*alerts.columns))
    # The result reads the marked alerts and the kept times only.
    discard(links)
    discard(alerts)
    return made
