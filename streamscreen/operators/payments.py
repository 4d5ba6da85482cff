"""Payment screening: rule score, reasons, route, dead letters and headers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamscreen import schemas
from streamscreen.functions.once import once
from streamscreen.functions.units import exact_sum
from streamscreen.sources.topics import add_headers, header, record, unique_headers

RAW, APPROVED, FLAGGED, DEAD_LETTER = (
    "payments.raw", "payments.approved", "payments.flagged", "payments.dlq")

# Screening lists and limits.
RISKY_COUNTRIES = ("NG", "RU")
HIGH_RISK_CATEGORIES = ("GIFT_CARDS", "CRYPTO")
HIGH_AMOUNT = 400.0
ATM_AMOUNT = 200.0
FLAG_SCORE = 60


@dataclass(frozen=True)
class ScoreRule:
    """``weight`` is added and ``reason`` reported where ``applies`` holds."""

    reason: str
    weight: int
    applies: Callable[[], Column]


def score_rules(high_amount: float = HIGH_AMOUNT, risky: Sequence[str] = RISKY_COUNTRIES,
                categories: Sequence[str] = HIGH_RISK_CATEGORIES,
                atm_amount: float = ATM_AMOUNT) -> tuple[ScoreRule, ...]:
    amount = F.col("amount").cast("double")
    return (
        ScoreRule("high_amount", 40, lambda: amount >= high_amount),
        ScoreRule("risky_country", 30, lambda: F.col("country").isin(*risky)),
        ScoreRule("high_risk_category", 30, lambda: F.col("merchant_category").isin(*categories)),
        ScoreRule("ip_country_mismatch", 25, lambda: F.col("ip_country") != F.col("country")),
        ScoreRule("large_atm_withdrawal", 20,
                  lambda: (F.col("channel") == "ATM") & (amount >= atm_amount)),
    )


def score(payments: DataFrame, rules: Sequence[ScoreRule] | None = None) -> DataFrame:
    """Add ``risk_score`` and ``risk_reasons`` (in rule order)."""
    rules = score_rules() if rules is None else rules
    points = [F.when(r.applies(), F.lit(r.weight)).otherwise(F.lit(0)) for r in rules]
    reasons = [F.when(r.applies(), F.lit(r.reason)) for r in rules]
    return once(payments, risk_score=reduce(lambda a, b: a + b, points).cast("int"),
                risk_reasons=F.array_compact(F.array(*reasons)))


def drop_zero_amounts(payments: DataFrame) -> DataFrame:
    """Rows with amount zero are neither approved nor flagged."""
    return payments.where(F.col("amount") != 0)


def route(scored: DataFrame, flag_score: int = FLAG_SCORE, approved: str = APPROVED,
          flagged: str = FLAGGED) -> DataFrame:
    """Add the output ``topic``."""
    return scored.withColumn(
        "topic", F.when(F.col("risk_score") >= flag_score, F.lit(flagged)).otherwise(F.lit(approved)))


def _text_or_empty(value: Column) -> Column:
    return F.coalesce(F.decode(value, "UTF-8"), F.lit(""))


def screen(checked: DataFrame, *, rules: Sequence[ScoreRule] | None = None,
           flag_score: int = FLAG_SCORE, processed_by: str = "payment-screening",
           approved: str = APPROVED, flagged: str = FLAGGED, dead_letter: str = DEAD_LETTER) -> DataFrame:
    """Records for all three output topics from validated input records.

    ``checked`` is the output of :func:`streamscreen.sources.validate.check_records`: the topic
    record columns plus ``event`` and ``error``. One narrow pass, no shuffle; every input row gives
    at most one output record with ``topic``, ``key``, ``value`` and ``headers``.
    """
    valid = F.col("error").isNull()
    amount = F.col("event.amount")
    fields = [F.col(f"event.{name}").alias(name) for name in schemas.PAYMENT.fieldNames()]
    source = checked.where(~valid | amount.isNull() | (amount != 0)).select(
        *fields, F.struct("topic", "partition", "offset", "key").alias("_in"),
        valid.alias("_valid"), "headers",
        F.coalesce("error", F.when(amount.isNull(), F.lit("amount not numeric"))).alias("_error"))
    source = once(source, _headers=unique_headers(F.col("headers")))
    judged = once(route(score(source, rules), flag_score, approved, flagged),
                  _route=F.when(F.col("_error").isNull(), F.col("topic")).otherwise(F.lit(dead_letter)))

    ok = F.col("_error").isNull()
    payment = F.struct(*schemas.PAYMENT.fieldNames())
    event = F.to_json(F.struct(*schemas.PAYMENT.fieldNames(), "risk_score", "risk_reasons"))
    letter = F.to_json(F.struct(
        F.col("_error").alias("error"), F.col("_in.topic").alias("topic"),
        F.col("_in.partition").alias("partition"), F.col("_in.offset").alias("offset"),
        _text_or_empty(F.col("_in.key")).alias("key"),
        header(F.col("_headers"), "excel_row", "").alias("excel_row"),
        F.when(F.col("_valid"), payment).alias("event")))
    return judged.select(
        F.col("_route").alias("topic"),
        F.when(ok, F.col("_in.key")).alias("key"),
        F.encode(F.when(ok, event).otherwise(letter), "UTF-8").alias("value"),
        F.when(ok, add_headers(F.col("_headers"), {
            "processed_by": F.lit(processed_by), "model": F.lit("rules_v1"), "routed_to": F.col("_route"),
        })).otherwise(F.col("_headers")).alias("headers"))


def totals_by_route(routed: DataFrame) -> DataFrame:
    """Count and amount per output topic."""
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("n"),
                                       exact_sum(F.col("amount")).alias("amount"))


def totals_by_reason(scored: DataFrame) -> DataFrame:
    """Count and amount per reason."""
    return (scored.select("amount", F.explode("risk_reasons").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n"),
                                   exact_sum(F.col("amount")).alias("amount")))


def payment_records(payments: DataFrame, source: Column, sheet: Column, row: Column,
                    topic: str = RAW) -> DataFrame:
    """Validated tabular rows as keyed records with lineage headers."""
    return record(payments, key=F.col("card_id"),
                  value=F.struct(*schemas.PAYMENT.fieldNames()), topic=topic,
                  headers={"source": source, "excel_sheet": sheet, "excel_row": row.cast("string")})
