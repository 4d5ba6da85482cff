"""Payment screening end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamscreen.operators import payments
from streamscreen.schemas import PAYMENT_RULES
from streamscreen.sources import tabular
from streamscreen.sources.validate import check_records, check_rows, rejected, valid_only


def ingest(spark: SparkSession, path: str, sheet: str = "payments") -> tuple[DataFrame, DataFrame]:
    """Raw topic records of a payment file, and its rows that fail validation."""
    rows = tabular.keep_complete(tabular.read_payment_rows(spark, path))
    checked = check_rows(rows, PAYMENT_RULES)
    good = checked.where(F.col("error").isNull()).drop("event", "error")
    return (payments.payment_records(good, F.col("source"), F.lit(sheet), F.col("row")),
            rejected(checked))


def screen_records(records: DataFrame, **options) -> DataFrame:
    """Approved, flagged and dead-letter records of raw payment records; batch or streaming."""
    return payments.screen(check_records(records, PAYMENT_RULES), **options)


def screen_events(records: DataFrame) -> DataFrame:
    """Valid, non-zero payments with score, reasons and topic as columns."""
    events = valid_only(records, F.col("value").cast("string"), PAYMENT_RULES)
    return payments.route(payments.score(payments.drop_zero_amounts(events)))
