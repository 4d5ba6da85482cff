"""Display strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def times(ratio: Column) -> Column:
    return F.format_string("%.1f", ratio)


def clock_hour(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)


def span(start_ms: Column, end_ms: Column) -> Column:
    return F.format_string("[%d - %d]", start_ms, end_ms)
