"""Unit conversions, clamps and time helpers as Column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sums of amounts run over whole units of 10^-10 as decimals, so a retried task or another
# partitioning gives the same total to the last digit. Amounts from 10^18 have no such units.
AMOUNT_DIGITS = 10
_AMOUNT = "decimal(28,10)"
_UNITS = "decimal(38,0)"


def f_to_c(fahrenheit: Column, digits: int = 2) -> Column:
    return F.round((fahrenheit - 32) * 5 / 9, digits)


def c_to_f(celsius: Column, digits: int = 2) -> Column:
    return F.round(celsius * 9 / 5 + 32, digits)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def humidity_in_range(value: Column) -> Column:
    return clamp(value, 0, 100)


def aqi_in_range(value: Column) -> Column:
    return clamp(value, 0, 500)


def to_units(amount: Column) -> Column:
    """Whole units of an amount, from the shortest decimal text of its double; null for NaN and from 10^18 on."""
    scale = F.lit(10 ** AMOUNT_DIGITS).cast("decimal(11,0)")
    return (amount.try_cast(_AMOUNT) * scale).cast("decimal(28,0)").cast(_UNITS)


def from_units(units: Column) -> Column:
    """Units as an amount: the nearest double, as long as a decimal can hold units and digits together."""
    held = units.try_cast("decimal(27,0)")
    exact = (held * F.lit(Decimal(10) ** -AMOUNT_DIGITS).cast("decimal(10,10)")).cast("double")
    return F.coalesce(exact, units.cast("double") / F.lit(float(10 ** AMOUNT_DIGITS)))


def without_units(amount: Column) -> Column:
    """The amount where ``to_units`` has none: NaN, or 10^18 and more; else null."""
    return F.when(amount.try_cast(_AMOUNT).isNull(), amount)


def exact_sum(amount: Column) -> Column:
    """Order-independent sum of a money column. No amount ends the job: amounts from 10^18 on are
    added as doubles, and a NaN makes the sum NaN."""
    exact, other = F.sum(amount.try_cast(_AMOUNT)).cast("double"), F.sum(without_units(amount))
    return F.when(other.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + other)


def capped_score(base: float, extra: Column, cap: float = 100.0) -> Column:
    """``min(cap, base + extra)``."""
    return F.least(F.lit(cap), F.lit(base) + extra)


def epoch_ms(df: DataFrame, name: str) -> Column:
    """Column ``name`` as epoch milliseconds, without any session-zone shift."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.LongType):
        return F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(
            f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`) div 1000")
    if isinstance(kind, T.StringType):
        return F.unix_millis(F.try_to_timestamp(F.col(name)))
    return F.unix_millis(F.col(name))


def utc_hour(ms: Column) -> Column:
    """Hour of day of an epoch-millisecond value, in UTC whatever the session zone."""
    return F.floor(F.pmod(ms, F.lit(86_400_000)) / 3_600_000).cast("int")


def utc_hh_mm(ms: Column) -> Column:
    """``HH:MM`` in UTC of an epoch-millisecond value."""
    minute = F.floor(F.pmod(ms, F.lit(86_400_000)) / 60_000)
    return F.format_string("%02d:%02d", F.floor(minute / 60), F.pmod(minute, F.lit(60)))
