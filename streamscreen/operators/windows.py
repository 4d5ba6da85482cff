"""Event-time windows: tumbling, hopping and session aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamscreen.functions.units import epoch_ms


def window_bounds(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` and ``window_end`` in epoch ms."""
    flat = df.select("*", F.col("window.start").alias("_start"), F.col("window.end").alias("_end"))
    return (flat.withColumn("window_start", epoch_ms(flat, "_start"))
            .withColumn("window_end", epoch_ms(flat, "_end"))
            .drop("window", "_start", "_end"))


def tumbling(df: DataFrame, keys: Sequence[str], time: str, size: str,
             aggregates: Sequence[Column]) -> DataFrame:
    """Aggregates per key and window ``[start, start + size)``."""
    grouped = df.groupBy(*keys, F.window(time, size).alias("window")).agg(*aggregates)
    return window_bounds(grouped)


def hopping(df: DataFrame, keys: Sequence[str], time: str, size: str, advance: str,
            aggregates: Sequence[Column]) -> DataFrame:
    """Aggregates per key and overlapping window; each row stands in ``size / advance`` of them."""
    grouped = df.groupBy(*keys, F.window(time, size, advance).alias("window")).agg(*aggregates)
    return window_bounds(grouped)


def sessions(df: DataFrame, keys: Sequence[str], time: str, gap_ms: int) -> DataFrame:
    """Row count per key and session: runs of rows at most ``gap_ms`` apart.

    Columns: keys, ``window_start`` and ``last_event`` (first and last row), ``window_end``
    (last row plus the gap) and ``readings_in_session``.

    In batch, rows are first reduced to one row per key and gap-wide slot - rows of one slot are
    always one session - so the ordered step sees at most one row per slot of a key's time range,
    however many rows the key has.
    """
    if df.isStreaming:
        seconds = gap_ms / 1000
        grouped = (df.groupBy(*keys, F.session_window(time, f"{seconds} seconds").alias("window"))
                   .agg(F.count(F.lit(1)).alias("readings_in_session"),
                        F.max(time).alias("_last")))
        flat = window_bounds(grouped)
        return flat.withColumn("last_event", epoch_ms(flat, "_last")).drop("_last")
    timed = df.select(*keys, epoch_ms(df, time).alias("_ms")).where(F.col("_ms").isNotNull())
    slot = F.col("_ms") - F.pmod(F.col("_ms"), F.lit(gap_ms))
    slots = timed.groupBy(*keys, slot.alias("_slot")).agg(
        F.min("_ms").alias("_first"), F.max("_ms").alias("_last"), F.count(F.lit(1)).alias("_n"))
    ordered = Window.partitionBy(*keys).orderBy("_slot")
    before = F.lag("_last").over(ordered)
    starts = (before.isNull() | (F.col("_first") - before > gap_ms)).cast("long")
    numbered = slots.withColumn("_starts", starts).withColumn(
        "_session", F.sum("_starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return (numbered.groupBy(*keys, "_session")
            .agg(F.min("_first").alias("window_start"), F.max("_last").alias("last_event"),
                 F.sum("_n").alias("readings_in_session"))
            .withColumn("window_end", F.col("last_event") + gap_ms)
            .drop("_session"))


def city_summary(sensors: DataFrame, time: str, size: str = "1 minute",
                 location: str = "location") -> DataFrame:
    """Readings, average temperature, humidity and AQI, and worst AQI per city and window."""
    return tumbling(sensors, [location], time, size, [
        F.count(F.lit(1)).alias("reading_count"),
        F.round(F.avg("temperature_fahrenheit"), 1).alias("avg_temp_f"),
        F.round(F.avg("humidity_percent"), 1).alias("avg_humidity"),
        F.round(F.avg("air_quality_index"), 0).alias("avg_aqi"),
        F.max("air_quality_index").alias("max_aqi"),
    ]).withColumnRenamed(location, "city")


def windowed_readings(sensors: DataFrame, time: str, size: str = "5 minutes") -> DataFrame:
    """Reading count, average temperature and worst AQI per location, with window bounds."""
    return tumbling(sensors, ["location"], time, size, [
        F.count(F.lit(1)).alias("reading_count"),
        F.avg("temperature_fahrenheit").alias("avg_temp"),
        F.max("air_quality_index").alias("max_aqi"),
    ])


def hopping_forecast(weather: DataFrame, time: str, size: str = "10 minutes",
                     advance: str = "5 minutes") -> DataFrame:
    """Average forecast temperature per city over overlapping windows."""
    return hopping(weather, ["city"], time, size, advance,
                   [F.avg("temperature_f").alias("avg_forecast_temp")])


def hourly_averages(sensors: DataFrame, time: str) -> DataFrame:
    return tumbling(sensors, ["location"], time, "1 hour", [
        F.count(F.lit(1)).alias("reading_count"),
        F.avg("temperature_fahrenheit").alias("avg_temp"),
        F.avg("humidity_percent").alias("avg_humidity"),
    ])


def per_minute(df: DataFrame, time_ms: str, keys: Sequence[str] = ()) -> DataFrame:
    """Row count per minute (epoch ms of its start) and optional keys."""
    if isinstance(df.schema[time_ms].dataType, T.LongType):
        minute = F.col(time_ms) - F.pmod(F.col(time_ms), F.lit(60_000))
    else:
        ms = epoch_ms(df, time_ms)
        minute = ms - F.pmod(ms, F.lit(60_000))
    return df.groupBy(minute.alias("minute_ms"), *keys).agg(F.count(F.lit(1)).alias("n"))


def bucket_counts(df: DataFrame, key: str, time_ms: str, bucket_ms: int) -> DataFrame:
    """Rows per key and time bucket (epoch ms of its start); batch or streaming, partly aggregated before rows are shuffled."""
    bucket = F.col(time_ms) - F.pmod(F.col(time_ms), F.lit(bucket_ms))
    return df.groupBy(F.col(key).alias("key"), bucket.alias("bucket_ms")).agg(F.count(F.lit(1)).alias("bucket_count"))
