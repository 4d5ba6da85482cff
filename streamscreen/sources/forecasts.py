"""Forecast documents to weather rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamscreen.functions.units import f_to_c
from streamscreen.schemas import FORECAST_DOCUMENT


def flatten_forecasts(documents: DataFrame, text: str, timestamp: Column) -> DataFrame:
    """The first period of each document as a weather row; documents without periods are dropped.

    Other columns of ``documents`` (city, state, latitude, longitude) are kept.
    """
    period = F.col("_period")
    # Defaults of fields a period leaves out.
    temperature_f = F.coalesce(period["temperature"], F.lit(0.0))
    keep = [c for c in documents.columns if c != text]
    return (documents
            .withColumn("_period", F.get(F.from_json(text, FORECAST_DOCUMENT)["properties"]["periods"], F.lit(0)))
            .where(period.isNotNull())
            .select(
                *keep, timestamp.alias("timestamp"),
                temperature_f.cast("int").alias("temperature_f"),
                f_to_c(temperature_f).alias("temperature_c"),
                F.coalesce(period["temperatureUnit"], F.lit("F")).alias("temperature_unit"),
                F.coalesce(period["windSpeed"], F.lit("N/A")).alias("wind_speed"),
                F.coalesce(period["windDirection"], F.lit("N/A")).alias("wind_direction"),
                F.coalesce(period["shortForecast"], F.lit("N/A")).alias("short_forecast"),
                F.coalesce(period["detailedForecast"], F.lit("")).alias("detailed_forecast"),
                F.coalesce(period["isDaytime"], F.lit(True)).alias("is_daytime"),
                F.coalesce(period["name"], F.lit("Current")).alias("period_name"),
                F.coalesce(period["icon"], F.lit("")).alias("icon")))
