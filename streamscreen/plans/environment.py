"""Environmental monitoring: weather, sensor and user data joined into views and alerts.

``sensors``, ``weather`` and ``users`` have the columns of the declared streams; ``users`` is the
lookup table with one row per city (:func:`streamscreen.operators.tables.users_table`). Queries without users take
batch or streaming inputs. A join with the users table inside one streaming plan would use the table as it was when the
query started, so streams join it per micro-batch: ``streaming.jobs.run_with_table`` calls the same functions with the
table as it is then.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamscreen.functions import labels
from streamscreen.functions.units import aqi_in_range, f_to_c, humidity_in_range
from streamscreen.operators.intervals import interval_join, lookup_join, spread_interval_join
from streamscreen.streaming.meetings import pairs, run_interval_join

# These spans, and the limits in the queries below.
MINUTE_MS = 60_000
HOUR_MS = 3_600_000


def hot_weather(weather: DataFrame, above: float = 80) -> DataFrame:
    return weather.where(F.col("temperature_f") > above).select(
        "city", "state", "temperature_f", "temperature_c", "short_forecast",
        labels.heat_alert(F.col("temperature_f")).alias("heat_alert"))


def poor_air(sensors: DataFrame, above: float = 100) -> DataFrame:
    return sensors.where(F.col("air_quality_index") > above).select(
        "location", "state", "air_quality_index", "air_quality_status",
        "temperature_fahrenheit", "humidity_percent")


def _with_users(stream: DataFrame, users: DataFrame, city: str) -> DataFrame:
    """Inner join to the users table, whose columns come out with a ``u_`` prefix."""
    prefixed = users.select([F.col(c).alias(f"u_{c}") for c in users.columns])
    return lookup_join(stream, prefixed, (city, "u_city"))


def _users(*names: str) -> list:
    return [F.col(f"u_{n}").alias(n) for n in names]


def user_local_sensors(sensors: DataFrame, users: DataFrame) -> DataFrame:
    return _with_users(sensors, users, "location").select(
        *_users("user_id", "username", "email", "city", "state"), "sensor_id",
        F.col("temperature_fahrenheit").alias("sensor_temp_f"), "humidity_percent",
        "air_quality_index", "air_quality_status", F.col("timestamp").alias("reading_time"))


def user_weather(weather: DataFrame, users: DataFrame) -> DataFrame:
    return _with_users(weather, users, "city").select(
        *_users("user_id", "username", "email", "city", "state"), "temperature_f", "temperature_c",
        "wind_speed", "wind_direction", "short_forecast", "period_name",
        F.col("timestamp").alias("forecast_time"))


def readings_with_forecast(sensors: DataFrame, weather: DataFrame, *, sensor_time: str, weather_time: str,
                           within_ms: int = HOUR_MS) -> DataFrame:
    """Readings with the forecasts (``w_`` columns) of the same city at most ``within_ms`` apart.

    Every such pair is a row: with a hundred times the rate of both streams there are 10^4 times the rows.
    """
    join = interval_join if sensors.isStreaming or weather.isStreaming else spread_interval_join
    return join(sensors, _forecasts(weather, weather_time), [("location", "w_city")], left_time=sensor_time,
                right_time="w_time", before_ms=within_ms, after_ms=within_ms)


def _forecasts(weather: DataFrame, weather_time: str) -> DataFrame:
    return weather.select(F.col("city").alias("w_city"), F.col(weather_time).alias("w_time"),
                          F.col("temperature_f").alias("w_temperature_f"),
                          F.col("short_forecast").alias("w_short_forecast"),
                          F.col("wind_speed").alias("w_wind_speed"))


def _addressed(readings: DataFrame, users: DataFrame) -> DataFrame:
    """Readings with their city's user and their alert status."""
    return _with_users(readings, users, "location").withColumn(
        "_alert_status", labels.alert_status(F.col("air_quality_index"), F.col("temperature_fahrenheit")))


def _full(addressed: DataFrame) -> DataFrame:
    return addressed.select(
        *_users("user_id", "username", "email", "city", "state"), "sensor_id",
        F.col("temperature_fahrenheit").alias("sensor_temp"), "humidity_percent", "pressure_hpa",
        "air_quality_index", "air_quality_status", F.col("w_temperature_f").alias("forecast_temp"),
        F.col("w_short_forecast").alias("short_forecast"), F.col("w_wind_speed").alias("wind_speed"),
        F.col("_alert_status").alias("alert_status"))


def _short(addressed: DataFrame) -> DataFrame:
    return addressed.select(
        *_users("user_id", "username", "city"), F.col("temperature_fahrenheit").alias("sensor_temp"),
        "air_quality_index", F.col("w_temperature_f").alias("forecast_temp"),
        F.col("w_short_forecast").alias("short_forecast"))


def dashboard_of(joined: DataFrame, users: DataFrame) -> DataFrame:
    """The full dashboard from the rows of ``readings_with_forecast``."""
    return _full(_addressed(joined, users))


def short_dashboard_of(joined: DataFrame, users: DataFrame) -> DataFrame:
    return _short(_addressed(joined, users))


def complete_dashboard(sensors: DataFrame, users: DataFrame, weather: DataFrame, *,
                       sensor_time: str, weather_time: str, within_ms: int = HOUR_MS) -> DataFrame:
    """Sensor reading, user and forecast of the same city at most ``within_ms`` apart.

    Users and labels belong to a reading, so they are joined and made once for each reading, not for each pair.
    """
    return _full(readings_with_forecast(_addressed(sensors, users), weather, sensor_time=sensor_time, weather_time=weather_time,
                                        within_ms=within_ms))


def short_dashboard(sensors: DataFrame, users: DataFrame, weather: DataFrame, *,
                    sensor_time: str, weather_time: str, within_ms: int = HOUR_MS) -> DataFrame:
    return _short(readings_with_forecast(_addressed(sensors, users), weather, sensor_time=sensor_time,
                                         weather_time=weather_time, within_ms=within_ms))


def run_dashboard(sensors: DataFrame, weather: DataFrame, users: Callable[[], DataFrame], checkpoint: str, path: str, *,
                  sensor_time: str, weather_time: str, within_ms: int = HOUR_MS, delay_ms: int = 0,
                  trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Streaming form of :func:`complete_dashboard`, read by :func:`written_dashboard`.

    Readings and forecasts meet in blocks (``streaming.meetings``); each micro-batch reads ``users`` anew and joins them to its readings.
    """
    readings = sensors.select("sensor_id", "location", "temperature_fahrenheit", "humidity_percent", "pressure_hpa",
                              "air_quality_index", "air_quality_status", sensor_time)
    return run_interval_join(readings, _forecasts(weather, weather_time), [("location", "w_city")], checkpoint, path,
                             left_time=sensor_time, right_time="w_time", before_ms=within_ms, after_ms=within_ms,
                             delay_ms=delay_ms, dress=lambda rows: _addressed(rows, users()), trigger=trigger)


def written_dashboard(spark: SparkSession, path: str, within_ms: int = HOUR_MS) -> DataFrame:
    return _full(pairs(spark, path, before_ms=within_ms, after_ms=within_ms))


def forecast_against_sensor(weather: DataFrame, sensors: DataFrame, *, weather_time: str,
                            sensor_time: str, within_ms: int = MINUTE_MS) -> DataFrame:
    """Forecast and measured temperature of the same city at most ``within_ms`` apart."""
    w, s = _compared_sides(weather, sensors, weather_time, sensor_time)
    return _compared(interval_join(w, s, [("city", "location")], left_time="w_time", right_time="s_time",
                                   before_ms=within_ms, after_ms=within_ms))


def _compared_sides(weather: DataFrame, sensors: DataFrame, weather_time: str, sensor_time: str) -> tuple[DataFrame, DataFrame]:
    return (weather.select("city", "temperature_f", F.col(weather_time).alias("w_time")),
            sensors.select("location", "temperature_fahrenheit", F.col(sensor_time).alias("s_time")))


def _compared(joined: DataFrame) -> DataFrame:
    forecast, actual = F.col("temperature_f"), F.col("temperature_fahrenheit")
    return joined.select(
        "city", forecast.alias("nws_forecast_temp"), actual.alias("sensor_actual_temp"),
        F.abs(forecast - actual).alias("temp_difference"),
        labels.variance_status(forecast, actual).alias("variance_status"))


def run_comparison(weather: DataFrame, sensors: DataFrame, checkpoint: str, path: str, *, weather_time: str,
                   sensor_time: str, within_ms: int = MINUTE_MS, delay_ms: int = 0,
                   trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Streaming form of :func:`forecast_against_sensor`, read by :func:`written_comparison`."""
    w, s = _compared_sides(weather, sensors, weather_time, sensor_time)
    return run_interval_join(w, s, [("city", "location")], checkpoint, path, left_time="w_time", right_time="s_time",
                             before_ms=within_ms, after_ms=within_ms, delay_ms=delay_ms, trigger=trigger)


def written_comparison(spark: SparkSession, path: str, within_ms: int = MINUTE_MS) -> DataFrame:
    return _compared(pairs(spark, path, before_ms=within_ms, after_ms=within_ms))


def user_alerts(sensors: DataFrame, users: DataFrame) -> DataFrame:
    """Readings outside the normal range, addressed to the city's user."""
    aqi, temp, humidity = (F.col("air_quality_index"), F.col("temperature_fahrenheit"),
                           F.col("humidity_percent"))
    unusual = sensors.where((aqi > 150) | (temp > 95) | (temp < 32) | (humidity > 90))
    return _with_users(unusual, users, "location").select(
        *_users("username", "email", "city"), "air_quality_index", "temperature_fahrenheit",
        labels.alert_message(aqi, temp, humidity).alias("alert_message"),
        F.col("timestamp").alias("alert_time"))


def user_alerts_wide(sensors: DataFrame, users: DataFrame) -> DataFrame:
    """The variant with wider limits and shorter texts; some of its rows read NORMAL CONDITIONS."""
    aqi, temp = F.col("air_quality_index"), F.col("temperature_fahrenheit")
    unusual = sensors.where((aqi > 100) | (temp > 90) | (temp < 35))
    return _with_users(unusual, users, "location").select(
        *_users("username", "email", "city"), "air_quality_index", "temperature_fahrenheit",
        labels.alert_message_short(aqi, temp).alias("alert_message"))


def local_air(sensors: DataFrame, users: DataFrame) -> DataFrame:
    return _with_users(sensors, users, "location").select(
        *_users("username", "email", "city"), "temperature_fahrenheit", "air_quality_index",
        "air_quality_status")


def both_units(sensors: DataFrame) -> DataFrame:
    return sensors.select(
        "sensor_id", "location", "temperature_fahrenheit", "temperature_celsius",
        f_to_c(F.col("temperature_fahrenheit")).alias("calculated_celsius"), "humidity_percent",
        "air_quality_status")


def label_readings(sensors: DataFrame) -> DataFrame:
    """Bring humidity and AQI into range and set the AQI status."""
    return (sensors.withColumn("humidity_percent", humidity_in_range(F.col("humidity_percent")))
            .withColumn("air_quality_index", aqi_in_range(F.col("air_quality_index")).cast("int"))
            .withColumn("air_quality_status", labels.aqi_status(F.col("air_quality_index"))))
