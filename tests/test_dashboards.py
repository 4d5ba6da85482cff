from pyspark.sql import functions as F

from streamscreen.plans import environment

SENSOR = ("sensor_id string, location string, temperature_fahrenheit double, humidity_percent double, pressure_hpa double, "
          "air_quality_index int, air_quality_status string, at timestamp")


def test_users_meet_readings_not_pairs(spark, monkeypatch):
    at = F.timestamp_millis(F.lit(1_706_000_000_000))
    sensors = spark.createDataFrame([(f"s{i}", "Rome", 50.0, 1.0, 1.0, 10, "x", None) for i in range(3)], SENSOR).withColumn("at", at)
    weather = spark.createDataFrame([("Rome", i, "s", "w") for i in range(4)],
                                    "city string, temperature_f int, short_forecast string, wind_speed string").withColumn("at", at)
    users = spark.createDataFrame([("u", "n", "e", "Rome", "X")], "user_id string, username string, email string, city string, state string")
    seen, join = [], environment.lookup_join

    def counted(stream, table, on):
        seen.append(stream.count())
        return join(stream, table, on)

    monkeypatch.setattr(environment, "lookup_join", counted)
    for made in (environment.complete_dashboard, environment.short_dashboard):
        assert made(sensors, users, weather, sensor_time="at", weather_time="at").count() == 12
    assert seen == [3, 3]
