from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from streamscreen.operators import intervals, stats, tables, windows
from streamscreen.plans import environment
from tests.conftest import rows

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
CITIES = [("New York", "NY"), ("Los Angeles", "CA"), ("Chicago", "IL"), ("San Francisco", "CA"), ("Miami", "FL")]


@pytest.fixture(scope="module")
def users(spark):
    data = [(i * 3 + j + 1, f"user{i}{j}", None if j == 2 else f"u{i}{j}@x", city, state)
            for i, (city, state) in enumerate(CITIES) for j in range(3)]
    return spark.createDataFrame(data, "user_id int, username string, email string, city string, state string")


def sensors(spark, data):
    """(sensor, city, seconds, aqi, °F, humidity)"""
    full = [(s, c, "ST", str(sec), 1.0, float(t), float(h), 1000.0, aqi, "x", T0 + timedelta(seconds=sec))
            for s, c, sec, aqi, t, h in data]
    return spark.createDataFrame(
        full, "sensor_id string, location string, state string, timestamp string, temperature_celsius double, "
              "temperature_fahrenheit double, humidity_percent double, pressure_hpa double, "
              "air_quality_index int, air_quality_status string, at timestamp")


def weather(spark, data):
    """(city, seconds, °F)"""
    full = [(c, "ST", str(sec), t, 1.0, "5 mph", "N", f"sky{t}", "Tonight", T0 + timedelta(seconds=sec)) for c, sec, t in data]
    return spark.createDataFrame(
        full, "city string, state string, timestamp string, temperature_f int, temperature_c double, "
              "wind_speed string, wind_direction string, short_forecast string, period_name string, at timestamp")


def test_users_table_keeps_latest_per_city(spark, users):
    table = tables.users_table(users.union(users))
    assert table.count() == 5
    ny = table.where("city = 'New York'").first()
    assert (ny["user_id"], ny["username"], ny["email"]) == (3, "user02", "u01@x")
    with_nulls = tables.users_table(users, ignore_nulls=False).where("city = 'New York'").first()
    assert with_nulls["email"] is None
    assert {r["user_count"] for r in tables.users_by_city(users).collect()} == {3}
    assert {r["user_count"] for r in tables.users_by_city(table).collect()} == {1}
    assert tables.total_users(users).first()[0] == 15


def test_lookup_join_is_inner_either_way(spark, users):
    table = tables.users_table(users)
    readings = sensors(spark, [("s1", "New York", 0, 10, 50, 10), ("s2", "Nowhere", 0, 10, 50, 10)])
    small = environment.user_local_sensors(readings, table)
    assert rows(small, "user_id", "sensor_id", "city") == [(3, "s1", "New York")]
    prefixed = table.select([F.col(c).alias(f"u_{c}") for c in table.columns])
    large = intervals.lookup_join(readings, prefixed, ("location", "u_city"), max_rows=2)
    assert not intervals.small_enough(prefixed, max_rows=2) and intervals.small_enough(prefixed)
    assert not intervals.small_enough(prefixed, max_bytes=10)
    assert rows(large, "u_user_id", "sensor_id") == [(3, "s1")]
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()


def test_user_alerts_both_variants(spark, users):
    table = tables.users_table(users)
    readings = sensors(spark, [
        ("a", "Miami", 0, 151, 96, 10), ("b", "Miami", 1, 150, 95, 90), ("c", "Miami", 2, 150, 95, 90.1),
        ("d", "Miami", 3, 0, 31.9, 0), ("e", "Miami", 4, 101, 50, 0), ("f", "Miami", 5, 100, 34.9, 0)])
    assert [m.split(" - ")[0] for m, in rows(environment.user_alerts(readings, table), "alert_message")] == [
        "FREEZING TEMPERATURES", "UNHEALTHY AIR QUALITY", "VERY HIGH HUMIDITY"]
    assert rows(environment.user_alerts_wide(readings, table), "alert_message") == [
        ("FREEZE WARNING",), ("NORMAL CONDITIONS",), ("NORMAL CONDITIONS",), ("NORMAL CONDITIONS",),
        ("NORMAL CONDITIONS",), ("UNHEALTHY AIR - Stay indoors",)]


def test_interval_join_edges(spark):
    readings = sensors(spark, [("s", "Miami", 1000, 10, 50, 10), ("s", "Chicago", 1000, 10, 50, 10)])
    forecasts = weather(spark, [("Miami", 1000 + d, d) for d in (-61, -60, 0, 60, 61)])
    got = environment.forecast_against_sensor(forecasts, readings, weather_time="at", sensor_time="at")
    assert rows(got, "nws_forecast_temp", "variance_status") == [
        (-60, "LARGE VARIANCE"), (0, "LARGE VARIANCE"), (60, "MODERATE VARIANCE")]


def test_interval_join_equals_brute_force(spark):
    left = [("hot" if i % 3 else "cold", (i * 37) % 1000 - 500) for i in range(60)]
    right = [("hot" if i % 2 else "cold", (i * 53) % 1000 - 500) for i in range(60)]
    l = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(left)], "k string, lt long, l int")
    r = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(right)], "k2 string, rt long, r int")
    for before, after in ((0, 0), (25, 25), (0, 90), (90, 0)):
        got = intervals.interval_join(l, r, [("k", "k2")], left_time="lt", right_time="rt", before_ms=before, after_ms=after)
        expected = sorted(((i, j) for i, (k, t) in enumerate(left) for j, (k2, u) in enumerate(right)
                           if k == k2 and u - before <= t <= u + after), key=repr)
        assert rows(got, "l", "r") == expected


def test_spread_join_equals_brute_force(spark):
    """Groups above the limit on the left, on the right and on both sides, repeated rows, null keys and times."""
    left = [("hot" if i % 3 else "cold", (i * 37) % 1000 - 500) for i in range(60)] + [("many", 5)] * 9 + [(None, 1), ("hot", None)]
    right = [("hot" if i % 2 else "cold", (i * 53) % 1000 - 500) for i in range(60)] + [("many", 6)] * 2 + [(None, 1), ("hot", None)]
    l = spark.createDataFrame([(k, t, i % 65) for i, (k, t) in enumerate(left)], "k string, lt long, l int")
    r = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(right)], "k2 string, rt long, r int")
    for before, after, piece_rows in ((0, 0, 1), (25, 25, 3), (0, 90, 5), (300, 0, 4096)):
        settings = {"left_time": "lt", "right_time": "rt", "before_ms": before, "after_ms": after}
        got = intervals.spread_interval_join(l, r, [("k", "k2")], piece_rows=piece_rows, **settings)
        expected = sorted(((k, t, i % 65, k2, u, j) for i, (k, t) in enumerate(left) for j, (k2, u) in enumerate(right)
                           if k and k == k2 and None not in (t, u) and u - before <= t <= u + after), key=repr)
        assert got.columns == [*l.columns, *r.columns] and rows(got) == expected and expected


def test_pairs_of_one_key_and_hour_are_made_by_many_tasks(spark):
    """However few bytes are read, and also where they are all of one key and bucket, no task makes most of the pairs."""
    readings = spark.range(300).selectExpr("concat('s', id) AS sensor_id", "'Rome' AS location", "id AS at", "1.0D AS temperature_fahrenheit",
                                           "1.0D AS humidity_percent", "1.0D AS pressure_hpa", "1 AS air_quality_index", "'x' AS air_quality_status")
    forecasts = spark.range(300).selectExpr("'Rome' AS city", "id AS at", "1 AS temperature_f", "'s' AS short_forecast", "'w' AS wind_speed")
    table = spark.sql("SELECT 1 AS user_id, 'n' AS username, 'e' AS email, 'Rome' AS city, 'X' AS state")
    one = intervals.spread_interval_join(readings, forecasts.withColumnsRenamed({"at": "w_at"}), [("location", "city")], left_time="at",
                                         right_time="w_at", before_ms=1000, after_ms=1000, piece_rows=30)
    tasks = rows(one.groupBy(F.spark_partition_id()).count().select("count"))
    assert sum(n for n, in tasks) == 90_000 and len(tasks) > 8 and max(tasks)[0] <= 30_000
    for made in (environment.complete_dashboard, environment.short_dashboard):
        hours = readings.withColumn("at", F.col("sensor_id").substr(2, 9).cast("long") * 10_000_000)
        pairs = made(hours, table, forecasts.withColumn("at", F.col("at") * 10_000_000), sensor_time="at", weather_time="at")
        assert pairs.rdd.getNumPartitions() > 8 and pairs.count() == 300


def test_dashboard_three_way(spark, users):
    table = tables.users_table(users)
    readings = sensors(spark, [("s", "Miami", 0, 151, 50, 10), ("s", "Nowhere", 0, 1, 50, 10)])
    forecasts = weather(spark, [("Miami", 3600, 1), ("Miami", 3601, 2), ("Miami", -3600, 3), ("Nowhere", 0, 4)])
    got = environment.complete_dashboard(readings, table, forecasts, sensor_time="at", weather_time="at")
    assert rows(got, "username", "forecast_temp", "alert_status") == [
        ("user42", 1, "AIR QUALITY WARNING"), ("user42", 3, "AIR QUALITY WARNING")]
    assert rows(environment.short_dashboard(readings, table, forecasts, sensor_time="at", weather_time="at"),
                "forecast_temp") == [(1,), (3,)]


def test_simple_queries(spark):
    forecasts = weather(spark, [("A", 0, 80), ("A", 1, 81), ("A", 2, 91)])
    assert rows(environment.hot_weather(forecasts), "temperature_f", "heat_alert") == [
        (81, "HOT"), (91, "EXTREME HEAT ALERT")]
    readings = sensors(spark, [("s", "A", 0, 100, 212, 10), ("s", "A", 1, 101, 32, 120)])
    assert rows(environment.poor_air(readings), "air_quality_index") == [(101,)]
    assert rows(environment.both_units(readings), "calculated_celsius") == [(0.0,), (100.0,)]
    assert rows(environment.label_readings(readings), "humidity_percent", "air_quality_status") == [
        (10.0, "Moderate"), (100.0, "Unhealthy for Sensitive Groups")]


def test_windows(spark):
    readings = sensors(spark, [("s", "A", 0, 10, 50, 10), ("s", "A", 59, 20, 51, 11), ("s", "A", 60, 30, 60, 20)])
    start = int(T0.timestamp()) * 1000
    assert rows(windows.city_summary(readings, "at"), "city", "reading_count", "avg_temp_f", "avg_aqi", "max_aqi",
                "window_start", "window_end") == [
        ("A", 1, 60.0, 30.0, 30, start + 60_000, start + 120_000), ("A", 2, 50.5, 15.0, 20, start, start + 60_000)]
    assert rows(windows.windowed_readings(readings, "at"), "reading_count", "max_aqi") == [(3, 30)]
    forecasts = weather(spark, [("A", 0, 10), ("A", 299, 20), ("A", 300, 60)])
    assert rows(windows.hopping_forecast(forecasts, "at"), "window_start", "avg_forecast_temp") == [
        (start - 300_000, 15.0), (start, 30.0), (start + 300_000, 60.0)]
    assert rows(windows.hourly_averages(readings, "at"), "reading_count", "window_start") == [(3, start)]
    assert rows(windows.per_minute(readings, "at", ["location"]), "minute_ms", "n") == [(start, 2), (start + 60_000, 1)]


def test_sessions_match_session_window(spark):
    seconds = [0, 29, 59, 90, 121, 300, 300, 329]
    readings = sensors(spark, [("s", "A", x, 1, 1, 1) for x in seconds] + [("t", "A", 10, 1, 1, 1)])
    start = int(T0.timestamp()) * 1000
    got = windows.sessions(readings, ["sensor_id"], "at", 30_000)
    built_in = readings.groupBy("sensor_id", F.session_window("at", "30 seconds").alias("w")).agg(
        F.count("*").alias("n")).select("sensor_id", F.unix_millis("w.start"), F.unix_millis("w.end"), "n")
    assert rows(got, "sensor_id", "window_start", "window_end", "readings_in_session") == rows(built_in)
    assert rows(got.where("sensor_id = 't'"), "window_start", "last_event") == [(start + 10_000, start + 10_000)]


def test_snapshot_changes(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 2)], "id int, name string, n int")
    new = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", 5)], "id int, name string, n int")
    assert rows(tables.snapshot_changes(old, new, "id")) == [
        (2, "update", "b", None), (3, "delete", "c", 2), (4, "insert", "d", 5)]


def test_chained_streams(spark):
    def part(*times):
        return spark.createDataFrame([("k", t, f"v{t}") for t in times], "k string, t long, v string")
    got = intervals.chain_interval_joins([(part(100), "a"), (part(95, 120), "b"), (part(105), "c"), (part(110, 111), "d")],
                                         "k", time="t", before_ms=10, after_ms=10)
    assert rows(got, "k", "a_t", "b_t", "c_t", "d_t") == [("k", 100, 95, 105, 110)]


ALERTS = "transaction_id string, customer_id string, amount double, rule_id string, risk_score double, alert_time long"


def test_stats_on_alerts(spark):
    data = [(f"t{i:03d}", f"C{i % 11:02d}", 1.0, "R1" if i % 2 else None, 79.9 if i % 3 else 80.0, 60_000 * i)
            for i in range(33)] + [("z", "C00", 1.0, "R5", None, 60_000 * 40)]
    alerts = spark.createDataFrame(data, ALERTS)
    figures = stats.key_figures(alerts).first()
    assert (figures["total_alerts"], figures["high_risk_count"]) == (34, 11)
    assert figures["avg_risk_score"] == pytest.approx(round((11 * 80 + 22 * 79.9) / 34, 1))
    assert rows(stats.alerts_by_rule(alerts)) == [("?", 17), ("R1", 16), ("R5", 1)]
    top = stats.top_customers(alerts).collect()
    assert [r["customer_id"] for r in top] == [f"C{i:02d}" for i in range(10)]
    assert (top[0]["alert_count"], top[0]["max_risk"]) == (4, 80.0)
    assert stats.flagged_customers(alerts).first()[0] == 11
    assert stats.rules_fired(alerts).first()[0] == 2
    assert [r["transaction_id"] for r in stats.newest(alerts, 2).collect()] == ["z", "t032"]
    minutes = stats.alerts_per_minute(alerts, F.lit(60_000 * 41 + 5), 30).collect()
    assert len(minutes) == 30 and minutes[-1]["count"] == 1 and minutes[-1]["time"] == "00:40"
    assert [m["count"] for m in minutes] == [1] * 22 + [0] * 7 + [1]
    per_rule = stats.alerts_per_minute_by_rule(alerts).where("minute_ms = 60000").first()
    assert (per_rule["R1"], per_rule["R5"]) == (1, 0)


def test_stats_keep_newest_500_and_empty(spark):
    alerts = spark.range(501).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit("C").alias("customer_id"), F.lit(1.0).alias("amount"),
        F.lit("R1").alias("rule_id"), F.lit(90.0).alias("risk_score"), F.col("id").alias("alert_time"))
    kept = stats.newest(alerts)
    assert stats.key_figures(kept).first()["total_alerts"] == 500
    assert kept.agg(F.min("alert_time")).first()[0] == 1
    empty = alerts.limit(0)
    assert tuple(stats.key_figures(empty).first()) == (0, 0.0, 0)
    assert stats.alerts_by_rule(empty).count() == 0 and stats.top_customers(empty).count() == 0
    assert {r["count"] for r in stats.alerts_per_minute(empty, F.lit(0)).collect()} == {0}


def test_alert_time_fallback(spark):
    df = spark.createDataFrame([(None, 60_000), (120_000, 1)], "alert_time long, event_time long")
    got = stats.alerts_per_minute(df, F.lit(200_000), 3, fallback="event_time").collect()
    assert [r["count"] for r in got] == [0, 1, 1]


def test_transaction_counts(spark):
    df = spark.createDataFrame([("A", 0), ("A", 59_999), ("B", 60_000)], "city string, event_time long")
    assert rows(stats.transactions_by_minute(df)) == [(0, 2), (60_000, 1)]
    assert rows(stats.transactions_by_city(df)) == [("A", 2), ("B", 1)]
