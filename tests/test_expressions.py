from pyspark.sql import functions as F

from streamscreen.functions import labels, units
from streamscreen.functions.display import clock_hour, dollars, span, times
from streamscreen.functions.sql import register_functions
from tests.conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def column_of(spark, values, expr, kind="double"):
    convert = float if kind == "double" else int
    df = spark.createDataFrame([(i, convert(v)) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_heat_alert_edges(spark):
    assert column_of(spark, [80, 81, 90, 91], labels.heat_alert, "int") == [
        "NORMAL", "HOT", "HOT", "EXTREME HEAT ALERT"]


def test_aqi_status_edges(spark):
    assert column_of(spark, [50, 51, 100, 101, 150, 151, 200, 201, 300, 301], labels.aqi_status, "int") == [
        "Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy for Sensitive Groups",
        "Unhealthy", "Unhealthy", "Very Unhealthy", "Very Unhealthy", "Hazardous"]


def test_alert_ladders_first_match_wins(spark):
    df = spark.createDataFrame([(151, 96.0, 95.0), (150, 95.1, 95.0), (150, 95.0, 90.1), (0, 31.9, 95.0),
                                (0, 32.0, 90.0)], "aqi int, t double, h double")
    aqi, t, h = F.col("aqi"), F.col("t"), F.col("h")
    assert [r[0] for r in df.select(labels.alert_status(aqi, t)).collect()] == [
        "AIR QUALITY WARNING", "HEAT WARNING", "NORMAL", "FREEZE WARNING", "NORMAL"]
    assert [r[0] for r in df.select(labels.alert_message(aqi, t, h)).collect()] == [
        "UNHEALTHY AIR QUALITY - Stay indoors if possible", "EXTREME HEAT - Stay hydrated",
        "VERY HIGH HUMIDITY - Mold risk", "FREEZING TEMPERATURES - Protect pipes", "NORMAL CONDITIONS"]
    assert [r[0] for r in df.select(labels.alert_message_short(aqi, t)).collect()] == [
        "UNHEALTHY AIR - Stay indoors", "EXTREME HEAT - Stay hydrated", "NORMAL CONDITIONS",
        "FREEZE WARNING", "NORMAL CONDITIONS"]


def test_variance_and_risk_bands(spark):
    assert column_of(spark, [10.1, 10, 5.1, 5, -11], lambda v: labels.variance_status(v, F.lit(0.0))) == [
        "LARGE VARIANCE", "MODERATE VARIANCE", "MODERATE VARIANCE", "CLOSE MATCH", "LARGE VARIANCE"]
    assert column_of(spark, [80, 79.9, 60, 59.9], labels.risk_band) == ["high", "medium", "medium", "low"]
    assert column_of(spark, [55, 49.9], lambda v: labels.risk_band(v, 80, 50)) == ["medium", "low"]


def test_units(spark):
    assert column_of(spark, [32, 212, 98.6], units.f_to_c) == [0.0, 100.0, 37.0]
    assert column_of(spark, [0, 100], units.c_to_f) == [32.0, 212.0]
    assert column_of(spark, [-1, 50, 101], units.humidity_in_range) == [0, 50, 100]
    assert column_of(spark, [-1, 501], units.aqi_in_range) == [0, 500]


def test_utc_time_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, units.utc_hour(F.lit(1704067207179 + 3 * 3_600_000))) == 3
        assert one(spark, units.utc_hh_mm(F.lit(1704067207179 + 61_000))) == "00:01"
        ntz = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.179575' AS t")
        assert ntz.select(units.epoch_ms(ntz, "t")).first()[0] == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_display(spark):
    assert one(spark, dollars(F.lit(1234.5))) == "$1,234.50"
    assert one(spark, times(F.lit(4.396))) == "4.4"
    assert one(spark, clock_hour(F.lit(3))) == "03:00"
    assert one(spark, span(F.lit(600000), F.lit(1200000))) == "[600000 - 1200000]"


def test_exact_sum_does_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1e9,)], "v double")
    assert df.agg(units.exact_sum(F.col("v"))).first()[0] == 1000000001.0


def test_exact_sum_keeps_digits_and_survives_odd_amounts(spark):
    def total(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(units.exact_sum(F.col("v"))).first()[0]

    assert total(*[0.00001] * 3, 1e12) == 1000000000000.00003
    assert total(1e16, 0.5, -1e16) == 0.5
    assert total(1e300, 1.0) == 1e300 and str(total(float("nan"), 1.0)) == "nan"
    assert total() is None and total(None, 2.0) == 2.0


def test_sql_functions(spark):
    assert register_functions(spark) == ["aqi_status", "c_to_f", "f_to_c"]
    assert rows(spark.sql("SELECT f_to_c(212), c_to_f(0), aqi_status(151)")) == [(100.0, 32.0, "Unhealthy")]
