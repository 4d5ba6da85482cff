"""Registered queries: every operator applied to the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streamscreen.functions import labels
from streamscreen.functions.display import clock_hour, dollars, times
from streamscreen.functions.sql import register_functions
from streamscreen.functions.units import c_to_f, clamp, exact_sum, f_to_c, utc_hh_mm, utc_hour
from streamscreen.operators import payments, rules, stats, tables, windows, words
from streamscreen.operators.intervals import chain_interval_joins
from streamscreen.plans import bindings as b
from streamscreen.plans import card_fraud, environment, payment_screening, people
from streamscreen.schemas import PAYMENT_RULES
from streamscreen.session import durable, new_path
from streamscreen.sources import forecasts, jsonlines, tabular, topics, validate
from streamscreen.sources.catalog import current_table, persist_table
from streamscreen.sources.kept_table import KeptTable
from streamscreen.streaming.carried import run_cool_off, run_sessions
from streamscreen.streaming.jobs import UNTIL_DRAINED, drain, run_idempotent, run_to_table, run_with_table
from streamscreen.streaming.processors import many_cities_stream, with_fading_history

Query = Callable[[SparkSession, str], DataFrame]
HOUR = 3_600_000
DAY = 24 * HOUR
REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def _without_text(alerts: DataFrame) -> DataFrame:
    return alerts.drop("details")


# Card transactions ------------------------------------------------------------------------------

@register
def card_fraud_alerts(spark, sf):
    return _without_text(card_fraud.detect(b.transactions(spark, sf), b.SCALED))


@register
def high_value_transactions(spark, sf):
    return rules.alerts_of(b.transactions(spark, sf), [rules.high_value()])


@register
def transaction_velocity(spark, sf):
    history = rules.with_history(b.transactions(spark, sf), b.SCALED)
    return _without_text(rules.alerts_of(history, [rules.velocity(b.SCALED)]))


@register
def recent_transaction_counts(spark, sf):
    return rules.with_history(b.transactions(spark, sf), rules.Limits(velocity_ms=DAY)).select(
        "transaction_id", "customer_id", "recent_count", "previous_amount")


@register
def window_spend_alerts(spark, sf):
    return _without_text(rules.spend_alerts(b.transactions(spark, sf), b.SCALED))


@register
def night_transactions(spark, sf):
    return rules.alerts_of(b.transactions(spark, sf), [rules.night_owl()])


@register
def amount_escalation(spark, sf):
    history = rules.with_history(b.transactions(spark, sf), b.SCALED)
    return _without_text(rules.alerts_of(history, [rules.escalation(b.SCALED)]))


@register
def customers_by_event_types(spark, sf):
    """More than three distinct merchants of one customer within two days."""
    txns = b.transactions(spark, sf).withColumn("city", F.col("merchant"))
    return rules.many_cities(txns, window_ms=2 * DAY).select("transaction_id", "customer_id", "city_count")


@register
def alert_cool_off(spark, sf):
    alerts = card_fraud.detect(b.transactions(spark, sf), b.SCALED)
    return rules.cool_off(_without_text(alerts), quiet_ms=DAY).select(
        "transaction_id", "customer_id", "rule_id", "event_time")


@register
def card_look_back(spark, sf):
    paid = b.payments(spark, sf).withColumn("event_time", F.col("ts_utc").cast("long")).withColumn(
        "country", F.col("channel"))
    out = rules.card_velocity(paid, window_ms=180 * DAY)
    return out.select("event_id", "card_id", "recent_count", "recent_amount",
                      F.col("previous_country").alias("previous_channel"),
                      F.col("country_changed").alias("channel_changed"))


@register
def alert_display(spark, sf):
    txns = b.transactions(spark, sf)
    return txns.select("transaction_id", dollars(F.col("amount")).alias("amount_text"),
                       clock_hour(F.col("hour")).alias("hour_text"),
                       times(F.col("amount") / 1000).alias("ratio_text"),
                       utc_hour(F.col("event_time")).alias("utc_hour"),
                       utc_hh_mm(F.col("event_time")).alias("hh_mm"))


@register
def parsed_transactions(spark, sf):
    """Transactions from JSON text; errors miss a key, signups have a quoted amount, clicks no hour."""
    t = b.transactions(spark, sf)
    full = F.struct("transaction_id", "customer_id", "amount", "merchant", "city", "event_time", "hour")
    quoted = F.struct("transaction_id", "customer_id", F.col("amount").cast("string").alias("amount"),
                      "merchant", "city", "event_time", "hour")
    short = F.struct("transaction_id", "customer_id", "amount", "event_time")
    text = (F.when(F.col("merchant") == "error", F.to_json(F.struct("transaction_id", "amount")))
            .when(F.col("merchant") == "signup", F.to_json(quoted))
            .when(F.col("merchant") == "click", F.to_json(short))
            .otherwise(F.to_json(full)))
    return validate.parse_transactions(t.select(text.alias("line")), F.col("line")).drop("event_ts")


# Alert summaries ---------------------------------------------------------------------------------

def _alerts(spark: SparkSession, sf: str) -> DataFrame:
    found = card_fraud.detect(b.transactions(spark, sf), b.SCALED)
    return _without_text(found).withColumn("alert_time", F.col("event_time"))


ARRIVAL = ("alert_time", "transaction_id", "rule_id")


@register
def alert_key_figures(spark, sf):
    return stats.key_figures(_alerts(spark, sf))


@register
def newest_alert_key_figures(spark, sf):
    return stats.key_figures(stats.newest(_alerts(spark, sf), order_by=ARRIVAL))


@register
def alert_counts_by_rule(spark, sf):
    return stats.alerts_by_rule(_alerts(spark, sf))


@register
def alert_minutes(spark, sf):
    return stats.alerts_per_minute(_alerts(spark, sf), F.lit(1_705_320_030_000), minutes=1440)


@register
def top_risk_customers(spark, sf):
    return stats.top_customers(_alerts(spark, sf), arrival=ARRIVAL)


@register
def newest_alerts(spark, sf):
    return stats.newest(_alerts(spark, sf), 50, ARRIVAL)


@register
def flagged_customers(spark, sf):
    return stats.flagged_customers(_alerts(spark, sf))


@register
def rules_fired(spark, sf):
    return stats.rules_fired(_alerts(spark, sf))


@register
def alert_minutes_by_rule(spark, sf):
    return stats.alerts_per_minute_by_rule(_alerts(spark, sf))


@register
def transaction_minutes(spark, sf):
    return stats.transactions_by_minute(b.transactions(spark, sf))


@register
def transaction_cities(spark, sf):
    return stats.transactions_by_city(b.transactions(spark, sf))


@register
def alert_risk_bands(spark, sf):
    risk = F.col("risk_score")
    return (_alerts(spark, sf)
            .groupBy(labels.risk_band(risk).alias("band"), labels.risk_band(risk, 80, 50).alias("wide_band"))
            .agg(F.count(F.lit(1)).alias("n")))


# Payments ----------------------------------------------------------------------------------------

@register
def payment_scores(spark, sf):
    scored = payments.route(payments.score(payments.drop_zero_amounts(b.payments(spark, sf))))
    return scored.select("event_id", "amount", "risk_score",
                         F.array_join("risk_reasons", ",").alias("reasons"), "topic")


@register
def payment_validation(spark, sf):
    checked = validate.check_records(b.payment_records(spark, sf), PAYMENT_RULES)
    return checked.select("offset", "error", F.col("event.amount").alias("amount"),
                          F.col("event.channel").alias("channel"))


@register
def payment_screening_records(spark, sf):
    out = payment_screening.screen_records(b.payment_records(spark, sf))
    body = "event_id string, offset string, risk_score int, error string"
    return out.withColumn("_body", F.from_json(F.col("value").cast("string"), body)).select(
        "topic", F.col("key").cast("string").alias("key"),
        F.coalesce("_body.event_id", "_body.offset").alias("id"), "_body.risk_score", "_body.error",
        topics.header(F.col("headers"), "excel_row").alias("excel_row"),
        topics.header(F.col("headers"), "routed_to").alias("routed_to"))


@register
def payment_totals_by_route(spark, sf):
    return payments.totals_by_route(payment_screening.screen_events(b.payment_records(spark, sf)))


@register
def payment_totals_by_reason(spark, sf):
    return payments.totals_by_reason(payment_screening.screen_events(b.payment_records(spark, sf)))


@register
def payment_table_ingest(spark, sf):
    """Complete rows of a payment table in which debtors have no country and AUTO cards no channel."""
    rows = _gappy_payments(spark, sf)
    return tabular.keep_complete(rows).select("event_id", "card_id", "amount", "country", "channel", "row")


@register
def payment_table_skipped(spark, sf):
    return tabular.skipped_rows(_gappy_payments(spark, sf)).select(
        "row", F.array_join("missing", ",").alias("missing"))


def _gappy_payments(spark: SparkSession, sf: str) -> DataFrame:
    return b.payments(spark, sf).select(
        *[F.when(F.col("amount") > 0, F.col("country")).alias(c) if c == "country"
          else F.when(F.col("merchant_category") != "AUTOMOBILE", F.col("channel")).alias(c) if c == "channel"
          else F.col(c) for c in tabular.FIELDS],
        (F.col("event_id").cast("long") + 2).alias("row"))


# Topics ------------------------------------------------------------------------------------------

def _event_records(spark: SparkSession, sf: str) -> DataFrame:
    events = b.table(spark, sf, "events")
    made = topics.record(
        events, key=F.col("user_id"), value=F.struct("event_id", "event_type", "value"),
        topic=F.concat(F.lit("events-"), F.col("event_type")),
        headers={"origin": F.col("event_type"), "props": F.col("props"), "origin2": F.lit("late")})
    # The record keeps no columns of its row, so the position comes from the value.
    return topics.numbered(made, 4, F.get_json_object(F.col("value").cast("string"), "$.event_id"),
                           F.current_timestamp())


@register
def topic_decode(spark, sf):
    decoded = topics.decode(_event_records(spark, sf))
    return decoded.select("topic", "offset", "key",
                          F.get_json_object("value", "$.event_type").alias("event_type"),
                          F.get_json_object("value", "$.value").cast("double").alias("value"))


@register
def topic_headers(spark, sf):
    records = _event_records(spark, sf)
    as_map = topics.header_map(F.concat(
        F.col("headers"), F.array(F.struct(F.lit("origin").alias("key"), F.encode(F.lit("again"), "UTF-8").alias("value")))))
    return records.select("offset", topics.header(F.col("headers"), "origin").alias("origin"),
                          topics.header(F.col("headers"), "none").alias("missing"),
                          as_map["origin"].cast("string").alias("last_origin"))


@register
def topic_typed_rows(spark, sf):
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])
    return topics.parse_json(_event_records(spark, sf), schema, key_column="user_id")


@register
def topic_offsets(spark, sf):
    records = _event_records(spark, sf).withColumn("partition", F.lit(0))
    return topics.offsets_by_partition(records)


@register
def topic_lag(spark, sf):
    """Lag of a consumer that has read each topic up to its last expensive event."""
    records = _event_records(spark, sf).withColumn("partition", F.lit(0))
    value = F.get_json_object(F.col("value").cast("string"), "$.value").cast("double")
    committed = records.where(value > 300).groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset"))
    return topics.lag_behind(records, committed)


@register
def topic_files(spark, sf):
    """Records written to a topic folder and read back."""
    topic = topics.Topic("events", folder=new_path(spark, "topics"))
    topics.write_batch(_event_records(spark, sf), topic)
    return topics.read_batch(spark, topic).select("topic", "offset", F.col("key").cast("string").alias("key"))


@register
def json_lines(spark, sf):
    """Event properties written as JSON lines and read back."""
    path = new_path(spark, "lines")
    b.table(spark, sf, "events").select(
        F.to_json(F.struct("event_id", "value")).alias("value")).write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    return jsonlines.read_json_lines(spark, path, schema)


# People ------------------------------------------------------------------------------------------

def _people(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("event_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_name")).alias("name"),
        F.floor(F.col("c_acctbal") / 100).cast("int").alias("age"), F.lit("2024-01-01").alias("ts_utc"))


@register
def person_events(spark, sf):
    records, _ = people.publish_people(_people(spark, sf))
    positioned = topics.numbered(
        records, 3, F.get_json_object(F.col("value").cast("string"), "$.event_id"), F.current_timestamp())
    good, _ = people.read_people(positioned)
    return good.select("topic", "offset", "key", "event_id", "name", "age", "ts_utc")


@register
def person_rejects(spark, sf):
    _, bad = people.publish_people(_people(spark, sf))
    return bad.select("event_id", "error")


@register
def users_aged_17(spark, sf):
    users = _people(spark, sf).select(F.col("event_id").cast("string").alias("user_id"), "name", "age")
    return people.users_of_age(users)


# Environment -------------------------------------------------------------------------------------

def _users(spark: SparkSession, sf: str) -> DataFrame:
    return tables.users_table(b.users(spark, sf))


@register
def hot_weather_alerts(spark, sf):
    return environment.hot_weather(b.weather(spark, sf))


@register
def poor_air_quality(spark, sf):
    return environment.poor_air(b.sensors(spark, sf))


@register
def users_with_local_sensors(spark, sf):
    return environment.user_local_sensors(b.sensors(spark, sf), _users(spark, sf))


@register
def users_with_forecast(spark, sf):
    return environment.user_weather(b.weather(spark, sf), _users(spark, sf))


@register
def complete_dashboard(spark, sf):
    return environment.complete_dashboard(
        b.sensors(spark, sf), _users(spark, sf), b.weather(spark, sf),
        sensor_time="event_ts", weather_time="event_ts")


@register
def short_dashboard(spark, sf):
    return environment.short_dashboard(
        b.sensors(spark, sf), _users(spark, sf), b.weather(spark, sf),
        sensor_time="event_ts", weather_time="event_ts")


@register
def sensor_against_forecast(spark, sf):
    return environment.forecast_against_sensor(
        b.weather(spark, sf), b.sensors(spark, sf), weather_time="event_ts", sensor_time="event_ts")


@register
def city_minute_summary(spark, sf):
    return windows.city_summary(b.sensors(spark, sf), "event_ts")


@register
def user_environment_alerts(spark, sf):
    return environment.user_alerts(b.sensors(spark, sf), _users(spark, sf))


@register
def user_environment_alerts_wide(spark, sf):
    return environment.user_alerts_wide(b.sensors(spark, sf), _users(spark, sf))


@register
def local_air_quality(spark, sf):
    return environment.local_air(b.sensors(spark, sf), _users(spark, sf))


@register
def temperature_units(spark, sf):
    return environment.both_units(b.sensors(spark, sf)).withColumn(
        "temperature_celsius", F.round("temperature_celsius", 4))


@register
def temperature_units_first_ten(spark, sf):
    """The ten first readings by time in both units."""
    readings = b.sensors(spark, sf).orderBy(F.col("timestamp").cast("long"), "sensor_id").limit(10)
    return environment.both_units(readings).select("sensor_id", "location", "temperature_fahrenheit",
                                                   "calculated_celsius")


@register
def users_by_city_latest(spark, sf):
    return tables.users_by_city(_users(spark, sf))


@register
def users_by_city_all(spark, sf):
    return tables.users_by_city(b.users(spark, sf)).orderBy("city")


@register
def users_total(spark, sf):
    return tables.total_users(b.users(spark, sf))


@register
def latest_user_of_city(spark, sf):
    return _users(spark, sf)


@register
def latest_user_of_city_with_nulls(spark, sf):
    return tables.users_table(b.users(spark, sf), ignore_nulls=False)


@register
def sensor_labels(spark, sf):
    shifted = b.sensors(spark, sf).withColumn("air_quality_index", F.col("air_quality_index") * 2 - 100) \
        .withColumn("humidity_percent", F.col("humidity_percent") * 2 - 50)
    return environment.label_readings(shifted).select(
        "sensor_id", "timestamp", "humidity_percent", "air_quality_index", "air_quality_status")


@register
def sql_functions(spark, sf):
    register_functions(spark)
    b.sensors(spark, sf).createOrReplaceTempView("sensor_readings")
    return spark.sql("SELECT timestamp, sensor_id, f_to_c(temperature_fahrenheit) AS celsius, "
                     "aqi_status(air_quality_index) AS status FROM sensor_readings")


@register
def unit_round_trip(spark, sf):
    value = F.col("value")
    return b.table(spark, sf, "events").select(
        "event_id", f_to_c(value).alias("celsius"), c_to_f(value).alias("fahrenheit"),
        clamp(value, 0, 100).alias("clamped"))


@register
def five_minute_readings(spark, sf):
    return windows.windowed_readings(b.sensors(spark, sf), "event_ts").withColumn(
        "avg_temp", F.round("avg_temp", 6))


@register
def hopping_forecasts(spark, sf):
    return windows.hopping_forecast(b.weather(spark, sf), "event_ts").withColumn(
        "avg_forecast_temp", F.round("avg_forecast_temp", 6))


@register
def sensor_sessions(spark, sf):
    return windows.sessions(b.sensors(spark, sf), ["sensor_id"], "event_ts", HOUR)


@register
def city_sessions(spark, sf):
    return windows.sessions(b.sensors(spark, sf), ["location"], "event_ts", HOUR)


@register
def hourly_city_averages(spark, sf):
    return windows.hourly_averages(b.sensors(spark, sf), "event_ts").select(
        "location", "window_start", "reading_count", F.round("avg_temp", 6).alias("avg_temp"),
        F.round("avg_humidity", 6).alias("avg_humidity"))


@register
def chained_streams(spark, sf):
    """Click, view, purchase, signup and error of one user, each within a day of the click."""
    events = b.table(spark, sf, "events")
    parts = [(events.where(F.col("event_type") == kind).select("user_id", "event_id", "ts"), kind)
             for kind in ("click", "view", "purchase", "signup", "error")]
    out = chain_interval_joins(parts, "user_id", time="ts", before_ms=DAY, after_ms=DAY)
    return out.select("user_id", "click_event_id", "view_event_id", "purchase_event_id", "signup_event_id",
                      "error_event_id")


@register
def customer_changes(spark, sf):
    """Changes between two customer snapshots: one segment left, one arrived, debts were written off."""
    customer = b.table(spark, sf, "customer")
    old = customer.where(F.col("c_mktsegment") != "MACHINERY")
    new = customer.where(F.col("c_mktsegment") != "HOUSEHOLD").withColumn(
        "c_acctbal", F.greatest("c_acctbal", F.lit(0.0)))
    return tables.snapshot_changes(old, new, "c_custkey")


@register
def forecast_documents(spark, sf):
    """Forecast documents built from events: errors have no periods, signups leave fields out."""
    events = b.table(spark, sf, "events")
    full = F.struct(F.floor("value").cast("int").alias("temperature"), F.lit("F").alias("temperatureUnit"),
                    F.col("props").alias("shortForecast"), F.lit(False).alias("isDaytime"),
                    F.col("event_type").alias("name"))
    part = F.struct(F.col("event_type").alias("name"))
    second = F.struct(F.lit(-1).alias("temperature"))
    text = (F.when(F.col("event_type") == "error", F.lit('{"properties":{"periods":[]}}'))
            .when(F.col("event_type") == "signup",
                  F.to_json(F.struct(F.struct(F.array(part).alias("periods")).alias("properties"))))
            .otherwise(F.concat(F.lit('{"properties":{"periods":['), F.to_json(full), F.lit(","),
                                F.to_json(second), F.lit("]}}"))))
    docs = events.select("event_id", text.alias("body"))
    return forecasts.flatten_forecasts(docs, "body", F.lit("t")).drop("timestamp", "detailed_forecast", "icon")


@register
def word_counts(spark, sf):
    return words.count_words_in_lines(b.table(spark, sf, "documents"), "text")


@register
def line_counts(spark, sf):
    """One word per line: the language of each document."""
    return words.count_words(b.table(spark, sf, "documents"), "lang")


# Streaming ---------------------------------------------------------------------------------------

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Version 3 keeps both sides of a stream join in one store of a partition instead of four.
JOIN_STATE = "spark.sql.streaming.join.stateFormatVersion"


def _stateful(spark: SparkSession, start: Callable[[], StreamingQuery | list[StreamingQuery]]) -> None:
    """Run queries with state in RocksDB until their input is used up."""
    settings = {STATE_STORE: ROCKSDB, JOIN_STATE: "3"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        started = start()
        for query in started if isinstance(started, list) else [started]:
            drain(query)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _drained(spark: SparkSession, df: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream until its input is used up and read what it wrote."""
    out = new_path(spark, "streamed")
    _stateful(spark, lambda: run_to_table(df, f"{out}/rows", f"{out}/checkpoint", mode=mode, trigger=UNTIL_DRAINED))
    return spark.read.schema(df.schema).parquet(f"{out}/rows")


def _kept(spark: SparkSession, df: DataFrame, keys: list[str]) -> DataFrame:
    """Run an aggregate in update mode until its input is used up and read the table it keeps."""
    out = new_path(spark, "kept-table")
    _stateful(spark, lambda: persist_table(df, keys, f"{out}/rows", f"{out}/checkpoint", trigger=UNTIL_DRAINED))
    return current_table(spark, f"{out}/rows", keys)


@register
def streamed_fraud_alerts(spark, sf):
    """The closing row lets the last spend windows fire; it has no amount and gives no alert."""
    txns = b.transactions(spark, sf, b.event_stream(spark, sf, closed=True))
    return _detected(spark, txns, _without_text)


def _detected(spark: SparkSession, txns: DataFrame, finish: Callable[[DataFrame], DataFrame], **settings) -> DataFrame:
    out = new_path(spark, "streamed")
    _stateful(spark, lambda: card_fraud.run_detection(txns, f"{out}/checkpoint", f"{out}/rows", b.SCALED, finish=finish,
                                                      trigger=UNTIL_DRAINED, **settings))
    return card_fraud.written_alerts(spark, f"{out}/rows")


@register
def streamed_hot_customer_alerts(spark, sf):
    """The same job where one customer has a third of all rows; rows above an even share of a task are cut."""
    txns = b.transactions(spark, sf, b.event_stream(spark, sf, closed=True))
    number = F.substring("transaction_id", 5, 20).cast("long")
    hot = txns.withColumn("customer_id", F.when(number % 3 == 0, F.lit("HOT")).otherwise(F.col("customer_id")))
    return _detected(spark, hot, _without_text, hot_rows=1000)


@register
def streamed_many_cities(spark, sf):
    """More than three merchants of one customer within two days, kept in map state with event-time timers."""
    txns = b.transactions(spark, sf, b.event_stream(spark, sf)).withColumn("city", F.col("merchant"))
    return _drained(spark, many_cities_stream(txns, window_ms=2 * DAY)).select("transaction_id", "customer_id", "city_count")


@register
def streamed_fading_history(spark, sf):
    """Previous amount and row number of customers, forgotten after half a day without a row."""
    txns = b.transactions(spark, sf, b.event_stream(spark, sf))
    return _drained(spark, with_fading_history(txns, DAY // 2)).select(
        "transaction_id", "customer_id", "rows_so_far", "previous_amount")


@register
def streamed_city_summary(spark, sf):
    """Windows in update mode, kept as a table: it holds every window, also those still open."""
    sensors = b.sensors(spark, sf, b.event_stream(spark, sf)).withWatermark("event_ts", "5 seconds")
    return _kept(spark, windows.city_summary(sensors, "event_ts", "1 hour"), ["city", "window_start"]).select(
        "city", "window_start", "reading_count", "max_aqi")


@register
def streamed_hopping_forecasts(spark, sf):
    weather = b.weather(spark, sf, b.event_stream(spark, sf)).withWatermark("event_ts", "5 seconds")
    return _kept(spark, windows.hopping_forecast(weather, "event_ts"), ["city", "window_start"]).select(
        "city", "window_start", F.round("avg_forecast_temp", 6).alias("avg_forecast_temp"))


@register
def streamed_sessions(spark, sf):
    """The closing row ends every session; its own stays open and is not given out."""
    sensors = b.sensors(spark, sf, b.event_stream(spark, sf, closed=True)).withWatermark("event_ts", "5 seconds")
    return _drained(spark, windows.sessions(sensors, ["sensor_id"], "event_ts", HOUR))


@register
def streamed_hot_sessions(spark, sf):
    """Sessions of a stream in which one sensor has a third of all readings: slots of a batch meet the open sessions."""
    readings = b.event_stream(spark, sf, closed=True).select(
        F.when(F.col("event_id") % 3 == 0, F.lit("HOT")).otherwise(F.col("user_id").cast("string")).alias("sensor_id"), "ts")
    out = new_path(spark, "streamed")
    drain(run_sessions(readings, ["sensor_id"], "ts", HOUR, f"{out}/checkpoint", f"{out}/rows", trigger=UNTIL_DRAINED))
    return spark.read.parquet(f"{out}/rows").drop("batch")


@register
def streamed_sensor_against_forecast(spark, sf):
    """Blocks of forecasts and readings meet in the stream; reading the result makes the pairs."""
    events, out = b.event_stream(spark, sf), new_path(spark, "streamed")
    drain(environment.run_comparison(
        b.weather(spark, sf, events), b.sensors(spark, sf, events), f"{out}/checkpoint", f"{out}/rows",
        weather_time="event_ts", sensor_time="event_ts", delay_ms=5000, trigger=UNTIL_DRAINED))
    return environment.written_comparison(spark, f"{out}/rows")


@register
def streamed_dashboard(spark, sf):
    """Blocks of readings and forecasts meet in the stream, users in each micro-batch; reading the result makes the pairs."""
    users, events = durable(_users(spark, sf), "users-table"), b.event_stream(spark, sf)
    out = new_path(spark, "streamed")
    drain(environment.run_dashboard(
        b.sensors(spark, sf, events), b.weather(spark, sf, events), lambda: users, f"{out}/checkpoint", f"{out}/rows",
        sensor_time="event_ts", weather_time="event_ts", delay_ms=5000, trigger=UNTIL_DRAINED))
    return environment.written_dashboard(spark, f"{out}/rows")


@register
def streamed_user_alerts(spark, sf):
    """Alerts to the user of the city as of their micro-batch.

    The first half of the events meets a kept table of all users under former names; then every user is renamed, and the
    second half meets them as they are.
    """
    inputs, kept, out = (new_path(spark, n) for n in ("event-files", "users-table", "streamed"))
    everyone = b.users(spark, sf)
    versions = [everyone.withColumn("username", F.concat(F.lit("former "), "username")), everyone]
    table = KeptTable(spark, kept, ["city"])
    for number, (part, users) in enumerate(zip(b.event_parts(spark, sf, 2), versions, strict=True)):
        files = b.write_slices([part], inputs)
        table.write(tables.users_table(users), number)
        sensors = b.sensors(spark, sf, b.read_event_stream(spark, inputs, files))
        drain(run_with_table(sensors, lambda: current_table(spark, kept, ["city"]), environment.user_alerts,
                             f"{out}/checkpoint", f"{out}/rows", trigger=UNTIL_DRAINED))
    return spark.read.parquet(f"{out}/rows").drop("batch")


@register
def streamed_cool_off(spark, sf):
    txns = b.transactions(spark, sf, b.event_stream(spark, sf))
    alerts = rules.alerts_of(txns, [rules.high_value(), rules.night_owl()])
    out = new_path(spark, "streamed")
    drain(run_cool_off(_without_text(alerts), f"{out}/checkpoint", f"{out}/rows", quiet_ms=DAY, hot_rows=1000, trigger=UNTIL_DRAINED))
    return spark.read.parquet(f"{out}/rows").select("transaction_id", "customer_id", "rule_id", "event_time")


@register
def streamed_event_counts(spark, sf):
    """A table kept by a stream: events and value per type."""
    events = b.event_stream(spark, sf)
    counted = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), exact_sum(F.col("value")).alias("total"))
    return _kept(spark, counted, ["event_type"])


@register
def streamed_word_counts(spark, sf):
    # A pattern of one name: the table may be a file or a folder of files.
    lines = (spark.readStream.schema("doc_id bigint, text string, lang string, source string, n_chars bigint")
             .parquet(f"{sf}/documents.parque[t]"))
    return _kept(spark, words.count_words_in_lines(lines, "text"), ["word"])


@register
def streamed_payment_routes(spark, sf):
    """Payment records written to a topic folder, screened as a stream, one output per batch."""
    topic = topics.Topic("payments.raw", folder=new_path(spark, "topics"))
    topics.write_batch(b.payment_records(spark, sf), topic)
    out = new_path(spark, "screened")
    screened = payment_screening.screen_records(topics.read_stream(spark, topic))
    drain(run_idempotent(screened, f"{out}/checkpoint", f"{out}/rows", trigger=UNTIL_DRAINED))
    return (spark.read.parquet(f"{out}/rows").groupBy("topic").agg(F.count(F.lit(1)).alias("n")))

