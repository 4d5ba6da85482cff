import json
import os
import time

import pytest
from pyspark.sql import functions as F

from streamscreen import schemas
from streamscreen.operators import rules, stats, tables, windows
from streamscreen.operators.rules import Limits
from streamscreen.plans import card_fraud, environment
from streamscreen.sources import relational, topics, validate
from streamscreen.sources.catalog import current_table, persist_table, push
from streamscreen.streaming import jobs, live, progress
from streamscreen.streaming.processors import bucket_totals, cool_off_stream, with_streaming_history
from tests.conftest import rows

T0 = 1_704_067_200_000
DRAIN = {"availableNow": True}


class Feed:
    """A folder of JSON-lines files, each one micro-batch, in writing order."""

    def __init__(self, path):
        self.path, self.n = path, 0
        path.mkdir()

    def add(self, *lines):
        file = self.path / f"{self.n:04d}.json"
        file.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
        os.utime(file, (1_000_000 + self.n * 10,) * 2)
        self.n += 1
        return self

    def lines(self, spark, streaming=True):
        reader = spark.readStream.option("maxFilesPerTrigger", "1") if streaming else spark.read
        return reader.text(str(self.path))

    def transactions(self, spark, streaming=True):
        return validate.parse_transactions(self.lines(spark, streaming), F.col("value"))


def txn(i, customer, amount, ms, **more):
    return {"transaction_id": f"t{i:03d}", "customer_id": customer, "amount": amount, "event_time": T0 + ms,
            "city": "Rome", "hour": 12, **more}


def drained(spark, df, path, mode="append"):
    jobs.drain(jobs.run_to_table(df, f"{path}/rows", f"{path}/cp", mode=mode, trigger=DRAIN))
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


ALERT = ("transaction_id", "customer_id", "rule_id", "risk_score", "amount")


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    feed = Feed(tmp_path_factory.mktemp("feed") / "in")
    for part in range(4):
        feed.add(*[txn(part * 10 + i, f"C{i % 3}", 2000.0 * (1 + (part * 7 + i) % 9), part * 40_000 + i * 3000,
                       hour=i % 6) for i in range(10)])
    # Closes the windows before it.
    feed.add(txn(900, "end", 1.0, 3_600_000))
    feed.add(txn(901, "end", 1.0, 3_600_001))
    return feed


def test_stream_equals_batch(spark, feed, tmp_path):
    limits = Limits(spend_limit=30_000)
    streamed = drained(spark, card_fraud.detect_stream(feed.transactions(spark), limits, state_ttl_ms=None), tmp_path)
    batch = card_fraud.detect(feed.transactions(spark, streaming=False), limits)
    assert rows(streamed, *ALERT, "details", "city", "event_time") == rows(batch, *ALERT, "details", "city", "event_time")
    assert {r["rule_id"] for r in streamed.select("rule_id").distinct().collect()} == {"R1", "R2", "R3", "R4", "R5"}


def test_restart_continues_state(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(*[txn(i, "C1", 10.0, i) for i in range(4)])

    def run():
        return drained(spark, card_fraud.detect_stream(feed.transactions(spark), state_ttl_ms=None), tmp_path / "out")

    assert run().count() == 0
    feed.add(txn(4, "C1", 10.0, 4), txn(5, "C1", 31.0, 5))
    assert rows(run(), "transaction_id", "rule_id", "risk_score") == [("t005", "R2", 48.0), ("t005", "R5", 65.5)]
    assert run().count() == 2


def test_late_rows_count_in_event_rules_only(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(txn(0, "C1", 60_000.0, 0))
    feed.add(txn(1, "C1", 1.0, 700_000))
    feed.add(txn(2, "C1", 1.0, 700_001))
    feed.add(txn(3, "C1", 90_000.0, 1_000))
    feed.add(txn(4, "C1", 1.0, 700_002))
    got = drained(spark, card_fraud.detect_stream(feed.transactions(spark), state_ttl_ms=None), tmp_path / "out")
    assert rows(got, "transaction_id", "rule_id", "amount") == [
        ("t000", "R1", 60000.0), ("t000", "R3", 60000.0), ("t003", "R1", 90000.0), ("t003", "R5", 90000.0)]


def test_bad_event_time_counts_in_spend_only(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add({**txn(0, "C1", 60_000.0, 0), "event_time": "x"}, "bad{", "5")
    parsed = validate.parse_transactions(feed.lines(spark, streaming=False), F.col("value"),
                                         F.timestamp_millis(F.lit(T0)))
    assert rows(card_fraud.detect(parsed), "rule_id", "event_time") == [("R3", None)]


def test_state_expires(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(txn(0, "C1", 10.0, 0))
    history = with_streaming_history(feed.transactions(spark), 60_000, ttl_ms=1)
    query = jobs.run_to_table(history, str(tmp_path / "rows"), str(tmp_path / "cp"),
                              trigger={"processingTime": "200 milliseconds"})
    def written(n):
        # State with expiry keeps starting micro-batches, so there is no end to wait for.
        until = time.time() + 60
        while time.time() < until and query.exception() is None:
            if sum(p["numInputRows"] for p in query.recentProgress) >= n:
                return
            time.sleep(0.2)
        raise AssertionError(f"fewer than {n} rows read: {query.exception()}")

    try:
        written(1)
        feed.add(txn(1, "C1", 100.0, 1))
        written(2)
    finally:
        query.stop()
    got = spark.read.schema(history.schema).parquet(str(tmp_path / "rows"))
    assert rows(got, "transaction_id", "recent_count", "previous_amount") == [("t000", 1, None), ("t001", 1, None)]


def test_cool_off_stream_equals_batch(spark, feed, tmp_path):
    def alerts(streaming):
        return rules.alerts_of(feed.transactions(spark, streaming), [rules.high_value()])

    got = drained(spark, cool_off_stream(alerts(True), quiet_ms=20_000), tmp_path)
    expected = rules.cool_off(alerts(False), quiet_ms=20_000)
    assert rows(got, "transaction_id") == rows(expected, "transaction_id")
    assert 0 < got.count() < alerts(False).count()


def test_bucket_totals(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(txn(0, "C1", 1.0, 0), txn(1, "C1", 2.0, 59_999), txn(2, "C1", 4.0, 60_000))
    feed.add(txn(3, "C1", 8.0, 1))
    df = bucket_totals(feed.transactions(spark), ttl_ms=None)
    out = str(tmp_path / "out")
    jobs.drain(jobs.run_idempotent(df, str(tmp_path / "cp"), out, mode="update", trigger=DRAIN))
    assert rows(spark.read.parquet(out), "batch", "bucket_ms", "bucket_count", "running_amount") == [
        (0, T0, 2, 7.0), (0, T0 + 60_000, 1, 7.0), (1, T0, 3, 15.0)]


def test_alert_records(spark):
    alert = spark.createDataFrame([("t", "C", 1.0, None, 5, "R1", "n", 50.0, "d")],
                                  "transaction_id string, customer_id string, amount double, city string, "
                                  "event_time long, rule_id string, rule_name string, risk_score double, details string")
    got = card_fraud.alert_records(alert).first()
    value = json.loads(bytes(got["value"]))
    assert got["topic"] == "fraud-alerts" and got["key"] is None
    assert sorted(value) == sorted(schemas.ALERT.fieldNames()) and value["city"] is None


SENSOR = ("sensor_id string, location string, state string, timestamp string, temperature_fahrenheit double, "
          "humidity_percent double, pressure_hpa double, air_quality_index int, air_quality_status string, at timestamp")
WEATHER = "city string, state string, temperature_f int, short_forecast string, wind_speed string, at timestamp"


def typed(feed, spark, schema, streaming):
    parsed = feed.lines(spark, streaming).select(F.from_json("value", schema).alias("r")).select("r.*")
    return parsed.withWatermark("at", "5 seconds") if streaming else parsed


def stamp(seconds):
    return f"2024-01-01T{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}Z"


@pytest.fixture(scope="module")
def env(tmp_path_factory):
    root = tmp_path_factory.mktemp("env")
    sensors, forecasts = Feed(root / "sensors"), Feed(root / "weather")
    for part in range(2):
        sensors.add(*[{"sensor_id": f"s{i % 2}", "location": ["Rome", "Oslo"][i % 2], "state": "X", "timestamp": "t",
                       "temperature_fahrenheit": 50.0 + i, "humidity_percent": 10.0, "pressure_hpa": 1.0,
                       "air_quality_index": 40 * i, "air_quality_status": "x", "at": stamp(part * 600 + i * 25)}
                      for i in range(6)])
        forecasts.add(*[{"city": c, "state": "X", "temperature_f": 50, "short_forecast": "s", "wind_speed": "w",
                         "at": stamp(part * 600 + i * 50)} for i, c in enumerate(("Rome", "Oslo", "Rome"))])
    sensors.add({"sensor_id": "end", "location": "End", "at": stamp(80_000)})
    sensors.add({"sensor_id": "end", "location": "End", "at": stamp(80_001)})
    forecasts.add({"city": "End", "temperature_f": 1, "at": stamp(80_000)})
    forecasts.add({"city": "End", "temperature_f": 1, "at": stamp(80_001)})
    return sensors, forecasts


def test_environment_streams_equal_batch(spark, env, tmp_path):
    sensors, forecasts = env

    def s(streaming):
        return typed(sensors, spark, SENSOR, streaming)

    def w(streaming):
        return typed(forecasts, spark, WEATHER, streaming)

    jobs_by_name = {
        "compare": lambda x: environment.forecast_against_sensor(w(x), s(x), weather_time="at", sensor_time="at"),
        "pairs": lambda x: environment.readings_with_forecast(s(x), w(x), sensor_time="at", weather_time="at"),
        "summary": lambda x: windows.city_summary(s(x), "at"),
        "hopping": lambda x: windows.hopping_forecast(w(x), "at"),
        "sessions": lambda x: windows.sessions(s(x), ["sensor_id"], "at", 30_000),
    }
    for name, job in jobs_by_name.items():
        # The rows named End only close the windows before them; their own stay open.
        got, expected = ([r for r in rows(df, *sorted(df.columns)) if not {"End", "end"} & set(r)]
                         for df in (drained(spark, job(True), tmp_path / name), job(False)))
        assert expected and got == expected, name


def test_table_is_read_anew_for_each_batch(spark, tmp_path):
    """A user who arrives between two micro-batches is met by the second; a stream in a plain join is refused."""
    schema = "user_id int, username string, email string, city string, state string"
    people = [(1, "u", "e", "Rome", "X"), (2, "v", None, "Oslo", "X")]
    readings = Feed(tmp_path / "in")
    for part in range(2):
        readings.add(*[{"sensor_id": f"{c}{part}", "location": c, "air_quality_index": 200, "at": "2024-01-01T00:00:00Z"}
                       for c in ("Rome", "Oslo")])
    kept, out = str(tmp_path / "users"), str(tmp_path / "out")

    def keep(n):
        tables.users_table(spark.createDataFrame(people[:n], schema)).write.mode("overwrite").parquet(f"{kept}/batch={n}")

    def join(batch, users):
        if not (tmp_path / "users/batch=2").exists():
            keep(2)  # arrives while the first batch is under way
        return environment.local_air(batch, users).select("city", "username")

    keep(1)
    stream = typed(readings, spark, SENSOR, True)

    def users():
        return spark.read.parquet(f"{kept}/batch={2 if (tmp_path / 'users/batch=2').exists() else 1}")

    jobs.drain(jobs.run_with_table(stream, users, join, str(tmp_path / "cp"), out, trigger=DRAIN))
    assert rows(spark.read.parquet(out), "batch", "city") == [(0, "Rome"), (1, "Oslo"), (1, "Rome")]
    with pytest.raises(ValueError):
        environment.user_alerts(stream, tables.users_table(spark.createDataFrame(people, schema)))


def test_kept_table_of_users(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add({"user_id": 1, "username": "a", "email": "e1", "city": "Rome"},
             {"user_id": 2, "username": "b", "email": None, "city": "Rome"})
    feed.add({"user_id": 3, "username": "c", "email": None, "city": "Oslo"})

    def run():
        users = feed.lines(spark).select(F.from_json("value", schemas.ENV_USER).alias("r")).select("r.*")
        jobs.drain(persist_table(tables.users_table(users), ["city"], str(tmp_path / "t"), str(tmp_path / "cp"), trigger=DRAIN))
        return rows(current_table(spark, str(tmp_path / "t"), ["city"]), "city", "user_id", "username", "email")

    assert run() == [("Oslo", 3, "c", None), ("Rome", 2, "b", "e1")]
    feed.add({"user_id": 4, "username": "d", "email": "e4", "city": "Rome"})
    assert run() == [("Oslo", 3, "c", None), ("Rome", 4, "d", "e4")]


def test_idempotent_output_survives_a_repeated_batch(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(txn(0, "C1", 1.0, 0))
    out, calls = str(tmp_path / "out"), []

    def prepare(batch):
        calls.append(1)
        if len(calls) == 1:
            batch.write.parquet(f"{out}/batch=0")
            raise RuntimeError("lost after writing")
        return batch

    def run():
        jobs.drain(jobs.run_idempotent(feed.lines(spark), str(tmp_path / "cp"), out, trigger=DRAIN, prepare=prepare))

    with pytest.raises(Exception, match="lost after writing"):
        run()
    run()
    assert len(calls) == 2 and spark.read.parquet(out).count() == 1


def test_late_audit(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(txn(0, "C1", 1.0, 100_000), txn(1, "C1", 1.0, 1))
    feed.add(txn(2, "C1", 1.0, 95_000), txn(3, "C1", 1.0, 94_999))
    feed.add(txn(4, "C1", 1.0, 99_000))
    jobs.drain(jobs.split_late(feed.transactions(spark), "event_ts", "5 seconds", str(tmp_path / "out"),
                               str(tmp_path / "cp"), trigger=DRAIN))
    assert rows(jobs.read_table(spark, str(tmp_path / "out/rows")), "transaction_id", "late") == [
        ("t000", False), ("t001", False), ("t002", False), ("t003", True), ("t004", False)]


def test_dropped_rows_are_counted(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(txn(0, "C1", 1.0, 0))
    feed.add(txn(1, "C1", 1.0, 2_000_000))
    feed.add(txn(5, "C1", 1.0, 2_000_001))
    feed.add(txn(2, "C1", 1.0, 5), txn(3, "C1", 1.0, 4_000_000))
    spend = rules.spend_alerts(feed.transactions(spark).withWatermark("event_ts", "5 seconds"))
    log = progress.ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        query = jobs.run_to_table(spend, str(tmp_path / "rows"), str(tmp_path / "cp"), trigger=DRAIN)
        jobs.drain(query)
        log.wait(query.runId)
    finally:
        spark.streams.removeListener(log)
    written = progress.progress_rows(spark, str(tmp_path / "progress"))
    assert progress.dropped_by_watermark(written).agg(F.sum("dropped")).first()[0] == 1
    assert written.agg(F.sum("numInputRows")).first()[0] == 5


def test_late_rows_of_more_batches_than_a_query_reports(spark, tmp_path):
    """The log holds every batch; the rows behind the checkpoint's own watermarks are those that were dropped."""
    feed = Feed(tmp_path / "in")
    for i in range(14):
        feed.add(txn(10 * i, "C1", 1.0, 100_000 * i), txn(10 * i + 1, "C2", 1.0, 100_000 * i - 70_000 * (i % 4)))
    most = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(most)
    spark.conf.set(most, "3")
    log = progress.ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    try:
        rows_ = feed.transactions(spark).withWatermark("event_ts", "5 seconds").dropDuplicates(["transaction_id", "event_ts"])
        query = jobs.run_to_table(rows_, str(tmp_path / "rows"), str(tmp_path / "cp"), trigger=DRAIN)
        jobs.drain(query)
        log.wait(query.runId)
    finally:
        spark.streams.removeListener(log)
        spark.conf.set(most, before)
    assert len(query.recentProgress) <= 3
    dropped = progress.dropped_by_watermark(progress.progress_rows(spark, str(tmp_path / "progress")))
    batches = progress.batch_log(spark, str(tmp_path / "cp"))
    assert dropped.count() == batches.count() >= 14 and batches.where("committed").count() == batches.count()
    audit = str(tmp_path / "audit")
    jobs.drain(jobs.run_idempotent(feed.transactions(spark), str(tmp_path / "cp2"), audit, trigger=DRAIN))
    late = progress.late_rows(spark.read.parquet(audit), batches, F.col("event_ts"))
    kept = spark.read.parquet(str(tmp_path / "rows"))
    assert late.count() == dropped.agg(F.sum("dropped")).first()[0] == 28 - kept.count() == 3
    assert not {r[0] for r in late.select("transaction_id").collect()} & {r[0] for r in kept.select("transaction_id").collect()}


def test_live_figures_equal_the_batch_ones(spark, feed, tmp_path):
    """After every micro-batch, also where it is repeated and where no alert comes."""
    def alerts(streaming):
        found = rules.alerts_of(feed.transactions(spark, streaming), [rules.high_value()])
        return found.withColumn("alert_time", F.col("event_time"))

    out, arrival = str(tmp_path / "out"), ("alert_time", "transaction_id")
    jobs.drain(live.run_live_figures(alerts(True), str(tmp_path / "cp"), out, arrival=arrival, keep=6, ring=3, trigger=DRAIN))
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() == 6
    files = feed.lines(spark, False).select("value", F.col("_metadata.file_name").alias("file"))
    for batch in range(6):
        so_far = validate.parse_transactions(files.where(F.substring("file", 1, 4).cast("int") <= batch), F.col("value"))
        found = rules.alerts_of(so_far, [rules.high_value()]).withColumn("alert_time", F.col("event_time"))
        newest = stats.newest(found, 6, arrival)
        own = {(r["figure"], r["key"]): r["value"] for r in got.where(F.col("batch") == batch).collect()}
        total = stats.key_figures(newest).first()
        assert (own["total_alerts", ""], own["avg_risk_score", ""], own["high_risk_count", ""]) == tuple(total)
        assert {k: v for (f, k), v in own.items() if f == "alerts_of_rule"} == dict(map(tuple, stats.alerts_by_rule(newest).collect()))
        now = newest.agg(F.max("alert_time")).first()[0]
        want = stats.alerts_per_minute(found, F.lit(now), minutes=3).collect() if now else []
        assert {k: v for (f, k), v in own.items() if f == "alerts_in_minute"} == {str(r["minute_ms"]): r["count"] for r in want}
        top = {r["customer_id"]: r["max_risk"] for r in stats.top_customers(newest, arrival=arrival).collect()}
        assert {k: v for (f, k), v in own.items() if f == "customer_max_risk"} == top


def test_a_repeated_poll_sends_the_same(spark, tmp_path):
    """A poll that fails after sending is repeated: it sends what it had read, though the table has changed since."""
    reads, topic = [], topics.Topic("postgres-people", folder=str(tmp_path / "topics"))

    def read(_name):
        reads.append(1)
        return spark.createDataFrame([(1, f"read {len(reads)}")], "id int, name string")

    failed = []

    def number(records, poll):
        if poll == 1 and not failed:
            failed.append(1)
            topics.replace_part(topics.numbered(records, 1, F.lit(poll), F.current_timestamp()), topic, f"poll-{poll:012d}")
            raise RuntimeError("lost after sending")
        return topics.numbered(records, 1, F.lit(poll), F.current_timestamp())

    def start():
        return relational.publish_snapshots(spark, read, {"people": F.col("id")}, lambda _: topic, str(tmp_path / "cp"),
                                            interval="3 seconds", number=number)

    with pytest.raises(Exception, match="lost after sending"):
        start().awaitTermination(120)
    jobs.stop_after_batches(start(), 3, seconds=60)
    sent = topics.read_batch(spark, topic).select("offset", F.get_json_object(F.col("value").cast("string"), "$.name").alias("name"))
    assert rows(sent.where("offset < 3")) == [(0, "read 1"), (1, "read 2"), (2, "read 3")]


def test_offsets_of_a_kafka_checkpoint(spark, tmp_path):
    """The log's own offsets; an uncommitted batch does not count."""
    for folder, files in {"offsets": {"0": '{"events":{"0":5,"1":7}}', "1": '{"events":{"0":9,"1":7}}'}, "commits": {"0": "{}"}}.items():
        (tmp_path / folder).mkdir()
        for name, text in files.items():
            (tmp_path / folder / name).write_text(f'v1\n{{"batchWatermarkMs":{int(name) * 1000}}}\n{text}')
    topic = topics.Topic("events", servers="broker:9092")
    assert rows(progress.committed_offsets(spark, str(tmp_path), topic)) == [("events", 0, 5), ("events", 1, 7)]
    assert rows(progress.batch_log(spark, str(tmp_path)), "batch", "watermark_ms", "committed") == [(0, 0, True), (1, 1000, False)]



def test_odd_records_do_not_end_a_stream(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(txn(0, "C1", "NaN", 0), txn(1, "C1", 1e300, 1000), txn(2, "C2", 20_000, 9_000_000_000_000_000_000 - T0))
    feed.add('{"transaction_id":"a","customer_id":"x","transaction_id":"t003","customer_id":"C3","amount":11000,"event_time":%d}' % T0)
    feed.add(txn(9, "C9", 1.0, 9_000_000), txn(10, "C9", 1.0, 9_100_000))
    feed.add(txn(11, "C9", 1.0, 9_200_000))
    alerts = card_fraud.detect_stream(feed.transactions(spark), state_ttl_ms=None)
    got = rows(drained(spark, alerts, tmp_path / "x"), "transaction_id", "rule_id")
    assert ("t001", "R1") in got and ("t003", "R1") in got
    batch = card_fraud.detect(feed.transactions(spark, False))
    assert got == [r for r in rows(batch, "transaction_id", "rule_id")]


def test_rows_can_be_limited_and_pushed(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(*[txn(i, "C1", 1.0, i) for i in range(20)])
    push(feed.transactions(spark).limit(10), "first_ten").awaitTermination()
    assert spark.table("first_ten").count() == 10


def test_captured_changes_go_on_after_a_restart_and_repeat_alike(spark, tmp_path):
    path, checkpoint, commits = str(tmp_path / "changes"), str(tmp_path / "cp"), tmp_path / "cp" / "commits"
    states = [[(1, "a"), (2, "b")], [(1, "a"), (2, "c"), (3, None)], [(2, "c"), (3, "d")]]
    now = {}

    def polled():
        return max(int(f.name) for f in commits.iterdir() if f.name.isdigit()) + 1

    def run(state, polls):
        now["rows"] = state
        jobs.stop_after_batches(relational.capture_changes(
            spark, lambda: spark.createDataFrame(now["rows"], "id long, name string"), "id", checkpoint, path, interval="2 seconds"), polls)

    def changes(poll):
        return sorted((r["id"], r["change"], r["name"]) for r in spark.read.parquet(f"{path}/poll={poll}").collect())

    run(states[0], 1)
    # The last poll is repeated, as after a failure before its commit, and compares the rows that it had read.
    last = polled() - 1
    before = changes(last)
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    # A poll that was broken off has read its rows already, so two more make sure that one reads anew.
    run(states[1], last + 3)
    assert changes(last) == before
    run(states[2], polled() + 2)
    assert [c for c in map(changes, range(polled())) if c] == [
        [(1, "insert", "a"), (2, "insert", "b")], [(2, "update", "c"), (3, "insert", None)], [(1, "delete", "a"), (3, "update", "d")]]
