import os
import random

import pytest
from pyspark.sql import functions as F

from streamscreen.operators import rules, windows
from streamscreen.operators.rules import Limits
from streamscreen.plans import card_fraud
from streamscreen.session import durable, shared_folder, temporary_tables
from streamscreen.streaming import carried, jobs
from streamscreen.streaming.processors import many_cities_stream, with_fading_history
from tests.conftest import rows
from tests.test_streaming import ALERT, DRAIN, T0, Feed, txn

DICE = random.Random(5)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """Four micro-batches in order of time; a third of the rows belongs to one customer. Amounts may be null."""
    feed, n = Feed(tmp_path_factory.mktemp("skewed") / "in"), 0
    for part in range(4):
        lines = []
        for i in range(240):
            who = "HOT" if i % 3 == 0 else f"C{DICE.randrange(40)}"
            amount = None if i % 17 == 0 else float(DICE.choice([100, 900, 4000, 12_000]))
            lines.append({**txn(n, who, amount, part * 600_000 + i * 2000, hour=i % 6), "transaction_id": f"t{n:05d}",
                          "city": DICE.choice(["Rome", "Oslo", "Bern", "Lima", "Riga", None])})
            n += 1
        feed.add(*lines)
    feed.add({**txn(0, "end", 1.0, 7_200_000), "transaction_id": "t99999"})
    return feed


LIMITS = Limits(velocity_ms=30_000, velocity_count=3, spend_limit=30_000)


def read(spark, path):
    return spark.read.parquet(path)


def test_a_hot_customer_in_a_stream(spark, skewed, tmp_path):
    """Same alerts as in batch, with rows of the hot customer cut into pieces."""
    for query in card_fraud.run_detection(skewed.transactions(spark), str(tmp_path / "cp"), str(tmp_path / "out"), LIMITS,
                                          hot_rows=20, trigger=DRAIN):
        jobs.drain(query)
    batch = card_fraud.detect(skewed.transactions(spark, False), LIMITS)
    got = card_fraud.written_alerts(spark, str(tmp_path / "out"))
    assert rows(got, *ALERT, "details", "city") == rows(batch, *ALERT, "details", "city")
    assert {r["rule_id"] for r in got.collect()} == {"R1", "R2", "R3", "R4", "R5"}


def test_no_task_holds_the_hot_customer(spark, skewed, tmp_path):
    """Where history is computed, no partition has more than twice its even share of a micro-batch's rows."""
    seen = []

    def finish(history):
        parts = history.groupBy(F.input_file_name().alias("file")).count().collect()
        seen.append((sum(p["count"] for p in parts), max(p["count"] for p in parts)))
        return history

    # What History.step gives out is written as it was computed, one file a task.
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        jobs.drain(carried.run_history(skewed.transactions(spark), 30_000, str(tmp_path / "cp"), str(tmp_path / "out"),
                                       finish=finish, hot_rows=20, trigger=DRAIN))
    finally:
        spark.conf.set(coalesce, "true")
    total, largest = max(seen)
    assert total > 200 and largest <= 2 * total / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_history_equals_batch(spark, skewed, tmp_path):
    jobs.drain(carried.run_history(skewed.transactions(spark), 30_000, str(tmp_path / "cp"), str(tmp_path / "out"), trigger=DRAIN))
    columns = ("transaction_id", "recent_count", "previous_amount")
    batch = rules.with_history(skewed.transactions(spark, False), Limits(velocity_ms=30_000))
    assert rows(read(spark, str(tmp_path / "out")), *columns) == rows(batch, *columns)


def test_a_customer_comes_back_after_the_window(spark, tmp_path):
    """The amount before is found though its row has left the carried window, and through batches without the customer."""
    feed = Feed(tmp_path / "in")
    feed.add(txn(0, "C1", 10.0, 0), txn(1, "C2", 7.0, 1))
    for i in range(5):
        feed.add(txn(10 + i, "C3", 1.0, 1_000_000 * (i + 1)))
    feed.add(txn(2, "C1", 50.0, 9_000_000), txn(4, "C1", 60.0, 9_000_002))
    feed.add(txn(5, "C1", 70.0, 9_100_000))
    jobs.drain(carried.run_history(feed.transactions(spark), 60_000, str(tmp_path / "cp"), str(tmp_path / "out"), trigger=DRAIN))
    got = {r["transaction_id"]: (r["recent_count"], r["previous_amount"]) for r in read(spark, str(tmp_path / "out")).collect()}
    assert got["t002"] == (1, 10.0) and got["t004"] == (2, 50.0) and got["t005"] == (1, 60.0)


@pytest.mark.parametrize("lateness_ms", [0, 100_000])
def test_a_late_row_meets_its_window(spark, tmp_path, lateness_ms):
    feed = Feed(tmp_path / "in")
    feed.add(*[txn(i, "C1", 10.0 + i, i * 1000) for i in range(4)])
    feed.add(txn(8, "C2", 1.0, 90_000))
    feed.add(txn(9, "C1", 99.0, 2500))
    jobs.drain(carried.run_history(feed.transactions(spark), 10_000, str(tmp_path / "cp"), str(tmp_path / "out"),
                                   lateness_ms=lateness_ms, trigger=DRAIN))
    late = read(spark, str(tmp_path / "out")).where("transaction_id = 't009'").first()
    assert (late["recent_count"], late["previous_amount"]) == ((4, 12.0) if lateness_ms else (1, 13.0))


def test_a_repeated_batch_gives_the_same(spark, skewed, tmp_path):
    """The job dies after its state is written and before the batch counts as done."""
    failed = []

    def finish(history):
        if len(failed) == 0 and history.where("event_time >= %d" % (T0 + 600_000)).count():
            failed.append(1)
            raise RuntimeError("lost after the state")
        return history

    def run():
        jobs.drain(carried.run_history(skewed.transactions(spark), 30_000, str(tmp_path / "cp"), str(tmp_path / "out"),
                                       finish=finish, trigger=DRAIN))

    with pytest.raises(Exception, match="lost after the state"):
        run()
    run()
    columns = ("transaction_id", "recent_count", "previous_amount")
    batch = rules.with_history(skewed.transactions(spark, False), Limits(velocity_ms=30_000))
    assert rows(read(spark, str(tmp_path / "out")), *columns) == rows(batch, *columns)


def test_cool_off_equals_batch(spark, skewed, tmp_path):
    def alerts(streaming):
        return rules.alerts_of(skewed.transactions(spark, streaming), [rules.high_value()])

    jobs.drain(carried.run_cool_off(alerts(True), str(tmp_path / "cp"), str(tmp_path / "out"), quiet_ms=45_000, hot_rows=10, trigger=DRAIN))
    got = rows(read(spark, str(tmp_path / "out")), "transaction_id")
    assert got == rows(rules.cool_off(alerts(False), quiet_ms=45_000), "transaction_id")
    assert 0 < len(got) < alerts(False).count()


def test_sessions_equal_batch(spark, skewed, tmp_path):
    stream, batch = (skewed.transactions(spark, s).select("customer_id", "event_ts") for s in (True, False))
    jobs.drain(carried.run_sessions(stream, ["customer_id"], "event_ts", 60_000, str(tmp_path / "cp"), str(tmp_path / "out"), trigger=DRAIN))
    columns = ("customer_id", "window_start", "window_end", "last_event", "readings_in_session")
    want = windows.sessions(batch, ["customer_id"], "event_ts", 60_000).where("customer_id <> 'end'")
    got = rows(read(spark, str(tmp_path / "out")), *columns)
    assert got == rows(want, *columns) and len(got) > 40


def test_sessions_across_batches_and_late_rows(spark, tmp_path):
    """A session goes on in a later batch; rows at the gap belong to it; rows behind the watermark do not come in."""
    feed = Feed(tmp_path / "in")
    feed.add(txn(0, "a", 1.0, 0), txn(1, "b", 1.0, 0))
    feed.add(txn(2, "a", 1.0, 10_000), txn(3, "b", 1.0, 10_001))
    feed.add(txn(4, "c", 1.0, 20_000), txn(5, "a", 1.0, 10_000))
    feed.add(txn(6, "a", 1.0, 9_999), txn(7, "d", 1.0, 40_000))
    feed.add(txn(8, "e", 1.0, 90_000))
    jobs.drain(carried.run_sessions(feed.transactions(spark), ["customer_id"], "event_ts", 10_000, str(tmp_path / "cp"),
                                    str(tmp_path / "out"), delay_ms=5000, trigger=DRAIN))
    got = [(k, s - T0, e - T0, n) for k, s, e, n in rows(read(spark, str(tmp_path / "out")), "customer_id", "window_start", "last_event",
                                                         "readings_in_session")]
    # t005 is late (10 000 against a watermark of 5 001 is not); t006 is late against 15 000.
    assert got == [("a", 0, 10_000, 3), ("b", 0, 0, 1), ("b", 10_001, 10_001, 1), ("c", 20_000, 20_000, 1), ("d", 40_000, 40_000, 1)]


def drained(spark, df, path):
    jobs.drain(jobs.run_to_table(df, f"{path}/rows", f"{path}/cp", trigger=DRAIN))
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


def test_many_cities_stream_equals_batch(spark, skewed, tmp_path):
    got = drained(spark, many_cities_stream(skewed.transactions(spark), window_ms=60_000), tmp_path)
    want = rules.many_cities(skewed.transactions(spark, False), window_ms=60_000)
    columns = ("transaction_id", "customer_id", "city_count")
    assert rows(got, *columns) == rows(want, *columns) and got.count() > 50


def test_timers_clear_cities(spark, tmp_path):
    """Cities that have left the window are removed though their customer does not come back."""
    feed = Feed(tmp_path / "in")
    feed.add(*[txn(i, "C1", 1.0, i, city=c) for i, c in enumerate("abcd")])
    for i in range(3):
        feed.add(txn(10 + i, "C2", 1.0, 100_000 * (i + 1), city="x"))
    stream = many_cities_stream(feed.transactions(spark), window_ms=10_000)
    query = jobs.run_to_table(stream, str(tmp_path / "rows"), str(tmp_path / "cp"), trigger=DRAIN)
    jobs.drain(query)
    assert rows(spark.read.parquet(str(tmp_path / "rows")), "transaction_id", "city_count") == [("t003", 4)]
    # Four cities and then one; the four go in one batch once the watermark has passed their window.
    assert [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress][:4] == [4, 5, 1, 1]


def test_history_fades_in_event_time(spark, tmp_path):
    """State goes by a timer or by the pause itself; a replay gives the same rows."""
    feed = Feed(tmp_path / "in")
    feed.add(txn(0, "C1", 10.0, 0), txn(1, "C2", 20.0, 0), txn(2, "C1", 11.0, 60_000))
    feed.add(txn(3, "C2", 21.0, 60_001), txn(5, "C1", 12.0, 120_000))
    feed.add(txn(6, "C3", 1.0, 1_000_000))
    feed.add(txn(7, "C1", 13.0, 1_000_001), txn(8, "C3", 2.0, 1_060_001))
    want = [("t000", 1, None), ("t001", 1, None), ("t002", 2, 10.0), ("t003", 1, None), ("t005", 3, 11.0),
            ("t006", 1, None), ("t007", 1, None), ("t008", 1, None)]
    for run in ("first", "again"):
        got = drained(spark, with_fading_history(feed.transactions(spark), 60_000), tmp_path / run)
        assert rows(got, "transaction_id", "rows_so_far", "previous_amount") == want


def test_temporary_tables_go_with_their_block(spark):
    with temporary_tables(spark):
        inner = durable(spark.range(3), "inner")
        outer = durable(spark.range(4), "outer", outlives=True)
        with temporary_tables(spark):
            deep = durable(spark.range(5), "deep")
        assert not os.path.exists(deep.durable_path) and os.path.exists(inner.durable_path)
    assert not os.path.exists(inner.durable_path) and outer.count() == 4
    assert outer.durable_path.startswith(shared_folder(spark))
