import random

import pytest
from pyspark.sql import functions as F

from streamscreen.operators import history, rules
from tests.conftest import rows

SPAN = 60_000


@pytest.fixture(scope="module")
def events(spark):
    """One customer holds a third of the rows, a third of those at one instant."""
    rng = random.Random(7)
    out = []
    for i in range(900):
        if i % 3 == 0:
            customer = "hot"
            at = 500_000 if i % 9 == 0 else rng.randrange(0, 1_000_000)
        else:
            customer = rng.choice(["a", "b", "c", None])
            at = rng.randrange(0, 1_000_000)
        out.append((f"T{i:04d}", customer, float(rng.randrange(1, 500)),
                    rng.choice(["X", "Y", "Z", "W", "V", None]), at))
    df = spark.createDataFrame(out, "transaction_id string, customer_id string, amount double, city string, event_time long")
    return df.repartition(3).cache(), out


def replay(out):
    """Row by row, in order: recent count, recent amount, previous amount, distinct cities."""
    got, seen = {}, {}
    for tid, customer, amount, city, at in sorted(out, key=lambda r: (r[4], r[0])):
        past = seen.setdefault(customer, [])
        window = [p for p in past if p[4] >= at - SPAN] + [(tid, customer, amount, city, at)]
        got[tid] = (len(window), sum(p[2] for p in window), past[-1][2] if past else None,
                    len({p[3] for p in window} - {None}))
        past.append((tid, customer, amount, city, at))
    return got


@pytest.mark.parametrize("hot_rows", [10_000, 40])
def test_look_back_equals_replay(spark, events, hot_rows):
    df, out = events
    got = history.look_back(df, ["customer_id"], "event_time", ["transaction_id"], SPAN,
                            sums={"n": F.lit(1), "total": F.col("amount")},
                            previous={"before": F.col("amount")}, hot_rows=hot_rows)
    expected = replay(out)
    found = {r["transaction_id"]: (r["n"], round(r["total"], 6), r["before"]) for r in got.collect()}
    assert found == {k: v[:3] for k, v in expected.items()}


@pytest.mark.parametrize("hot_rows", [10_000, 40])
def test_distinct_look_back_equals_replay(spark, events, hot_rows):
    df, out = events
    got = history.distinct_look_back(df, ["customer_id"], "city", "event_time", ["transaction_id"], SPAN,
                                     "cities", hot_rows=hot_rows)
    assert {r["transaction_id"]: r["cities"] for r in got.collect()} == {
        k: v[3] for k, v in replay(out).items()}


def test_hot_keys_are_split_into_pieces(spark, events):
    df, _ = events
    found = history.hot_keys(df, ["customer_id"], 200)
    assert rows(found.keys) == [("hot",)] and found.small and found.rows == 300
    assert history.hot_keys(df, ["customer_id"], 300) is None


def test_many_hot_keys_are_joined_not_broadcast(spark, events, monkeypatch):
    df, out = events
    monkeypatch.setattr(history, "MAX_BROADCAST_KEYS", 2)
    got = history.running(df, ["customer_id"], ["event_time", "transaction_id"],
                          sums={"n": F.lit(1).cast("long")}, hot_rows=40)
    plain = history.running(df, ["customer_id"], ["event_time", "transaction_id"],
                            sums={"n": F.lit(1).cast("long")}, hot=None)
    assert rows(got, "transaction_id", "n") == rows(plain, "transaction_id", "n")


def keep_quiet(out, quiet):
    last, kept = {}, []
    for row in sorted(out, key=lambda r: (r[4], r[0])):
        if row[1] not in last or row[4] - last[row[1]] >= quiet:
            last[row[1]] = row[4]
            kept.append(row[0])
    return sorted(kept)


@pytest.mark.parametrize("quiet,hot_rows", [(5_000, 10_000), (20_000, 10_000), (20_000, 60), (3_000_000, 10_000)])
def test_cool_off_equals_replay(spark, events, quiet, hot_rows):
    df, out = events
    got = rules.cool_off(df, tie=("transaction_id",), quiet_ms=quiet, hot_rows=hot_rows)
    assert got.columns == df.columns
    assert sorted(r[0] for r in got.select("transaction_id").collect()) == keep_quiet(out, quiet)
