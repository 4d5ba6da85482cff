import pytest
from pyspark.sql import functions as F

from streamscreen.operators import rules
from streamscreen.plans import card_fraud
from tests.conftest import rows

T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def txns(spark, data):
    """(id, customer, amount, offset ms[, hour[, city]])"""
    full = [(i, c, float(a), "shop", rest[1] if len(rest) > 1 else "Rome", T0 + ms, rest[0] if rest else 12)
            for i, c, a, ms, *rest in data]
    df = spark.createDataFrame(
        full, "transaction_id string, customer_id string, amount double, merchant string, city string, "
              "event_time long, hour int")
    return df.withColumn("event_ts", F.timestamp_millis("event_time"))


def test_high_value_scores(spark):
    df = txns(spark, [("a", "C1", 10000, 0), ("b", "C1", 10000.01, 1), ("c", "C1", 25000, 2), ("d", "C1", 70000, 3)])
    got = rules.alerts_of(df, [rules.high_value()])
    assert rows(got, "transaction_id", "risk_score") == [("b", 50.0), ("c", 65.0), ("d", 100.0)]
    assert got.where("transaction_id = 'c'").first()["details"] == "Amount $25,000.00 exceeds $10,000 threshold"


def test_velocity_fires_from_the_sixth(spark):
    df = txns(spark, [(f"t{i}", "C1", 5, i * 1200) for i in range(8)])
    got = rules.event_alerts(df)
    assert rows(got, "transaction_id", "rule_id", "risk_score") == [
        ("t5", "R2", 48.0), ("t6", "R2", 56.0), ("t7", "R2", 64.0)]
    assert got.where("transaction_id = 't5'").first()["details"] == "6 transactions in the last 60 seconds"


@pytest.mark.parametrize("last,fires", [(60_000, True), (60_001, False)])
def test_velocity_window_includes_both_ends(spark, last, fires):
    df = txns(spark, [(f"t{i}", "C1", 5, i) for i in range(5)] + [("z", "C1", 5, last)])
    assert (rules.event_alerts(df).count() == 1) is fires


def test_velocity_ties_count_in_order(spark):
    df = txns(spark, [(f"t{i}", "C1", 5, 0) for i in range(7)])
    assert rows(rules.with_history(df), "transaction_id", "recent_count") == [
        (f"t{i}", i + 1) for i in range(7)]


def test_spend_window(spark):
    inside = txns(spark, [(f"t{i}", "C1", 9000, i * 1000, 12, f"city{i}") for i in range(6)])
    got = rules.spend_alerts(inside).collect()
    assert len(got) == 1
    assert (got[0]["risk_score"], got[0]["amount"], got[0]["transaction_id"], got[0]["city"]) == (
        64.0, 54000.0, "t5", "city5")
    assert got[0]["details"] == (f"6 transactions totalling $54,000.00 in 10-min window "
                                 f"[{T0} - {T0 + 600_000}]")
    split = txns(spark, [(f"t{i}", "C1", 9000, 597_000 + i * 1000) for i in range(6)])
    assert rules.spend_alerts(split).count() == 0
    exact = txns(spark, [(f"t{i}", "C1", 10000, i) for i in range(5)])
    assert rules.spend_alerts(exact).count() == 0


def test_night_rule(spark):
    df = txns(spark, [(f"{h}-{a}", "C1", a, h * 1000, h) for h in (0, 1, 4, 5) for a in (3000, 3000.01)])
    got = rules.alerts_of(df, [rules.night_owl()])
    assert rows(got, "transaction_id", "risk_score") == [("1-3000.01", 70.0), ("4-3000.01", 70.0)]
    assert got.first()["details"] == "$3,000.01 transaction at 01:00"


def test_escalation(spark):
    df = txns(spark, [("a", "C1", 10, 0), ("b", "C1", 30, 1), ("c", "C1", 91, 2), ("d", "C1", 400, 3)])
    got = rules.event_alerts(df)
    assert rows(got, "transaction_id", "risk_score") == [("c", 65.17), ("d", 71.98)]
    assert got.where("transaction_id = 'd'").first()["details"] == "$400.00 is 4.4x previous $91.00"


def test_zero_previous_amount_never_divides(spark):
    df = txns(spark, [("a", "C1", 0, 0), ("b", "C1", 30, 1)])
    assert rules.event_alerts(df).count() == 0


def test_many_cities(spark):
    df = txns(spark, [(f"t{i}", "C1", 5, i * 60_000, 12, c) for i, c in enumerate("ABACDA")]
              + [("late", "C1", 5, 60 * 60_000, 12, "E")])
    assert rows(rules.many_cities(df), "transaction_id", "city_count") == [("t4", 4), ("t5", 4)]


def test_card_velocity(spark):
    df = spark.createDataFrame([("e1", "k", 10.0, "CA", 0), ("e2", "k", 5.0, "US", 1000), ("e3", "k", 1.0, "US", 700_000)],
                               "event_id string, card_id string, amount double, country string, event_time long")
    assert rows(rules.card_velocity(df), "event_id", "recent_count", "recent_amount", "previous_country",
                "country_changed") == [("e1", 1, 10.0, None, False), ("e2", 2, 15.0, "CA", True),
                                       ("e3", 1, 1.0, "US", False)]


def test_all_alerts_and_stamp(spark):
    df = txns(spark, [(f"t{i}", "C1", 12000, i * 1000, 2) for i in range(6)])
    got = rules.stamp(card_fraud.detect(df), F.lit(7))
    assert got.columns == [*rules.ALERT_COLUMNS, "alert_time"]
    assert rows(got.groupBy("rule_id").count()) == [("R1", 6), ("R2", 1), ("R3", 1), ("R4", 6)]
