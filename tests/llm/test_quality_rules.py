import math
import random

import pytest
from pyspark.sql import functions as F

from streamscreen.llm import quality_rules as q
from streamscreen.llm.common import table

SMALL = "/root/testdata/sf0.001"

RNG = random.Random(4)


def good(n):
    return " ".join(RNG.choice(["river", "stone", "Meadow", "walked", "slowly", "over", "the", "light"]) for _ in range(n)) + "."


def bad(n):
    return RNG.choice([lambda: "BUY!! " * n, lambda: " | ".join("item%d" % i for i in range(n)), lambda: "same " * n])()


def test_statistics_of_known_texts(spark):
    rows = [(1, "Ab ab ab\nCd! 12."), (2, None), (3, ""), (4, "x")]
    got = {r["doc_id"]: r for r in q.with_statistics(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    r = got[1]
    assert abs(r["distinct_words"] - 4 / 5) < 1e-9 and abs(r["repeated_next"] - 1 / 5) < 1e-9
    assert abs(r["upper"] - 2 / 16) < 1e-9 and abs(r["digits"] - 2 / 16) < 1e-9 and abs(r["symbols"] - 2 / 16) < 1e-9
    assert r["distinct_lines"] == 1.0 and abs(r["exclamations"] - 1 / 5) < 1e-9
    assert all(got[2][s] == got[3][s] for s in q.STATISTICS) and got[2]["chars_log"] == 0


def test_held_out_accuracy_rules_and_filter(spark):
    texts = [(i, bad(RNG.randint(5, 60)) if i % 6 == 0 else good(RNG.randint(5, 90)), int(i % 6 != 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "l", 1, 0.5) for i, t, _ in texts], "doc_id long, text string, label string, quality int, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts if i % 2] + [(0, 0), (6, 0), (12, 0), (18, 0), (24, 0), (30, 0), (36, 0), (42, 0), (1, None)],
                                   "doc_id long, quality int")
    model = q.fit(docs.select("doc_id", "text"), labels)
    assert model.rules and all(1 <= len(rule) <= q.DEPTH for rule, _ in model.rules)
    scored = {r["doc_id"]: r["score"] for r in q.score(docs, model, ["doc_id"]).collect()}
    assert all(0 <= s <= 1 for s in scored.values())
    right = sum((scored[i] >= q.THRESHOLD) == bool(y) for i, _, y in texts)
    assert right >= 0.95 * len(texts)
    kept = q.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scored.items() if s >= q.THRESHOLD}
    assert q.score(docs.where("false"), model, ["doc_id"]).collect() == []


def test_rules_of_a_printed_tree():
    text = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5
  If (feature 0 <= 1.5)
   If (feature 1 <= -2.0E-3)
    Predict: 0.0
   Else (feature 1 > -2.0E-3)
    Predict: 1.0
  Else (feature 0 > 1.5)
   Predict: 1.0"""
    a, b, c, d = q.tree_rules(text, ["p", "q"])
    assert a == (q.Condition("p", False, 1.5),) and d == (q.Condition("p", True, 1.5),)
    assert b == (*a, q.Condition("q", False, -0.002)) and c == (*a, q.Condition("q", True, -0.002))


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "word"), (2, None)], "doc_id long, text string")
    model = q.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r[0] for r in q.score(docs, model, []).select(F.round("score", 6)).collect()] == [0.5, 0.5]


def test_columns_named_like_statistics_are_kept(spark):
    docs = spark.createDataFrame([(1, "word", "d", 7.0)], "doc_id long, text string, digits string, score double")
    got = q.score(docs, q.Model(0.0, (), ()), ["doc_id", "digits", "score"])
    assert got.columns == ["doc_id", "digits", "score"] and tuple(got.first()) == (1, "d", 0.5)


def test_compiled_score_matches_the_rules_row_by_row(spark):
    """Every rule and every clipped statistic evaluated in Python on the collected statistics."""
    C = q.Condition
    model = q.Model(0.3, (((C("chars_log", True, 2.0), C("digits", False, 0.1)), -1.5), ((C("upper", True, 0.05),), 0.7)),
                                (("word_length", 1.0, 6.0, 0.4), ("symbols", 0.0, 0.02, -3.0)))
    texts = ["", None, "Some Plain words.", "1234 5678 90", "!!! ### ???", "UPPER CASE TEXT " * 9, "a b c d e f g", "é ü ñ" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = {r["doc_id"]: r for r in q.with_statistics(docs, ["doc_id"]).collect()}
    for r in q.score(docs, model, ["doc_id"]).collect():
        own, total = seen[r["doc_id"]], 0.3
        for rule, weight in model.rules:
            if all((own[c.statistic] > c.value) == c.above for c in rule):
                total += weight
        for name, low, high, weight in model.linear:
            total += weight * max(min(own[name], high), low)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-12)


def test_training_is_reproducible(spark):
    """The same rows in other partitions give the same model."""
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    labels = table(spark, SMALL, "labels").select("doc_id", "quality")
    first, again = (q.fit(d, labels) for d in (docs, docs.repartition(7)))
    assert first == again and first.rules
