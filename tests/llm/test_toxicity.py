import math
import random

import pytest
from pyspark.sql import functions as F

from streamscreen.llm import toxicity as t

RNG = random.Random(8)


def calm(n):
    return " ".join("".join(RNG.choice(["ra", "te", "lo", "min", "su"]) for _ in range(RNG.randint(1, 4))) for _ in range(n))


def toxic(n):
    words = calm(n).split()
    for _ in range(4):
        words.insert(RNG.randrange(len(words)), RNG.choice(["idiot", "grumpf" + calm(1), "grumpf" + calm(1)]))
    return " ".join(words)


def brute(scores):
    """Maximal segments by definition: take the best segment, then go on left and right of it."""
    best = max(((sum(scores[i:j]), -i, -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    i, j = best[3:]
    return brute(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in brute(scores[j:])]


@pytest.mark.parametrize("seed", range(40))
def test_segments_match_brute_force(seed):
    dice = random.Random(seed)
    scores = [dice.choice([t.DRIFT] * 3 + [0.4 + dice.random() * 3, -0.5 - dice.random() * 3]) for _ in range(dice.randint(0, 24))]
    found = [(i, s) for i, s in enumerate(scores) if s != t.DRIFT]
    got = t.segments(found)
    assert [(a, b) for a, b, _ in got] == brute(scores)
    assert all(abs(s - sum(scores[a:b])) < 1e-9 for a, b, s in got)


def test_held_out_scores_and_passages(spark):
    texts = [(i, toxic(60) if i % 5 == 0 else calm(60), int(i % 5 == 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, x, "e", "p") for i, x, _ in texts], "doc_id long, text string, toxic string, passages string")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts] + [(0, 1), (7, None), (9999, 1)], "doc_id long, toxic int")
    model = t.fit(docs, labels)
    fresh = [(1, toxic(80)), (2, calm(80)), (3, None), (4, ""), (5, calm(3)), (6, calm(40_000) + " idiot grumpfo idiot " + calm(10)), (6, calm(4))]
    got = t.score(spark.createDataFrame([(i, x, 1.0) for i, x in fresh], "doc_id long, text string, toxic double"), model).collect()
    assert len(got) == 7 and got[0]["score"] > 0.5 and all(r["score"] < 0.5 for r in got[1:5])
    assert got[2]["score"] == got[3]["score"] and got[2]["passages"] == []
    text, (first, *_) = fresh[0][1], got[0]["passages"]
    assert "idiot" in text[first["start"]:first["end"]] or "grumpf" in text[first["start"]:first["end"]]
    long = got[5]
    assert [fresh[5][1][p["start"]:p["end"]] for p in long["passages"]] == ["idiot grumpfo idiot"] and long["score"] > 0.5


def test_pieces_end_between_words(monkeypatch):
    monkeypatch.setattr(t, "PIECE", 7)
    text = calm(50)
    assert "".join(t.pieces(text)) == text
    assert sum(len(t._WORD.findall(p)) for p in t.pieces(text)) == 50


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "word")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert 0 <= t.score(docs, t.fit(docs, none)).first()["score"] < 0.5
    assert t.score(docs.where("false"), t.fit(docs, none)).collect() == []


def test_calibration_counts_every_hit(spark):
    texts = [(i, toxic(60) if i % 2 else calm(60), i % 2) for i in range(600)]
    texts += [(1000 + i, ("idiot" + " quiet" * 60 + " ") * 200, 0) for i in range(6)]
    docs = spark.createDataFrame([(i, x) for i, x, _ in texts], "doc_id long, text string")
    model = t.fit(docs, spark.createDataFrame([(i, y) for i, _, y in texts], "doc_id long, toxic int"))
    half = {r[0] for r in docs.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)) == 1).select("doc_id").collect()}
    read = [model.scored(x) for i, x, y in texts if i in half and not y]
    hits = [s for _, found in read for _, s in found]
    assert max(len(found) for _, found in read) > 64 and 0.05 < model.decay < 1
    rest = sum(n for n, _ in read) - len(hits)
    moment = sum(math.exp(model.decay * s) for s in hits) + rest * math.exp(model.decay * t.DRIFT)
    assert moment == pytest.approx(rest + len(hits), rel=1e-6)


def test_letters_that_grow_when_lower_cased():
    """Words are counted in the text itself, so a capital that lower-cases to two characters moves no passage."""
    model = t.Model({}, {"idiot": 6.0}, decay=0.9, k=0.1)
    for text in ("İstanbul İzmir fine idiot idiot idiot", "İ İ İ idiot IDIOT idiot İ"):
        evidence, kept = model.passages(text)
        (start, end, *_), = t._offsets(text, kept)
        assert evidence > 0 and text[start:end].lower().split() == ["idiot"] * 3


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "word", 7.0, "x")], "doc_id long, text string, score double, passages string")
    got = t.score(docs, t.Model())
    assert got.columns == ["doc_id", "text", "score", "passages"] and got.select("score").first()[0] == 0.5
