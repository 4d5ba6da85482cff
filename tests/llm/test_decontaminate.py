import random
import re

import pytest

from streamscreen.llm import decontaminate as d
from tests.conftest import rows

RNG = random.Random(3)
VOCABULARY = ["the", "Of", "größe", "ÉTÉ", "x1", "日本", "İstanbul", "K", "end"]


def said(n):
    return RNG.choice([" ", ", ", "\n"]).join(RNG.choice(VOCABULARY) for _ in range(n))


ITEMS = [(1, said(14)), (2, said(10)), (3, "Two Words"), (4, ""), (5, None), (6, "!!"), (7, said(25)), (7, said(25)), (30, "two words")]
DOCS = [(0, None), (1, ""), (2, "..."), (3, ITEMS[0][1]), (4, "a " + re.sub("[a-z]", lambda m: m[0].upper(), ITEMS[1][1]) + " b"), (5, said(400)),
        (6, "two, words two words"), (6, "two, words two words"), (7, "É" + ITEMS[0][1] + " " + ITEMS[6][1]),
        (8, ITEMS[7][1] + " and " + ITEMS[7][1]), (None, "so two words"), (9, "w " * 30_000 + ITEMS[1][1])]


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text):
    own, hit, items = words(text), set(), set()
    for item, said_ in ITEMS:
        w = words(said_)
        n = min(10, len(w))
        for i in range(max(len(w) - n + 1, 1) if w else 0):
            for j in range(len(own) - n + 1):
                if own[j:j + n] == w[i:i + n]:
                    hit.update(range(j, j + n))
                    items.add(str(item))
    return len(own), len(hit), sorted(items), hit


def tables(spark):
    docs = spark.createDataFrame([(i, t, "de", 5, "y") for i, t in DOCS], "doc_id long, text string, words string, n_words int, item_id string")
    return docs, spark.createDataFrame([(i, t, "z") for i, t in ITEMS], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("limits", [{}, {"max_passages": 7}, {"max_bytes": 400}])
def test_hits_match_brute_force(spark, limits):
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in d.contamination(*tables(spark), **limits).collect()}
    assert got == {i: brute(t)[:3] for i, t in DOCS}


def test_documents_are_read_once_and_no_words_are_shuffled(spark):
    docs, items = tables(spark)
    windows = d.benchmark_windows(items)
    plan = d.hits(docs, windows, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1
    # The only exchanges are those of the relation.
    above = plan[:plan.index("BroadcastExchange")]
    assert "Exchange" not in above
    many = d.hits(docs, windows, ["doc_id"], max_passages=7)._jdf.queryExecution().executedPlan().toString()
    assert many.count("BroadcastHashJoin") == -(-windows.select("passage").distinct().count() // 7)


def test_items_without_an_id_mark_words_but_are_not_listed(spark):
    items = spark.createDataFrame([(None, "two words"), (8, "two words more")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "say two words"), (2, "two words more")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["items"]) for r in d.contamination(docs, items).collect()}
    assert got == {1: (2, 0, []), 2: (3, 1, ["8"])}


def test_one_passage_of_many_items(spark):
    items = spark.range(3000).selectExpr("id AS item_id", "'an opening that all of them share' AS text")
    docs = spark.createDataFrame([(1, "an opening that all of them share"), (2, "none")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in d.contamination(docs, items).collect()}
    assert got == {1: (7, 3000), 2: (0, 0)}


def test_documents_mode_drops_hit_documents(spark):
    docs, items = tables(spark)
    clean = [i for i, t in DOCS if not brute(t)[1]]
    assert 0 in clean and 4 not in clean
    assert rows(d.clean(docs, items)) == rows(docs.where(docs.doc_id.isin(clean)))


def test_spans_mode_takes_out_hit_words(spark):
    docs, items = tables(spark)
    docs = docs.withColumnRenamed("n_words", "n_chars")
    got = d.clean(docs, items, "spans")
    assert got.columns == docs.columns
    for i, text, n in got.select("doc_id", "text", "n_chars").collect():
        before = next(t for j, t in DOCS if j == i)
        hit = brute(before)[3]
        assert words(text) == [w for k, w in enumerate(words(before)) if k not in hit]
        assert text == before if not hit else n == len(text)
    with pytest.raises(ValueError):
        d.clean(docs, items, "other")


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert d.contamination(docs.where("false"), items).collect() == []
    assert all(r["n_hit"] == 0 for r in d.contamination(docs, items.where("false")).collect())


def test_words_do_not_depend_on_what_stands_around_them(spark):
    items = spark.createDataFrame([(1, "Α.Σ. ΠΑΟΚ"), (2, "ΟΔΟΣ.ΑΘΗΝΑ x"), (3, "οδος")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Α.Σ. ΠΑΟΚ"), (2, "say ΟΔΟΣ.ΑΘΗΝΑ X"), (3, "say ΟΔΟΣ")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in d.contamination(docs, items).collect()}
    assert got == {1: (3, 3, ["1"]), 2: (4, 3, ["2"]), 3: (2, 0, [])}
    assert [r["doc_id"] for r in d.clean(docs, items).collect()] == [3]
