import random

import numpy as np

from streamscreen.llm import language

RNG = random.Random(5)
SYLLABLES = {"aa": ["ka", "to", "ri", "mu"], "bb": ["sch", "ung", "ein", "ker"], "cc": ["eau", "oux", "ille", "ment"]}


def prose(lang, n):
    return " ".join("".join(RNG.choice(SYLLABLES[lang]) for _ in range(RNG.randint(1, 4))) for _ in range(n)).capitalize() + "."


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_held_out_accuracy_and_defined_results(spark):
    learned = frame(spark, [(i, prose(lang, 30), lang, "x") for i, lang in enumerate(["aa"] * 60 + ["bb"] * 20 + ["cc"] * 10)]
                    + [(900, None, "aa", "x"), (901, prose("aa", 9), None, "x"), (902, "123", "bb", "x")])
    model = language.fit(language.training_passages(learned.drop("score")))
    assert model.languages == ["aa", "bb", "cc"]
    want = [(i, prose(lang, n), lang) for i, (lang, n) in enumerate((lang, n) for lang in SYLLABLES for n in (3, 20, 400))]
    odd = [(100, None, "und"), (101, "", "und"), (102, "12 !? 34", "und")]
    docs = frame(spark, [(i, t, "aa", "s") for i, t, _ in want + odd])
    got = {r["doc_id"]: r for r in language.predict(docs.drop("score"), model).collect()}
    assert {i: r["lang_pred"] for i, r in got.items()} == {i: lang for i, _, lang in want + odd}
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[100]["score"] == 0


def test_kernel_is_the_share_of_common_grams(spark):
    texts = [prose(lang, 12) for lang in SYLLABLES]
    model = language.fit([(t, lang) for t, lang in zip(texts, SYLLABLES, strict=True)])
    sets = [set(np.concatenate(list(language._grams(t))).tolist()) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert abs(model.kernel(texts)[i, j] - len(a & b) / np.sqrt(len(a) * len(b))) < 1e-5


def test_pieces_of_a_long_text_give_the_same_grams(monkeypatch):
    text = prose("bb", 300)
    whole = set(np.concatenate(list(language._grams(text))).tolist())
    monkeypatch.setattr(language, "PIECE", 37)
    assert set(np.concatenate(list(language._grams(text))).tolist()) == whole


def test_nothing_to_learn_from_and_no_rows(spark):
    empty = frame(spark, []).drop("score")
    model = language.fit(language.training_passages(empty))
    assert language.predict(frame(spark, [(1, "word", None, None)]).drop("score"), model).first()["lang_pred"] == "und"
    assert language.predict(empty, model).collect() == []


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "word", 7.0, "x")], "doc_id long, text string, score double, lang_pred string")
    got = language.predict(docs, language.fit([]))
    assert got.columns == ["doc_id", "text", "lang_pred", "score"] and got.select("lang_pred").first()[0] == "und"
