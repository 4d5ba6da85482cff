import random

import pytest

from streamscreen.llm import near_duplicates as nd
from streamscreen.llm.components import components
from tests.conftest import rows

RNG = random.Random(12)
WORDS = [f"w{i}" for i in range(400)]


def prose(n):
    return [RNG.choice(WORDS) for _ in range(n)]


def changed(words, k):
    out = list(words)
    for _ in range(k):
        out[RNG.randrange(len(out))] = RNG.choice(WORDS)
    return out


def texts():
    made, seed = [], prose(150)
    made += [" ".join(changed(seed, RNG.choice([0, 1, 1, 2, 3, 5]))) for _ in range(70)]  # a hot group of near copies
    made += ["Copy of the same text, seven words"] * 12 + ["copy of the SAME text: seven words."]
    for _ in range(20):
        own = prose(RNG.choice([30, 80, 300]))
        made += [" ".join(own), " ".join(changed(own, RNG.choice([1, 2, 6])))]
    made += [" ".join(prose(60)) for _ in range(30)]
    made += [None, "", "...", "one two", "one two", "one two three", " ".join(prose(6000))]
    RNG.shuffle(made)
    return list(enumerate(made))


def brute(docs):
    sets = {}
    for i, t in docs:
        w = nd._WORD.findall((t or "").lower())
        n = min(5, len(w))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    near = {i: set() for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if i != j and a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                near[i].add(j)
    label = {}
    for i in sorted(sets):
        reach, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        label[i] = min(reach)
    return {i: (label[i], min([j for j in sets if sets[j] == sets[i] and sets[i]] or [i]), len(near[i])) for i in sets}


@pytest.mark.parametrize("block", [nd.BLOCK, 9])
def test_links_and_classes_match_brute_force(spark, block):
    docs = texts()
    df = spark.createDataFrame([(i, t, 3, "b") for i, t in docs], "doc_id long, text string, node int, bands string")
    got = {r["doc_id"]: (r["class_id"], r["representative"], r["n_links"]) for r in nd.near_duplicates(df, block=block).collect()}
    assert got == brute(docs)
    kept = nd.deduplicate(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for c, *_ in got.values()}


def test_repeated_rows_null_ids_and_no_rows(spark):
    same = " ".join(prose(40))
    df = spark.createDataFrame([(1, same), (1, same), (2, same), (3, "other words here"), (3, "other words there"), (None, same), (None, same)],
                               "doc_id long, text string")
    got = nd.near_duplicates(df)
    assert rows(got) == sorted([(1, 1, 1, 1)] * 2 + [(2, 1, 1, 1)] + [(3, 3, 3, 0)] * 2 + [(None, None, None, 0)] * 2, key=repr)
    assert rows(nd.deduplicate(df)) == sorted(
        [(1, same), (3, "other words here"), (3, "other words there"), (None, same), (None, same)], key=repr)
    assert nd.near_duplicates(df.where("false")).collect() == []


def test_texts_of_one_id_are_told_apart(spark):
    """A text that is a copy of nothing stays, whatever else its id stands for."""
    x, y = "a text of its own", " ".join(prose(30))
    for first, second in ((x, y), (y, x)):
        df = spark.createDataFrame([(3, first, "p"), (3, second, "q"), (7, y, "r"), (7, y.upper(), "s"), (9, None, "t"), (9, "", "u")],
                                   "doc_id long, text string, least string")
        got = nd.deduplicate(df)
        assert got.columns == df.columns
        assert rows(got, "doc_id", "text")[:2] == sorted([(3, x), (3, y)], key=repr) and got.count() == 3
    # The class of the other text is not touched by a link of this one.
    df = spark.createDataFrame([(3, x), (3, y), (4, y + " more"), (5, x)], "doc_id long, text string")
    assert rows(nd.near_duplicates(df), "doc_id", "class_id", "n_links") == [(3, 3, 1), (3, 3, 1), (4, 3, 1), (5, 3, 1)]
    assert rows(nd.deduplicate(df)) == sorted([(3, x), (3, y)], key=repr)


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, per_band = nd.bands_and_rows(threshold, 0.999)
        assert 1 - (1 - threshold ** per_band) ** bands >= 0.999 and bands * per_band <= nd.MAX_HASHES
    with pytest.raises(ValueError):
        nd.bands_and_rows(0.01, 0.9999)


def test_components(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 300), (300, 250), (7, 7), (None, 3)] + [(500, 500 + k) for k in range(50)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(101)}, 200: 200, 300: 200, 250: 200, **{500 + k: 500 for k in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
