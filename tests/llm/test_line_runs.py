import random
from collections import Counter

import pytest

from streamscreen.llm import line_runs as lr
from streamscreen.session import new_path
from tests.conftest import rows

DICE = random.Random(13)
LINES = ["", "  ", "Terms apply.", " terms APPLY.\t", "Ärger", "ärger", "\x0bend\r", "日本", *[f"line {i}" for i in range(40)]]
DOCS = [(i, "\n".join(DICE.choice(LINES) for _ in range(DICE.randint(1, 12)))) for i in range(120)] + [
    (200, None), (201, ""), (202, "\n"), (203, "\n\nTERMS apply.\n"), (None, "line 1\nown"), (5, "line 2\nmine"), (5, "line 2\nmine"),
    (204, "terms apply.\nrare\n" * 2000 + "last")] + [(300 + i, "copied\nbody") for i in range(25)]


def keys(text):
    lines = (text or "").split("\n")
    return lines, ["".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r")) for line in lines]


def brute(docs, min_docs=10, min_chars=1):
    seen = Counter(k for _, t in docs for k in set(keys(t)[1]) if len(k) >= min_chars)
    made = []
    for i, t in docs:
        lines, own = keys(t)
        kept = [line for line, k in zip(lines, own, strict=True) if len(k) < min_chars or seen[k] < min_docs]
        made.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(made, key=repr)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, keys string, n_lines int").repartition(3)


@pytest.mark.parametrize("settings", [{}, {"min_docs": 3}, {"min_chars": 7}, {"batches": 1}, {"batches": 11, "fan": 2}])
def test_texts_match_brute_force(spark, settings):
    made = lr.deduplicate_lines(frame(spark, DOCS), **settings)
    own = {k: v for k, v in settings.items() if k.startswith("min")}
    assert rows(made, "doc_id", "text", "n_lines", "n_dropped") == brute(DOCS, **own)
    assert set(made.columns) == {"doc_id", "text", "keys", "n_lines", "n_dropped"}


def test_frequent_keys_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lr, "join_counted", lambda left, right, on, how: left.join(right.hint("merge"), on, how))
    assert rows(lr.deduplicate_lines(frame(spark, DOCS)), "doc_id", "text", "n_lines", "n_dropped") == brute(DOCS)


def test_empty(spark):
    assert lr.deduplicate_lines(frame(spark, DOCS).where("false")).collect() == []


def test_runs_are_levelled(spark):
    """Nine batches, three runs a level: every third makes a run of the next level, and buckets are merged without a shuffle."""
    path = new_path(spark, "runs")
    runs, shape = lr.LineRuns(spark, path, min_docs=4, fan=3, buckets=3), []
    for at in range(9):
        runs.add(frame(spark, DOCS[at::9]))
        shape.append([len(level) for level in runs.levels])
    assert shape == [[1], [2], [0, 1], [1, 1], [2, 1], [0, 2], [1, 2], [2, 2], [0, 0, 1]]
    assert "Exchange" not in runs.frequent()._jdf.queryExecution().executedPlan().toString()
    want = Counter(k for _, t in DOCS for k in set(keys(t)[1]) if k)
    assert runs.frequent().count() == sum(n >= 4 for n in want.values())
    runs.close()


def test_a_store_outlives_its_session(spark):
    """Opened again without its table in the catalog; a run that no manifest names does not count."""
    path = new_path(spark, "runs")
    first = lr.LineRuns(spark, path, min_docs=4, buckets=3)
    for at in range(4):
        first.add(frame(spark, DOCS[at::5]))
    before = sorted(map(tuple, first.frequent().collect()))
    first._write(first._merge([n for level in first.levels for n in level]))  # a job that died before naming it
    spark.sql(f"DROP TABLE {first._state['table']}")
    again = lr.LineRuns(spark, path)
    assert again.levels == first.levels and sorted(map(tuple, again.frequent().collect())) == before
    again.add(frame(spark, DOCS[4::5]))
    want = Counter(k for _, t in DOCS for k in set(keys(t)[1]) if k)
    assert again.frequent().count() == sum(n >= 4 for n in want.values())
    again.close()


def test_settled_keys_are_not_counted_again(spark):
    runs = lr.LineRuns(spark, new_path(spark, "runs"), min_docs=2, buckets=2)
    for _ in range(2):
        runs.add(frame(spark, [(1, "a\nb"), (2, "A\nc")]))
    newest = runs.levels[0][-1]
    assert runs._runs([newest]).count() == 2  # b and c; a is settled
    assert runs.frequent().count() == 3
