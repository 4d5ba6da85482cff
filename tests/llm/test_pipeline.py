import re

import pytest

import corpus_pipeline
from streamscreen.llm import pieces
from streamscreen.llm.common import table
from streamscreen.llm.queries import ORACLE, REGISTRY
from streamscreen.session import durable
from tests.llm.test_decontaminate import words
from tests.llm.test_near_duplicates import brute as brute_classes
from tests.llm.test_pii import brute as brute_spans

SMALL = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in REGISTRY) == list(range(1, 14))
    assert set(ORACLE) <= set(REGISTRY) and len(corpus_pipeline.STAGES) == 5


def test_run_matches_brute_force(spark):
    """Every stage against a plain form of it, on what the stage before kept."""
    docs = table(spark, SMALL, "documents")
    items = [words(r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = durable(stage(spark, docs, SMALL), "test")
        before, after = docs.collect(), made.collect()
        text = {r["doc_id"]: r["text"] for r in before}
        ids = {r["doc_id"] for r in after}
        if number < 4:
            assert made.columns == docs.columns
        if number == 0:
            bad = {r["doc_id"] for r in table(spark, SMALL, "labels").where("quality = 0").collect()}
            good = {r["doc_id"] for r in table(spark, SMALL, "labels").where("quality = 1").collect()}
            assert len(ids & bad) <= 0.1 * len(bad) and len(ids & good) >= 0.98 * len(good)
        elif number == 1:
            assert ids == {c for c, *_ in brute_classes(list(text.items())).values()}
        elif number == 2:
            windows = {tuple(w[i:i + 10]) for w in items for i in range(max(len(w) - 9, 1 if w else 0))}
            hit = {i for i, t in text.items() if any(tuple(own[k:k + len(w)]) == w for own in [words(t)] for w in windows for k in
                                                     ([] if w[0] not in own else range(len(own) - len(w) + 1)))}
            assert ids == set(text) - hit
        elif number == 3:
            assert ids == set(text)
            for r in after:
                want, at = "", 0
                for start, rank, end in brute_spans(text[r["doc_id"]]):
                    if start >= at:
                        want += text[r["doc_id"]][at:start] + ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")[rank]
                    at = max(at, end)
                assert r["text"] == want + text[r["doc_id"]][at:] and (r["n_chars"] == len(r["text"]))
        else:
            vocabulary = pieces.Vocabulary.parse(open(pieces.MODEL, "rb").read())
            assert all(vocabulary.decode(pieces.np.array(r["ids"])) == text[r["doc_id"]] and r["restored"] for r in after)
        docs = made


@pytest.fixture
def odd_tables(spark, tmp_path):
    """Null columns, empty and repeated rows, and an empty tables beside them."""
    schema = table(spark, SMALL, "documents").schema
    some = [tuple(r) for r in table(spark, SMALL, "documents").limit(5).collect()]
    rows = [*some, some[0], (None, None, None, None, None), (10_001, "", None, "s", 0), (10_002, None, "en", None, None), (None, "a@b.cd text", "en", "s", 11)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/t/documents.parquet")
    for name in ("benchmark", "labels", "conversations"):
        table(spark, SMALL, name).where("false").write.parquet(f"{tmp_path}/t/{name}.parquet")
    # As many vectors as documents: op11 has a row for each of them.
    vectors = [(i, [float(i % 3 + k) for k in range(8)], i % 2 or None) for i in range(len(rows))]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/t/embeddings.parquet")
    return f"{tmp_path}/t"


def test_odd_tables(spark, odd_tables):
    rows = table(spark, odd_tables, "documents").count()
    for name, query in REGISTRY.items():
        got = query(spark, odd_tables).collect()
        if name.startswith("op4"):
            assert [r["conv_id"] for r in got] == [-1]
        elif name.startswith("op5"):
            assert len(got) == len({r["doc_id"] for r in table(spark, odd_tables, "documents").collect()})
        elif name.startswith("op12"):
            assert got == [], "there are no items to search for"
        elif not name.startswith("op10"):
            assert len(got) == rows, name
    ends = corpus_pipeline.run(spark, odd_tables).collect()
    assert all(r["restored"] for r in ends) and len(ends) < rows


def test_empty_documents(spark, odd_tables, tmp_path):
    for name in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        table(spark, odd_tables, name).where("false").write.parquet(f"{tmp_path}/e/{name}.parquet")
    for name, query in REGISTRY.items():
        assert len(query(spark, f"{tmp_path}/e").collect()) == (1 if name.startswith("op4") else 0), name
    assert corpus_pipeline.run(spark, f"{tmp_path}/e").collect() == []
