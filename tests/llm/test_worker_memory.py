import gc
import weakref

import pyarrow as pa

import corpus_pipeline
from streamscreen.llm import near_duplicates as nd
from streamscreen.llm import pieces
from streamscreen.session import ARROW_ROWS

TEXTS = ["one two three four five six seven", "one two three four five six seven", "eight nine ten"]


def test_a_worker_forgets_the_vocabulary_when_the_join_begins():
    with open(pieces.MODEL, "rb") as file:
        data = file.read()
    vocabulary = weakref.ref(pieces._vocabulary(data))
    assert pieces._vocabulary(data) is vocabulary()
    nd.gram_set(TEXTS[0])
    gc.collect()
    assert vocabulary() is None


def test_verification_leaves_no_words_in_the_worker():
    class Members:
        def groupBy(self, *columns):
            return self

        def applyInArrow(self, run, schema):
            return run

    found = nd._verified(Members(), 5, 0.8)(pa.table(
        {"root": [1, 1, 1], "node": [1, 2, 3], "block": [0, 0, 0], "copies": [1, 1, 1], "text": TEXTS})).to_pylist()
    assert found == [{"node": n, "parent": 1, "linked": 1, "linked_docs": 1} for n in (1, 2)]
    assert not nd._words()


def test_texts_reach_the_workers_in_small_batches(spark, monkeypatch):
    own, seen = spark.conf.get(ARROW_ROWS), {}

    def noted(module):
        write = module.durable

        def durable(df, label="stage", **more):
            seen[label] = int(spark.conf.get(ARROW_ROWS))
            return write(df, label, **more)

        monkeypatch.setattr(module, "durable", durable)

    noted(nd)
    noted(corpus_pipeline)
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string")
    kept = nd.deduplicate(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]
    assert all(r["restored"] for r in corpus_pipeline.encode(spark, kept, "").collect())
    assert {seen[label] for label in ("near-scan", "near-links", "pipeline-pieces")} == {1000} and spark.conf.get(ARROW_ROWS) == own
