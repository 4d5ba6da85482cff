import hashlib

import pytest
from pyspark.sql import functions as F

from streamscreen.llm import fingerprints as f
from streamscreen.llm.queries import REGISTRY


def marks(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["m"] for r in df.select("i", f.as_text(f.fingerprint(F.col("t"))).alias("m")).sort("i").collect()]


PARTS = [f"paragraph {i} tells of matter {i * 7}." for i in range(30)]


def test_order_does_not_matter_and_content_does(spark):
    own = "\n".join(PARTS)
    m = marks(spark, [own, "\n".join(reversed(PARTS)), own + "\n" + PARTS[0], own.replace("matter 7.", "matter 8."), None, "", " \n", own])
    assert m[0] == m[1] == m[7] and len({m[0], m[2], m[3]}) == 3 and m[4] == m[5] == m[6] == "0:"


def test_insert_and_delete(spark):
    a, b = "\n".join(PARTS[:20]), "\n".join(PARTS[20:] + PARTS[:1])
    row = spark.createDataFrame([(a, b, a + "\n" + b)], "a string, b string, ab string").select(
        *[f.fingerprint(F.col(c)).alias(c) for c in ("a", "b", "ab")]).select(
        "a", "ab", f.combined(F.col("a"), F.col("b")).alias("plus"), f.combined(F.col("ab"), F.col("b"), -1).alias("minus")).first()
    assert row["plus"] == row["ab"] and row["minus"] == row["a"]


def test_likeness_follows_the_share_of_common_pieces(spark):
    pairs = [(PARTS, PARTS), (PARTS, PARTS[:20] + [f"other {i}" for i in range(10)]), (PARTS, [f"other {i}" for i in range(30)]), ([], []),
             ([f"line {i}" for i in range(2000)], [f"line {i}" for i in range(1500)] + [f"new {i}" for i in range(500)])]
    df = spark.createDataFrame([(i, "\n".join(a), "\n".join(b)) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in df.select("i", f.fingerprint(F.col("a")).alias("a"), f.fingerprint(F.col("b")).alias("b")).sort("i").select(
        f.likeness(F.col("a"), F.col("b"))).collect()]
    assert got[0] == got[3] == 1.0 and abs(got[1] - 0.5) < 0.1 and got[2] < 0.05 and abs(got[4] - 0.6) < 0.08


@pytest.mark.parametrize("rows_a_range", [4000, 7, 1])
def test_next_texts(spark, monkeypatch, tmp_path, rows_a_range):
    monkeypatch.setattr(f, "ROWS_A_RANGE", rows_a_range)
    texts = {i * i - 30: f"text {i} " * (i % 9) for i in range(60)} | {5_000: None, 6_000: "é😀" * 40}
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, next_text string").write.parquet(
        f"{path}/documents.parquet")
    got = {r["doc_id"]: r for r in REGISTRY["op8_document_fingerprints"](spark, path).collect()}
    ids = sorted(texts, reverse=True)
    assert len(got) == len(ids)
    for k, i in enumerate(ids):
        own, after = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        third = len(own) // 3
        edit = own[:len(own) - third] + after[:third]
        assert got[i]["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest() and got[i]["n_chars"] == len(own)
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1


def test_repeated_single_and_no_rows(spark):
    schema = "doc_id long, text string"
    twice = f.edited(spark.createDataFrame([(1, "abcdef"), (1, "abcdef"), (0, "uvwxyz"), (None, "q")], schema)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["edited_text"]) for r in twice) == [
        (False, 0, "uvwxq"), (False, 1, "abcdab"), (False, 1, "abcduv"), (True, 0, "q")]
    assert [r["next_text"] for r in f.edited(spark.createDataFrame([(1, "abcdef")], schema)).collect()] == ["abcdef"]
    assert f.edited(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("n", [12_000, 50_000])
def test_likeness_of_long_texts(spark, n):
    own, other = [f"line {i}" for i in range(n)], [f"other {i}" for i in range(n)]
    pairs = [(own, own[:n - n // 3] + other[:n // 3]), (own, other), (own, own[1:] + other[:1])]
    df = spark.createDataFrame([(i, "\n".join(a), "\n".join(b)) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    marked = df.select("i", f.fingerprint(F.col("a")).alias("a"), f.fingerprint(F.col("b")).alias("b"))
    got = [r[0] for r in marked.sort("i").select(f.likeness(F.col("a"), F.col("b"))).collect()]
    assert abs(got[0] - 0.5) < 0.06 and got[1] < 0.06 and 0.999 < got[2] < 1
    undone = marked.where("i = 0").select(f.combined(f.combined(F.col("a"), F.col("b")), F.col("b"), -1) == F.col("a"))
    assert undone.first()[0]


def test_marks_of_a_sentence_end_alone_are_pieces(spark):
    m = marks(spark, ["", "!!!!", "...", "abc", "!!!\nabc", " !!! \nabc", "a ...\n!"])
    assert len(set(m)) == 6 and m[4] == m[5] and m[0] == "0:" and m[1][:2] == m[2][:2] == "1:" and m[6][:2] == "2:"


def test_texts_with_equal_lanes_differ_in_the_second_sum(spark):
    rows = spark.createDataFrame([("one", "two\nsix\none")], "a string, b string").select(
        *[f.fingerprint(F.col(c)).alias(c) for c in "ab"])
    # As if the first hashes of both texts collided.
    forged = F.struct(F.col("a.pieces").alias("pieces"), F.col("b.sum").alias("sum"), F.col("a.lanes").alias("lanes"))
    texts = rows.select(f.as_text(F.col("a")), f.as_text(forged), F.col("a.sum"), F.col("b.sum"),
                        f.combined(F.col("b"), F.col("a"), -1)["sum"]).first()
    assert texts[0] != texts[1] and texts[2] != texts[3] and (texts[2] + texts[4] - texts[3]) % 2**64 == 0
