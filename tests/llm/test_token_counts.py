import base64

import tiktoken

from streamscreen.llm import token_counts as tc
from tests.conftest import rows


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string, n_docs int")


def lengths(texts):
    with open(tc.RANKS, "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in file)}
    encode = tiktoken.Encoding("own", pat_str=tc.WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return [len(encode(t or "")) for t in texts]


TEXTS = ["", None, "one two", "one two", "a <|endoftext|> b", "Größe çä 日本", "long " * 3000, "x" * 5000, "tie a b", "tie b a"]


def test_totals_match_brute_force(spark):
    got = tc.token_totals(frame(spark, TEXTS)).collect()
    own = lengths(TEXTS)
    assert sorted(r["n_tokens"] for r in got) == sorted(set(own))
    for r in got:
        limit = r["n_tokens"]
        assert r["n_docs"] == own.count(limit)
        assert r["docs_upto"] == sum(n <= limit for n in own) and r["docs_longer"] == sum(n > limit for n in own)
        assert r["tokens_upto"] == sum(n for n in own if n <= limit)
        assert r["truncated_tokens"] == sum(min(n, limit) for n in own)
        assert abs(r["quantile"] - sum(n <= limit for n in own) / len(own)) < 1e-12


def test_blocks_and_any_limit(spark):
    histogram = spark.createDataFrame([(0, 3), (4, 2), (5, 1), (9, 4), (30, 1)], "n_tokens long, n_docs long")
    own = [0] * 3 + [4] * 2 + [5] + [9] * 4 + [30]
    totals = tc.limit_totals(histogram, block=4)
    assert rows(totals) == rows(tc.limit_totals(histogram))
    for limit in (0, 1, 4, 7, 9, 29, 30, 100):
        one = tc.truncated_total(totals, limit).first()
        assert one["truncated_tokens"] == sum(min(n, limit) for n in own)
        assert one["docs_longer"] == sum(n > limit for n in own)
    for q in (0.01, 0.27, 0.5, 0.9, 1.0):
        assert tc.length_quantile(totals, q).first()[0] == next(
            n for n in sorted(own) if sum(m <= n for m in own) / len(own) >= q)


def test_empty_table(spark):
    assert tc.token_totals(frame(spark, []).where("false")).collect() == []
