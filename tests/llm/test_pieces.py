import random
from itertools import pairwise

import pytest
import sentencepiece

from streamscreen.llm import pieces

RNG = random.Random(6)
TEXTS = [None, "", " ", "  two  spaces\n\n\ttab", "▁literal mark", "日本語 😀😀 é ﬁ ①", "x" * 3000, "=" * 40, "word " * 4000, "tie tie", "tie tie",
         *("".join(RNG.choice("ab ▁the\n ingé日①😀.=-XY") for _ in range(RNG.randint(1, 60))) for _ in range(300))]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "k", 7) for i, t in enumerate(texts)], "doc_id long, text string, piece string, score int")


def test_ids_are_the_librarys_and_read_back(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    encoded = pieces.encode(frame(spark))
    assert encoded.columns == ["doc_id", "text", "piece", "score", "ids", "n_pieces", "restored"]
    for r in pieces.decode(encoded).collect():
        text = r["text"] or ""
        assert r["ids"] == library.encode(text) and r["n_pieces"] == len(r["ids"])
        assert r["decoded"] == library.decode(r["ids"]) == text.replace(pieces.MARK, " ") and r["restored"]


def small(model_type):
    words = ["a", "b", "c", "ab", "bc", "abc", "cab", "▁", "▁a", "▁ab", "ca"]
    scores = [-4.0, -4.5, -3.7, -5.2, -5.0, -9.9, -8.1, -2.0, -5.5, -6.0, -6.3]
    return pieces.Vocabulary(["<unk>", *words], [0.0, *scores], [pieces.UNKNOWN, *[pieces.NORMAL] * len(words)], model_type, True)


def cuts(word):
    """Every way to cut a word."""
    for mask in range(1 << (len(word) - 1)):
        at = [0, *[i + 1 for i in range(len(word) - 1) if mask >> i & 1], len(word)]
        yield [word[a:b] for a, b in pairwise(at)]


def words(alphabet, count=300):
    return sorted({"".join(RNG.choice(alphabet) for _ in range(RNG.randint(1, 9))) for _ in range(count)})


def test_unigram_paths_have_the_largest_sum():
    v = small(pieces.UNIGRAM)
    score = lambda p: v.scores[v.ids[p]] if p in v.ids else v.unknown_score if len(p) == 1 else -1e9
    for word, path in v.segment(words("abcx▁")):
        got = sum(v.scores[i] if i >= 0 else v.unknown_score for i, _, _ in path)
        assert "".join(word[b:e] for _, b, e in path) == word
        assert abs(got - max(sum(map(score, cut)) for cut in cuts(word))) < 1e-9


def test_bpe_paths_are_those_of_merging():
    v = small(pieces.BPE)
    for word, path in v.segment(words("abcx▁")):
        assert [word[b:e] for _, b, e in path] == v.merged(word)


def test_forgetting_changes_nothing(monkeypatch):
    v, w = small(pieces.BPE), small(pieces.BPE)
    monkeypatch.setattr(pieces, "MAX_WORDS", 2)
    monkeypatch.setattr(pieces, "MAX_PAIRS", 2)
    texts = words("abc ", 60)
    one = [i.tolist() for t in texts for i in v.encode([t])]
    assert one == [i.tolist() for i in w.encode(texts)]


def test_clashing_columns_and_empty_table(spark):
    with pytest.raises(ValueError):
        pieces.encode(frame(spark).withColumnRenamed("piece", "IDS"))
    assert pieces.encode(frame(spark, [])).collect() == []
