"""SentencePiece encoding and decoding with a shared-prefix Viterbi search.

Spaces are marked, and a text falls into marked words, which no piece crosses. The distinct words of a batch that
are new to the worker are sorted, which is a trie walked depth-first: a word keeps the forward states of the prefix it shares
with the word before it and extends them one character at a time, along a trie of the pieces. A state holds the last
piece of the best segmentation that ends there, so the best path is read off backwards.

What "best" means is the model file's business:

- unigram: the largest sum of piece scores, the ordinary Viterbi recursion;
- BPE: the segmentation that merging by rank gives. It obeys the same recursion with a yes/no score: the segmentation of a
  prefix, without its last piece, is that of a shorter prefix, and neighbours u, t stand side by side if and only if merging
  the text of u followed by t gives just u, t. The largest sum of scores would not be what the model's
  own library returns; this is.

Characters without a piece become byte pieces (or the unknown piece). Decoding joins pieces, puts bytes together and turns marks
into spaces.

The model file is read on the driver and broadcast (its size is checked); files with a normaliser other than identity are refused.

Defined results: a null or empty text has no pieces; a literal mark character in a text reads back as a space, as
in the model's own library; repeated rows give repeated results; an empty table gives no rows; other columns are kept; a table with
columns of the new names is refused. A word, however long, is one path; texts are taken whole.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from streamscreen.llm.common import remembered

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_MODEL_BYTES = 64 << 20
MARK = "▁"
UNIGRAM, BPE = 1, 2
#: Kinds of piece in a model file (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
#: Entries that a worker remembers before it forgets them all.
MAX_WORDS, MAX_PAIRS = 300_000, 400_000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol buffer message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 1:
            value, at = data[at:at + 8], at + 8
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        elif kind == 5:
            value, at = struct.unpack("<f", data[at:at + 4])[0], at + 4
        else:
            raise ValueError(f"field kind {kind}")
        yield key >> 3, value


@dataclass
class Vocabulary:
    """The pieces of a model file and the encoder over them."""

    texts: list[str]
    scores: list[float]
    kinds: list[int]
    model_type: int
    dummy_prefix: bool

    @staticmethod
    def parse(data: bytes) -> Vocabulary:
        texts, scores, kinds, model_type, dummy = [], [], [], UNIGRAM, True
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                texts.append(piece.get(1, b"").decode())
                scores.append(piece.get(2, 0.0))
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                model_type = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                rules = dict(_fields(value))
                dummy = bool(rules.get(3, 1))
                if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("only files with the identity normaliser are read")
        if model_type not in (UNIGRAM, BPE):
            raise ValueError(f"model type {model_type}: unigram or BPE")
        return Vocabulary(texts, scores, kinds, model_type, dummy)

    def __post_init__(self):
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds, strict=True)) if k in (NORMAL, USER)}
        self.bytes = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.texts, self.kinds, strict=True)) if k == BYTE}
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        self.unknown_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        #: Pieces as a trie of dicts; the key "" holds the id of the piece that ends there.
        self.trie: dict = {}
        for text, i in self.ids.items():
            node = self.trie
            for c in text:
                node = node.setdefault(c, {})
            node[""] = i
        crossing = any(MARK in t.lstrip(MARK) for t in self.ids)
        alone = "" if any("\n" in t for t in self.ids) else "\n"
        #: A marked word; a line break is one by itself where no piece holds it.
        self.word = re.compile(r"(?s).+" if crossing else rf"{MARK}*[^{MARK}{alone}]+|{MARK}+" + ("|\n" if alone else ""))
        self.raw = [bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else
                    " ⁇ ".encode() if k == UNKNOWN else t.encode()
                    for t, k in zip(self.texts, self.kinds, strict=True)]
        self.known: dict[str, bytes] = {}
        #: (piece before + 1) * number of pieces + piece -> whether the piece stands there
        self.beside: dict[int, bool] = {}

    # Segmentation ------------------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Merging by score, leftmost first among equals: the definition, for short texts."""
        parts = list(text)
        while True:
            best = None
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best[0]):
                    best = (self.scores[i], k)
            if best is None:
                return parts
            k = best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    def stands(self, before: int, piece: int) -> bool:
        """Whether ``piece`` stays whole after ``before`` (-1: a beginning or a character without a piece)."""
        key = (before + 1) * len(self.texts) + piece
        known = self.beside.get(key)
        if known is None:
            if len(self.beside) >= MAX_PAIRS:
                self.beside.clear()
            parts = [self.texts[i] for i in (before, piece) if i >= 0]
            known = self.beside[key] = self.merged("".join(parts)) == parts
        return known

    def segment(self, words: list[str]) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
        """Each of the sorted ``words`` with its pieces as (id or -1, begin, end)."""
        unigram, trie = self.model_type == UNIGRAM, self.trie
        scores, stands, beside, size = self.scores, self.stands, self.beside, len(self.texts)
        # States of the prefixes of the last word, by length: pieces begun and not ended (begin, node), last piece (id, begin), score.
        begun: list[list] = [[]]
        last: list[tuple[int, int]] = [(-1, 0)]
        forward: list[float] = [0.0]
        previous = ""
        for word in words:
            shared, limit = 0, min(len(word), len(previous))
            while shared < limit and word[shared] == previous[shared]:
                shared += 1
            del begun[shared + 1:], last[shared + 1:], forward[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                c = word[end - 1]
                going, chosen, best = [], None, -float("inf")
                for begin, node in (*begun[-1], (end - 1, trie)):  # longest piece first
                    node = node.get(c)
                    if node is None:
                        continue
                    going.append((begin, node))
                    piece = node.get("")
                    if piece is None:
                        continue
                    if unigram:
                        if (score := forward[begin] + scores[piece]) > best:
                            chosen, best = (piece, begin), score
                    elif chosen is None:
                        before = last[begin][0]
                        fits = beside.get((before + 1) * size + piece)
                        if stands(before, piece) if fits is None else fits:
                            chosen, best = (piece, begin), 0.0
                if unigram and trie.get(c, {}).get("") is None and (score := forward[end - 1] + self.unknown_score) > best:
                    chosen, best = (-1, end - 1), score
                begun.append(going)
                last.append(chosen or (-1, end - 1))
                forward.append(best if chosen else forward[-1] + self.unknown_score)
            path, end = [], len(word)
            while end:
                piece, begin = last[end]
                path.append((piece, begin, end))
                end = begin
            yield word, path[::-1]
            previous = word

    def learn(self, words: set[str]) -> None:
        """Remember the pieces of words, as little-endian 32-bit ids."""
        for word, path in self.segment(sorted(words)):
            ids = array("i")
            for piece, begin, end in path:
                if piece >= 0:
                    ids.append(piece)
                elif self.bytes:
                    ids.extend(self.bytes[b] for b in word[begin:end].encode("utf-8", "surrogatepass"))
                else:
                    ids.append(self.unknown)
            self.known[word] = ids.tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        prefix = MARK if self.dummy_prefix else ""
        split = [self.word.findall(prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) >= MAX_WORDS:
            self.known.clear()
        new: set[str] = set()
        for words in split:
            new.update(words)
        self.learn(new.difference(self.known))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype=np.int32) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def _vocabulary(data: bytes) -> Vocabulary:
    """One for each Python worker, with what it remembers."""
    return remembered(("pieces", hash(data)), lambda: Vocabulary.parse(data))


def _shared_model(df: DataFrame, path: str):
    with open(path, "rb") as file:
        data = file.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MAX_MODEL_BYTES} bytes")
    return df.sparkSession.sparkContext.broadcast(data)


def _mapped(df: DataFrame, added: list[T.StructField], make) -> DataFrame:
    """``df`` with the columns that ``make(batch)`` returns, a part of a batch at a time."""
    clash = {f.name.lower() for f in added} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"the table has columns named {sorted(clash)}")
    names = [f.name for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, max(whole.num_rows, 1), 250):
                batch = whole.slice(at, 250)
                yield pa.RecordBatch.from_arrays([*batch.columns, *make(batch)], [*batch.schema.names, *names])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added]))


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` with ids (array<int>), n_pieces, and restored: whether decoding the ids gives the text again."""
    model = _shared_model(docs, path)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        vocabulary = _vocabulary(model.value)
        texts = batch.column("text").to_pylist()
        ids = vocabulary.encode(texts)
        lengths = np.array([len(i) for i in ids], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        values = np.concatenate([*ids, np.empty(0, np.int32)])
        restored = [vocabulary.decode(i) == (t or "").replace(MARK, " ") for i, t in zip(ids, texts, strict=True)]
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(values)), pa.array(lengths), pa.array(restored, pa.bool_())]

    return _mapped(docs, [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()),
                          T.StructField("restored", T.BooleanType())], make)


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` with decoded: the text of its column ids (null: '')."""
    model = _shared_model(encoded, path)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        vocabulary = _vocabulary(model.value)
        return [pa.array([vocabulary.decode(np.array(i or [], dtype=np.int64)) for i in batch.column("ids").to_pylist()],
                         pa.string())]

    return _mapped(encoded, [T.StructField("decoded", T.StringType())], make)
