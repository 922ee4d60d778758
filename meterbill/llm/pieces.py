"""SentencePiece encoding and decoding: Aho-Corasick over the pieces, one Viterbi pass.

A text is segmented into the pieces with the greatest sum of scores.  An Aho-Corasick automaton over all pieces
reads the text once; at every position its output links name the pieces that end there, and each relaxes the best
score of that position.  Characters without a piece of their own are written as byte pieces, at a score below that
of any piece.  Of equal sums the longer last piece wins.

Pieces write a space as U+2581; here they are matched with real spaces, so that a U+2581 in a text is an ordinary
character (encoded as bytes), and ``decode(encode(text)) == text`` holds for every text.  As in the model, a space
is put before a text that is not empty, and taken off again when decoding.

A text is cut into units (spaces, then characters other than letters and digits, then letters and digits) where no piece
reaches over the cut, which the coder checks for its pieces (it takes longer units otherwise); so the best segmentation
is that of the units.  Each unit is solved once and kept in a bounded cache.  The model's pieces (a file of under 1 MB, read on the driver from ``model``) are broadcast.

Defined cases: NULL text gives NULL ids, an empty text no ids; texts are encoded whole; repeated rows get equal
ids; ids that are no piece and control ids decode to nothing, bytes that are no UTF-8 to U+FFFD; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterbill.llm.common import chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
LETTER = r"[^\W_²³¹]"
UNKNOWN_PENALTY = 10.0
CACHE_UNITS = 200_000


def read_pieces(model: str = MODEL) -> list[tuple[str | None, float, int]]:
    """(piece, score, byte value or -1) by id; piece is None for control, unknown and byte pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    out = []
    for i in range(sp.get_piece_size()):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            out.append((None, 0.0, int(name[3:-1], 16)))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            out.append((None, 0.0, -1))
        else:
            out.append((name.replace(SPACE, " "), sp.get_score(i), -1))
    return out


class PieceCoder:
    """Encoder and decoder of one piece table; built once per task's process."""

    def __init__(self, pieces: list[tuple[str | None, float, int]], cache_units: int = CACHE_UNITS) -> None:
        self.auto = ahocorasick.Automaton()
        self.single: set[str] = set()
        self.byte = {}
        self.bytes_of: list[bytes] = []
        for i, (name, score, byte) in enumerate(pieces):
            self.bytes_of.append(bytes([byte]) if byte >= 0 else (name or "").encode())
            if byte >= 0:
                self.byte[byte] = i
            elif name:
                self.auto.add_word(name, (len(name), i, score))
                if len(name) == 1:
                    self.single.add(name)
        self.auto.make_automaton()
        names = [n for n, _, _ in pieces if n]
        self.unknown = min((s for n, s, _ in pieces if n), default=0.0) - UNKNOWN_PENALTY
        # units may be cut before a space and around a line end if no piece reaches over such a cut
        over_space = any(re.search(r"[^ ] ", n) for n in names)
        over_line = any("\n" in n for n in names)
        # likewise between a letter or digit and a character that is neither
        over_letter = any(re.search(rf"{LETTER}[^ \n\w]|{LETTER}[_²³¹]", n) for n in names)
        self.unit = re.compile(r"(?s).+" if over_space else r"(?s) *[^ ]+| +" if over_line else r"\n| *[^ \n]+| +" if over_letter
                               else rf"\n| *(?:[^\w \n]|[_²³¹])*{LETTER}*")
        self.cache: dict[str, bytes] = {}
        self.cache_units = cache_units

    def best(self, text: str) -> list[int]:
        """Ids of the best segmentation of ``text`` as it stands."""
        n = len(text)
        score = [0.0] + [float("-inf")] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        if self.single.issuperset(text):
            # pieces that end at a position come together, longest first, and all before it is settled
            for end, (size, i, s) in self.auto.iter(text):
                x = score[end + 1 - size] + s
                if x > score[end + 1]:
                    score[end + 1], back[end + 1] = x, (size, i)
        else:
            ends: list[list] = [[] for _ in range(n + 1)]
            for end, value in self.auto.iter(text):
                ends[end + 1].append(value)
            for e in range(1, n + 1):
                for size, i, s in ends[e]:
                    if score[e - size] + s > score[e]:
                        score[e], back[e] = score[e - size] + s, (size, i)
                if text[e - 1] not in self.single and score[e - 1] + self.unknown > score[e]:
                    score[e], back[e] = score[e - 1] + self.unknown, (1, -1)
        out: list[int] = []
        while n:
            size, i = back[n]
            if i < 0:
                out += [self.byte[b] for b in reversed(text[n - 1].encode())]
            else:
                out.append(i)
            n -= size
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as packed 32-bit integers."""
        if not text:
            return b""
        units = self.unit.findall(" " + text)
        cache = self.cache
        try:
            return b"".join(map(cache.__getitem__, units))
        except KeyError:
            pass
        out = []
        for u in units:
            got = cache.get(u)
            if got is None:
                got = np.array(self.best(u), np.int32).tobytes()
                if len(cache) >= self.cache_units:
                    cache.clear()
                if len(u) <= 64:
                    cache[u] = got
            out.append(got)
        return b"".join(out)

    def decode(self, ids) -> str:
        table, n = self.bytes_of, len(self.bytes_of)
        try:
            raw = b"".join(map(table.__getitem__, ids)) if not len(ids) or min(ids) >= 0 else None
        except IndexError:
            raw = None
        if raw is None:
            raw = b"".join(table[i] for i in ids if 0 <= i < n)
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


_HELD: dict[int, PieceCoder] = {}


def _held(shared) -> PieceCoder:
    """The coder of a broadcast piece table; a Python worker keeps it (and its cache) from task to task."""
    if shared.id not in _HELD:
        _HELD.clear()
        _HELD[shared.id] = PieceCoder(shared.value)
    return _HELD[shared.id]


class _Shared:
    """A broadcast and its id."""

    def __init__(self, spark: SparkSession, model: str) -> None:
        self.data = spark.sparkContext.broadcast(read_pieces(model))
        self.id = hash((model, id(self.data)))

    @property
    def value(self):
        return self.data.value


def _lists(packed: list[bytes | None]) -> pa.Array:
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 if p else 0 for p in packed], out=offsets[1:])
    values = np.frombuffer(b"".join(p for p in packed if p), np.int32)
    mask = pa.array([p is None for p in packed], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()), mask=mask)


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids (array of int), round_trip (decoding gives the text back), one row per document."""
    shared = _Shared(docs.sparkSession, model)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        coder = _held(shared)
        for piece in chunks(batches):
            texts = piece.column(1).to_pylist()
            ids = [None if t is None else coder.encode(t) for t in texts]
            same = [t is None or coder.decode(np.frombuffer(p, np.int32).tolist()) == t for t, p in zip(texts, ids)]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([None if p is None else len(p) // 4 for p in ids], pa.int32()), _lists(ids),
                 pa.array(same, pa.bool_())], names=["doc_id", "n_tokens", "ids", "round_trip"])

    return plain.mapInArrow(run, "doc_id long, n_tokens int, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text)."""
    shared = _Shared(encoded.sparkSession, model)
    plain = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))

    def run(batches):
        coder = _held(shared)
        for piece in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([None if i is None else coder.decode([x for x in i if x is not None])
                                            for i in piece.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return plain.mapInArrow(run, "doc_id long, text string")
