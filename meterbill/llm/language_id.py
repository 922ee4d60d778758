"""Language identification by compression.

A text is compressed once per language, each time with a zstandard raw-content dictionary made of texts of that
language; the language whose dictionary compresses it best is the prediction; sizes within ``TIE`` bytes are told apart by how
often the dictionaries hold the letter triples of the whole text.  Texts are reduced to lower-case
letters with single spaces (digits, marks and line ends say nothing about a language) and compressed in pieces of
``PIECE`` bytes, each against the fresh dictionary, so that a long text cannot become its own dictionary; the sizes
of all pieces count.  ``score`` is the share of the second-best size that the best one saves, scaled to 0..1; below
``MARGIN`` the prediction is marked as rejected (``confident`` false), which callers may read as unknown.

Learning: from rows with a text and a non-null language whose crc32(doc_id as text) mod 3 is not 1.  Each
language's dictionary is made of at most ``SLOTS`` documents (those with the least hash in each of ``SLOTS``
slots of hashed ids, ``SAMPLE_CHARS`` characters of each at most) and ``DICTIONARY`` bytes: a bounded, documented sample.  Every label is learned;
if there are over 200, each gets a smaller share (``shares``), so that what the driver holds stays bounded.

Defined cases: NULL text, or a text without Unicode letters (digits, fractions and superscripts are none), gives ``und`` with score 0; texts are read whole; repeated
rows get equal results; with no learnable row every text is ``und``; an empty table gives an empty result; extra
columns are ignored; language, source and id are never inputs of a prediction.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbill.llm.common import chunks

DICTIONARY = 96 * 1024
SLOTS = 64
SAMPLE_CHARS = 24 * 1024     # of a sampled document, at most
DICTIONARIES = 200 * DICTIONARY    # bytes of all dictionaries together; with over 200 languages each gets a smaller one
PIECE = 1024
LEVEL = 6
TIE = 3              # bytes within which sizes count as equal
MARGIN = 0.01
UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters_of(text: str | None) -> str:
    """Lower-case Unicode letters of a text, words apart by one space."""
    out = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if out and not out.replace(" ", "").isalpha():      # numbers that are no decimal digits, such as superscripts and fractions
        out = " ".join("".join(c if c.isalpha() else " " for c in out).split())
    return out


class CompressionClassifier:
    """Prepared dictionaries by language."""

    def __init__(self, samples: dict[str, list[str]], size: int = DICTIONARY, level: int = LEVEL) -> None:
        self.names, self.packers, self.triples = [], [], []
        for name in sorted(samples):
            texts = [letters_of(t) for t in samples[name]]
            share = max(256, size // max(1, len(texts)))
            # every document gives its share; what short ones leave is filled from the longer ones
            parts = [t.encode()[:share] for t in texts]
            spare = size - sum(map(len, parts))
            more = []
            for t in texts:
                if spare <= 0:
                    break
                extra = t.encode()[share:share + spare]
                more.append(extra)
                spare -= len(extra)
            data = b" ".join(p for p in more + parts if p)[-size:]
            if len(data) < 8:
                continue
            book = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            book.precompute_compress(level)
            self.names.append(name)
            padded = b" " + data + b" "
            self.triples.append(Counter(padded[i:i + 3] for i in range(len(padded) - 2)))
            self.packers.append(zstandard.ZstdCompressor(dict_data=book, write_checksum=False, write_content_size=False,
                                                         write_dict_id=False, level=level))

    def sizes(self, text: str) -> np.ndarray:
        """Compressed bytes of the letters of ``text`` by language, over all pieces."""
        data = text.encode()
        pieces = [data[a:a + PIECE] for a in range(0, len(data), PIECE)]
        return np.array([sum(len(p.compress(x)) for x in pieces) for p in self.packers], float)

    def matches(self, text: str, i: int) -> float:
        """How well the letter triples of the whole text are covered by dictionary i, for sizes that a few bytes decide."""
        data = f" {text} ".encode()
        found = Counter(data[a:a + 3] for a in range(len(data) - 2))
        return sum(n * math.log1p(self.triples[i][t]) for t, n in found.items())

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, confident)."""
        letters = letters_of(text)
        if not letters or not self.names:
            return UNKNOWN, 0.0, False
        if len(self.names) == 1:
            return self.names[0], 1.0, True
        sizes = self.sizes(letters)
        close = np.flatnonzero(sizes <= sizes.min() + TIE)
        best = int(close[0] if len(close) == 1 else max(close, key=lambda i: (self.matches(letters, i), -sizes[i])))
        second = float(np.delete(sizes, best).min())
        if second <= sizes[best]:
            return self.names[best], 0.0, False
        margin = float((second - sizes[best]) / second)
        return self.names[best], min(1.0, 4 * margin), margin >= MARGIN


def shares(languages: int, slots: int = SLOTS) -> tuple[int, int, int]:
    """(dictionary bytes, sampled documents, characters of each) of a language, so that all languages together stay bounded."""
    size = max(2048, min(DICTIONARY, DICTIONARIES // max(1, languages)))
    return size, max(4, slots * size // DICTIONARY), max(512, SAMPLE_CHARS * size // DICTIONARY)


def sample(docs: DataFrame, slots: int = SLOTS) -> dict[str, list[str]]:
    """The bounded training sample of every language.  The choice reads doc_id and lang only; then the chosen texts."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                        F.col("text").cast("string").alias("text"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    rows = named.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held, F.lit(False)))
    h = F.xxhash64(F.coalesce("doc_id", F.lit(-1)))
    _, slots, chars = shares(rows.select("lang").distinct().count(), slots)
    pick = rows.groupBy("lang", F.pmod(h, F.lit(slots)).alias("slot")).agg(F.min_by("doc_id", F.struct(h, F.length("text"))).alias("doc_id")) \
        .select("lang", "doc_id")
    texts = rows.join(F.broadcast(pick), ["lang", "doc_id"]) \
        .groupBy("lang", "doc_id").agg(F.max(F.substring("text", 1, chars)).alias("text"))
    out: dict[str, list[str]] = {}
    for r in texts.orderBy("lang", "doc_id").collect():
        out.setdefault(r.lang, []).append(r.text)
    return out


def identify(docs: DataFrame, samples: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, confident, one row per document; one pass over the texts.

    ``samples``: training texts by language, else those of ``sample(docs)``."""
    shared = docs.sparkSession.sparkContext.broadcast(sample(docs) if samples is None else samples)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out"))

    def run(batches):
        own = CompressionClassifier(shared.value, shares(len(shared.value))[0])
        for piece in chunks(batches):
            names, scores, sure = zip(*[own.predict(t) for t in piece.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "confident"])

    return plain.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, confident boolean")
