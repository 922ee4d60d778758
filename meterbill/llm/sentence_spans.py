"""Substring deduplication by sliding sentence spans.

A text is cut into sentences: at line ends, after ``.``, ``!`` or ``?`` (and closing quotes or brackets) before white space, and after
the full stops of scripts without spaces.  From every sentence a span runs over several consecutive sentences: the shortest run of
at least ``SPAN`` sentences and ``WORDS`` words, or of two sentences and ``PAIR_WORDS`` words.  The spans of all documents
are joined by hash; every occurrence but the first (smallest doc_id, then position) is repeated, and all sentences
that a repeated span covers are removed, whole.  Shared lines and single sentences are left alone.  Only a run-on sentence of over
``RUN_ON`` words (a list, a table, prose without stops) is taken in pieces, cut after words whose hash is a multiple of ``CUT``
and else every ``PIECE`` words, the same wherever it stands: a long passage without full stops thus has several units too.

Words are compared with A-Z lower-cased and without ASCII punctuation, so spacing, case and marks hide no repeat; in
scripts without spaces every character is a word.  Spans are equal if 128 bits agree: a hash of their words' hashes and a second, of
another family, over their words' bytes (at 5e12 spans some 4e-14 false matches are expected).

Scale: spans are computed once and written; they are reduced per hash by partial aggregates, and the hashes of several documents then meet
their spans in an equi-join with one row per hash on one side, which AQE splits for a passage that a third of all rows share.

Defined cases: NULL text stays NULL and an empty text empty; repeats inside a row count; rows with an equal doc_id are one
document, not deduplicated against each other (repeated rows so get equal results), and rows with a NULL doc_id are
one nameless document that comes last; a text of fewer sentences or words than a span is left alone; texts are read whole; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbill.llm.common import chunks, map_chunks, stored
from meterbill.llm.decontaminate import MARKS, UNSPACED
from meterbill.llm.wordhash import PLAIN, SPACE, run_hashes, words_at

SPAN = 3
WORDS = 20
PAIR_WORDS = 40
RUN_ON = 50
PIECE = 12
CUT = 4
SEED = 7
STOP, CLOSING = np.zeros(256, bool), np.zeros(256, bool)
STOP[[ord(c) for c in ".!?"]] = True
CLOSING[[ord(c) for c in "\"')]}"]] = True
FULL_STOPS = ("\u3002", "\uff01", "\uff1f", "\uff61")    # of scripts without spaces


def spaced(text: str) -> tuple[str, np.ndarray | None]:
    """The text with every character of scripts without spaces as a word of its own, and for every
    byte of it the byte of the text it stands for (None: the same)."""
    if text.isascii() or not (UNSPACED.search(text) or MARKS.search(text)):
        return text, None
    parts, origin, at, byte = [], [], 0, 0
    for m in sorted([*UNSPACED.finditer(text), *MARKS.finditer(text)], key=lambda m: m.start()):
        size = len(text[at:m.start()].encode("utf-8", "surrogatepass"))
        own = len(m[0].encode("utf-8"))
        full = m[0] in FULL_STOPS
        parts += [text[at:m.start()], ". " if full else " " if MARKS.fullmatch(m[0]) else f" {m[0]} "]
        origin.append(np.arange(byte, byte + size))
        byte += size
        mark = len(parts[-1]) if parts[-1].isascii() else 0
        origin.append(np.full(mark, byte) if mark else np.concatenate(([byte], np.arange(byte, byte + own), [byte + own])))
        byte += own
        at = m.end()
    parts.append(text[at:])
    origin.append(np.arange(byte, byte + len(parts[-1].encode("utf-8", "surrogatepass")) + 1))
    return "".join(parts), np.concatenate(origin)


def units(text: str | None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, tuple[bytes, np.ndarray]]:
    """(text as bytes, byte at which each unit starts, index of each unit's first word, word hashes,
    (the words, a space after each; byte at which each starts))."""
    text = text or ""
    wide, origin = spaced(text)
    own = wide.encode("utf-8", "surrogatepass")
    low = own.lower()
    start, end, words = words_at(low, PLAIN)
    raw = own if origin is None else text.encode("utf-8", "surrogatepass")
    none = np.zeros(0, np.int64)
    if not len(words):
        return raw, none, none, words, (b"", none)
    data = np.frombuffer(own, np.uint8)
    # a stop, closing marks or not, before white space ends a sentence
    stop = STOP[data]
    ends = (data == 10) | (data == 13)
    ends[:-1] |= stop[:-1] & SPACE[data[1:]]
    ends[:-2] |= stop[:-2] & CLOSING[data[1:-1]] & SPACE[data[2:]]
    ends[:-3] |= stop[:-3] & CLOSING[data[1:-2]] & CLOSING[data[2:-1]] & SPACE[data[3:]]
    before = np.concatenate(([0], np.cumsum(ends)))
    first = np.ones(len(words), bool)
    first[1:] = before[start[1:]] > before[end[:-1]]
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(words)))
    run_on = np.repeat(size > RUN_ON, size)
    if run_on.any():
        first[1:] |= run_on[1:] & run_on[:-1] & (words[:-1] % np.uint64(CUT) == 0)
        at = np.flatnonzero(first)
        size = np.diff(np.append(at, len(words)))
        inside = np.arange(len(words)) - np.repeat(at, size)
        first |= run_on & (inside % PIECE == 0)
        at = np.flatnonzero(first)
    joined = b" ".join([low[a:b] for a, b in zip(start.tolist(), end.tolist())]) + b" "
    offset = np.concatenate(([0], np.cumsum(end - start + 1)))
    begin = start[at] if origin is None else origin[start[at]]
    return raw, begin, at, words, (joined, offset)


def spans(at: np.ndarray, words: np.ndarray, plain: tuple[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first unit, unit after the last, hash, second hash) of every span."""
    n = len(at)
    unit = np.arange(n)
    edge = np.append(at, len(words))
    last = np.minimum(np.maximum(unit + SPAN, np.searchsorted(edge, at + WORDS, "left")),
                      np.maximum(unit + 2, np.searchsorted(edge, at + PAIR_WORDS, "left")))
    first = np.flatnonzero(last <= n)
    last = last[first]
    joined, offset = plain
    digest = xxhash.xxh3_64_intdigest
    second = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(offset[edge[first]].tolist(), offset[edge[last]].tolist())), np.uint64, len(first))
    return first, last, run_hashes(words, edge[first], edge[last]), second


def _span_rows(docs: DataFrame) -> DataFrame:
    """(h, g, doc, row_key, unit, size, again): every span of every row; ``again``: not the row's first with its hashes."""
    def run(batches):
        for piece in chunks(batches):
            cols = [[] for _ in range(7)]
            for doc, key, text in zip(*[c.to_pylist() for c in piece.columns]):
                _, _, at, words, plain = units(text)
                first, last, h, g = spans(at, words, plain)
                if not len(first):
                    continue
                again = np.ones(len(h), bool)
                order = np.lexsort((first, g, h))
                new = np.concatenate(([True], (np.diff(h[order]) != 0) | (np.diff(g[order]) != 0)))
                again[order[new]] = False
                for c, x in zip(cols, (h.view(np.int64), g.view(np.int64), np.full(len(h), doc), np.full(len(h), key), first.astype(np.int32),
                                       (last - first).astype(np.int32), again)):
                    c.append(x)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols],
                                                 names=["h", "g", "doc", "row_key", "unit", "size", "again"])

    return docs.select("doc", "row_key", "text") \
        .mapInArrow(run, "h long, g long, doc long, row_key long, unit int, size int, again boolean")


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, text (without repeated spans), n_removed, removed (ranges of sentences), one row per document."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("doc", F.coalesce("doc_id", F.lit((1 << 63) - 1))).withColumn("row_key", F.xxhash64("doc_id", "text"))
    rows = stored(_span_rows(named), "spans-rows")
    # written first, so that the join below meets two plain shuffles and AQE can split a hot hash
    shared = stored(rows.groupBy("h", "g").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
                    .filter("first_doc < last_doc").select("h", "g", "first_doc"), "spans-shared")
    late = rows.join(shared, ["h", "g"]).filter("doc > first_doc").select("row_key", "unit", "size")
    inside = rows.filter("again").select("row_key", "unit", "size")
    # what to remove of a row: bounded by the row's own sentences
    gone = late.union(inside).groupBy("row_key").agg(F.collect_set(F.struct("unit", "size")).alias("gone"))

    def one(batch):
        texts, removed, ranges = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            if not gone:
                texts.append(text)
                removed.append(0)
                ranges.append([])
                continue
            raw, starts, at, _, _ = units(text)
            drop = np.zeros(len(at) + 1, np.int64)
            for g in gone:
                drop[g["unit"]] += 1
                drop[g["unit"] + g["size"]] -= 1
            covered = np.cumsum(drop[:-1]) > 0
            removed.append(int(covered.sum()))
            edge = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
            ranges.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
            if text and covered.any():
                cut = np.append(starts, len(raw))
                keep = [raw[:cut[0]]] + [raw[cut[i]:cut[i + 1]] for i in np.flatnonzero(~covered).tolist()]
                text = b"".join(keep).decode("utf-8", "surrogatepass")
            texts.append(text)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(removed, pa.int32()),
             pa.array(ranges, span)], names=["doc_id", "text", "n_removed", "removed"])

    whole = named.join(gone, "row_key", "left").select("doc_id", "text", "gone")
    return map_chunks(whole, one, "doc_id long, text string, n_removed int, "
                                  "removed array<struct<start: int, end: int>>")
