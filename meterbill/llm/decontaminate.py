"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A document is contaminated by a benchmark item if some passage of it is within
``(1 - similarity) * n`` word edits of the item's ``n`` words (words are runs of letters and digits, lower-cased; in
Chinese, Japanese kana, Thai, Lao, Khmer and Burmese, which set no spaces, every character is a word).

Windows as long as the item (to 15 %) are embedded by the CGK random walk: reading position ``p`` advances at each of
``2 n`` steps by a random bit of (step, symbol), so that few edits between two windows become few differing
symbols between the embeddings.  Each repetition has its own walk and samples ``SAMPLES`` positions of the
embedding as a key; windows and items that agree in a key are verified by edit distance against the window's
surroundings.  ``REPETITIONS`` is set for a recall of at least 0.95 at the very bound for windows of up to ``SEGMENT`` words, nearly 1
short of it (``tests/llm`` measures it).  A window's recall falls with its length, so longer items are indexed by equal segments of
at most ``SEGMENT`` words, any of which makes a candidate: of an item within the bound at least one segment is within its own.
Before the walk a count filter drops windows that cannot match: an item within ``k`` edits keeps at least
``n - 1 - 2 k`` of its word pairs, so a window with fewer word pairs of the benchmark is out (nothing is lost by this).

The documents are read once per block of items and never shuffled.  The benchmark is the stated query set; its
distinct texts are taken in blocks of ``BLOCK_CHARS``, and each block's index is broadcast.

Defined cases: NULL or empty texts of documents or items never match; of items under ``MIN_WORDS`` words
only exact passages match, found by the hash of the whole run, down to items of one word; items without a word never match; repeated items are all reported; repeated documents each get their rows;
of several matching passages for one item the one with the fewest edits, then the first, is reported; empty
tables give empty results; extra columns are ignored by ``search`` and kept by ``drop``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbill.llm.common import chunks, packed, unpacked
from meterbill.llm.wordhash import PLAIN, mix, shingles, word_hashes

SIMILARITY = 0.8
MIN_WORDS = 8
REPETITIONS, SAMPLES = 24, 3
SEGMENT = 32                       # longer items are indexed by segments of at most so many words
BLOCK_CHARS = 4_000_000
SLICE = 4096                       # windows embedded at once
PAIR_BITS = 22
PAIR = np.uint64(0x9E3779B97F4A7C15)
PAD = np.uint64(0x7F4A7C159E3779B9)  # the symbol past a window's end
# Scripts without spaces, and the marks between their sentences.
UNSPACED = re.compile("[\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ecd\u1000-\u1049\u1050-\u109f\u1780-\u17d3\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029"
                      "\u3041-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3100-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
                      "\uff66-\uff9f\U00020000-\U000323af]")
MARKS = re.compile("[\u0e4f\u0e5a\u0e5b\u104a-\u104f\u17d4-\u17da\u3000-\u3003\u3008-\u3020\u3030\u30a0\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


def words_of(text: str | None) -> np.ndarray:
    if text and not text.isascii():
        text = UNSPACED.sub(r" \g<0> ", MARKS.sub(" ", text))
    return word_hashes((text or "").lower().encode("utf-8", "surrogatepass"), PLAIN)


def allowed_edits(n: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n + 1e-9)


def best_passage(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the passage of ``text`` nearest to ``item`` in word edits; the first such."""
    m = len(text)
    steps = np.arange(m + 1)
    cost, start = np.zeros(m + 1, np.int64), steps.copy()
    big = m + 1                        # cost and start in one number, so that minima pick the first start
    key = cost * big + start
    for i, w in enumerate(item.tolist()):
        change = (text != np.uint64(w)).astype(np.int64)
        new = np.concatenate(([(i + 1) * big], np.minimum(key[:-1] + change * big, key[1:] + big)))
        key = np.minimum.accumulate(new - steps * big) + steps * big
    end = int(key.argmin())
    return int(key[end] // big), int(key[end] % big), end


class ItemIndex:
    """Count filter and LSH tables of a block of items."""

    def __init__(self, texts: list[str], similarity: float = SIMILARITY, repetitions: int = REPETITIONS,
                 samples: int = SAMPLES, seed: int = 7) -> None:
        self.similarity, self.repetitions, self.samples = similarity, repetitions, samples
        words = [words_of(t) for t in texts]
        self.items = {i: w for i, w in enumerate(words) if len(w)}
        long = {i: w for i, w in self.items.items() if len(w) >= MIN_WORDS}
        self.short = []                # (words, sorted hashes, items) of the items of each length below
        for n in sorted({len(w) for w in self.items.values()} - {len(w) for w in long.values()}):
            own = np.array([i for i, w in self.items.items() if len(w) == n])
            h = np.array([shingles(self.items[i], n)[0] for i in own.tolist()])
            self.short.append((n, np.sort(h), own[np.argsort(h, kind="stable")]))
        self.parts = []                # (item, offset in the item, words) of every segment
        for i, w in long.items():
            edges = np.linspace(0, len(w), -(-len(w) // SEGMENT) + 1).astype(int).tolist()
            self.parts += [(i, a, w[a:b]) for a, b in zip(edges, edges[1:])]
        lengths = sorted({len(w) for _, _, w in self.parts})
        self.longest = max(lengths, default=0)
        rng = np.random.default_rng(seed)
        self.odd = rng.integers(0, 1 << 63, (repetitions, 2 * self.longest), np.uint64) * np.uint64(2) + np.uint64(1)
        self.pairs = np.zeros(1 << PAIR_BITS, bool)
        for w in long.values():
            self.pairs[self._pair(w)] = True
        # Lengths in classes of up to 15 %: a window is as long as the longest item of its class.  Positions are
        # sampled where a walk still reads words of the shortest (a step advances by one half on average).
        self.classes, at, keys, which = [], 0, [], []
        while at < len(lengths):
            own = [n for n in lengths[at:] if n <= lengths[at] * 1.15]
            need = min(n - 1 - 2 * allowed_edits(n, similarity) for n in own)
            sampled = np.sort(np.stack([rng.choice(2 * own[0], samples, replace=False) for _ in range(repetitions)]), axis=1)
            self.classes.append((own[-1], max(need, 1), own[-1] + allowed_edits(own[-1], similarity) - 1, sampled))
            mine = [p for p, (_, _, w) in enumerate(self.parts) if own[0] <= len(w) <= own[-1]]
            rows = np.stack([np.pad(self.parts[p][2], (0, own[-1] - len(self.parts[p][2])), constant_values=PAD) for p in mine])
            keys.append(self._keys(rows, sampled).ravel())
            which.append(np.repeat(np.array(mine, np.int64), repetitions))
            at += len(own)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.which = np.concatenate(which)[order] if which else np.zeros(0, np.int64)

    @staticmethod
    def _pair(words: np.ndarray) -> np.ndarray:
        return (mix(words[:-1] * PAIR + words[1:]) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)

    def _keys(self, windows: np.ndarray, sampled: np.ndarray) -> np.ndarray:
        """CGK walks of all windows (rows) in all repetitions; one key each of the symbols at the sampled positions."""
        m, width = windows.shape
        flat = np.concatenate([windows, np.full((m, 1), PAD)], axis=1).ravel()
        base = (np.arange(m, dtype=np.int64) * (width + 1))[None, :]
        point = np.broadcast_to(base, (self.repetitions, m)).copy()
        key = np.broadcast_to(np.arange(width, width + self.repetitions, dtype=np.uint64)[:, None] * PAIR, point.shape).copy()
        last = base + width
        for step in range(int(sampled.max()) + 1):
            symbol = flat[point]
            hit = np.flatnonzero((sampled == step).any(axis=1))
            if len(hit):
                key[hit] = key[hit] * PAIR + (symbol[hit] ^ (symbol[hit] >> np.uint64(29)))
            point += ((symbol * self.odd[:, step][:, None]) >> np.uint64(63)).astype(np.int64)
            np.minimum(point, last, out=point)
        return mix(key).T

    def _exact(self, whole: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """What ``search`` gives for the short items: the first exact passage of each pair."""
        out = []
        for n, hashes, items in self.short:
            runs = shingles(whole, n)
            low, high = np.searchsorted(hashes, runs, "left"), np.searchsorted(hashes, runs, "right")
            at = np.flatnonzero(high > low)
            text = np.searchsorted(bounds, at, "right") - 1
            first = np.unique(np.stack([text, low[at]]), axis=1, return_index=True)[1]   # of a text and run
            for p, t in zip(at[first].tolist(), text[first].tolist()):
                start = p - int(bounds[t])
                out += [(t, i, 0, start, start + n) for i in items[low[p]:high[p]].tolist() if (whole[p:p + n] == self.items[i]).all()]
        return out

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, first word, word after the last) of the best passage of each pair."""
        if not self.items:
            return []
        words = [words_of(t) for t in texts]
        bounds = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
        whole = np.concatenate([x for w in words for x in (w, np.full(1, PAD))]) if words else np.zeros(0, np.uint64)
        if len(whole) < 2:
            return []
        hits = np.concatenate(([0], np.cumsum(self.pairs[self._pair(whole)], dtype=np.int32)))
        padded = np.concatenate([whole, np.full(2 * self.longest + 2, PAD)])
        opens = np.flatnonzero(np.diff(hits))          # a passage begins with a word pair of the benchmark
        before = hits[opens]
        found: dict[tuple[int, int], set[int]] = {}
        for width, need, span, sampled in self.classes:
            start = opens[hits[np.minimum(opens + span, len(hits) - 1)] - before >= need]
            for a in range(0, len(start), SLICE):
                s = start[a:a + SLICE]
                keys = self._keys(padded[s[:, None] + np.arange(width)[None, :]], sampled)
                low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
                for i, r in zip(*np.nonzero(high > low)):
                    text = int(np.searchsorted(bounds, s[i], "right")) - 1
                    for part in self.which[low[i, r]:high[i, r]].tolist():
                        item, offset, _ = self.parts[part]
                        found.setdefault((text, item), set()).add(max(int(s[i]) - offset, int(bounds[text])))
        out = self._exact(whole, bounds)
        for (text, item), at in sorted(found.items()):
            w, own = self.items[item], words[text]
            edits = allowed_edits(len(w), self.similarity)
            best, seen = None, -1
            for s in sorted(at):
                s -= int(bounds[text])
                if s <= seen:
                    continue
                left = max(0, s - len(w))        # one look serves the next starts too
                seen = s + len(w)
                e, b, c = best_passage(w, own[left:seen + len(w) + edits])
                if e <= edits and (best is None or e < best[0]):
                    best = (e, left + b, left + c)
            if best:
                out.append((text, item, *best))
        return out


def _blocks(benchmark: DataFrame, block_chars: int):
    """Yields (keys, texts) of the distinct item texts, about ``block_chars`` at a time."""
    items = benchmark.select(F.col("text").cast("string").alias("text")).filter("text is not null").distinct() \
        .select(F.xxhash64("text").alias("item_key"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // block_chars)
    for b in range(count):
        rows = items.filter(F.pmod(F.xxhash64("item_key"), F.lit(count)) == b).orderBy("item_key", "text").collect()
        yield [r.item_key for r in rows], [r.text for r in rows]


def search(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, edits, n_item_words, start_word, end_word."""
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_key long, edits int, n_item_words int, start_word int, end_word int"
    found = spark.createDataFrame([], schema)
    for keys, texts in _blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast((keys, ItemIndex(texts, similarity)))

        def run(batches, shared=shared):
            names, index = shared.value
            for piece in chunks(batches):
                ids = piece.column(0).to_pylist()
                rows = [(ids[t], names[i], e, len(index.items[i]), a, b)
                        for t, i, e, a, b in index.search(piece.column(1).to_pylist())]
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64())] + [pa.array(c, pa.int32()) for c in cols[2:]],
                        names=["doc_id", "item_key", "edits", "n_item_words", "start_word", "end_word"])
        found = found.union(plain.mapInArrow(run, schema))
    named = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64(F.col("text").cast("string")).alias("item_key")) \
        .filter(F.col("text").isNotNull())
    return found.join(named, "item_key").select("doc_id", "item_id", "edits", "n_item_words", "start_word", "end_word")


def drop(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` without a contaminated text, all columns kept; no shuffle."""
    spark = docs.sparkSession
    rows = packed(docs)
    schema = f"row {rows.schema['row'].dataType.simpleString()}"
    for _, texts in _blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(ItemIndex(texts, similarity))

        def run(batches, shared=shared):
            for piece in chunks(batches):
                bad = {x[0] for x in shared.value.search(piece.column(0).field("text").to_pylist())}
                yield piece.filter(pa.array([i not in bad for i in range(piece.num_rows)], pa.bool_()))
        rows = rows.mapInArrow(run, schema)
    return unpacked(rows, docs.columns)
