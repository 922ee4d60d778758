"""Phrase collocations: frequent phrases by mergeable Misra-Gries summaries, counted exactly in a second pass.

Texts are split into pieces and words; everything is counted per language.  A phrase of 2 to ``LONGEST`` words is a
candidate if it occurs ``threshold`` times or more; so then does every part of it, and the same search finds the
words and phrases whose counts the score needs.

1. *Summaries.*  An n-gram (language, length, words) has a 64-bit key whose top bits name its hash partition.  A
   first pass adds up the mass (occurrences) of every partition.  The next passes summarise: a task counts the keys
   of some million words, a summary per partition from which nothing is subtracted yet.  Merging them, a partition keeps a Misra-Gries summary
   whose capacity k exceeds mass / threshold (counters beyond k are met by subtracting the (k+1)-th largest from all).  Every
   subtraction of c takes more than c * k of the partition's mass away, so all of them together stay below the threshold, and an n-gram that
   occurs that often keeps a counter.  What a partition really lost is known, and only counters that could reach the threshold with it survive.
   (Tasks could cut their summaries to k as well; from a hundred of them on they are smaller than k.)
   Words and pairs come first, then triples of surviving pairs, then 4 and 5 words of surviving triples.
2. *Sieve.*  The survivors' keys set bits of an array of at most ``SIEVE_BITS`` (32 MB, whatever the input), which is
   broadcast.  It loses none of them; what it lets through besides, more the larger the corpus, is only counted in vain.
3. *Exact counts.*  The last pass counts the n-grams the sieve lets through by their words, not by keys (equal word
   numbers within a task, the phrase itself where a partition's counts are added up), so no hash collision reaches a count.

Scores, dropped phrases and ranks are equi-joins and aggregates over the counts.  A phrase that holds a third of all
occurrences is one counter per task; a language's ranking is cut to the wanted rows in slices before one task ranks them.

Defined cases: NULL and empty texts have no words; a NULL lang is ``und``; texts are read whole, and a very long one
takes memory in proportion to its length in its task; equal rows count each; equal scores rank by a, then by
the phrase's bytes; an empty table or no candidate gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterbill.llm.common import chunks, stored
from meterbill.llm.wordhash import mix

LONGEST = 5
THRESHOLD = 100
TOP = 2000
SIEVE_BITS = 1 << 28
FLUSH_WORDS = 1 << 21          # words whose n-grams a task combines at once
PARTITION_BYTES = 1 << 22      # text bytes per hash partition
MOST_PARTITIONS = 1 << 16
SLICES = 64                    # slices in which a language's phrases are cut to the wanted rows
STEP = np.uint64(0x9E3779B97F4A7C15)
# What separates pieces, and the tab, which separates words as a space does.
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(SEPARATORS + b"\t", b"\n" * len(SEPARATORS) + b" ")


def word_list(data: bytes) -> list[bytes]:
    """Lower-cased words in order, with a line feed between pieces and empty strings between neighbouring gaps."""
    return data.lower().translate(_TABLE).replace(b"\n", b" \n ").split(b" ")


class Vocabulary(dict):
    """Numbers of words in order of appearance: 0 a piece's end, 1 nothing."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": 1})
        self.words, self.hashes = [b"\n", b""], [0, 0]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return n


class Grams:
    """The n-grams of some texts of one language, addressed by the position of their first word."""

    def __init__(self, ids: np.ndarray, vocabulary: Vocabulary, lang: str):
        self.ids = ids
        self.hash = np.array(vocabulary.hashes, np.uint64)[ids]
        self.lang = xxhash.xxh64_intdigest(lang.encode())
        ends = np.append(np.flatnonzero(ids == 0), len(ids))
        self.room = ends[np.searchsorted(ends, np.arange(len(ids)))] - np.arange(len(ids))   # words up to the piece's end

    def at(self, k: int) -> np.ndarray:
        """Positions where k words of one piece start."""
        return np.flatnonzero(self.room >= k)

    def keys(self, k: int, at: np.ndarray) -> np.ndarray:
        """Keys of the k-grams that start at ``at``."""
        acc = np.full(len(at), self.lang + k & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for i in range(k):
            acc = mix(acc * STEP + self.hash[at + i])
        return acc


def texts_by_language(batches: Iterator[pa.RecordBatch], words: int = FLUSH_WORDS) -> Iterator[list[tuple[str, np.ndarray, Vocabulary]]]:
    """(language, word numbers) of about ``words`` words at a time, whole texts only; texts are piece by piece apart."""
    vocabulary, held, count = Vocabulary(), {}, 0
    for batch in chunks(batches, 64):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if text:
                listed = word_list(text)
                listed.append(b"\n")
                ids = np.fromiter(map(vocabulary.__getitem__, listed), np.int64, len(listed))
                held.setdefault(lang, []).append(ids[ids != 1])
                count += len(ids)
                if count >= words:
                    yield [(k, np.concatenate(v), vocabulary) for k, v in held.items()]
                    vocabulary, held, count = Vocabulary(), {}, 0
    if held:
        yield [(k, np.concatenate(v), vocabulary) for k, v in held.items()]


def combined(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, in order, with their counts added."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def misra_gries(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """At most ``capacity`` counters, and what was subtracted from all to get there."""
    if len(keys) <= capacity:
        return keys, counts, 0
    cut = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])   # the (capacity + 1)-th largest
    stay = counts > cut
    return keys[stay], counts[stay] - cut, cut


def capacity(mass: int, threshold: int) -> int:
    """Counters that suffice for every key with ``threshold`` occurrences of so much mass: mass / threshold, rounded up past it."""
    return mass // threshold + 1


def survivors(keys: np.ndarray, counts: np.ndarray, lost: int, threshold: int) -> np.ndarray:
    """Keys whose true count may reach the threshold: a counter is short of it by at most what was lost."""
    return keys[counts + lost >= threshold]


class Sieve:
    """A bit per key hash; no bits lets everything through."""

    def __init__(self, bits: bytes | None):
        self.bits = None if bits is None else np.frombuffer(bits, np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys & np.uint64(8 * len(self.bits) - 1)).astype(np.int64)
        return self.bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1


def _partition(keys: np.ndarray, power: int) -> np.ndarray:
    return (keys >> np.uint64(64 - power)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string").cast("binary").alias("text")
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text)


def masses(texts: DataFrame, power: int, longest: int) -> DataFrame:
    """(lang, k, part, mass): occurrences of k-grams per hash partition, and with k = 0 words per language."""
    def run(batches):
        for group in texts_by_language(batches):
            total = np.zeros((longest + 1, 1 << power), np.int64)
            words = {}
            for lang, ids, vocabulary in group:
                grams = Grams(ids, vocabulary, lang)
                words[lang] = len(grams.at(1))
                for k in range(1, longest + 1):
                    total[k] += np.bincount(_partition(grams.keys(k, grams.at(k)), power), minlength=1 << power)
            k, p = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(k), pa.string()), pa.array(k, pa.int32()), pa.array(p, pa.int32()),
                                              pa.array(total[k, p])], names=["lang", "k", "part", "mass"])
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array([0] * len(words), pa.int32()),
                                              pa.array([0] * len(words), pa.int32()), pa.array(list(words.values()), pa.int64())],
                                             names=["lang", "k", "part", "mass"])
    return texts.mapInArrow(run, "lang string, k int, part int, mass long").groupBy("lang", "k", "part").agg(F.sum("mass").alias("mass"))


def _by_partition(keys: np.ndarray, power: int) -> Iterator[tuple[int, int, int]]:
    """(hash partition, start, end) of the runs of ``keys``, which are in order."""
    part = _partition(keys, power)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
        yield int(part[a]), a, b


SUMMARY = "k int, part int, keys binary, counts binary"


def _batch(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)], names=[n for n, _ in types])


_SUMMARY = [("k", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
_COUNTED = [("lang", pa.string()), ("k", pa.int32()), ("part", pa.int32()), ("phrases", pa.binary()), ("counts", pa.binary())]
_PHRASES = [("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())]


def summaries(texts: DataFrame, lengths: tuple[int, ...], sieve, inner: int, power: int) -> DataFrame:
    """Counters of the k-grams of the given lengths, one row per hash partition and some million words; only of those
    whose inner n-grams of ``inner`` words all pass the sieve, a broadcast (all, if ``inner`` is 0)."""
    def run(batches):
        test = Sieve(sieve.value) if inner else None
        for group in texts_by_language(batches):
            found = {k: [] for k in lengths}
            for lang, ids, vocabulary in group:
                grams = Grams(ids, vocabulary, lang)
                if inner:
                    start = grams.at(inner)
                    passes = np.zeros(len(ids) + LONGEST, bool)
                    passes[start] = test(grams.keys(inner, start))
                for k in lengths:
                    at = grams.at(k)
                    for i in range(k - inner + 1 if inner else 0):
                        at = at[passes[at + i]]
                    found[k].append(grams.keys(k, at))
            for k in lengths:
                keys, counts = combined(np.concatenate(found[k]))
                small = counts.astype(np.uint32)
                rows = [(k, p, keys[a:b].tobytes(), small[a:b].tobytes()) for p, a, b in _by_partition(keys, power)]
                for i in range(0, len(rows), 1024):
                    yield _batch(rows[i:i + 1024], _SUMMARY)
    return texts.mapInArrow(run, SUMMARY)


def merged(rows: DataFrame, threshold: int, caps) -> DataFrame:
    """The keys that survive when each partition's summaries are merged, at most twice its capacity held at a time."""
    def run(batches):
        now, keys, counts, lost, held = None, [], [], 0, 0

        def fold():
            k, c, cut = misra_gries(*combined(np.concatenate(keys), np.concatenate(counts)), caps.value[now])
            return [k], [c], lost + cut, len(k)

        def done():
            k, c, all_lost, _ = fold()
            return pa.RecordBatch.from_arrays([pa.array(survivors(k[0], c[0], all_lost, threshold).view(np.int64))], names=["key"])

        for batch in chunks(batches, 64):
            for k, part, some, n in zip(*[c.to_pylist() for c in batch.columns]):
                if (k, part) != now:
                    if now is not None:
                        yield done()
                    now, keys, counts, lost, held = (k, part), [], [], 0, 0
                keys.append(np.frombuffer(some, np.uint64))
                counts.append(np.frombuffer(n, np.uint32).astype(np.int64))
                held += len(keys[-1])
                if held > max(2 * caps.value[now], 1 << 20):
                    keys, counts, lost, held = fold()
        if now is not None:
            yield done()

    return rows.repartition("k", "part").sortWithinPartitions("k", "part").mapInArrow(run, "key long")


def _sieve_bytes(keys: DataFrame) -> bytes:
    """The sieve of the keys: 32 bits a key, ``SIEVE_BITS`` at most; its bytes are all that reaches the driver."""
    size = 1 << 16
    n = keys.count()
    while size < 32 * n and size < SIEVE_BITS:
        size *= 2
    span = min(size, 1 << 20)                  # bits that one row of the sieve holds

    def run(batches):
        now, bits = None, None
        for batch in batches:
            slot = batch.column(1).to_numpy()
            part = batch.column(0).to_numpy()
            first = np.flatnonzero(np.diff(part, prepend=-1))
            for a, b in zip(first, np.append(first[1:], len(part))):
                if part[a] != now:
                    if now is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()])],
                                                         names=["part", "bits"])
                    now, bits = int(part[a]), np.zeros(span, bool)
                bits[slot[a:b] & (span - 1)] = True
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()])],
                                             names=["part", "bits"])

    slots = keys.select(F.col("key").bitwiseAND(F.lit(size - 1)).alias("slot"))
    slots = slots.select((F.col("slot") / F.lit(span)).cast("long").alias("part"), "slot").distinct()
    out = bytearray(size // 8)
    for part, bits in slots.repartition("part").sortWithinPartitions("part").mapInArrow(run, "part long, bits binary").collect():
        out[part * span // 8:(part + 1) * span // 8] = bits
    return bytes(out)


def exact_counts(texts: DataFrame, sieve, longest: int, power: int) -> DataFrame:
    """(lang, k, part, phrases, counts): occurrences, counted by their words, of every n-gram whose parts pass the sieve; a
    row holds those of one hash partition and some million words, phrases apart by line feeds."""
    def run(batches):
        test = Sieve(sieve.value)
        for group in texts_by_language(batches):
            for lang, ids, vocabulary in group:
                grams = Grams(ids, vocabulary, lang)
                words = np.array(vocabulary.words, object)
                number, names = None, None      # of the (k-1)-gram at each position, and the phrases so numbered
                for k in range(1, longest + 1):
                    at = grams.at(k)
                    if number is not None:
                        at = at[(number[at] >= 0) & (number[at + 1] >= 0)]
                    keys = grams.keys(k, at)
                    passes = test(keys)
                    at, keys = at[passes], keys[passes]
                    exact = ids[at] if number is None else number[at] << 32 | ids[at + k - 1]
                    found, place, back, n = np.unique(exact, return_index=True, return_inverse=True, return_counts=True)
                    names = words[found] if number is None else [names[x >> 32] + b" " + words[x & 0xFFFFFFFF] for x in found.tolist()]
                    number = np.full(len(ids) + 1, -1, np.int64)
                    number[at] = back
                    order = np.argsort(keys[place], kind="stable")
                    listed, n = np.array([*names, None], object)[order], n[order].astype(np.uint32)
                    rows = [(lang, k, p, b"\n".join(listed[a:b]), n[a:b].tobytes()) for p, a, b in _by_partition(keys[place][order], power)]
                    for i in range(0, len(rows), 1024):
                        yield _batch(rows[i:i + 1024], _COUNTED)
    return texts.mapInArrow(run, "lang string, k int, part int, phrases binary, counts binary")


def added_up(rows: DataFrame, threshold: int) -> DataFrame:
    """(lang, k, phrase, f): the exact counts of each hash partition added up, those that reach the threshold."""
    def run(batches):
        now, total = None, defaultdict(Counter)

        def done():
            found = [(*who, phrase.decode(), f) for who, counts in total.items() for phrase, f in counts.items() if f >= threshold]
            for i in range(0, len(found), 1 << 16):
                yield _batch(found[i:i + (1 << 16)], _PHRASES)

        for batch in chunks(batches, 64):
            for lang, k, part, phrases, n in zip(*[c.to_pylist() for c in batch.columns]):
                if part != now:
                    yield from done() if now is not None else ()
                    now, total = part, defaultdict(Counter)
                counts = total[lang, k]
                for phrase, f in zip(phrases.split(b"\n"), np.frombuffer(n, np.uint32).tolist()):
                    counts[phrase] += f
        if now is not None:
            yield from done()

    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(run, "lang string, k int, phrase string, f long")


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, f) of every phrase of 1 to ``longest`` words with f >= threshold, (lang, n) of all words)."""
    texts = _texts(docs)
    context = docs.sparkSession.sparkContext
    size = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    power = 6
    while 1 << power < size // PARTITION_BYTES and 1 << power < MOST_PARTITIONS:
        power += 1
    mass = stored(masses(texts, power, longest), "phrase-mass")
    # at most longest * 65536 rows
    caps = context.broadcast({(r.k, r.part): capacity(r.mass, threshold)
                              for r in mass.filter("k > 0").groupBy("k", "part").agg(F.sum("mass").alias("mass")).collect()})
    keys, sieve = None, None
    for lengths, inner in ((1, 2), 0), ((3,), 2), ((4, 5), 3):
        lengths = tuple(k for k in lengths if k <= longest)
        if not lengths:
            continue
        more = stored(merged(summaries(texts, lengths, sieve, inner, power), threshold, caps), "phrase-keys")
        keys = more if keys is None else keys.union(more)
        sieve = context.broadcast(_sieve_bytes(keys))
    counts = stored(added_up(exact_counts(texts, sieve, longest, power), threshold), "phrase-counts")
    return counts, mass.filter("k = 0").groupBy("lang").agg(F.sum("mass").alias("n"))


def _words(a: Column | str, b: Column | str) -> Column:
    """Words a to b of ``words``, joined by spaces."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.array_join(F.slice("words", a, b - a + 1), " ")


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every candidate: the cut that scores least, the first of equals."""
    phrases = counts.filter("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))) \
        .select("lang", "phrase", "a", "cut", _words(F.lit(1), "cut").alias("first"), _words(F.col("cut") + 1, "k").alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(18,0)")  # noqa: E731  products are exact to 38 digits
    score = F.expr("div((a * 1000bd) * n, l * r)")
    rows = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    rows = rows.select("lang", "phrase", "cut", *[wide(c).alias(c) for c in "alrn"]).withColumn("score", score)
    best = rows.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("b"))
    return best.select("lang", "phrase", *[F.col(f"b.{c}").cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])


def longer(counts: DataFrame) -> DataFrame:
    """(lang, phrase, over): the count of the most frequent candidate that holds the phrase and is longer."""
    whole = counts.filter("k > 2").select("lang", "k", "f", F.split("phrase", " ").alias("words"))
    parts = whole.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1))) \
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    return parts.select("lang", _words("at", F.col("at") + F.col("size") - 1).alias("phrase"), "f") \
        .groupBy("lang", "phrase").agg(F.max("f").alias("over"))


def mine(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, covered: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases by score; phrases go that a longer
    one holds with at least ``covered`` percent of their count."""
    counts, totals = frequent_phrases(docs, threshold, longest)
    kept = (scored(counts, totals).join(longer(counts), ["lang", "phrase"], "left")
            .filter(F.col("over").isNull() | (100 * F.col("over") < covered * F.col("a"))).drop("over"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = kept.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    few = slices.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
