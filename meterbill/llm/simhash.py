"""SimHash near duplicates: close fingerprints found by pigeonhole blocks, verified by Hamming distance.

A document's fingerprint has bit i set if over half of its word shingles' XXH64 hashes have it set (shingles count
as often as they occur).  Fingerprints link at ``distance`` or fewer differing bits; a component is what links reach.

Plan: one pass over the texts writes (doc_id, fingerprint).  Equal fingerprints become one row by an aggregate that
combines before the shuffle, so a group of copies that holds a third of all rows weighs as much as one document.  Each
distinct fingerprint is cut into m blocks; two that differ in at most d bits agree in at least m - d blocks, so they
meet under one of the C(m, m-d) choices of blocks.  m is the smallest for which a key is expected to hold at most
``PER_KEY`` fingerprints: more of them mean wider keys, not larger groups, and every m finds the same links.  A task compares the
fingerprints of a key with each other and returns links that span what is connected, never all pairs.  A key with over
``KEY_LIMIT`` fingerprints is dealt in slices, and every two slices meet in a task of their own.

Defined cases: a NULL, empty or blank text has the fingerprint zero and links like any other; under four words are
one shingle; texts are read whole, the bits of a very long one are counted in pieces; equal rows all stay and share
their component; a NULL doc_id is never the smallest (a component of nothing else has the id NULL); an empty
table gives no rows; columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbill.llm.common import map_chunks, stored
from meterbill.llm.components import contract_pairs, contracted_components

BITS = 64
WIDTH = 4           # words of a shingle
DISTANCE = 4        # differing bits up to which fingerprints link
SEED = 42
PER_KEY = 256       # fingerprints that a key is expected to hold at most: some 256 comparisons a row and key
KEY_LIMIT = 8192    # fingerprints of one key that one task compares with each other
COUNT_ROWS = 1 << 16
GROUP_ROWS = 100_000   # rows a task holds while it compares groups; the last group is always held whole


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """The 64-bit SimHash of a text (UTF-8)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    end = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    start = [0, *(e + 1 for e in end[:-1])]
    n = max(len(words) - width + 1, 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start[:n], end[min(width, len(words)) - 1:])), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, COUNT_ROWS):
        piece = hashes[at:at + COUNT_ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` holds the 64 bits as a long."""
    def one(batch):
        found = np.array([fingerprint(t, width) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_chunks(texts, one, "doc_id long, fp long")


def hexadecimal(fp: Column | str) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def block_masks(rows: int, distance: int = DISTANCE, per_key: int = PER_KEY) -> list[int]:
    """One mask of agreeing blocks per choice of blocks, for that many distinct fingerprints."""
    m = distance + 1
    while m < BITS and rows >> ((m - distance) * (BITS // m)) >= per_key and comb(m + 1, distance) <= 1000:
        m += 1
    cuts = [BITS * i // m for i in range(m + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(blocks, m - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def close_pairs(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span, within each run of equal keys, the fingerprints that differ in at most ``distance`` bits."""
    a, b, held = [], [], 0
    at, step = np.arange(len(key) - 1), 1
    while len(at):
        at = at[:np.searchsorted(at, len(key) - step)]
        at = at[key[at] == key[at + step]]
        near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= distance]
        a.append(fp[near].view(np.int64))
        b.append(fp[near + step].view(np.int64))
        held += len(near)
        if held > 4 * GROUP_ROWS:
            x, y = contract_pairs(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], len(x)
        step += 1
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return contract_pairs(np.concatenate(a), np.concatenate(b))


def _task_links(rows: DataFrame, distance: int) -> DataFrame:
    """(key, fp) -> spanning links of every key's fingerprints."""
    def run(batches):
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(k, f):
            a, b = close_pairs(k, f, distance)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            if len(keys) >= GROUP_ROWS:
                done = int(np.searchsorted(keys, keys[-1]))     # the last key may go on in the next batch
                if done:
                    yield links(keys[:done], fps[:done])
                    keys, fps = keys[done:], fps[done:]
        if len(keys):
            yield links(keys, fps)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def close_links(distinct: DataFrame, rows: int, distance: int = DISTANCE, per_key: int = PER_KEY,
                key_limit: int = KEY_LIMIT) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` that connect what Hamming distance connects."""
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(mask))))
            for i, mask in enumerate(block_masks(rows, distance, per_key))]
    spread = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = stored(spread.groupBy("key").agg(F.count("*").alias("members")).filter(F.col("members") > key_limit), "simhash-hot")
    if hot.isEmpty():
        return _task_links(spread.select("key", "fp"), distance)
    slices = F.ceil(F.col("members") / key_limit).cast("int")
    mine = F.pmod(F.xxhash64("fp"), slices).cast("int")
    dealt = spread.join(hot, "key", "left")
    few = dealt.filter("members is null").select("key", "fp")
    many = (dealt.filter("members is not null")
            .select("key", "fp", mine.alias("i"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("j"))
            .select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("key"), "fp"))
    return _task_links(few.union(many), distance)


def components(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE, per_key: int = PER_KEY,
               key_limit: int = KEY_LIMIT) -> DataFrame:
    """doc_id, fingerprint and component_id (the smallest doc_id reachable by links) of every row."""
    rows = stored(fingerprints(docs, width), "simhash-rows")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    links = close_links(distinct.select("fp"), distinct.count(), distance, per_key, key_limit)
    roots = contracted_components(links)
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(placed.join(names, "root").select("fp", "component_id"), "simhash-named")
    return rows.join(named, "fp").select("doc_id", hexadecimal("fp").alias("fingerprint"), "component_id")
