"""Exact n-gram Jaccard join with signature trees.

Two documents link when the Jaccard similarity of their shingle sets reaches the threshold.

1. **Signatures.** A set is cut by hash range into parts, in bands of similar set size.  Linked
   sets differ in at most ``d`` shingles, so with ``d + 1`` parts at least one part is equal; its
   digest is a key both sets emit.  ``slack`` further parts allow parts of under two or three shingles
   to be left out (at most ``slack`` equal parts can be such; a set with more emits all its parts),
   which keeps unrelated sets apart.  No pair is lost and no key needs a cap.  For thresholds below
   ``EXACT_FROM`` per cent such parts would hold too few shingles to tell sets apart and be as many as
   half the shingles; there the keys are min-hash bands, which miss a link at the threshold with a
   probability of 3e-6 (at 0.8) and less above it.
2. **Candidate groups.** Sets with a common key are chained (never paired) and the chains'
   connected components are the candidate groups: every link lies inside a group.
3. **Signature trees.** Within a group the sets are leaves of a tree whose nodes hold OR-combined
   token bitmaps and size ranges.  A dual traversal prunes pairs of nodes whose greatest possible
   overlap is too small, and pairs already known to be connected; the rest is verified on whole sets.
4. **Large groups** (over ``BLOCK_SHINGLES`` shingles) never meet in one task: every set is first
   compared with one pivot; sets linked to it are connected, and only pairs with at least one of the
   other sets are traversed, block against block.  A set at distance x from the pivot can only link
   to sets at a distance of at least x - (1 - threshold), since Jaccard distance is a metric.

Sets of equal content are one class throughout, so exact copies are never paired.  Classes and
shingles are identified by 64-bit digests.

Defined cases: NULL or empty text (or white space only) has an empty set and links with nothing;
fewer words than the width are one shingle; repeated rows are one class; a NULL doc_id takes part
but never names a component (a component of NULL ids only has a NULL id); an empty table gives an
empty result; extra columns are ignored by ``components`` and kept by ``keep_one``.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterbill.llm.common import chunks, map_chunks, packed, stored, unpacked
from meterbill.llm.components import contracted_components
from meterbill.llm.wordhash import mix, shingles, word_hashes

WIDTH = 3
PERCENT = 90                    # threshold, as whole per cent so that comparisons are exact
STRONG = 3                      # shingles a part needs to be a key by itself
EXACT_FROM = 88                 # per cent
BANDS, ROWS = 32, 5             # of the min-hash keys below that
BAND_RATIO = 1.25
FLUSH_KEYS = 400_000            # signature keys a task combines before it passes them on
BLOCK_SHINGLES = 1_000_000      # shingles of a block (8 MB)
LEAF, FANOUT = 16, 8


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; A-Z is lower-cased, words end at ASCII white space."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return shingles(words, len(words)) ^ np.uint64(len(words))
    return np.unique(shingles(words, width))


def class_id(s: np.ndarray) -> int:
    """Signed 64-bit digest of a set."""
    return int(mix(np.array([mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) + np.uint64(len(s))])).view(np.int64)[0])


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def least_size(percent: int) -> int:
    """The smallest set size that can link to a different set."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


@lru_cache(None)
def band(percent: int, k: int) -> tuple[int, int, int, int, int]:
    """(low, high, parts, strong, slack) of the k-th size band; the first starts at the least linkable size."""
    low = least_size(percent) if k == 0 else band(percent, k - 1)[1] + 1
    high = int(low * max(BAND_RATIO, 100 / percent + 0.01)) + 1
    return (low, high, *_plan(high, percent))


def _plan(high: int, percent: int) -> tuple[int, int, int]:
    """Parts of a band, shingles a part needs to be a key, and parts that may be left out: as many as a
    typical set of the band has below that size."""
    d = _differences(high, percent)
    for strong in range(STRONG, 1, -1):
        for slack in range(max(1, d // 8)):
            parts = d + 1 + slack
            mean = 0.85 * high / parts
            weak = parts * math.exp(-mean) * sum(mean ** i / math.factorial(i) for i in range(strong))
            if d < 10 or weak + math.sqrt(weak) <= slack:
                return parts, strong, slack
    return d + 1, STRONG, 0


def _differences(high: int, percent: int) -> int:
    """Most shingles in which two linked sets of sizes up to ``high`` differ: union - overlap, with
    overlap >= percent/100 union and union + overlap = sum of sizes."""
    union = 2 * high * 100 // (100 + percent)
    return union * (100 - percent) // 100


def signatures(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of a sorted set; linked sets share at least one (below ``EXACT_FROM``: miss none but with
    probability ``(1 - t^ROWS)^BANDS``)."""
    n = len(s)
    if n < least_size(percent):
        return np.zeros(0, np.uint64)
    if percent < EXACT_FROM:
        return _minhash_keys(s)
    found = []
    total = None
    for k in range(1000):
        low, high, parts, least, slack = band(percent, k)
        if 100 * n < percent * low and n < low:
            break
        # a set belongs to its own band and, as the smaller of a pair, to the next one
        if not (low <= n <= high or (n < low and 100 * n >= percent * low)):
            continue
        if total is None:
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(mix(s + np.uint64(0x632BE59BD9B4E019)), out=total[1:])
        bounds = (np.arange(1, parts, dtype=np.uint64) * np.uint64((1 << 64) // parts))
        cut = np.concatenate(([0], np.searchsorted(s, bounds), [n]))
        size = np.diff(cut)
        name = mix(np.arange(parts, dtype=np.uint64) + np.uint64(low) * np.uint64(0x100000001))
        key = mix((total[cut[1:]] - total[cut[:-1]]) + name * np.uint64(3) + size.astype(np.uint64))
        strong = size >= least
        found.append(key[strong] if int((~strong).sum()) <= slack else key)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _minhash_keys(s: np.ndarray) -> np.ndarray:
    """One key per band: the least hashes of the set under the band's ROWS hash functions."""
    seeds = mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64))
    least = np.concatenate([((s[:, None] ^ seeds[None, a:a + 32]) * (seeds[None, a:a + 32] | np.uint64(1))).min(axis=0)
                            for a in range(0, len(seeds), 32)]).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least.T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + row)
    return key


def _key_rows(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(kind, key, id): kind 0 a signature key of class id; kind 1 a chain edge key - id found inside the task."""
    def flush(keys, ids):
        k, i = np.concatenate(keys), np.concatenate(ids)
        order = np.lexsort((i, k))
        k, i = k[order], i[order]
        same = k[1:] == k[:-1]
        edge = np.flatnonzero(same & (i[1:] != i[:-1]))
        pairs = np.unique(np.stack([i[edge], i[edge + 1]], 1), axis=0) if len(edge) else np.zeros((0, 2), np.int64)
        first = np.concatenate(([True], ~same))
        kind = np.concatenate([np.zeros(int(first.sum()), np.int8), np.ones(len(pairs), np.int8)])
        return pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(np.concatenate([k[first], pairs[:, 0]])), pa.array(np.concatenate([i[first], pairs[:, 1]]))],
            names=["kind", "key", "id"])

    def run(batches):
        keys, ids, held = [], [], 0
        for piece in chunks(batches):
            for text in piece.column(0).to_pylist():
                s = shingle_set(text, width)
                k = signatures(s, percent)
                if len(k):
                    keys.append(k.view(np.int64))
                    ids.append(np.full(len(k), class_id(s), np.int64))
                    held += len(k)
            if held >= FLUSH_KEYS:
                yield flush(keys, ids)
                keys, ids, held = [], [], 0
        if held:
            yield flush(keys, ids)

    return texts.mapInArrow(run, "kind byte, key long, id long")


def candidate_edges(texts: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Distinct edges (a, b) between classes that share a signature key, as chains."""
    before = F.lag("id").over(Window.partitionBy("kind", "key").orderBy("id"))
    edge = F.when(F.col("kind") == 1, F.col("key")).otherwise(before)
    return _key_rows(texts, width, percent).select(edge.alias("a"), F.col("id").alias("b")) \
        .filter("a is not null and a <> b").distinct()


def classes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n, cls) per row; cls is NULL for an empty set."""
    def one(batch):
        sets = [shingle_set(t, width) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([class_id(s) if len(s) else None for s in sets], pa.int64())], names=["doc_id", "n", "cls"])
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_chunks(plain, one, "doc_id long, n long, cls long")


class SignatureTree:
    """Leaves of up to LEAF sets, inner nodes of up to FANOUT nodes; a node holds the OR of its sets'
    token bitmaps, their size range, the fewest bits of any of its bitmaps, and its range of sets (by size)."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
        self.sets = [sets[i] for i in self.order]
        self.size = np.array([len(s) for s in self.sets])
        bits = 64
        while bits < 2 * int(self.size.max()) and bits < 8192:
            bits *= 2
        maps = np.zeros((len(sets), bits), bool)
        for row, s in zip(maps, self.sets):
            row[(s & np.uint64(bits - 1)).astype(np.int64)] = True
        self.maps = np.packbits(maps, axis=1).view(np.uint64)
        self.bits = np.bitwise_count(self.maps).sum(1).astype(np.int64)
        level = [self._node(list(range(i, min(i + LEAF, len(sets)))), []) for i in range(0, len(sets), LEAF)]
        while len(level) > 1:
            level = [self._node([], level[i:i + FANOUT]) for i in range(0, len(level), FANOUT)]
        self.root = level[0]

    def _node(self, own: list[int], below: list[dict]) -> dict:
        rows = (own[0], own[-1] + 1) if own else (below[0]["rows"][0], below[-1]["rows"][1])
        part = slice(*rows)
        either = np.bitwise_or.reduce(self.maps[part], axis=0) if own else np.bitwise_or.reduce([b["or"] for b in below])
        return {"rows": rows, "below": below, "or": either, "low": int(self.size[rows[0]]), "high": int(self.size[rows[1] - 1]),
                "bits": int(self.bits[part].min())}


def tree_links(sets: list[np.ndarray], percent: int = PERCENT, joined: np.ndarray | None = None,
               wanted: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that span the components among ``sets``, by dual traversal of their signature tree.

    ``joined``: component labels known before; ``wanted``: only pairs with at least one wanted set matter."""
    tree = SignatureTree(sets)
    label = np.arange(len(sets)) if joined is None else joined[tree.order].copy()
    want = np.ones(len(sets), bool) if wanted is None else wanted[tree.order]
    links = []
    stack = [(tree.root, tree.root)]
    while stack:
        a, b = stack.pop()
        ra, rb = slice(*a["rows"]), slice(*b["rows"])
        # sizes: the larger of a linked pair is at most 100 / percent of the smaller
        if percent * max(a["low"], b["low"]) > 100 * min(a["high"], b["high"]):
            continue
        if not (want[ra].any() or want[rb].any()):
            continue
        first = label[a["rows"][0]]
        if (label[ra] == first).all() and (label[rb] == first).all():
            continue
        # a set x of a has at least bits(x) - |or(a) & or(b)| shingles that no set of b has
        common = int(np.bitwise_count(a["or"] & b["or"]).sum())
        most = min(a["high"] - max(0, a["bits"] - common), b["high"] - max(0, b["bits"] - common))
        if 100 * most < percent * max(a["low"], b["low"]):
            continue
        if a["below"] or b["below"]:
            if a is b:
                kids = a["below"]
                stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(len(kids) - 1, i - 1, -1)]
            elif a["below"]:
                stack += [(k, b) for k in a["below"]]
            else:
                stack += [(a, k) for k in b["below"]]
            continue
        for i in range(*a["rows"]):
            lost = np.bitwise_count(tree.maps[i] & ~tree.maps[rb]).sum(1).astype(np.int64)
            gained = np.bitwise_count(tree.maps[rb] & ~tree.maps[i]).sum(1).astype(np.int64)
            most = np.minimum(tree.size[i] - lost, tree.size[rb] - gained)
            fits = (100 * most >= percent * np.maximum(tree.size[i], tree.size[rb])) & (want[i] | want[rb])
            for j in (np.flatnonzero(fits) + b["rows"][0]).tolist():
                if (a is not b or j > i) and label[i] != label[j] and linked(tree.sets[i], tree.sets[j], percent):
                    links.append((tree.order[i], tree.order[j]))
                    label[label == label[j]] = label[i]
    return links


def _task_links(tasks: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside each task; rows (task, cls, core, wanted, shingles) of a task lie together and are
    at most two blocks."""
    def solve(rows):
        if len(rows) < 2:
            return []
        ids = [r[0] for r in rows]
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        wanted = np.array([r[2] for r in rows])
        joined = np.arange(len(rows))
        core = np.array([r[1] for r in rows])
        joined[core] = len(rows)
        return [(ids[i], ids[j]) for i, j in tree_links(sets, percent, joined, wanted)]

    def run(batches):
        task, rows = None, []
        for piece in chunks(batches, 64):
            links = []
            for t, c, core, wanted, s in zip(*[col.to_pylist() for col in piece.columns]):
                if t != task:
                    links += solve(rows)
                    task, rows = t, []
                rows.append((c, core, wanted, s))
            if links:
                yield _pairs(links)
        if links := solve(rows):
            yield _pairs(links)

    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def _pairs(links) -> pa.RecordBatch:
    a, b = zip(*links)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _pivot_distance(pairs: DataFrame, percent: int) -> DataFrame:
    """(cls, grp, pivot, n, shingles, pivot_shingles) -> core flag and Jaccard distance to the pivot."""
    def one(batch):
        a = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
        b = [np.frombuffer(x, np.uint64) for x in batch.column("pivot_shingles").to_pylist()]
        both = [overlap(x, y) for x, y in zip(a, b)]
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("grp", "cls", "pivot", "n", "shingles")]
            + [pa.array([100 * o >= percent * (len(x) + len(y) - o) for o, x, y in zip(both, a, b)], pa.bool_()),
               pa.array([1 - o / (len(x) + len(y) - o) for o, x, y in zip(both, a, b)], pa.float64())],
            names=["grp", "cls", "pivot", "n", "shingles", "core", "far"])
    return map_chunks(pairs.select("grp", "cls", "pivot", "n", "shingles", "pivot_shingles"), one,
                      "grp long, cls long, pivot long, n long, shingles binary, core boolean, far double", 128)


def _links(sets: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """Spanning links (a, b) of all candidate groups; ``sets``: (grp, cls, n, shingles), stored."""
    weight = sets.groupBy("grp").agg(F.sum("n").alias("weight"), F.count("*").alias("members"), F.min("cls").alias("pivot"))
    weight = stored(weight.filter("members > 1"), "join-groups")
    yes, no = F.lit(True), F.lit(False)
    small = sets.join(weight.filter(F.col("weight") <= block_shingles).select("grp"), "grp") \
        .select(F.col("grp").alias("task"), "cls", no.alias("core"), yes.alias("wanted"), "shingles")
    links = _task_links(small, percent)
    large = weight.filter(F.col("weight") > block_shingles)
    if large.isEmpty():
        return links
    pivots = sets.join(large.select("grp", F.col("pivot").alias("cls")), ["grp", "cls"]) \
        .select("grp", F.col("cls").alias("pivot"), F.col("shingles").alias("pivot_shingles"))
    near = stored(_pivot_distance(sets.join(pivots, "grp"), percent), "join-pivot")
    links = links.union(near.filter("core and cls <> pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b")))
    rest = near.filter(~F.col("core")).groupBy("grp").agg(F.sum("n").alias("rest"), F.max("far").alias("farthest"))
    plan = near.join(rest, "grp").join(large.select("grp", "weight"), "grp")
    ceil = lambda c: F.ceil(F.col(c) / block_shingles).cast("int")
    mine = F.pmod(F.xxhash64("cls"), ceil("rest")).cast("int")
    other = F.pmod(F.xxhash64("cls"), ceil("weight")).cast("int")
    # every block of the sets off the pivot meets every block of the group; a set can be on both sides of a task
    left = plan.filter(~F.col("core")).select("grp", "cls", "core", yes.alias("wanted"), "shingles", mine.alias("i"),
                                               F.explode(F.sequence(F.lit(0), ceil("weight") - 1)).alias("j"))
    reach = F.col("far") >= 0  # sets on the pivot's side that are too near it to reach any set off it are left out
    lowest = near.filter(~F.col("core")).groupBy("grp").agg(F.min("far").alias("nearest"))
    reach = ~F.col("core") | (F.col("far") >= F.col("nearest") - (1 - percent / 100) - 1e-9)
    right = plan.join(lowest, "grp").filter(reach).select(
        "grp", "cls", "core", no.alias("wanted"), "shingles", F.explode(F.sequence(F.lit(0), ceil("rest") - 1)).alias("i"),
        other.alias("j"))
    tasks = left.union(right).select(F.xxhash64("grp", "i", "j").alias("task"), "cls", "core", "wanted", "shingles")
    return links.union(_task_links(tasks, percent))


def class_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT,
                     block_shingles: int = BLOCK_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): (doc_id, n, cls) per document, stored, and (node, root) of the classes that link."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    groups = contracted_components(candidate_edges(texts, width, percent)).select(F.col("node").alias("cls"), F.col("root").alias("grp"))
    rows = stored(classes(docs, width), "join-classes")
    # one row stands for each class: the row with the smallest doc_id that is not NULL, else any
    stand = rows.join(groups, "cls").groupBy("cls", "grp").agg(F.min("doc_id").alias("doc_id"))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = named.join(stand.filter("doc_id is not null"), "doc_id").select("grp", "cls", "doc_id", "text")
    sets = stored(_standing(found, width).dropDuplicates(["cls"]), "join-sets")
    nameless = stand.filter("doc_id is null")
    if not nameless.isEmpty():     # classes that only rows without an id have
        lone = named.filter("doc_id is null").withColumn("grp", F.lit(None).cast("long"))
        own = _classed(lone, width).join(nameless.select("cls", F.col("grp").alias("g")), "cls")
        sets = stored(sets.union(own.select(F.col("g").alias("grp"), "cls", "n", "shingles")).dropDuplicates(["cls"]), "join-sets")
    return rows, contracted_components(_links(sets, percent, block_shingles))


def _classed(texts: DataFrame, width: int) -> DataFrame:
    """(text) -> (cls, n, shingles), the class taken from the text itself."""
    def one(batch):
        sets = [shingle_set(t, width) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([class_id(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "n", "shingles"])
    return map_chunks(texts.select("text"), one, "cls long, n long, shingles binary", 128)


def _standing(found: DataFrame, width: int) -> DataFrame:
    """Sets of the rows that stand for their class; a row whose id occurs with several texts is
    kept only for the class its own text has."""
    def one(batch):
        sets = [shingle_set(t, width) for t in batch.column("text").to_pylist()]
        keep = [len(s) > 0 and class_id(s) == c for s, c in zip(sets, batch.column("cls").to_pylist())]
        out = pa.RecordBatch.from_arrays(
            [batch.column("grp"), batch.column("cls"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([s.tobytes() for s in sets], pa.binary())], names=["grp", "cls", "n", "shingles"])
        return out.filter(pa.array(keep, pa.bool_()))
    return map_chunks(found.select("grp", "cls", "text"), one, "grp long, cls long, n long, shingles binary", 128)


def components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT,
               block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row."""
    rows, roots = class_components(docs, width, percent, block_shingles)
    # one row per class up to the last join, whose class side is small and whose rows AQE can split
    per_class = rows.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
    placed = per_class.join(roots, per_class["cls"] == roots["node"], "left").select("cls", "least", F.coalesce("root", "cls").alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(placed.join(names, "root").select("cls", "component_id"), "join-named")
    return rows.filter("cls is not null").join(named, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id") \
        .union(rows.filter("cls is null").select("doc_id", "n", "doc_id"))


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs``, one of each component: the one with the smallest doc_id (NULL last); of rows
    that share it, one.  Rows with an empty set all stay."""
    rows, roots = class_components(docs, width, percent, block_shingles)
    placed = rows.filter("cls is not null").join(roots, rows["cls"] == roots["node"], "left") \
        .select("doc_id", "cls", F.coalesce("root", "cls").alias("root"))
    copies = placed.groupBy("doc_id", "cls").agg(F.count("*").alias("times"))
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "cls")).alias("s"))
    stay = first.select(F.col("s.doc_id").alias("stay_id"), F.col("s.cls").alias("stay_cls"))
    stay = stored(stay.join(copies, stay["stay_id"].eqNullSafe(copies["doc_id"]) & (stay["stay_cls"] == copies["cls"]))
                  .select("stay_id", "stay_cls", "times"), "join-stay")

    def one(batch):
        row = batch.column(0)
        sets = [shingle_set(t, width) for t in row.field("text").to_pylist()]
        return pa.RecordBatch.from_arrays([row, pa.array([class_id(s) if len(s) else None for s in sets], pa.int64())],
                                          names=["row", "cls"])
    whole = packed(docs)
    whole = map_chunks(whole, one, f"row {whole.schema['row'].dataType.simpleString()}, cls long") \
        .withColumn("id", F.col("row.doc_id").cast("long"))
    # rows without a class stay; a spread key keeps them from meeting in one task
    spread = whole.withColumn("empty", F.col("cls").isNull()).withColumn("cls", F.coalesce("cls", F.xxhash64("id", F.rand(1))))
    kept = spread.join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("cls") == F.col("stay_cls")), "left") \
        .filter("empty or times is not null")
    if not stay.filter("times > 1").isEmpty():     # the same id and set in several rows
        kept = kept.filter("empty or times = 1").union(kept.filter("not empty and times > 1").dropDuplicates(["id", "cls"]))
    return unpacked(kept, docs.columns)
