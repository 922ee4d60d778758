"""Phrase collocations, the filter audit and SimHash components against brute force."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from meterbill.llm import collocations, filter_audit, simhash
from meterbill.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("key", ["op11_phrase_collocations", "op12_filter_audit"])
def test_equals_its_sql(spark, key):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[key](spark, SF)
    want = con.sql(ORACLE[key])
    assert sorted(got.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in got.columns]
    assert rows_of(got) == sorted(tuple(r[i] for i in at) for r in want.fetchall())


# ------------------------------------------------------------------ phrases
def brute_phrases(rows, threshold, longest, top):
    total, counts = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    found = {g: f for g, f in counts.items() if len(g[1]) > 1 and f >= threshold}
    out = defaultdict(list)
    for (lang, g), a in found.items():
        if any(o == lang and len(d) > len(g) and f >= a and any(d[i:i + len(g)] == g for i in range(len(d)))
               for (o, d), f in found.items()):
            continue
        cuts = [(1000 * a * total[lang] // (counts[lang, g[:k]] * counts[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out[lang].append((score, a, " ".join(g), counts[lang, g[:k]], counts[lang, g[k:]]))
    return sorted((lang, i + 1, p, a, l, r, total[lang], s) for lang, them in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(them, key=lambda x: (-x[0], -x[1], x[2].encode()))[:top]))


def phrase_rows(seed, n=120):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "İ", "\x01", "a-b", " x", "日本"]
    fixed = ["New York Stock Exchange opens", "a b a b a b a", "tick\ttock  tick"]
    out = []
    for i in range(n):
        parts = [rnd.choice(vocabulary) if rnd.random() < .8 else rnd.choice(fixed) for _ in range(rnd.randrange(1, 60))]
        text = "".join(p + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "!?"]) for p in parts)
        out.append((i, text, rnd.choice(["en", "en", "en", "de", None, "und"])))
    return out + [(900, None, "en"), (901, "", "fr"), (902, " .\t", None), (None, "new york", "en"), (903, "x " * 3000, "de")]


@pytest.mark.parametrize("seed,threshold,top", [(1, 10, 2000), (2, 3, 7)])
def test_phrases_equal_brute_force(spark, seed, threshold, top):
    rows = phrase_rows(seed)
    docs = spark.createDataFrame(rows, DOCS)
    got = rows_of(collocations.mine(docs, threshold=threshold, top=top))
    want = brute_phrases(rows, threshold, 5, top)
    assert want and got == want


def test_phrases_of_small_flushes_and_many_tasks(spark, monkeypatch):
    rows = phrase_rows(3)
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    counts, totals = collocations.frequent_phrases(docs, 5)
    wide = collocations.frequent_phrases(docs.coalesce(1), 5)[0]
    assert rows_of(counts) == rows_of(wide)
    assert sum(r.n for r in totals.collect()) == sum(len(re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", t or "")) for _, t, _ in rows)


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS + ", phrase int, f int, k string")
    assert collocations.mine(docs).collect() == []
    docs = spark.createDataFrame([(1, None, "en", 1, 1, "x"), (2, "only once", None, 2, 2, "y")], DOCS + ", phrase int, f int, k string")
    assert collocations.mine(docs).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000
    counts = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 2)], "lang string, k int, phrase string, f long")
    totals = spark.createDataFrame([("en", 9 * 10**15 + 7)], "lang string, n long")
    row = collocations.scored(counts, totals).first()
    assert row.score == 1000 * (big - 2) * (9 * 10**15 + 7) // (big * (big - 1))


@pytest.mark.parametrize("seed", range(4))
def test_misra_gries_keeps_every_frequent_key(seed):
    """Merged summaries of any split lose less than the threshold, and no frequent key."""
    rnd = np.random.default_rng(seed)
    threshold = 50
    stream = np.concatenate([rnd.integers(0, 20000, 30000), np.repeat(rnd.integers(0, 20000, 12), [50, 51, 60, 80, 99, 400, 50, 50, 70, 50, 52, 3000])]).astype(np.uint64)
    rnd.shuffle(stream)
    size = collocations.capacity(len(stream), threshold)
    keys, counts, lost = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    for part in np.array_split(stream, 9):
        k, n, cut = collocations.misra_gries(*collocations.combined(part), size)
        lost += cut
        keys, counts = collocations.combined(np.concatenate([keys, k]), np.concatenate([counts, n]))
        keys, counts, cut = collocations.misra_gries(keys, counts, size)
        lost += cut
        assert len(keys) <= size
    assert 0 < lost < threshold
    true = Counter(stream.tolist())
    assert {x for x, n in true.items() if n >= threshold} <= set(collocations.survivors(keys, counts, lost, threshold).tolist())


# ------------------------------------------------------------------ audit
def brute_audit(docs, labels):
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    seen = []
    for i, text, lang in docs:
        t = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {c for c, bad in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                                               bool(re.search("[#$%&*|]", t)), i is not None and i > first[t])) if bad}
        seen.append((lang or "", fails, i in good, i in toxic))
    out = []
    for part in {s[0] for s in seen}:
        mine, shapley, rows = [s for s in seen if s[0] == part], Counter(), []
        for order in permutations("ABCDE"):
            stay = mine
            for step, f in enumerate(order):
                gone = [s for s in stay if f in s[1]]
                before = len([s for s in mine if f in s[1]]) - len(gone)
                stay = [s for s in stay if f not in s[1]]
                shapley[f] += len(gone)
                rows.append((part, "".join(order), step + 1, len(stay), len(gone), before, len([s for s in mine if s[1] == {f}]),
                             sum(s[2] for s in gone), sum(s[3] for s in gone), f))
        out += [(*r[:-1], shapley[r[-1]]) for r in rows]
    return sorted(out)


def audit_docs(seed):
    rnd = random.Random(seed)
    texts = [None, "", " \n", "A B C", "one # two", "x" * 5000]
    for _ in range(12):
        n = rnd.choice([20, 99, 100, 101, 150])
        words = [f"w{rnd.randrange(rnd.choice([40, 5000]))}" for _ in range(n)]
        if rnd.random() < .4:
            words = [w.upper() + "QQQQ" if rnd.random() < .5 else w for w in words]
        texts.append(rnd.choice(["", " ", "\t"]) + rnd.choice([" ", "\x0b", " \r\n"]).join(words) + rnd.choice(["", " |", "\n"]))
    rows = [(rnd.choice([i, i, i, None, 3]), rnd.choice(texts), rnd.choice(["en", "de", None, ""])) for i in range(80)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(60)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_all_orders_run_one_by_one(spark, seed):
    rows, labels = audit_docs(seed)
    docs = spark.createDataFrame([(*r, 7, "z") for r in rows], DOCS + ", mask int, words string")
    marks = spark.createDataFrame([(*x, "p") for x in labels], "doc_id long, quality int, toxic int, part string")
    assert rows_of(filter_audit.audit(docs, marks)) == brute_audit(rows, labels)


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    some = spark.createDataFrame([(1, None, None)], DOCS)
    assert len(filter_audit.audit(some, labels).collect()) == 600


def test_potentials_give_shapley_values_for_any_number_of_filters(spark):
    rnd = random.Random(4)
    masks = [rnd.randrange(8) for _ in range(50)]
    counts = spark.createDataFrame([("p", m, masks.count(m), 0, 0) for m in set(masks)], "part string, mask int, n long, good long, toxic long")
    got = filter_audit.potentials(counts, "XYZ").first()
    want = [0, 0, 0]
    for order in permutations(range(3)):
        before = 0
        for i in order:
            want[i] += sum(1 for m in masks if m >> i & 1 and not m & before)
            before |= 1 << i
    assert got.shapley == want and got.potential[7] - 3 * got.potential[3] == want[2]


# ------------------------------------------------------------------ simhash
def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps, distance):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x
    order = sorted(root)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (a ^ b).bit_count() <= distance and find(a) != find(b):
                root[find(a)] = find(b)
    return {f: find(f) for f in order}


def near_texts(seed):
    rnd = random.Random(seed)
    out = [None, "", " \t\n", "One", "one", "two words", "A b C d", "a B c D", "é É", "word " * 70000]
    for _ in range(4):
        base = [f"w{rnd.randrange(2000)}" for _ in range(rnd.choice([5, 60, 400]))]
        for _ in range(12):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2, 6])):
                w[rnd.randrange(len(w))] = f"z{rnd.randrange(99)}"
            out.append(" ".join(w))
    return [(i, t) for i, t in enumerate(out)] + [(None, out[10]), (3, out[11]), (3, out[11]), (None, "nameless text of its own here")]


@pytest.mark.parametrize("per_key,key_limit", [(256, 8192), (1, 8192), (256, 3)])
def test_simhash_components_equal_brute_force(spark, per_key, key_limit):
    rows = near_texts(5)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, key int").repartition(5)
    fps = [brute_fingerprint(t) for _, t in rows]
    cls = brute_classes(set(fps), 4)
    least = defaultdict(lambda: None)
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[cls[f]] = i if least[cls[f]] is None else min(i, least[cls[f]])
    want = sorted(((i, f"{f:016x}", least[cls[f]]) for (i, _), f in zip(rows, fps)), key=repr)
    got = sorted((tuple(r) for r in simhash.components(docs, per_key=per_key, key_limit=key_limit).collect()), key=repr)
    assert got == want
    assert len({c for _, _, c in want}) < len(set(fps))


@pytest.mark.parametrize("rows", [10, 10**6, 10**10])
def test_blocks_hold_every_close_pair(rows):
    masks = simhash.block_masks(rows)
    rnd = random.Random(rows)
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_a_dense_group_gives_spanning_links_only(spark):
    """700 fingerprints within two bits of one another: their links number no more than they do."""
    fps = [1 << a | 1 << b for a in range(40) for b in range(a)][:700]
    rows = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long").repartition(4)
    links = simhash.close_links(rows, len(fps)).collect()
    assert len(links) <= len(fps) * len(simhash.block_masks(len(fps)))
    close = simhash.close_links(rows, len(fps), key_limit=100).collect()
    for got in (links, close):
        root = {f: f for f in (simhash._signed(f) for f in fps)}

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x
        for a, b in got:
            root[find(a)] = find(b)
        assert len({find(f) for f in root}) == len(set(brute_classes(fps[:], 4).values()))


def test_simhash_of_nothing(spark):
    assert simhash.components(spark.createDataFrame([], DOCS)).collect() == []


def test_fingerprint_query_reads_whole_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.fingerprint for r in QUERIES["op13_simhash_near_duplicates"](spark, SF).collect()}
    assert got == {r.doc_id: f"{brute_fingerprint(r.text):016x}" for r in docs.select(F.col("doc_id"), "text").collect()}
