"""The n-gram join, components and sentence spans against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterbill.llm import components, ngram_join, sentence_spans
from meterbill.llm.common import table
from meterbill.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def brute_components(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and len(x) * 100 >= len(y) * percent and len(y) * 100 >= len(x) * percent and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, n=40):
    rnd = random.Random(seed)
    base = [[f"w{rnd.randrange(400)}" for _ in range(rnd.choice([4, 9, 12, 30, 120, 300]))] for _ in range(6)]
    out = {}
    for i in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 5])):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(9)}"
        out[i] = " ".join(words)
    return out | {n: None, n + 1: "", n + 2: " \n", n + 3: "lone", n + 4: "LONE"}


@pytest.mark.parametrize("width,percent,block", [(3, 90, 1_000_000), (3, 90, 600), (5, 80, 1_000_000)])
def test_components_equal_brute_force(spark, width, percent, block):
    texts = near_copies(width + block) | {1000 + i: t for i, t in near_copies(9, 10).items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.components(docs, width, percent, block).collect()}
    assert got == brute_components(texts, width, percent)


@pytest.mark.parametrize("percent", [90, 80, 70])
def test_linked_sets_share_a_signature(percent):
    rnd = random.Random(percent)
    met = 0
    for _ in range(1500):
        n = rnd.choice([1, 2, 5, 8, 9, 10, 11, 12, 19, 20, 40, 100, 300])
        a = [rnd.getrandbits(64) for _ in range(n)]
        b = a[:]
        drop = rnd.random()
        for _ in range(rnd.randint(0, n * (100 - percent) // 100 + 1)):
            if rnd.random() < drop and b:
                b.pop(rnd.randrange(len(b)))
            else:
                b.append(rnd.getrandbits(64))
        x, y = np.unique(np.array(a, np.uint64)), np.unique(np.array(b, np.uint64))
        if len(y) and (len(x) != len(y) or (x != y).any()) and ngram_join.linked(x, y, percent):
            met += 1
            assert set(ngram_join.signatures(x, percent).tolist()) & set(ngram_join.signatures(y, percent).tolist())
    assert met > 200


def test_signature_tree_finds_every_component():
    rnd = random.Random(5)
    sets = []
    for _ in range(12):
        base = [rnd.getrandbits(64) for _ in range(rnd.choice([20, 60, 200]))]
        for _ in range(rnd.randint(1, 12)):
            s = set(base)
            for _ in range(rnd.randint(0, 6)):
                s.discard(rnd.choice(base))
                s.add(rnd.getrandbits(64))
            sets.append(np.array(sorted(s), np.uint64))

    def label(links):
        mark = list(range(len(sets)))
        for a, b in links:
            x, y = mark[a], mark[b]
            mark = [min(x, y) if m in (x, y) else m for m in mark]
        return mark
    every = [(a, b) for a in range(len(sets)) for b in range(a) if ngram_join.linked(sets[a], sets[b])]
    assert label(ngram_join.tree_links(sets)) == label(every)


def test_join_cases(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (None, "q r s t"), (None, "q r s t"),
            (3, None), (4, ""), (4, ""), (5, "x"), (6, "x"), (1, "zz yy xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as cls", "2 as n", "3 as row", "4 as id")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in ngram_join.components(docs).collect())
    assert got == sorted([(-1, 4, 1), (-1, 2, -1), (-1, 2, -1), (1, 4, 1), (1, 4, 1), (1, 1, 1), (2, 4, 1), (3, 0, 3), (4, 0, 4), (4, 0, 4), (5, 1, 5), (6, 1, 5)])
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect() if r.text) == [(-1, "q r s t"), (1, "a b c d e f"), (1, "zz yy xx"), (5, "x")]
    assert kept.filter("text is null or text = ''").count() == 3
    assert ngram_join.components(docs.limit(0)).count() == 0 and ngram_join.keep_one(docs.limit(0)).count() == 0


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (200, 200), (None, 5), (7, None)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("task_edges", [1_000_000, 7])
def test_contracted_components(spark, monkeypatch, task_edges):
    monkeypatch.setattr(components, "TASK_EDGES", task_edges)
    rnd = random.Random(task_edges)
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (200, 200), (None, 5)] + [(1000 + rnd.randrange(40), 1000 + rnd.randrange(40)) for _ in range(25)]
    want = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {r.node: r.root for r in components.contracted_components(spark.createDataFrame(edges, "a long, b long")).collect()} == want
    assert components.contracted_components(spark.createDataFrame([], "a long, b long")).count() == 0


def sentences_of(text):
    """Words of every sentence, by regular expressions on the text; a run-on sentence is None."""
    out = []
    for line in re.split(r"[\n\r]", text or ""):
        for part in re.split(r"(?<=[.!?])[\"')\]}]{0,2}(?=[ \t\x0b\x0c])", line):
            words = tuple(w for w in re.split(r"[\x00-/:-@\[-`{-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), part)) if w)
            if words:
                out.append(words)
    return out


def brute_spans(texts):
    """Sentences of each text that a span covers which occurs earlier: the shortest run of 3 sentences and 20 words or 2 and 40."""
    places = defaultdict(list)
    gone = {i: set() for i in texts}
    for i in sorted(texts):
        own = sentences_of(texts[i])
        for u in range(len(own)):
            for v in range(u + 2, len(own) + 1):
                words = sum(own[u:v], ())
                if len(words) >= 40 or v - u >= 3 and len(words) >= 20:
                    places[words].append((i, u, v))
                    break
    for found in places.values():
        for i, u, v in sorted(found)[1:]:
            gone[i] |= set(range(u, v))
    return gone


def test_spans_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    # texts with a run-on sentence have a test of their own
    texts = {r.doc_id: r.text for r in docs.collect() if all(len(w) <= sentence_spans.RUN_ON for w in sentences_of(r.text))}
    want = brute_spans(texts)
    got = sentence_spans.deduplicate(docs.filter(F.col("doc_id").isin(list(texts)))).collect()
    assert len(got) == len(texts) > 100 and sum(map(len, want.values())) > 100
    for r in got:
        assert r.n_removed == len(want[r.doc_id]) and {u for x in r.removed for u in range(x.start, x.end)} == want[r.doc_id]
        left = [w for k, w in enumerate(sentences_of(texts[r.doc_id])) if k not in want[r.doc_id]]
        assert r.text == texts[r.doc_id] if not r.n_removed else sum(sentences_of(r.text), ()) == sum(left, ())


@pytest.mark.parametrize("seed", range(3))
def test_made_spans_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    pool = [" ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(1, 30))) for _ in range(12)]
    texts = {i: "".join(rnd.choice(pool) + rnd.choice([". ", "! ", ".) ", "?\" ", "\n", ".x ", ", "]) for _ in range(rnd.randrange(14))) for i in range(60)}
    texts = {i: t for i, t in texts.items() if all(len(w) <= sentence_spans.RUN_ON for w in sentences_of(t))}
    want = brute_spans(texts)
    got = sentence_spans.deduplicate(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: {u for x in r.removed for u in range(x.start, x.end)} for r in got} == want and any(want.values())


def test_one_shared_sentence_is_no_span(spark):
    line = " ".join(f"word{k}" for k in range(32)) + "."
    docs = spark.createDataFrame([(i, f"First {i} of all {i}. {line} Last {i} of all {i}.") for i in range(5)], "doc_id long, text string")
    assert all(r.n_removed == 0 for r in sentence_spans.deduplicate(docs).collect())


def test_scripts_without_spaces_have_sentences_and_words(spark):
    rnd = random.Random(3)
    sentence = lambda: "".join(chr(0x4e00 + rnd.randrange(3000)) for _ in range(12)) + "\u3002"
    shared = "".join(sentence() for _ in range(4))
    docs = {i: sentence() + shared + sentence() + "Latin words too. " + sentence() for i in range(3)}
    got = {r.doc_id: r for r in sentence_spans.deduplicate(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert got[0].text == docs[0]
    for i in (1, 2):
        assert got[i].text == docs[i].replace(shared, "") and got[i].n_removed == 4


def test_second_hashes_follow_the_words_alone(monkeypatch):
    monkeypatch.setattr(sentence_spans, "run_hashes", lambda words, a, b: np.zeros(len(a), np.uint64))    # every first hash collides

    def second(text):
        _, _, at, words, plain = sentence_spans.units(text)
        return sentence_spans.spans(at, words, plain)[3].tolist()
    texts = ["".join(f"a{i} b{i} c{k} d{k} e f g. " for k in range(4)) for i in range(3)]
    assert len({h for t in texts for h in second(t)}) == 6
    assert second(texts[0]) == second("Zero, one.\n" + texts[0].upper().replace(" E", ",  e"))[-2:]


def test_long_passages_stay_once(spark):
    rnd = random.Random(6)

    def prose(n, stops):
        return " ".join(f"p{rnd.randrange(5000)}" + (". " if stops and rnd.random() < 0.1 else "") for _ in range(n))
    full, single = prose(60, True), prose(70, False)
    docs = {i: f"{prose(40, True)}.\n{full}\n{prose(30, True)} {single} {prose(10, True)}" for i in range(6)} | {9: prose(200, True)}
    got = {r.doc_id: r for r in sentence_spans.deduplicate(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert got[0].text == docs[0] and got[9].text == docs[9] and got[9].n_removed == 0
    for i in range(1, 6):
        left = set(got[i].text.replace(".", "").split())
        for passage in (full, single):
            words = passage.replace(".", "").split()
            assert sum(w in left for w in words) < 0.35 * len(words)


def test_span_cases(spark):
    text = "one two three four five six seven eight. nine ten eleven twelve thirteen. fourteen fifteen sixteen seventeen eighteen nineteen twenty."
    rows = [(1, text), (1, text), (2, text.upper()), (None, text), (None, text), (3, None), (4, ""), (5, "short. one.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as doc", "2 as h", "3 as gone")
    got = sorted(((r.doc_id or -1), r.text or str(r.text)) for r in sentence_spans.deduplicate(docs).collect())
    assert got == sorted([(1, text), (1, text), (2, ""), (-1, ""), (-1, ""), (3, "None"), (4, ""), (5, "short. one.")])
    assert sentence_spans.deduplicate(docs.limit(0)).count() == 0
