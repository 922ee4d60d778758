"""Word hashing, decontamination and piece coding against brute force."""

import random

import numpy as np
import pytest

from meterbill.llm import decontaminate, pieces, wordhash
from meterbill.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("text", ["", " ", "a", "a b", "x\ty\nz  w", "é ü\x0bß\x0c a", "long " * 100_000, "z" * 700_000 + " q z"])
def test_word_hashes_tell_words_apart(text):
    data = text.encode()
    words, hashes = data.split(), wordhash.word_hashes(data).tolist()
    assert len(words) == len(hashes)
    assert len(set(words)) == len(set(hashes)) == len(set(zip(words, hashes)))


def test_run_hashes_are_equal_for_equal_runs_only():
    words = np.array([5, 6, 7, 5, 6, 7, 8], np.uint64)
    h = wordhash.run_hashes(words, np.array([0, 3, 0, 4]), np.array([3, 6, 2, 7]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3


def brute_edits(item, text):
    """Least word edits between ``item`` and any passage of ``text``."""
    best = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        now = [i]
        for j, x in enumerate(text, 1):
            now.append(min(best[j] + 1, now[j - 1] + 1, best[j - 1] + (w != x)))
        best = now
    return min(best)


def test_best_passage_equals_brute_force():
    rnd = random.Random(4)
    for _ in range(200):
        item = np.array([rnd.randrange(5) for _ in range(rnd.randint(1, 12))], np.uint64)
        text = np.array([rnd.randrange(5) for _ in range(rnd.randint(0, 30))], np.uint64)
        edits, a, b = decontaminate.best_passage(item, text)
        assert edits == brute_edits(item.tolist(), text.tolist())
        assert 0 <= a <= b <= len(text)


def test_decontamination_recall_at_the_bound_and_no_false_hits(spark):
    bench = [r.text for r in table(spark, SF, "benchmark").orderBy("item_id").collect()]
    docs = [r.text for r in table(spark, SF, "documents").orderBy("doc_id").limit(100).collect()]
    index = decontaminate.ItemIndex(bench)
    rnd = random.Random(3)
    vocabulary = [w for t in bench for w in t.split()]
    met = found = 0
    for _ in range(150):
        i = rnd.randrange(len(bench))
        words = bench[i].split()
        allowed = decontaminate.allowed_edits(len(index.items[i]))
        for _ in range(allowed):
            kind, j = rnd.random(), rnd.randrange(len(words))
            if kind < 0.4:
                words[j] = rnd.choice(vocabulary)
            elif kind < 0.7:
                words.insert(j, rnd.choice(vocabulary))
            else:
                words.pop(j)
        base = rnd.choice(docs).split()
        at = rnd.randrange(len(base) + 1)
        text = " ".join(base[:at] + words + base[at:])
        if decontaminate.best_passage(index.items[i], decontaminate.words_of(text))[0] <= allowed:
            met += 1
            found += any(x[1] == i for x in index.search([text]))
    assert met > 100 and found >= 0.93 * met
    for text, hits in ((t, index.search([t])) for t in docs):
        for _, item, edits, a, b in hits:
            words = decontaminate.words_of(text)
            assert brute_edits(index.items[item].tolist(), words.tolist()) == edits <= decontaminate.allowed_edits(len(index.items[item]))
            assert 0 <= a < b <= len(words)


@pytest.mark.parametrize("n,share", [(16, 0.2), (40, 0.2), (100, 0.2), (100, 0.1), (200, 0.2), (200, 0.05), (400, 0.2), (400, 0.15)])
def test_recall_does_not_fall_with_the_length_of_items(n, share):
    rnd = random.Random(n + int(100 * share))
    some = lambda k: [f"w{rnd.randrange(20_000)}" for _ in range(k)]
    items = [some(n) for _ in range(40)]
    index = decontaminate.ItemIndex([" ".join(x) for x in items])
    texts = []
    for words in map(list, items):
        for _ in range(int(share * n + 1e-9)):
            kind, j = rnd.random(), rnd.randrange(len(words))
            if kind < 0.4:
                words[j] = some(1)[0]
            elif kind < 0.7:
                words.insert(j, some(1)[0])
            else:
                words.pop(j)
        texts.append(some(50) + words + some(50))
    want = {i for i, t in enumerate(texts) if brute_edits(items[i], t) <= decontaminate.allowed_edits(n)}
    got = {t: (item, edits) for t, item, edits, _, _ in index.search([" ".join(t) for t in texts])}
    assert len(want) == len(items) and all(got[t] == (t, brute_edits(items[t], texts[t])) for t in got)
    assert len(got) >= (0.9 if n < 40 else 0.97) * len(want)


def test_short_items_match_exactly_and_characters_are_words_without_spaces():
    chinese = "今天天气很好我们一起去公园散步然后回家吃饭"
    thai = "ประเทศไทยมีเมืองหลวงคือกรุงเทพ"
    index = decontaminate.ItemIndex(["What is the capital?", "what IS the capital", "Zyzzyva", chinese, "北京。", "", thai])
    near = chinese[:5] + "不" + chinese[6:]
    texts = ["So what is the capital of it, what is the capital", "what is a capital", "a zyzzyva x zyzzyva", f"他说：“{near}。”", "去北京吧", "北方京城", None, "", f"x{thai}y"]
    assert sorted(index.search(texts)) == [(0, 0, 0, 1, 5), (0, 1, 0, 1, 5), (2, 2, 0, 1, 2), (3, 3, 1, 3, 3 + len(chinese)), (4, 4, 0, 1, 3), (8, 6, 0, 1, 1 + len(thai))]
    assert decontaminate.ItemIndex(["too short"]).search(["not too short", "too", None]) == [(0, 0, 0, 1, 3)]


def test_exact_passages_are_all_found(spark):
    bench = {r.item_id: r.text for r in table(spark, SF, "benchmark").collect()}
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {(r.doc_id, r.item_id) for r in decontaminate.search(table(spark, SF, "documents"), table(spark, SF, "benchmark")).collect()}
    exact = {(d, i) for d, t in docs.items() for i, b in bench.items() if b in t}
    assert exact and exact <= got


def test_decontamination_cases(spark):
    long = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, long), (2, long), (3, None), (4, ""), (5, "too short"), (None, long)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {long.upper()}!"), (1, f"x {long.upper()}!"), (2, None), (3, ""), (None, long + " y"), (4, "no match here")],
                                 "doc_id long, text string").selectExpr("*", "1 as item_key", "2 as row")
    got = sorted((r.doc_id or -1, r.item_id or -1, r.edits, r.start_word) for r in decontaminate.search(docs, bench).collect())
    assert got == sorted([(-1, x, 0, 0) for x in (1, 2, -1)] + [(1, x, 0, 1) for x in (1, 2, -1)] * 2)
    kept = decontaminate.drop(docs, bench, block_chars=20)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert decontaminate.search(docs.limit(0), bench).count() == 0
    assert decontaminate.search(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop(docs, bench.limit(0)).count() == 6


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder(pieces.read_pieces())


def test_viterbi_equals_brute_force_and_round_trips(coder):
    table_ = pieces.read_pieces()
    by_name = {n: s for n, s, _ in table_ if n}
    longest = max(map(len, by_name))

    def best(text):
        score = [0.0] + [float("-inf")] * len(text)
        for e in range(1, len(text) + 1):
            for a in range(max(0, e - longest), e):
                if text[a:e] in by_name:
                    score[e] = max(score[e], score[a] + by_name[text[a:e]])
            if text[e - 1] not in by_name:
                score[e] = max(score[e], score[e - 1] + coder.unknown)
        return score[-1]

    def total(ids):
        raw = bytes(table_[i][2] for i in ids if table_[i][2] >= 0)
        return sum(table_[i][1] for i in ids if table_[i][2] < 0) + len(raw.decode()) * coder.unknown

    rnd = random.Random(2)
    texts = ["", " ", "  a  b ", "▁x▁ ▁", "日本語 \U0001F600\n\n tab\t", "x" * 300, "a,b. c!d ²³ _x_"] + \
        ["".join(rnd.choice("abc theé日▁ \n😀',.²_") for _ in range(rnd.randint(1, 40))) for _ in range(150)]
    for text in texts:
        ids = np.frombuffer(coder.encode(text), np.int32).tolist()
        assert coder.decode(ids) == text
        if text:
            assert total(ids) == pytest.approx(best(" " + text), abs=1e-6)


def test_small_cache_gives_the_same_ids(coder):
    small = pieces.PieceCoder(pieces.read_pieces(), cache_units=2)
    text = "the cat and the dog and the bird, " * 5
    assert small.encode(text) == coder.encode(text) == small.encode(text)


def test_piece_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "hi there"), (3, "hi there"), (None, "x" * 100_000)],
                                 "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_tokens")
    rows = pieces.encode(docs).collect()
    assert len(rows) == 5 and all(r.round_trip for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[1].ids is None and by[1].n_tokens is None and by[2].ids == [] and by[2].n_tokens == 0
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs)).collect()}
    assert back == {1: None, 2: "", 3: "hi there", None: "x" * 100_000}
    assert pieces.encode(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, [-5, 1, 2, 999_999])], "doc_id long, ids array<int>")
    assert pieces.decode(odd).first().text == ""
