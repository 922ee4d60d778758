"""Quality rules, language identification and pseudonyms against brute force and exact properties."""

import datetime
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from meterbill.llm import language_id, pseudonyms, quality
from meterbill.llm.common import table

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    """The contract's counts, written out."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@pytest.fixture(scope="module")
def judged(spark):
    return {r.doc_id: r for r in quality.assess(table(spark, SF, "documents")).collect()}


def test_counts_equal_brute_force(spark, judged):
    for d in table(spark, SF, "documents").collect():
        r = judged[d.doc_id]
        want = plain_counts(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("text", [None, "", "\xa0 a b\x1cc", "a b c d e f g h a b c d e f g h", "x\n\nx\r\nx", "a " * 30, "é|<\n" * 4])
def test_counts_of_odd_texts(text):
    assert quality.text_stats(text)[:5] == plain_counts(text)


def test_outliers_are_the_labelled_junk(spark, judged):
    labels = table(spark, SF, "labels").collect()
    passed = [(r.quality, judged[r.doc_id].kept) for r in labels if not judged[r.doc_id].base_failed]
    good, bad = [k for q, k in passed if q == 1], [k for q, k in passed if q == 0]
    assert len(good) > 200 and all(good)
    assert sum(bad) <= 0.1 * len(bad)


def brute_mcd(x, steps=quality.STEPS):
    """The concentration steps over one group, in numpy and without a grid."""
    floors = np.array(list(quality.STATS.values()))
    centre = np.median(x, axis=0)
    scale = np.maximum(1.4826 * np.median(np.abs(x - centre), axis=0), floors)
    inverse = np.diag(1 / scale ** 2)
    for _ in range(steps):
        d2 = np.einsum("ni,ij,nj->n", x - centre, inverse, x - centre)
        inner = x[d2 <= np.quantile(d2, quality.SUPPORT)]
        centre = inner.mean(axis=0)
        cov = quality.CONSISTENCY * (inner.T @ inner / len(inner) - np.outer(centre, centre))
        cov[np.diag_indices(len(floors))] += np.maximum(0, floors ** 2 - np.diag(cov)) + 1e-9
        w, v = np.linalg.eigh(cov)
        inverse = (v / w.clip((0.5 * floors.min()) ** 2)) @ v.T
    return np.einsum("ni,ij,nj->n", x - centre, inverse, x - centre)


def test_distances_follow_the_estimate_computed_at_once(spark):
    docs = table(spark, SF, "documents").filter("lang = 'en'").selectExpr("doc_id", "text", "'en' as lang", "'one' as source")
    got = {r.doc_id: r for r in quality.assess(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = [i for i in texts if not got[i].base_failed]
    x = np.array([quality.text_stats(texts[i])[5:] for i in ids])
    want = brute_mcd(x)
    assert np.corrcoef(np.log1p([got[i].distance for i in ids]), np.log1p(want))[0, 1] > 0.99
    assert np.mean([got[i].kept == (w <= quality.CUTOFF) for i, w in zip(ids, want)]) > 0.995


def test_quality_cases(spark):
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None, None, None), (2, "", "en", None), (3, words, None, "s"), (3, words, None, "s"), (None, words, "en", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as n_words", "2 as kept", "3 as row")
    got = sorted((r.doc_id or -1, r.n_words, r.base_failed, r.kept) for r in quality.assess(docs).collect())
    assert got == [(-1, 30, False, True), (1, 0, True, False), (2, 0, True, False), (3, 30, False, True), (3, 30, False, True)]
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or -1, r.n_words, r.row) for r in kept.collect()) == [(-1, 1, 3), (3, 1, 3), (3, 1, 3)]
    assert quality.assess(docs.limit(0)).count() == 0 and quality.keep(docs.limit(0)).count() == 0


def test_language_accuracy_on_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_id.identify(docs).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.lang_pred in set(lang.values()) for r in rows)


def test_language_does_not_depend_on_columns_other_than_text(spark):
    docs = table(spark, SF, "documents")
    model = language_id.sample(docs)
    some = docs.limit(50)
    shuffled = some.selectExpr("doc_id + 1000000 as doc_id", "text", "'xx' as lang", "'none' as source", "1 as score", "2 as held_out")
    a = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(some, model).collect()}
    b = {r.doc_id - 1000000: (r.lang_pred, r.score) for r in language_id.identify(shuffled, model).collect()}
    assert a == b


def test_language_cases(spark):
    docs = spark.createDataFrame([(0, "the cat sat on the mat and the dog", "en"), (0, "the cat sat on the mat and the dog", "en"),
                                  (2, None, "en"), (3, "12 !?", "fr"), (None, "chat", None), (5, "le chat est sur la table avec le chien", "fr")],
                                 "doc_id long, text string, lang string")
    rows = language_id.identify(docs).collect()
    assert len(rows) == 6 and all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (2, 3))
    assert language_id.identify(docs.limit(0)).count() == 0
    nothing = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language_id.identify(nothing).collect()} == {"und"}


@pytest.fixture(scope="module")
def names():
    return pseudonyms.Pseudonyms(b"test key")


def test_permutation_is_a_bijection(names):
    for size in (1, 2, 3, 10, 97, 1000):
        image = [names.permute(x, size, "t") for x in range(size)]
        assert sorted(image) == list(range(size))
        assert all(names.permute(y, size, "t", forward=False) == x for x, y in enumerate(image))


def test_formats_are_kept_and_values_change(names):
    values = {"card": "4111 1111 1111 1111", "phone": "+1 (988) 555-2485", "ip": "42.144.35.254", "ssn": "123-45-6789",
              "iban": "DE89 3704 0044 0532 0130 00", "email": "bosbt.42@mail8.example.com"}
    for kind, value in values.items():
        new, spans = names.replace(f"x {value}, y {value}. z")
        assert [s[0] for s in spans] == [kind, kind]
        a, b = re.fullmatch(r"x (.*), y (.*)\. z", new).groups()
        assert a == b != value
        shape = lambda t: re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "9", t)))
        assert kind == "ip" or shape(a) == shape(value)
        again = names.replace(f"x {a}, y")[1]
        assert [s[0] for s in again] == [kind]           # the pseudonym validates too


@pytest.mark.parametrize("value", ["1980-02-29", "03/04/1999", "12/31/1999", "1.2.2001", "2024/12/01"])
def test_dates_stay_dates(names, value):
    new, spans = names.replace(f"born {value} in")
    assert spans[0][0] == "date" and new != f"born {value} in"
    parts = re.findall(r"\d+", new)
    y, rest = (parts[0], parts[1:]) if len(parts[0]) == 4 else (parts[2], parts[:2])
    month = {"1980-02-29": 0, "2024/12/01": 0, "12/31/1999": 0}.get(value, 1)
    datetime.date(int(y), int(rest[month]), int(rest[1 - month]))


@pytest.mark.parametrize("text", ["4111 1111 1111 1112", "1234567890123", "300.1.1.1", "666-45-6789", "1999-13-41", "DE00 3704 0044 0532 0130 00",
                                  "v1.2.3.4.5", "a@b", "no values", "", None])
def test_what_does_not_validate_is_left_alone(names, text):
    assert names.replace(text) == (text, [])


def test_neighbouring_values_are_all_found(names):
    text = "call +1 (269) 555-3296 4111111111111111 and 42.144.35.254 a.01@mail8.example.com"
    new, spans = names.replace(text)
    assert [s[0] for s in spans] == ["phone", "card", "ip", "email"]
    assert not set(text.split()[3:]) & set(new.split()) - {"and"}


@pytest.mark.parametrize("text,phones", [
    ("call 212-555-0187 1200 y", ["212-555-0187"]), ("555-123-4567 555 987 6543", ["555-123-4567"]), ("on 1200 212-555-0187 y", ["212-555-0187"]),
    ("212-555-0187 555-123-4567", ["212-555-0187", "555-123-4567"]), *[(f"a 555-123-4567 {n} z", ["555-123-4567"]) for n in range(2020, 2040)],
    *[(f"a {n} 555-123-4567 z", ["555-123-4567"]) for n in range(2020, 2040)]])
def test_phones_beside_other_digits_are_found(names, text, phones):
    new, spans = names.replace(text)
    assert [(k, text[a:b]) for k, a, b in spans] == [("phone", p) for p in phones]
    assert not any(p in new for p in phones) and all(names.replace(p)[0] in new for p in phones)


def test_cards_of_any_grouping_are_found(names):
    for card in ("4111 1111 1111 1111", "4111-1111-1111-1111", "4111-1111 1111-1111", "3782 822463 10005", "4111111111111111"):
        assert names.replace(f"a {card} z")[1] == [("card", 2, 2 + len(card))]


def test_values_link_across_documents_and_nothing_else_changes(spark):
    docs = table(spark, SF, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    rows = pseudonyms.findings(docs, b"k").collect()
    hits = 0
    for r in rows:
        outside, at = [], 0
        for s in r.spans:
            outside.append(before[r.doc_id][at:s.start])
            at = s.end
            hits += 1
        outside.append(before[r.doc_id][at:])
        assert re.fullmatch(".+".join(map(re.escape, outside)), r.text, re.S) if r.spans else r.text == before[r.doc_id]
    assert hits > 30
    found = {x for t in before.values() for x in re.findall(r"[\w.+-]+@[\w.-]+\w|\+1 \(\d{3}\) \d{3}-\d{4}", t)}
    assert not any(x in r.text for r in rows for x in found)


def test_pseudonym_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a1@b.com"), (3, "a1@b.com"), (3, "a1@b.com")], "doc_id long, text string") \
        .selectExpr("*", "1 as row", "2 as kinds")
    out = pseudonyms.pseudonymise(docs, b"k")
    assert out.columns == docs.columns
    texts = Counter((r.doc_id, r.text) for r in out.collect())
    assert texts[(1, None)] == texts[(2, "")] == 1 and len({t for (i, t) in texts if i in (None, 3)}) == 1 and max(texts.values()) == 2
    assert pseudonyms.findings(docs.limit(0), b"k").count() == 0 and pseudonyms.pseudonymise(docs.limit(0), b"k").count() == 0


def test_every_small_domain_is_permuted_without_a_fixed_point(names):
    back = pseudonyms.Pseudonyms(b"test key", forward=False)
    for size in [*range(2, 120), 1000, 9999]:
        image = [names.move(x, size, "t") for x in range(size)]
        assert sorted(image) == list(range(size)) and all(x != y for x, y in enumerate(image))
        assert [back.move(y, size, "t") for y in image] == list(range(size))
    small = [f"{a}{b}@x.org" for a in pseudonyms.LOWER for b in pseudonyms.DIGITS]
    got = [names.value("email", v) for v in small]
    assert sorted(got) == sorted(small) and all(a != b for a, b in zip(small, got))


def test_every_day_has_its_own_pseudonym_in_every_notation(names):
    days = [datetime.date.fromordinal(pseudonyms.EPOCH + n) for n in range(0, pseudonyms.DAYS)]
    iso = {d: names.value("date", d.isoformat()) for d in days}
    assert len(set(iso.values())) == len(days) and all(d.isoformat() != v for d, v in iso.items())
    for d in days[::37]:
        to = datetime.date.fromisoformat(iso[d])
        assert names.value("date", f"{d:%d.%m.%Y}") == f"{to:%d.%m.%Y}"
        if d.day > 12:     # month first, and still only to be read so
            assert names.value("date", f"{d:%m/%d/%Y}") == f"{to:%m/%d/%Y}" and to.day > 12


def test_one_number_in_two_notations_has_one_pseudonym(names):
    digits = lambda t: "".join(c for c in t if c.isdigit())
    assert digits(names.value("phone", "+1 212-555-0187")) == "1" + digits(names.value("phone", "212-555-0187"))
    french = names.value("phone", "01 23 45 67 89")
    assert digits(names.value("phone", "+33 1 23 45 67 89")) == "33" + digits(french)[1:] and french[0] == "0" and french[1] != "0"
    text = names.replace("at 2024-03-05T10:00:00 call 01 23 45 67 89.")[0]
    assert "2024-03-05" not in text and "01 23 45 67 89" not in text and "T10:00:00 call 0" in text


def test_undo_gives_every_text_back(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    hidden = pseudonyms.pseudonymise(docs, b"one key")
    assert hidden.exceptAll(docs).count() > 0
    assert pseudonyms.undo(hidden, b"one key").exceptAll(docs).count() == 0
    assert pseudonyms.undo(hidden, b"another key").exceptAll(docs).count() > 0


@pytest.mark.parametrize("text", ["²³ ½ ②", "Ⅻ 1 ٣", "۱ _ !", "́"])
def test_numerals_are_no_letters(text):
    model = language_id.CompressionClassifier({"de": ["der die das und nicht " * 9], "en": ["the and of to in not " * 9]})
    assert model.predict(text)[0] == "und" and model.predict(text + " nicht")[0] == "de"


def test_ties_look_at_the_whole_text_and_rare_labels_are_learned(spark):
    model = language_id.CompressionClassifier({"aa": ["xyz " * 30], "bb": ["uvw " * 30]})
    assert model.matches("q " * 300 + "uvw", 1) > model.matches("q " * 300 + "uvw", 0)
    rows = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}ord{chr(97 + k)}" for k in range(20)), f"l{i:03d}") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language_id.sample(docs)
    assert set(learned) == {l for i, _, l in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    size, slots, chars = language_id.shares(100_000)
    assert 100_000 * min(size, slots * chars) < 1 << 28 and language_id.shares(4) == (language_id.DICTIONARY, 64, language_id.SAMPLE_CHARS)
