"""Operators against brute-force Python definitions on random small inputs."""

import datetime as dt
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from meterbill.operators.attributes import attributes_as_of
from meterbill.operators.intervals import covering_counts, range_join
from meterbill.operators.readings import last_reading, latest_max_reading, meter_summary

SETTINGS = settings(max_examples=12, deadline=None)
D0 = dt.date(2024, 1, 1)
READING_SCHEMA = "cd_cntr_kid int, bl_bill_id int, date_ind_take date, value double, cd_indic_src_id string"

dates = st.integers(0, 40).map(lambda d: D0 + dt.timedelta(days=d))
reading = st.tuples(st.integers(0, 3), st.sampled_from([202401, 202402, 202403]),
                    st.one_of(st.none(), dates), st.one_of(st.none(), st.sampled_from([1.0, 2.0, 5.0])),
                    st.sampled_from(["A", "B"]))
full_reading = st.tuples(st.integers(0, 3), st.integers(0, 40), st.sampled_from([1.0, 2.0, 5.0]),
                         st.sampled_from(["A", "B"]))


@SETTINGS
@given(st.lists(reading, max_size=25))
def test_latest_max_reading_matches_definition(spark, rows):
    df = spark.createDataFrame(rows, READING_SCHEMA)
    got = sorted(map(tuple, latest_max_reading(df).select(*df.columns).collect()), key=repr)
    groups = defaultdict(list)
    for r in rows:
        groups[(r[0], r[1])].append(r)
    want = []
    for g in groups.values():
        ds = [r[2] for r in g if r[2] is not None]
        vs = [r[3] for r in g if r[3] is not None]
        if ds and vs:
            want += [r for r in g if r[2] == max(ds) and r[3] == max(vs)]
    assert got == sorted(want, key=repr)


def _with_period(rows):
    out = []
    for m, day, v, s in rows:
        d = D0 + dt.timedelta(days=day)
        out.append((m, d.year * 100 + d.month, d, v, s))
    return out


@SETTINGS
@given(st.lists(full_reading, min_size=1, max_size=25))
def test_last_reading_and_summary_match_definition(spark, raw):
    rows = _with_period(raw)
    df = spark.createDataFrame(rows, READING_SCHEMA)
    by_meter = defaultdict(list)
    for r in rows:
        by_meter[r[0]].append(r)
    last = {m: max(g, key=lambda r: (r[2], r[3], r[4])) for m, g in by_meter.items()}
    got_last = {r.cd_cntr_kid: (r.date_ind_take, r.value, r.cd_indic_src_id) for r in last_reading(df).collect()}
    assert got_last == {m: (r[2], r[3], r[4]) for m, r in last.items()}

    period = 202402
    want_vol = {}
    for m, g in by_meter.items():
        per = defaultdict(list)
        for r in g:
            per[r[1]].append(r)
        ps = sorted(per)
        lv = {p: max(per[p], key=lambda r: (r[2], r[3], r[4]))[3] for p in ps}
        if period in lv and ps.index(period) > 0:
            want_vol[m] = lv[period] - lv[ps[ps.index(period) - 1]]
        else:
            want_vol[m] = None
    got = {r.cd_cntr_kid: (r.volume, r.date_ind_take, r.value) for r in meter_summary(df, period).collect()}
    assert got == {m: (want_vol[m], last[m][2], last[m][3]) for m in by_meter}


intervals = st.tuples(st.integers(0, 400), st.integers(-20, 400), st.one_of(st.none(), st.just(1)))


@SETTINGS
@given(st.lists(intervals, max_size=15), st.lists(st.integers(0, 400), max_size=8))
def test_range_join_paths_match_definition(spark, ivs, pts):
    def day(n):
        return D0 + dt.timedelta(days=n)
    iv_rows = [(i, day(b), day(b + ln) if ln >= 0 else day(b + ln), None if nul else 0)
               for i, (b, ln, nul) in enumerate(ivs)]
    # an open-ended bound (NULL) never matches, like BETWEEN
    iv_rows = [(i, b, None if n is None and i % 2 else e) for i, b, e, n in iv_rows]
    left = spark.createDataFrame(iv_rows, "i int, date_begin date, date_end date")
    right = spark.createDataFrame([(j, day(p), None if j % 2 else "x") for j, p in enumerate(pts)], "j int, d date, label string")
    want = sorted((i, j) for i, b, e in iv_rows for j, p in enumerate(pts)
                  if e is not None and b <= day(p) <= e)
    got = sorted((r.i, r.j) for r in range_join(left, right, "d").collect())
    assert got == want
    counts = {r.j: r.n for r in covering_counts(left, right, "d", out="n").collect()}
    want_counts = {}
    for _, j in want:
        want_counts[j] = want_counts.get(j, 0) + 1
    assert counts == want_counts


attr = st.tuples(st.integers(0, 3), st.sampled_from(["x", "y"]), st.sampled_from(["1", "2", "3"]),
                 st.integers(0, 10), st.integers(0, 10))


@SETTINGS
@given(st.lists(attr, max_size=20), st.integers(0, 12))
def test_attributes_as_of_match_definition(spark, rows, at):
    def ts(h):
        return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    data = [(o, c, v, ts(b), ts(b + ln)) for o, c, v, b, ln in rows]
    df = spark.createDataFrame(data, "object_id int, cn_chrct_id string, value string, "
                                     "date_begin timestamp, date_end timestamp")
    got = {r.object_id: (r.a, r.b) for r in attributes_as_of(df, {"a": "x", "b": "y"}, ts(at)).collect()}
    want = {}
    for o in {r[0] for r in data}:
        vals = []
        for code in ("x", "y"):
            valid = [(r[3], r[2]) for r in data if r[0] == o and r[1] == code and r[3] <= ts(at) <= r[4]]
            vals.append(max(valid)[1] if valid else None)
        if any(v is not None for v in vals):
            want[o] = tuple(vals)
    assert got == want


def _ora_cat(*parts):
    """Oracle ||: NULL is the empty string; an empty result is NULL."""
    out = "".join("" if p is None else str(p) for p in parts)
    return out or None


texts = st.one_of(st.none(), st.sampled_from(["Oak", "Main", "A"]))
nums = st.one_of(st.none(), st.integers(0, 3))


@SETTINGS
@given(st.lists(st.tuples(texts, texts, texts, texts, nums, nums, nums, nums), min_size=1, max_size=10))
def test_oracle_address_matches_model(spark, rows):
    from pyspark.sql import functions as F
    from meterbill.functions.text import FIXTURE_ORACLE_LABELS as L, address_null_as_empty
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, tn string, tt string, sn string, st string, h int, k int, b int, f int")
    got = {r.i: r.a for r in df.select("i", address_null_as_empty(
        F.col("tn"), F.col("tt"), F.col("sn"), F.col("st"), F.col("h"), F.col("k"), F.col("b"), F.col("f"),
        labels=L).alias("a")).collect()}
    for i, (tn, tt, sn, stp, h, k, b, f) in enumerate(rows):
        town = L.default_city if tn is None else _ora_cat(tt, " ", tn)
        want = _ora_cat(town, "" if sn is None else ", ", stp, " ", sn, L.house, h,
                        None if k is None else _ora_cat(L.corpus, k),
                        None if b is None else _ora_cat(L.building, b),
                        None if f is None else _ora_cat(L.flat, f))
        assert got[i] == want


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["", "Oak"])), texts,
                          st.one_of(st.none(), st.sampled_from(["5", "12"])),
                          st.one_of(st.none(), st.sampled_from(["", "a"])),
                          st.one_of(st.none(), st.sampled_from(["", "2"])),
                          nums, st.one_of(st.none(), st.sampled_from(["", "b"]))),
                min_size=1, max_size=10))
def test_firebird_address_matches_model(spark, rows):
    from pyspark.sql import functions as F
    from meterbill.functions.text import FIXTURE_FIREBIRD_LABELS as L, address_null_propagating
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, city string, street string, dom string, dom2 string, korp string, "
                               "kv int, kv2 string")
    got = {r.i: r.a for r in df.select("i", address_null_propagating(
        F.col("city"), F.col("street"), F.col("dom"), F.col("dom2"), F.col("korp"), F.col("kv"),
        F.col("kv2"), labels=L).alias("a")).collect()}

    def cat(*parts):  # Firebird ||: any NULL makes the whole NULL
        return None if any(p is None for p in parts) else "".join(str(p) for p in parts)

    for i, (city, street, dom, dom2, korp, kv, kv2) in enumerate(rows):
        # IIF(cond, a, b): a NULL condition takes b
        c = L.city_raw if city == "" else cat(L.city_raw + " (", city, ")")
        d2 = dom2 if (dom2 is not None and len(dom2) > 0) else ""
        k = cat(L.corpus, korp) if (korp is not None and len(korp) > 0) else ""
        fl = "" if kv == 0 else cat(L.flat, kv)
        k2 = "" if kv2 is None else kv2
        raw = cat(c, L.street, street, L.house, dom, d2, k, fl, k2)
        want = None if raw is None else raw.replace(L.city_raw, L.city_final)
        assert got[i] == want


snap = st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 99))


@SETTINGS
@given(st.lists(snap, max_size=25))
def test_latest_snapshot_matches_definition(spark, rows):
    from meterbill.operators.snapshots import latest_snapshot_per_base
    df = spark.createDataFrame(rows, "base int, data_my int, ls int")
    newest = {}
    for b, d, _ in rows:
        if d is not None:
            newest[b] = max(newest.get(b, d), d)
    want = sorted(r for r in rows if r[1] is not None and r[1] == newest.get(r[0]))
    got = sorted(map(tuple, latest_snapshot_per_base(df).select("base", "data_my", "ls").collect()))
    assert got == want


period = st.tuples(st.integers(202401, 202406), st.sampled_from(["O", "C"]))
ledger_row = st.tuples(st.sampled_from(["job", "other"]), st.integers(202401, 202406))


@SETTINGS
@given(st.lists(period, max_size=6, unique_by=lambda p: p[0]), st.lists(ledger_row, max_size=4))
def test_period_gate_matches_definition(spark, periods, ledger):
    import datetime as _dt
    from meterbill.operators.periods import period_gate
    from meterbill.streaming.ledger import LEDGER_SCHEMA
    p = spark.createDataFrame([(i, _dt.date(i // 100, i % 100, 1), f"P{i}", s) for i, s in periods],
                              "bl_bill_id long, bill_date date, bill_name string, period_status string")
    led = spark.createDataFrame(ledger, LEDGER_SCHEMA)
    got = [tuple(r) for r in period_gate(p, led, "job").collect()]
    open_ids = [i for i, s in periods if s == "O"]
    done = max([e for n, e in ledger if n == "job"], default=0)
    want = [("job", max(open_ids))] if open_ids and max(open_ids) != done else []
    assert got == want
