"""Quality rules by robust multivariate outliers.

Every document gets plain counts (words, symbols, repeated lines, repeated
8-word windows).  Documents that pass the base rules are described by a vector
of transformed statistics; for each language and source the minimum covariance
determinant estimate (the centre and scatter of the most concentrated
``SUPPORT`` share of rows) gives Mahalanobis distances, and a document beyond
the cutoff is rejected.

The estimate is computed over all rows by aggregates only: a start from medians
and absolute deviations, then concentration steps (centre and scatter of the
rows with the smallest distances).  A group of any size is a set of partial
sums, so a source with a third of all rows is no hot task.  Quantiles are read
from counts on a fixed grid, which makes them exact to the grid and independent
of partitioning.

Defined cases: a NULL or empty text has zero words and fails the base rules;
NULL ``lang`` or ``source`` is a group of its own; repeated rows each get their
own (equal) result; a group with under ``min_group`` usable rows is estimated
with the other small groups of its language, and those of small languages
together; if even that has too few rows, nothing is rejected; an empty table
gives an empty result.  Extra columns are ignored by ``assess`` and kept by ``keep``.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterbill.llm.common import map_chunks, packed, stored, unpacked

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!?;:^~_=+@\\"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30

# The statistic vector; the second value is the least standard deviation a dimension is given, so
# that a statistic that is zero in nearly all documents of a group does not turn a trace into an outlier.
STATS = {"x_len": 0.10, "x_sym": 0.04, "x_dup": 0.25, "x_rep": 0.20, "x_up": 0.08, "x_mark": 0.06}
DIM = len(STATS)
SUPPORT = 0.75
# Scatter of the inner 75 % of a normal sample in six dimensions, as a share of the whole (0.75 / P(chi2_8 <= 7.84)).
CONSISTENCY = 1.36
STEPS = 4
MIN_GROUP = 60
CUTOFF = 40.0   # squared distance; chi-square with six degrees of freedom passes it with probability 5e-7
GRID = 512      # cells per unit when quantiles are read from counts

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS_SCHEMA = ", ".join([f"{c} long" for c in COUNTS] + [f"{x} double" for x in STATS])


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by ``width``-word windows that occur at least twice in the text (the first included)."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    acc = np.zeros(n, np.uint64)
    for k in range(width):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    order = np.argsort(acc, kind="stable")
    same = acc[order][1:] == acc[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    seen: dict[tuple, int] = {}      # the hash only preselects; equal windows are compared word by word
    starts = np.flatnonzero(again).tolist()
    for i in starts:
        key = tuple(words[i:i + width])
        seen[key] = seen.get(key, 0) + 1
    cover = np.zeros(len(words) + 1, np.int64)
    for i in starts:
        if seen[tuple(words[i:i + width])] > 1:
            cover[i] += 1
            cover[i + width] -= 1
    return int((np.cumsum(cover) > 0).sum())


def text_stats(text: str | None) -> tuple:
    """Counts of one text and its transformed statistics."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()   # ASCII white space, as the contract's pattern
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line and line.strip(SPACES):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    rep = repeat_words(words)
    if not n:
        return (0, 0, symbols, 0, 0) + (0.0,) * DIM
    upper = len(re.findall("[A-ZÀ-ÖØ-Þ]", text))
    marks = sum(map(text.count, MARKS))
    return (n, chars, symbols, dup, rep, float(np.log(chars / n)), (symbols / chars) ** 0.5, (dup / lines) ** 0.5,
            (rep / n) ** 0.5, (upper / chars) ** 0.5, (marks / chars) ** 0.5)


def _with_stats(rows: DataFrame) -> DataFrame:
    """``row`` (a struct with a field text) -> row and the statistics."""
    names = [c.strip().split(" ")[0] for c in STATS_SCHEMA.split(",")]
    kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * DIM

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        row = batch.column(0)
        cols = list(zip(*map(text_stats, row.field("text").to_pylist()))) or [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [row] + [pa.array(c, t) for c, t in zip(cols, kinds)], names=["row"] + names)

    return map_chunks(rows, one, f"row {rows.schema['row'].dataType.simpleString()}, {STATS_SCHEMA}")


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def grid_quantile(df: DataFrame, key: list[str], bin_col: str, q: float) -> DataFrame:
    """Per key, the smallest cell whose cumulative count reaches ``q`` of the key's rows.  Rows are
    counted per cell first, so a window holds one row per cell of a bounded grid, whatever the group's size."""
    counts = df.groupBy(*key, bin_col).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*key)
    run = counts.withColumn("cum", F.sum("c").over(w.orderBy(bin_col))).withColumn("all", F.sum("c").over(w))
    return run.filter(F.col("cum") >= q * F.col("all")).groupBy(*key).agg(F.min(bin_col).alias("cell"))


def _wide(df: DataFrame, prefix: str) -> DataFrame:
    """(gk, dim, cell) -> one row per gk with prefix0.., in grid units."""
    return df.groupBy("gk").agg(*[F.max(F.when(F.col("dim") == i, F.col("cell") / GRID)).alias(f"{prefix}{i}")
                                  for i in range(DIM)])


def _start(rows: DataFrame) -> DataFrame:
    """Medians and absolute deviations per group as centre and diagonal scatter."""
    def cells(df, value):
        return df.select("gk", F.posexplode(F.array(*[F.round(value(i) * GRID).cast("int") for i in range(DIM)]))
                         .alias("dim", "cell"))
    xs = list(STATS)
    med = _wide(grid_quantile(cells(rows, lambda i: F.col(xs[i])), ["gk", "dim"], "cell", 0.5), "m")
    dev = cells(rows.join(_salted(med), ["gk", "salt"]), lambda i: F.abs(F.col(xs[i]) - F.col(f"m{i}")))
    mad = _wide(grid_quantile(dev, ["gk", "dim"], "cell", 0.5), "s")
    floors = list(STATS.values())
    inv = {(i, i): 1.0 / F.pow(F.greatest(1.4826 * F.col(f"s{i}"), F.lit(floors[i])), 2) for i in range(DIM)}
    return med.join(mad, "gk").select("gk", *[F.col(f"m{i}") for i in range(DIM)],
                                      *[inv.get((i, j), F.lit(0.0)).alias(f"p{i}_{j}")
                                        for i in range(DIM) for j in range(i, DIM)])


def _distance():
    """Squared Mahalanobis distance from the joined columns m* (centre) and p*_* (inverse scatter)."""
    d = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(STATS)]
    terms = [F.col(f"p{i}_{j}") * d[i] * d[j] * (1 if i == j else 2) for i in range(DIM) for j in range(i, DIM)]
    return F.greatest(reduce(lambda a, b: a + b, terms), F.lit(0.0))


def _inverse(sums: DataFrame) -> DataFrame:
    """Inverse scatter from sums per group: one small matrix per row, groups spread over the tasks."""
    pairs = [(i, j) for i in range(DIM) for j in range(i, DIM)]
    floors = np.array(list(STATS.values()))

    def run(frames):
        for pdf in frames:
            out = {"gk": pdf["gk"].to_list()} | {f"m{i}": pdf[f"m{i}"].to_list() for i in range(DIM)}
            inv = np.zeros((len(pdf), DIM, DIM))
            for k in range(len(pdf)):
                m = np.array([pdf[f"m{i}"].iloc[k] for i in range(DIM)])
                cov = np.zeros((DIM, DIM))
                for i, j in pairs:
                    cov[i, j] = cov[j, i] = pdf[f"c{i}_{j}"].iloc[k] - m[i] * m[j]
                cov = CONSISTENCY * cov
                # raise each axis to its floor; off-diagonal terms keep their covariance
                cov[np.diag_indices(DIM)] = np.diag(cov).clip(0) + np.maximum(0, floors ** 2 - np.diag(cov)) + 1e-9
                w, v = np.linalg.eigh(cov)
                inv[k] = (v / w.clip((0.5 * floors.min()) ** 2)) @ v.T
            out |= {f"p{i}_{j}": inv[:, i, j] for i, j in pairs}
            yield type(pdf)(out)

    schema = ", ".join(["gk string"] + [f"m{i} double" for i in range(DIM)] + [f"p{i}_{j} double" for i, j in pairs])
    return sums.mapInPandas(run, schema)


SALT = 8           # shares a group's rows are dealt in where they are joined with the group's figures


def _dealt(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.floor(F.rand(3) * SALT).cast("int"))


def _salted(df: DataFrame) -> DataFrame:
    """The figures of each group once per share, so that a group with a third of all rows is joined in many tasks."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))


def fit(stats: DataFrame, steps: int = STEPS, min_group: int = MIN_GROUP) -> tuple[DataFrame, DataFrame]:
    """(groups, params): the estimation group ``gk`` of each (lang, source), and centre and inverse scatter per gk.

    ``stats`` needs lang, source, base_failed and the statistics, and is read several times."""
    rows = stats.filter(~F.col("base_failed")).select("lang", "source", *STATS)
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.when(F.col("n") < min_group, F.col("n"))
    by_lang = sizes.groupBy(F.col("lang").alias("l")).agg(F.coalesce(F.sum(small), F.lit(0)).alias("pooled"))
    level = F.when(F.col("n") >= min_group, 2).when(F.col("pooled") >= min_group, 1).otherwise(0)
    key = F.to_json(F.struct(level.alias("level"), F.when(level > 0, F.col("lang")).alias("lang"),
                             F.when(level > 1, F.col("source")).alias("source")))
    groups = stored(sizes.join(by_lang, sizes["lang"].eqNullSafe(by_lang["l"]))
                    .select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), key.alias("gk")), "mcd-groups")
    rows = stored(_grouped(rows, groups).select("gk", "salt", *STATS), "mcd-rows")
    params = stored(_start(rows), "mcd-start")
    means = [F.avg(x).alias(f"m{i}") for i, x in enumerate(STATS)]
    xs = list(STATS)
    cross = [F.avg(F.col(xs[i]) * F.col(xs[j])).alias(f"c{i}_{j}") for i in range(DIM) for j in range(i, DIM)]
    for step in range(steps):
        near = rows.join(_salted(params), ["gk", "salt"]).select("gk", "salt", *STATS, _distance().alias("d2")) \
            .withColumn("bin", F.floor(32 * F.log2(F.col("d2") + 1e-6)).cast("int"))
        cut = grid_quantile(near, ["gk"], "bin", SUPPORT)
        inner = near.join(_salted(cut), ["gk", "salt"]).filter(F.col("bin") <= F.col("cell"))
        params = stored(_inverse(inner.groupBy("gk").agg(F.count("*").alias("n"), *means, *cross)
                                 .filter(F.col("n") >= SUPPORT * min_group)), f"mcd-{step}")
    return groups, params


def _grouped(df: DataFrame, groups: DataFrame) -> DataFrame:
    df, groups = _dealt(df), _salted(groups).withColumnRenamed("salt", "g_salt")
    return df.join(groups, df["lang"].eqNullSafe(groups["g_lang"]) & df["source"].eqNullSafe(groups["g_source"])
                   & (df["salt"] == groups["g_salt"]), "left")


def _judged(stats: DataFrame, groups: DataFrame, params: DataFrame, cutoff: float) -> DataFrame:
    """Adds distance and kept."""
    joined = _grouped(stats, groups).join(_salted(params), ["gk", "salt"], "left")
    return joined.withColumn("distance", F.when(~F.col("base_failed"), _distance())) \
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True)))



def assess(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: doc_id, lang, source, the counts, base_failed, kept, distance."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                        F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    rows = packed(plain)
    stats = stored(_with_stats(rows).select("row.doc_id", "row.lang", "row.source", *COUNTS, *STATS,
                                            _base_failed().alias("base_failed")), "quality-stats")
    groups, params = fit(stats)
    return _judged(stats, groups, params, cutoff).select("doc_id", "lang", "source", *COUNTS, "base_failed", "kept", "distance")


def keep(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.  The texts are read twice (statistics, then the
    filter), never shuffled by document."""
    first = docs.select(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                        F.col("text").cast("string").alias("text"))
    stats = stored(_with_stats(packed(first)).select("row.lang", "row.source", *STATS, _base_failed().alias("base_failed")),
                   "quality-stats")
    groups, params = fit(stats)
    whole = _with_stats(packed(docs)).withColumn("base_failed", _base_failed()).filter(~F.col("base_failed")) \
        .withColumn("lang", F.col("row.lang").cast("string")).withColumn("source", F.col("row.source").cast("string"))
    return unpacked(_judged(whole, groups, params, cutoff).filter("kept"), docs.columns)
