"""Filter interaction audit: what each filter removes, alone, in every order, and by its Shapley value.

A set S of filters plays the removal game: v(S) counts the documents that fail a filter of S.  One pass over
the texts gives every document the bit mask of the filters it fails; documents are counted by part and mask (at most 2^n
rows a part), and everything else is arithmetic on those counts, one row a part:

* v of all 2^n coalitions, in documents, in documents labelled good and in toxic ones;
* the Hart-Mas-Colell potential, P(S) = (v(S) + sum over i in S of P(S without i)) / |S|, recursively from the empty
  coalition.  It is kept as |S|! P(S), so it stays whole: Q(S) = (|S|-1)! v(S) + sum of Q(S without i);
* the Shapley value of filter i is P(N) - P(N without i), times n! the sum of its removals over all n! orders;
* step k of an order removes v(S and i) - v(S) documents, S the filters before it.

Identical texts are told by their SHA-256, the smallest doc_id of each comes from an aggregate that combines before the
shuffle, and is joined back for repeated texts only, so a text that a third of all documents share is a skewed
equi-join that AQE splits.

Defined cases: a NULL text is empty, has no words and equals other empty texts; texts are read whole, very long ones too;
a NULL doc_id is neither smaller nor larger than another, so its row never fails E nor meets a label; a row whose doc_id
and text occur twice is two documents, neither a copy of the other; of several labels of a doc_id any 1 counts; NULL labels
are no 1; a NULL lang is the part ''; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbill.llm.common import stored

FILTERS = "ABCDE"
SPACE = " \t\n\x0b\x0c\r"


def text_failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest): the bits of the filters A to D that a document's text fails, and its SHA-256."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       text.alias("text"))
    # a text without words counts as one empty word, which changes neither A nor B
    rows = rows.withColumn("words", F.split(F.btrim("text", F.lit(SPACE)), r"[\x20\x09-\x0D]+"))
    capitals = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]", ""))
    words = F.size("words")
    fails = [words < 100,
             100 * F.size(F.array_distinct("words")) < 80 * words,
             100 * capitals > 10 * F.length("text"),
             F.col("text").rlike(r"[#$%&*|]")]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of every document under the five filters; E: a smaller doc_id has the same text."""
    rows = stored(text_failures(docs), "audit-rows")
    # written first: AQE splits a text that many rows share only where the join alone reads both sides' exchanges
    shared = stored(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("times")).filter("times > 1"), "audit-shared")
    copy = F.when(F.col("doc_id") > F.col("first"), 1 << 4).otherwise(0)
    return rows.join(shared, "digest", "left").select("doc_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"))


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters they fail."""
    is_one = lambda c: F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0)).alias(c)
    marked = labels.filter("quality = 1 or toxic = 1").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(is_one("quality"), is_one("toxic"))
    return (failed.join(marked, "doc_id", "left").groupBy("part", "mask")
            .agg(F.count("*").alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))


def _worth(count: str, coalitions: int) -> Column:
    """v of every coalition 0 .. 2^n - 1 as an array, from the part's mask counts ``by_mask``."""
    return F.transform(F.sequence(F.lit(0), F.lit(coalitions - 1)), lambda s: F.aggregate(
        "by_mask", F.lit(0).cast("long"), lambda acc, m: acc + F.when(m["mask"].bitwiseAND(s) != 0, m[count]).otherwise(F.lit(0))))


def _potential(n: int) -> Column:
    """|S|! P(S) of every coalition as an array; each needs only those of smaller number."""
    whole = F.array(*[F.lit(factorial(k)).cast("long") for k in range(n + 1)])

    def add(acc, s):
        value = F.get(whole, F.bit_count(s) - 1) * F.get(F.col("v"), s)
        for i in range(n):
            value = value + F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(acc, s - F.lit(1 << i))).otherwise(F.lit(0))
        return F.concat(acc, F.array(value))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n) - 1)), F.array(F.lit(0).cast("long")), add)


def potentials(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row a part: total, arrays v, good and toxic (by coalition), potential (|S|! P(S)) and shapley (n! times, by filter)."""
    n = len(names)
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("by_mask"))
    game = parts.select("part", "total", _worth("n", 1 << n).alias("v"), _worth("good", 1 << n).alias("good"),
                        _worth("toxic", 1 << n).alias("toxic"))
    game = game.withColumn("potential", _potential(n))
    grand = (1 << n) - 1
    return game.withColumn("shapley", F.array(*[F.get("potential", F.lit(grand)) - n * F.get("potential", F.lit(grand - (1 << i)))
                                               for i in range(n)]))


def steps(names: str = FILTERS) -> Column:
    """Every step of every order: array of (filter_order, step, filter, before), ``before`` the coalition before it."""
    rows = [{"filter_order": "".join(names[i] for i in p), "step": k + 1, "filter": i, "before": sum(1 << j for j in p[:k])}
            for p in permutations(range(len(names))) for k, i in enumerate(p)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order:string,step:int,filter:int,before:int>>")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step, zeros included; see the module."""
    n, grand = len(FILTERS), (1 << len(FILTERS)) - 1
    rows = potentials(mask_counts(failures(docs), labels)).withColumn("s", F.explode(steps())).select("*", "s.*")
    bit = F.expr("shiftleft(1, filter)")
    at = lambda c, s: F.get(F.col(c), s)
    after = F.col("before") + bit
    removed = at("v", after) - at("v", F.col("before"))
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - at("v", after)).alias("kept"), removed.alias("removed"),
        (at("v", bit) - removed).alias("redundant"), (at("v", F.lit(grand)) - at("v", F.lit(grand) - bit)).alias("unique_fails"),
        (at("good", after) - at("good", F.col("before"))).alias("good_lost"),
        (at("toxic", after) - at("toxic", F.col("before"))).alias("toxic_lost"), at("shapley", F.col("filter")).alias("shapley"))
