"""Connected components by alternating large-star and small-star steps, DataFrame operations only.

Every step is an aggregate (partial sums first) and an equi-join with one row per node on the small
side, so a node with a third of all edges is a skewed join that AQE splits, never one group.  Each
step's edges are written to the shared folder, which cuts the lineage; only a count and a checksum
per round reach the driver.

``contracted_components`` first lets tasks of at most ``TASK_EDGES`` edges replace their edges by stars to the
smallest node; where one task holds all edges that is the answer, else the star steps go on with what is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterbill.llm.common import stored

MAX_ROUNDS = 60   # rounds grow with the logarithm of the longest path; beyond this something is wrong


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has an edge.

    ``edges`` has two columns of one orderable type; self-loops and rows with a NULL end are ignored,
    repeated and reversed edges count once, no edges give no rows."""
    a, b = edges.columns[:2]
    pairs = edges.select(F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v"),
                         F.col(a).alias("a"), F.col(b).alias("b"))
    now = stored(pairs.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v")))
                 .select("u", "v").distinct(), "cc-0")
    before = None
    for _ in range(MAX_ROUNDS):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .filter("u <> v").distinct(), "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        now = stored(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                     .union(low).distinct(), "cc-small")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = tuple(mark)
    raise RuntimeError("components did not converge")


TASK_EDGES = 1_000_000     # 16 MB of edges; about five times that while they are contracted


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of the edges a - b, by label passing and pointer jumping."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        if (label[x] == low).all() and (label[y] == low).all():
            return nodes, nodes[label]
        # hang both ends' roots under the lower label, then let every node follow its root
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while (label != label[label]).any():
            label = label[label]


def contract_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node to the smallest of its component, in place of the links a - b."""
    node, root = _stars(a, b)
    return node[node != root], root[node != root]


def contracted_components(edges: DataFrame) -> DataFrame:
    """``connected_components`` for edges between long ids, with few rounds."""
    a, b = edges.columns[:2]
    pairs = stored(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
                   .filter("a is not null and b is not null and a <> b"), "cc-edges")
    tasks = 1 + pairs.count() // TASK_EDGES

    def run(batches):
        got = [(x.column(0).to_numpy(), x.column(1).to_numpy()) for x in batches if x.num_rows]
        if got:
            node, root = _stars(*(np.concatenate(c) for c in zip(*got)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["node", "root"])

    stars = pairs.repartition(tasks).mapInArrow(run, "node long, root long")
    return stored(stars, "cc-stars") if tasks == 1 else connected_components(stars)
