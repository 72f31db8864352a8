"""Connected components over an edge table, by minimum labels with pointer jumping.

Each round is two joins and one partially aggregated minimum; labels are written to the shared folder between rounds, so
the plan stays short and a lost executor costs one round at most.  The number of rounds grows with the logarithm of a
component's diameter.  Nothing but the count of changed labels reaches the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulastar.llm.store import forget, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node of an edge, the smallest node that it can reach."""
    e = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v"), "cc-links")
    both = stored(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-edges")
    labels = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root")), "cc-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("root").alias("near")))
        step = labels.join(near.withColumnRenamed("u", "node"), "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        step = stored(step, "cc-step")
        up = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
        after = stored(step.join(up, "root", "left").select("node", "old", F.least("root", F.coalesce("up", "root")).alias("root")), "cc-labels")
        changed = after.filter("old <> root").limit(1).count()
        forget(labels, step)
        labels = after
        if not changed:
            return labels.select("node", "root")


def local_roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 and edges u-v: the smallest node of each node's component."""
    root = np.arange(n)
    while len(u):
        ru, rv = root[u], root[v]
        live = ru != rv
        if not live.any():
            break
        u, v, ru, rv = u[live], v[live], ru[live], rv[live]
        low, high = np.minimum(ru, rv), np.maximum(ru, rv)
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root
