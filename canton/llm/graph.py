"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from canton.session import stored_table as stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of an edge (u, v): the least node it reaches.

    Every round takes the least label over a node's edges and then the label of
    that label, so paths shorten by half. Labels are stored between the rounds,
    which lets a join split the partition of a hub; the minima are partial
    aggregates. Only the count of changed labels reaches the driver.
    """
    edges = stored(edges.select("u", "v").distinct(), "edges")
    both = F.explode(F.array("u", "v")).alias("node")
    labels = stored(
        edges.select(both, F.least("u", "v").alias("root")).groupBy("node").agg(F.min("root").alias("root")),
        "labels",
    )
    while True:
        u = labels.select(F.col("node").alias("u"), F.col("root").alias("root_u"))
        v = labels.select(F.col("node").alias("v"), F.col("root").alias("root_v"))
        met = edges.join(u, "u").join(v, "v").withColumn("least", F.least("root_u", "root_v"))
        # Both ends, and the labels they had, learn of the smaller label.
        told = met.select(
            F.explode(F.array("u", "v", "root_u", "root_v")).alias("node"), F.col("least").alias("root")
        )
        lower = stored(told.groupBy("node").agg(F.min("root").alias("root")), "labels")
        up = lower.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = stored(
            lower.join(up, "root").select("node", F.col("above").alias("root")), "labels"
        )
        old = labels.select("node", F.col("root").alias("old"))
        changed = jumped.join(old, "node").where(F.col("root") != F.col("old")).limit(1).count()
        labels = jumped
        if not changed:
            return labels


def local_roots(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each node's component under the links a[i] - b[i] (positions)."""
    root = nodes.copy()
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == root).all():
            break
        root = new
    return root
