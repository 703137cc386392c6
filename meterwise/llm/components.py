"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Every node that has an edge, with the smallest node it can reach: columns node, root.

    Each round links the larger neighbours of every node to its smallest neighbour (large star), then its
    smaller neighbours (small star); rounds grow with the logarithm of the longest chain. Only minima are
    gathered per node, never neighbour lists, so a node with very many edges is a skewed join that adaptive
    execution splits. Rounds are cut by tables in the shared folder."""
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs, seen = stored(pairs, "edges"), None
    while True:
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = state
        near = pairs.select(F.col("u").alias("x"), "v").union(pairs.select(F.col("v").alias("x"), "v")).groupBy("x").agg(F.min("v").alias("m"))
        large = pairs.join(near, pairs["v"] == near["x"]).select("u", F.col("m").alias("v")).distinct()
        least = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        small = large.join(least, large["u"] == least["x"])
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(small.select("u", F.col("m").alias("v")))
        pairs = stored(moved.distinct(), "edges")


def local_forest(n: int, left: np.ndarray, right: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Smallest member of each of n items' component under the pairs (left, right), from earlier labels on."""
    labels = np.arange(n) if labels is None else labels
    while len(left):
        a, b = labels[left], labels[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        apart = low < high
        if not apart.any():
            break
        left, right = left[apart], right[apart]
        np.minimum.at(labels, high[apart], low[apart])
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped
    return labels
