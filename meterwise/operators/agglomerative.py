"""Ward clustering of any number of rows, and exact silhouettes with plain distances.

Rows become clustering features (count, sums, sum of squares) of a bounded number of cells, added up on the map side.
With no more distinct points than that the cells are the points and the tree is exact; otherwise a cell is a small box,
and the boxes are made as small as the bound allows. Ward's merges depend on counts and means only, so the tree is built
from the features by following chains of nearest neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.operators.clean import nan_to_null
from meterwise.session import durable

#: clustering features that reach the driver, where their distances take a square table
MOST_CELLS = 2_000
#: finest split of all columns together, in bits
MOST_BITS = 60
#: points of a block in the distance sums; a task holds a slice of a block by block table
POINTS_PER_BLOCK = 4_096


def _points(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles; rows with a null, NaN or infinite value do not take part."""
    doubles = nan_to_null(df.withColumns({c: F.col(c).cast("double") for c in columns}))
    return doubles.where(reduce(and_, [F.abs(c) < float("inf") for c in columns]))


def _splits(widths: dict[str, float]) -> list[dict[str, int]]:
    """Bits of each column, one more from step to step: the column whose boxes are widest is halved."""
    bits, out = dict.fromkeys(widths, 0), []
    for _ in range(MOST_BITS):
        widest = max(widths, key=lambda c: widths[c] / 2.0 ** bits[c])
        if not widths[widest]:
            break
        bits[widest] += 1
        out.append(dict(bits))
    return out


def cells(df: DataFrame, columns: Sequence[str], most: int = MOST_CELLS) -> tuple[Column, pd.DataFrame]:
    """The cell of a row (as a column) and the clustering features: cell, n, sums, squares (about the middle of the columns).

    At most `most` cells reach the driver (approximate counts choose the split with a tenth to spare, and a coarser one is
    taken if that is not enough)."""
    columns = list(columns)
    points = _points(df, columns)
    ends = points.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for f, n in ((F.min, "a"), (F.max, "b"))]).first()
    empty = pd.DataFrame({"cell": [], "n": [], **{f"s{i}": [] for i in range(len(columns))}, "q": []})
    if ends["a0"] is None:
        return F.lit(""), empty
    low = {c: ends[f"a{i}"] for i, c in enumerate(columns)}
    width = {c: ends[f"b{i}"] - low[c] for i, c in enumerate(columns)}

    def box(bits: dict[str, int]) -> Column:
        parts = [F.least(F.floor((F.col(c) - F.lit(low[c])) / F.lit(width[c] or 1.0) * float(2**b)), F.lit((1 << b) - 1)) for c, b in bits.items() if b]
        return F.concat_ws("_", *parts)

    whole = F.concat_ws("_", *[F.col(c).cast("double") + F.lit(0.0) for c in columns])
    choices = [box(bits) for bits in _splits(width)] + [whole]

    def fits(numbers: list[int]) -> list[int]:
        if not numbers:
            return []
        found = points.agg(*[F.approx_count_distinct(choices[i]).alias(f"k{i}") for i in numbers]).first()
        return [i for i in numbers if found[f"k{i}"] <= 0.9 * most]

    # splits only get finer: every eighth first, then those up to the next
    last = len(choices) - 1
    fitting = fits([*range(0, last, 8), last])
    if fitting and fitting[-1] < last:
        fitting += fits([i for i in range(fitting[-1] + 1, min(fitting[-1] + 8, last))])
    middle = {c: low[c] + width[c] / 2 for c in columns}
    shifted = [F.col(c) - F.lit(middle[c]) for c in columns]
    for i in reversed(fitting):
        features = points.groupBy(choices[i].alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{j}") for j, x in enumerate(shifted)], F.sum(sum((x * x for x in shifted), F.lit(0.0))).alias("q")
        )
        rows = features.limit(most + 1).toPandas()
        if len(rows) <= most:
            break
    else:
        choices, i = [F.lit("")], 0
        rows = points.agg(F.lit("").alias("cell"), F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{j}") for j, x in enumerate(shifted)], F.sum(sum((x * x for x in shifted), F.lit(0.0))).alias("q")).toPandas()
    for j, c in enumerate(columns):
        rows[f"m{j}"] = rows[f"s{j}"] / rows["n"] + middle[c]
    return choices[i], rows.sort_values("cell", ignore_index=True)


def ward(counts: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Merges (first, second, height, size) in order of height; items come first, then merges in that order.

    The height of a merge is sqrt(2 ab / (a + b)) times the distance of the centres, the usual one for single points."""
    n = len(counts)
    size, centre = counts.astype(float).copy(), centres.astype(float).copy()
    alive, chain, merges = np.ones(n, dtype=bool), [], []
    for _ in range(n - 1):
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        while True:
            a = chain[-1]
            d = 2 * size[a] * size / (size[a] + size) * ((centre - centre[a]) ** 2).sum(axis=1)
            d[~alive] = np.inf
            d[a] = np.inf
            b = int(np.argmin(d))
            # the one before wins ties, so chains end
            if len(chain) > 1 and d[chain[-2]] <= d[b]:
                b = chain[-2]
                break
            chain.append(b)
        chain.pop()
        chain.pop()
        merges.append((a, b, float(np.sqrt(d[b]))))
        total = size[a] + size[b]
        centre[b] = (size[a] * centre[a] + size[b] * centre[b]) / total
        size[b], alive[a] = total, False
    # names by order of height
    up, name, out = list(range(n)), list(range(n)), []

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    weight = counts.astype(float).copy()
    for i, k in enumerate(sorted(range(len(merges)), key=lambda k: (merges[k][2], k))):
        a, b = find(merges[k][0]), find(merges[k][1])
        weight[b] += weight[a]
        out.append((*sorted((name[a], name[b])), merges[k][2], weight[b]))
        up[a], name[b] = b, n + i
    return np.array(out).reshape(-1, 4)


def cut(merges: np.ndarray, items: int, k: int) -> np.ndarray:
    """Cluster of each item when k clusters are left (all items if there are fewer), numbered by their first item."""
    up = list(range(items + len(merges)))
    for i, (a, b, _, _) in enumerate(merges[: max(0, items - k)]):
        up[int(a)] = up[int(b)] = items + i
    label = []
    for x in range(items):
        while up[x] != x:
            x = up[x]
        label.append(x)
    return pd.factorize(np.array(label, dtype=np.int64))[0]


@dataclass
class Tree:
    """A Ward tree: the cell of a row, the features of the cells, and the merges."""

    columns: list[str]
    cell: Column
    features: pd.DataFrame
    merges: np.ndarray

    def within(self) -> float:
        """Sum of squares inside the cells, which no merge counts."""
        s = self.features[[f"s{j}" for j in range(len(self.columns))]].to_numpy()
        return float((self.features["q"] - (s**2).sum(axis=1) / self.features["n"]).clip(lower=0).sum())

    def merge_table(self, df: DataFrame) -> DataFrame:
        """(step, first, second, height, size) of all merges."""
        rows = [(i + 1, int(a), int(b), float(h), int(n)) for i, (a, b, h, n) in enumerate(self.merges)]
        return df.sparkSession.createDataFrame(rows, "step int, first int, second int, height double, size long")

    def labelled(self, df: DataFrame, ks: Sequence[int]) -> DataFrame:
        """The rows that take part with their clusters: `clusters`, an array with one label per number in `ks`."""
        labels = [cut(self.merges, len(self.features), k) for k in ks]
        rows = [(c, [int(x[i]) for x in labels]) for i, c in enumerate(self.features["cell"])]
        known = df.sparkSession.createDataFrame(rows, "__cell string, clusters array<int>")  # at most MOST_CELLS rows
        return _points(df, self.columns).withColumn("__cell", self.cell).join(F.broadcast(known), "__cell").drop("__cell")


def ward_tree(df: DataFrame, columns: Sequence[str], most: int = MOST_CELLS) -> Tree:
    """The Ward tree of the rows' columns; see `cells` for what a leaf is."""
    cell, features = cells(df, columns, most)
    centres = features[[f"m{j}" for j in range(len(columns))]].to_numpy() if len(features) else np.zeros((0, len(columns)))
    return Tree(list(columns), cell, features, ward(features["n"].to_numpy(), centres))


def distance_sums(points: DataFrame, columns: Sequence[str], cluster: str) -> DataFrame:
    """For every point the sum of its distances to the rows of each cluster: (x, own, w, cluster, total).

    Equal points of one cluster are one with weight w. Points are cut into blocks; a task adds up distances of one block to
    another, and only sums by (point, cluster) leave it. The work is that of all distances of distinct points."""
    columns = list(columns)
    merged = points.groupBy(*columns, cluster).agg(F.count(F.lit(1)).alias("w"))
    blocks = max(1, -(-merged.count() // POINTS_PER_BLOCK))
    place = F.pmod(F.xxhash64(*columns, cluster), F.lit(blocks)).cast("int")
    placed = merged.select(F.array(*columns).alias("x"), F.col(cluster).cast("int").alias("c"), "w", place.alias("b"))
    # each block meets all blocks as `others`
    tasks = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda o: F.struct(F.col("b").alias("i"), o.alias("j"), F.lit(True).alias("asks")))
    answers = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda o: F.struct(o.alias("i"), F.col("b").alias("j"), F.lit(False).alias("asks")))
    spread = placed.select("x", "c", "w", F.explode(F.concat(tasks, answers)).alias("t")).select("t.i", "t.j", "t.asks", "x", "c", "w")

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        ask = pdf["asks"].to_numpy()
        mine, other = pdf[ask], pdf[~ask]
        a, b = (np.array(p["x"].tolist(), dtype=float).reshape(len(p), len(columns)) for p in (mine, other))
        names, codes = np.unique(other["c"].to_numpy(), return_inverse=True)
        weights = np.zeros((len(other), len(names)))
        weights[np.arange(len(other)), codes] = other["w"]
        total = np.empty((len(mine), len(names)))
        for low in range(0, len(mine), 256):
            part = a[low : low + 256]
            square = np.zeros((len(part), len(b)))
            for d in range(len(columns)):
                square += (part[:, d : d + 1] - b[:, d]) ** 2
            total[low : low + 256] = np.sqrt(square) @ weights
        out = mine[["x", "c", "w"]].loc[mine.index.repeat(len(names))].rename(columns={"c": "own"})
        return out.assign(cluster=np.tile(names, len(mine)), total=total.ravel())

    parts = spread.groupBy("i", "j").applyInPandas(sums, "x array<double>, own int, w long, cluster int, total double")
    return parts.groupBy("x", "own", "w", "cluster").agg(F.sum("total").alias("total"))


def exact_silhouettes(df: DataFrame, columns: Sequence[str], labels: Column, count: int, scale: bool = True) -> DataFrame:
    """(at, clusters, silhouette) of `count` nested clusterings: `labels` is an array, coarser clusterings first.

    With `scale` columns are divided by their sample standard deviation (standardised Euclidean distance). A row alone in
    its cluster counts 0; with fewer than two clusters the silhouette is null. The distances to the clusters of the finest
    clustering are added up once; those to coarser clusters are sums of them."""
    columns = list(columns)
    base = _points(df, columns).select(*columns, labels.alias("__l"))
    if scale:
        spread = base.agg(*[F.stddev_samp(c).alias(c) for c in columns]).first()
        base = base.withColumns({c: F.col(c) / F.lit(float(spread[c] or 0.0) or 1.0) for c in columns})
    fine = F.col("__l")[count - 1]
    base = durable(base.withColumn("__c", fine))
    groups = base.groupBy("__c").agg(F.first("__l").alias("l"), F.count(F.lit(1)).alias("n"))  # nested: one row per cluster
    groups = durable(groups)
    sums = durable(distance_sums(base, columns, "__c"))
    nested = groups.select("__c", F.posexplode("l").alias("at", "coarse"), "n")
    sizes = nested.groupBy("at", "coarse").agg(F.sum("n").alias("size"))
    up = nested.join(sizes, ["at", "coarse"]).select("__c", "at", "coarse", "size")
    other = up.select(F.col("__c").alias("cluster"), "at", F.col("coarse").alias("theirs"), F.col("size").alias("n"))
    mine = up.select(F.col("__c").alias("own"), "at", F.col("coarse").alias("mine"))
    # clusters times clusterings: a handful of rows
    rows = sums.join(F.broadcast(other), "cluster").join(F.broadcast(mine), ["own", "at"])
    means = rows.groupBy("x", "own", "w", "at", "theirs").agg(F.sum("total").alias("t"), F.first("n").alias("n"), F.first(F.col("mine") == F.col("theirs")).alias("same"))
    inner = F.max(F.when(F.col("same") & (F.col("n") > 1), F.col("t") / (F.col("n") - 1)))
    by_point = means.groupBy("x", "own", "w", "at").agg(inner.alias("a"), F.min(F.when(~F.col("same"), F.col("t") / F.col("n"))).alias("b"), F.count(F.lit(1)).alias("clusters"))
    largest = F.greatest("a", "b")
    score = F.when(F.col("b").isNull(), None).when(F.col("a").isNull() | (largest == 0), 0.0).otherwise((F.col("b") - F.col("a")) / largest)
    scored = by_point.withColumn("s", score)
    return scored.groupBy("at").agg(F.max("clusters").cast("int").alias("clusters"), (F.sum(F.col("s") * F.col("w")) / F.sum("w")).alias("silhouette"))


def silhouette(df: DataFrame, columns: Sequence[str], cluster: str, scale: bool = True) -> float | None:
    """Mean silhouette of one clustering with plain (standardised) Euclidean distances."""
    row = exact_silhouettes(df, columns, F.array(F.col(cluster).cast("int")), 1, scale).first()
    return row["silhouette"] if row else None


def hierarchical_scan(df: DataFrame, columns: Sequence[str], ks: Sequence[int], most: int = MOST_CELLS) -> DataFrame:
    """Ward clusters for every k: (k, clusters, silhouette), with standardised Euclidean silhouettes."""
    ks = sorted(ks)
    labelled = ward_tree(df, columns, most).labelled(df, ks)
    found = exact_silhouettes(labelled, columns, F.col("clusters"), len(ks))
    number = F.element_at(F.array(*[F.lit(int(k)) for k in ks]), F.col("at") + 1)
    return found.select(number.alias("k"), "clusters", "silhouette")
