"""k-means, squared silhouettes, mean shift and quantisation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.operators.features import PopulationScaler
from meterwise.operators.neighbors import nearest_neighbors
from meterwise.session import durable, run_jobs


def weighted_sites(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct coordinates with their number of rows as ``weight``."""
    return df.select(*columns).dropna().groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def kmeans(df: DataFrame, k: int, features: str = "features", weight: str | None = None, seed: int = 42):
    estimator = KMeans(k=k, seed=seed, featuresCol=features, maxIter=50)
    return (estimator.setWeightCol(weight) if weight else estimator).fit(df)


def kmeans_sites(df: DataFrame, columns: Sequence[str], k: int, scale: bool = True, seed: int = 42) -> dict:
    """Cluster the distinct scaled sites once and join the labels back to the rows."""
    sites = weighted_sites(df, columns)
    scaled = sites.select("*", *[F.col(c).alias(f"__s_{c}") for c in columns])
    names = [f"__s_{c}" for c in columns]
    if scale:
        scaled = PopulationScaler(columns=names).fit(scaled).transform(scaled)
    assembled = assemble(scaled, names)
    model = kmeans(assembled, k, weight="weight", seed=seed)
    labels = model.transform(assembled).select(*columns, F.col("prediction").alias("cluster"))
    return {"labels": df.join(labels, list(columns), "left"), "centers": model.clusterCenters(), "sites": labels}


def _center_of(cluster: Column, centers: Sequence[np.ndarray]) -> Column:
    table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    return F.element_at(table, cluster + 1)


def _euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def elbow(df: DataFrame, ks: Sequence[int], features: str = "features", seed: int = 42) -> DataFrame:
    """(k, mean distance to the nearest centre)."""
    df = durable(df.select(features))

    def distortion(k: int) -> tuple:
        model = kmeans(df, k, features, seed=seed)
        point = vector_to_array(F.col(features))
        scored = model.transform(df).select(_euclidean(point, _center_of(F.col("prediction"), model.clusterCenters())).alias("d"))
        return k, scored.agg(F.avg("d")).first()[0]

    rows = run_jobs(df.sparkSession, [partial(distortion, k) for k in ks])
    return df.sparkSession.createDataFrame(rows, "k int, distortion double")


def silhouette(df: DataFrame, columns: Sequence[str], cluster: str) -> float:
    """Silhouette on columns divided by their standard deviation (squared distances)."""
    scaled = PopulationScaler(columns=list(columns)).fit(df).transform(df)
    return ClusteringEvaluator(featuresCol="__x", predictionCol=cluster, distanceMeasure="squaredEuclidean").evaluate(
        assemble(scaled, columns, "__x")
    )


def quantise(df: DataFrame, columns: Sequence[str], cluster: str, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Replace each point by the centre of its cluster."""
    center = _center_of(F.col(cluster), [np.asarray(c) for c in centers])
    return df.select(
        *[center[list(columns).index(c)].alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def estimate_bandwidth(df: DataFrame, columns: Sequence[str], quantile: float = 0.1, samples: int = 200, seed: int = 42) -> float:
    """Mean distance to the farthest of the nearest ``quantile`` share inside a small sample."""
    order = [F.xxhash64(*columns, F.lit(seed)), *columns]
    rows = df.select(*columns).orderBy(*order).limit(samples).collect()  # sample size fixed by the operator
    x = np.array(rows, dtype=float)
    k = max(1, int(len(x) * quantile))
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    return float(np.sort(d, axis=1)[:, k - 1].mean())


def _cell(columns: Sequence[str], width: float) -> Column:
    return F.array(*[F.floor(F.col(c) / width) for c in columns])


def _near_cells(columns: Sequence[str], width: float) -> Column:
    """Explode to the 3^d cells around a point."""
    around: Column = F.array(F.array().cast("array<bigint>"))
    for c in columns:
        base = F.floor(F.col(c) / width)
        around = F.flatten(
            F.transform(around, lambda head: F.transform(F.array(base - 1, base, base + 1), lambda i: F.array_append(head, i)))
        )
    return F.explode(around)


def mean_shift(df: DataFrame, columns: Sequence[str], bandwidth: float, max_rounds: int = 300) -> dict:
    """Flat-kernel mean shift from grid-binned seeds.

    Equal points are merged first.  A seed only meets points of its 3^d neighbouring cells, by
    an equi-join on the cell; seeds that meet are merged after every round.  Each round's seeds
    are checkpointed.
    """
    columns = list(columns)
    if bandwidth <= 0:
        raise ValueError("bandwidth must be positive")
    points = durable(
        df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna().groupBy(*columns).agg(
            F.count(F.lit(1)).cast("double").alias("w")
        )
    )
    celled = points.withColumn("cell", _cell(columns, bandwidth))
    moving = durable(
        points.select(*[(F.round(F.col(c) / bandwidth) * bandwidth).alias(c) for c in columns]).distinct()
    )
    names = {c: f"__p_{c}" for c in columns}
    others = celled.select("cell", "w", *[F.col(c).alias(names[c]) for c in columns])
    square = sum(((F.col(c) - F.col(names[c])) ** 2 for c in columns), F.lit(0.0))
    settled = None
    for _ in range(max_rounds):
        pairs = moving.withColumn("cell", _near_cells(columns, bandwidth)).join(others, "cell").filter(
            square <= bandwidth * bandwidth
        )
        stepped = pairs.groupBy(*columns).agg(
            *[(F.sum(F.col("w") * F.col(names[c])) / F.sum("w")).alias(f"__n_{c}") for c in columns],
            F.sum("w").alias("mass"),
        )
        shift = sum(((F.col(c) - F.col(f"__n_{c}")) ** 2 for c in columns), F.lit(0.0))
        stepped = durable(stepped.withColumn("done", F.sqrt(shift) < 1e-3 * bandwidth))
        arrived = stepped.filter("done").select(*[F.col(f"__n_{c}").alias(c) for c in columns], "mass")
        settled = arrived if settled is None else settled.unionByName(arrived)
        digits = max(0, 6 - int(np.floor(np.log10(bandwidth))))
        moving = durable(
            stepped.filter("NOT done").select(*[F.round(F.col(f"__n_{c}"), digits).alias(c) for c in columns]).distinct()
        )
        if moving.isEmpty():
            break
    else:
        last = stepped.filter("NOT done").select(*[F.col(f"__n_{c}").alias(c) for c in columns], "mass")
        settled = settled.unionByName(last)
    modes = _strongest(durable(settled.groupBy(*columns).agg(F.max("mass").alias("mass"))), columns, bandwidth)
    centers = durable(modes.withColumn("cluster", F.xxhash64(*columns)))
    keyed = points.withColumn("id", F.xxhash64(*columns)).withColumn("vector", F.array(*columns))
    targets = centers.select(F.col("cluster").alias("id"), F.array(*columns).alias("vector"))
    nearest = nearest_neighbors(keyed.select("id", "vector"), targets, 1)
    labels = keyed.join(nearest.select(F.col("query").alias("id"), F.col("neighbor").alias("cluster")), "id").select(
        *columns, "cluster"
    )
    return {"centers": centers, "labels": df.join(labels, columns, "left")}


def _strongest(modes: DataFrame, columns: Sequence[str], bandwidth: float) -> DataFrame:
    """Keep a mode only when no stronger kept mode lies within the bandwidth.

    Each round keeps the local maxima and removes their neighbourhood, which gives the same
    set as one pass in order of strength.
    """
    columns = list(columns)
    other = {c: f"__o_{c}" for c in columns}
    square = sum(((F.col(c) - F.col(other[c])) ** 2 for c in columns), F.lit(0.0))
    kept = None
    left = modes
    while not left.isEmpty():
        right = left.select(*[F.col(c).alias(other[c]) for c in columns], F.col("mass").alias("__om"), _cell(columns, bandwidth).alias("cell"))
        near = left.withColumn("cell", _near_cells(columns, bandwidth)).join(right, "cell").filter(square <= bandwidth * bandwidth)
        mine = F.struct("mass", *columns)
        theirs = F.struct(F.col("__om").alias("mass"), *[F.col(other[c]).alias(c) for c in columns])
        best = near.groupBy("mass", *columns).agg(F.max(theirs).alias("best")).withColumn("top", F.col("best") == mine)
        winners = durable(best.filter("top").select(*columns, "mass"))
        kept = winners if kept is None else kept.unionByName(winners)
        heads = winners.select(*[F.col(c).alias(other[c]) for c in columns], _cell(columns, bandwidth).alias("cell"))
        covered = (
            left.withColumn("cell", _near_cells(columns, bandwidth)).join(heads, "cell")
            .filter(square <= bandwidth * bandwidth).select(*columns).distinct()
        )
        left = durable(left.join(covered, columns, "left_anti"))
    return kept if kept is not None else modes
