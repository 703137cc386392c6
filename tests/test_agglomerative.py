import numpy as np
import pytest
from pyspark.sql import functions as F

from meterwise.operators import agglomerative as ag


def plain_ward(x):
    """Heights of all merges by trying every pair."""
    groups, heights = [(1.0, np.array(p, dtype=float)) for p in x], []
    while len(groups) > 1:
        best = min(
            ((2 * a[0] * b[0] / (a[0] + b[0]) * ((a[1] - b[1]) ** 2).sum(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j),
        )
        (n, p), (m, q) = groups[best[1]], groups[best[2]]
        groups = [g for k, g in enumerate(groups) if k not in best[1:]] + [(n + m, (n * p + m * q) / (n + m))]
        heights.append(best[0] ** 0.5)
    return heights


def plain_silhouette(x, labels):
    x = x / x.std(axis=0, ddof=1)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i, c in enumerate(labels):
        own = labels == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == o].mean() for o in set(labels.tolist()) if o != c)
        out.append((b - a) / max(a, b))
    return np.mean(out)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(12)
    spots = rng.normal(size=(5, 2)) * 8
    x = np.concatenate([spots[i] + rng.normal(size=(14, 2)) for i in range(5)] + [[[40.0, 40.0]]])
    return np.round(np.concatenate([x, x[:6]]), 3)


def table(spark, x):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")


def test_merges_and_silhouettes_against_all_pairs(spark, points, monkeypatch):
    monkeypatch.setattr(ag, "POINTS_PER_BLOCK", 20)
    df = table(spark, points).unionByName(spark.createDataFrame([(900, None, 1.0), (901, float("nan"), 1.0), (902, 1.0, float("inf"))], "id long, a double, b double"))
    tree = ag.ward_tree(df, ["a", "b"])
    heights = plain_ward(points)
    # the six repeated points merge at 0 first; equal points are one leaf
    assert len(tree.features) == 71 and np.allclose([h for h in heights if h > 0], tree.merges[:, 2])
    ks = [2, 3, 4, 5, 6, 7]
    rows = sorted(tree.labelled(df, ks).select("id", "clusters").collect())
    assert len(rows) == len(points)
    labels = np.array([r.clusters for r in rows])
    found = {r.k: (r.clusters, r.silhouette) for r in ag.hierarchical_scan(df, ["a", "b"], ks).collect()}
    for at, k in enumerate(ks):
        assert found[k][0] == k == len(set(labels[:, at])) and found[k][1] == pytest.approx(plain_silhouette(points, labels[:, at]))
    named = tree.labelled(df, [4]).withColumn("c", F.col("clusters")[0])
    assert ag.silhouette(named, ["a", "b"], "c") == pytest.approx(plain_silhouette(points, labels[:, 2]))


def test_many_points_become_few_boxes(spark):
    rng = np.random.default_rng(13)
    x = np.concatenate([rng.normal(size=(3000, 2)) + c for c in ([0, 0], [30, 0], [0, 30])])
    df = table(spark, x)
    tree = ag.ward_tree(df, ["a", "b"], most=200)
    assert 40 < len(tree.features) <= 200 and tree.features["n"].sum() == 9000
    total = ((x - x.mean(axis=0)) ** 2).sum()
    assert (tree.merges[:, 2] ** 2).sum() / 2 + tree.within() == pytest.approx(total)
    found = np.array([r.clusters[0] for r in sorted(tree.labelled(df, [3]).select("id", "clusters").collect())])
    assert all(len(set(found[i : i + 3000])) == 1 for i in (0, 3000, 6000)) and len(set(found)) == 3
    again = ag.ward_tree(df.repartition(7), ["a", "b"], most=200)
    assert np.allclose(again.merges[:, 2], tree.merges[:, 2])


def test_odd_tables(spark, points):
    df = table(spark, points)
    empty = ag.ward_tree(df.limit(0), ["a", "b"])
    assert len(empty.features) == 0 == len(empty.merges) and empty.labelled(df.limit(0), [2]).count() == 0
    assert ag.hierarchical_scan(df.limit(0), ["a", "b"], [2, 3]).count() == 0
    same = spark.createDataFrame([(1.0, 2.0)] * 5, "a double, b double")
    assert len(ag.ward_tree(same, ["a", "b"]).features) == 1
    assert [(r.k, r.clusters, r.silhouette) for r in ag.hierarchical_scan(same, ["a", "b"], [2]).collect()] == [(2, 1, None)]
    two = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "a double, b double")
    assert ag.hierarchical_scan(two, ["a", "b"], [2]).collect()[0].silhouette == 0
