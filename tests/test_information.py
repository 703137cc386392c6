import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterwise.operators import selection


def plain(x, y, k):
    x, y = x / x.std(), y / y.std()
    n = len(x)
    dx, dy = np.abs(x[:, None] - x), np.abs(y[:, None] - y)
    both = np.maximum(dx, dy)
    np.fill_diagonal(both, np.inf)
    r = np.sort(both, axis=1)[:, k - 1] * (1 - 1e-10)
    harmonic = np.concatenate([[0.0], np.cumsum(1 / np.arange(1, n + 1))])
    nx, ny = ((d <= r[:, None]).sum(axis=1) - 1 for d in (dx, dy))
    return max(0.0, harmonic[n - 1] + harmonic[k - 1] - np.mean(harmonic[nx] + harmonic[ny]))


def test_against_all_pairs(spark):
    rng = np.random.default_rng(40)
    n = 260
    y = rng.normal(size=n)
    columns = {"near": y + 0.2 * rng.normal(size=n), "free": rng.normal(size=n), "steps": np.round(y * 2), "bent": y**2}
    rows = [(i, *(float(c[i]) for c in columns.values()), 1.0, float(y[i])) for i in range(n)]
    rows += [(n, None, 1.0, 1.0, float("nan"), 1.0, 5.0), (n + 1, 1.0, 1.0, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, near double, free double, steps double, bent double, flat double, y double")
    found = {r.feature: r for r in selection.neighbour_information(df, [*columns, "flat"], "y", "id", 3).collect()}
    assert found["flat"].mutual_information == 0
    extra = {"near": [], "free": [(1.0, 5.0)], "steps": [(1.0, 5.0)], "bent": []}
    for name, values in columns.items():
        x, t = np.append(values, [a for a, _ in extra[name]]), np.append(y, [b for _, b in extra[name]])
        assert found[name].n == len(x) and found[name].mutual_information == pytest.approx(plain(x, t, 3), abs=1e-9), name
    assert found["near"].mutual_information > 1 > 0.2 > found["free"].mutual_information


def test_small_tables(spark):
    df = spark.createDataFrame([(i, float(i), float(i)) for i in range(3)], "id long, x double, y double")
    assert [tuple(r) for r in selection.neighbour_information(df, ["x"], "y", "id", 3).collect()] == [("x", 0.0, 3)]
    assert selection.neighbour_information(df.limit(0), ["x"], "y", "id", 3).collect()[0].n == 0


def test_harmonic_numbers(spark):
    found = spark.range(0, 60).select("id", selection._harmonic(F.col("id")).alias("h")).collect()
    assert all(r.h == pytest.approx(math.fsum(1 / i for i in range(1, r.id + 1)), abs=1e-13) for r in found)
