"""Gram-matrix regressions and feature selection.

One pass sums X'X, X'y and y'y per group on the executors; every later fit (ridge path,
recursive elimination, cross-validated elimination) is p × p algebra on those sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.functions.special import f_sf
from meterwise.operators.clean import nan_to_null
from meterwise.operators.neighbors import nearest_neighbors
from meterwise.operators.ranking import bucket_column, quantiles, unpivot_numeric, weighted_cumulative
from meterwise.session import durable

MAX_GRAM_COLUMNS = 2_000


def gram_by_group(df: DataFrame, columns: Sequence[str], group: str | None = None) -> dict:
    """{group: matrix of sums of products} with a leading constant column.

    Each task adds up its own rows and emits one matrix per group (folds: a handful).
    """
    columns = list(columns)
    if len(columns) > MAX_GRAM_COLUMNS:
        raise ValueError(f"more than {MAX_GRAM_COLUMNS} columns")
    size = len(columns) + 1
    picked = df.select(
        (F.col(group) if group else F.lit(0)).cast("int").alias("__g"), *[F.col(c).cast("double").alias(c) for c in columns]
    ).dropna()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for g, part in pdf.groupby("__g"):
                x = np.hstack([np.ones((len(part), 1)), part[columns].to_numpy()])
                sums[g] = sums.get(g, 0) + x.T @ x
        for g, matrix in sums.items():
            i, j = np.triu_indices(size)
            yield pd.DataFrame({"g": g, "i": i, "j": j, "s": matrix[i, j]})

    rows = picked.mapInPandas(partial, "g int, i int, j int, s double").groupBy("g", "i", "j").agg(F.sum("s").alias("s"))
    result: dict[int, np.ndarray] = {}
    for r in rows.collect():  # (columns + 1)² / 2 sums per group
        m = result.setdefault(r["g"], np.zeros((size, size)))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"]
    return result


def gram_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    size = len(columns) + 1
    return gram_by_group(df, columns).get(0, np.zeros((size, size)))


def _centred(sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    n = sums[0, 0]
    means = sums[0, 1:] / n
    return n, means, sums[1:, 1:] - n * np.outer(means, means)


def ols_from_sums(sums: np.ndarray, keep: Sequence[int], ridge: float = 0.0) -> dict:
    """Least squares of the last column on the kept feature positions (0-based)."""
    n, means, c = _centred(sums)
    keep = list(keep)
    a = c[np.ix_(keep, keep)] + ridge * np.eye(len(keep))
    beta = np.linalg.lstsq(a, c[keep, -1], rcond=None)[0]
    sse = float(c[-1, -1] - 2 * beta @ c[keep, -1] + beta @ c[np.ix_(keep, keep)] @ beta)
    return {
        "n": n,
        "coefficients": beta,
        "intercept": float(means[-1] - beta @ means[keep]),
        "sse": sse,
        "r2": 1 - sse / c[-1, -1],
        "scale": np.sqrt(np.diag(c)[keep] / n),
    }


def _score(sums: np.ndarray, keep: Sequence[int], fit: dict) -> float:
    """R² of a fit on another set of rows, given their sums of products."""
    keep = list(keep)
    b = np.zeros(sums.shape[0] - 1)
    b[0] = fit["intercept"]
    for position, value in zip(keep, fit["coefficients"]):
        b[position + 1] = value
    yy, xy, xx = sums[-1, -1], sums[:-1, -1], sums[:-1, :-1]
    sse = yy - 2 * b @ xy + b @ xx @ b
    sst = yy - sums[0, -1] ** 2 / sums[0, 0]
    return float(1 - sse / sst)


def ridge_path(df: DataFrame, features: Sequence[str], target: str, alphas: Sequence[float], fold: str | None = None) -> DataFrame:
    """Ridge fits for every penalty from one pass; with a fold column also the mean R² of held-out folds."""
    per_fold = gram_by_group(df, [*features, target], fold)
    total = sum(per_fold.values())
    everything = list(range(len(features)))
    rows = []
    for alpha in alphas:
        fit = ols_from_sums(total, everything, alpha)
        scores = [
            _score(held, everything, ols_from_sums(total - held, everything, alpha)) for held in per_fold.values()
        ] if fold else []
        rows.append((float(alpha), fit["intercept"], [float(b) for b in fit["coefficients"]], float(fit["r2"]), float(np.mean(scores)) if scores else None))
    return df.sparkSession.createDataFrame(rows, "alpha double, intercept double, coefficients array<double>, r2 double, cv_r2 double")


def _eliminate(sums: np.ndarray, p: int, stop: int) -> tuple[list[int], dict[int, int]]:
    """Drop the feature with the smallest absolute coefficient until ``stop`` remain."""
    kept, rank = list(range(p)), {}
    while len(kept) > stop:
        beta = np.abs(ols_from_sums(sums, kept)["coefficients"])
        weakest = int(np.argmin(beta))
        rank[kept[weakest]] = len(kept) - stop + 1
        del kept[weakest]
    rank.update({k: 1 for k in kept})
    return kept, rank


def recursive_elimination(df: DataFrame, features: Sequence[str], target: str, keep: int) -> DataFrame:
    """(feature, ranking, selected): rank 1 is kept, larger ranks left earlier."""
    sums = gram_matrix(df, [*features, target])
    _, rank = _eliminate(sums, len(features), keep)
    return df.sparkSession.createDataFrame(
        [(f, rank[i] , rank[i] == 1) for i, f in enumerate(features)], "feature string, ranking int, selected boolean"
    )


def recursive_elimination_cv(
    df: DataFrame, features: Sequence[str], target: str, fold: str, expanding: bool = True
) -> DataFrame:
    """Held-out R² per number of features, and the features kept at the best number.

    With ``expanding`` the fold number is a time order: fold k trains on folds before it.
    Output (n_features, cv_r2, feature, ranking), ranking from the full table.
    """
    per_fold = gram_by_group(df, [*features, target], fold)
    p = len(features)
    total = sum(per_fold.values())
    order = sorted(per_fold)
    pairs = []
    for position, held in enumerate(order):
        if expanding:
            if position == 0:
                continue
            pairs.append((sum(per_fold[k] for k in order[:position]), per_fold[held]))
        else:
            pairs.append((total - per_fold[held], per_fold[held]))
    scores = {}
    for size in range(1, p + 1):
        found = []
        for train, test in pairs:
            kept, _ = _eliminate(train, p, size)
            found.append(_score(test, kept, ols_from_sums(train, kept)))
        scores[size] = float(np.mean(found))
    best = max(scores, key=lambda s: (scores[s], -s))
    _, rank = _eliminate(total, p, best)
    rows = [(best, scores[best], f, rank[i]) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "n_features int, cv_r2 double, feature string, ranking int")


def f_regression(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Univariate F score and p-value of each feature over its complete pairs, from one aggregation."""
    columns = [*features, target]
    known = nan_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    pair = lambda f: F.when(F.col(f).isNotNull() & F.col(target).isNotNull(), 1)
    row = known.agg(
        *[F.count(pair(f)).alias(f"n{i}") for i, f in enumerate(features)], *[F.corr(f, target).alias(f"r{i}") for i, f in enumerate(features)]
    ).first()
    rows = []
    for i, f in enumerate(features):
        r, free = row[f"r{i}"], row[f"n{i}"] - 2
        score = None if r is None or r * r >= 1 or free < 1 else r * r * free / (1 - r * r)
        rows.append((f, score, None if score is None else f_sf(score, 1, free)))
    return df.sparkSession.createDataFrame(rows, "feature string, f double, p_value double")


def k_best(scores: DataFrame, column: str, k: int) -> DataFrame:
    """The k best rows of a small (feature, score) table."""
    return scores.orderBy(F.desc_nulls_last(column), "feature").limit(k)


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 16) -> DataFrame:
    """Mutual information (nats) of quantile-binned features and target, from joint counts."""
    shares = [i / bins for i in range(1, bins)]
    columns = [*features, target]
    # edges of every column in one exact pass: one row per column
    cuts = {
        r["column"]: sorted({r[f"q{i}"] for i in range(bins - 1)})
        for r in quantiles(unpivot_numeric(df, columns), "value", shares, ["column"]).collect()
    }

    coded = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    coded = coded.select(*[bucket_column(c, cuts[c]).alias(c) for c in columns])
    joint = coded.unpivot([target], list(features), "feature", "x").groupBy("feature", "x", target).agg(
        F.count(F.lit(1)).alias("n")
    )
    from pyspark.sql import Window

    # bins² rows per feature
    f, fx, fy = Window.partitionBy("feature"), Window.partitionBy("feature", "x"), Window.partitionBy("feature", target)
    n, total = F.col("n"), F.sum("n").over(f)
    part = n / total * F.log(n * total / (F.sum("n").over(fx) * F.sum("n").over(fy)))
    return joint.withColumn("part", part).groupBy("feature").agg(F.sum("part").alias("mutual_information"))


def _harmonic(n: Column) -> Column:
    """1 + 1/2 + ... + 1/n (0 for 0): the digamma function of n + 1 and Euler's constant."""
    small = F.aggregate(F.sequence(F.lit(1).cast("long"), F.least(n, F.lit(20).cast("long"))), F.lit(0.0), lambda s, i: s + 1.0 / i)
    m = n.cast("double")
    # the series is exact to double precision from 20 on
    large = F.log(m) + F.lit(float(np.euler_gamma)) + 1 / (2 * m) - 1 / (12 * m * m) + 1 / (120 * F.pow(m, 4)) - 1 / (252 * F.pow(m, 6)) + 1 / (240 * F.pow(m, 8))
    return F.when(n <= 0, 0.0).when(n <= 20, small).otherwise(large)


def neighbour_information(df: DataFrame, features: Sequence[str], target: str, key: str, k: int = 3) -> DataFrame:
    """(feature, mutual_information, n): information (nats, at least 0) that each feature has about the target, by neighbours.

    The published estimate for continuous columns: around every row a square that reaches to its k-th nearest neighbour
    in (feature, target), both divided by their standard deviation; the information follows from how many rows lie
    strictly inside its two shadows. Rows are counted by ranks of the shadows' ends among the values, never by pairs. Rows
    at distance 0 count as inside where the k-th neighbour is at distance 0. `key` is a unique whole number. Rows with a
    NULL or NaN in the pair are left out; a constant column, or too few rows, gives 0."""
    rows, schema = [], "feature string, mutual_information double, n long"
    result = None
    for name in features:
        pair = nan_to_null(df.select(F.col(key).cast("long").alias("id"), F.col(name).cast("double").alias("x"), F.col(target).cast("double").alias("y"))).dropna()
        size = pair.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("x").alias("x"), F.stddev_pop("y").alias("y")).first()
        if size["n"] <= k or not size["x"] or not size["y"]:
            rows.append((name, 0.0, size["n"]))
            continue
        scaled = durable(pair.select("id", *[(F.col(c) / F.lit(size[c])).alias(c) for c in ("x", "y")]))
        points = scaled.select("id", F.array("x", "y").alias("vector"))
        near = nearest_neighbors(points, points, k, metric="chebyshev", exclude_same_key=True)
        # a hair less than the distance: what lies at it counts as outside whatever the rounding
        reach = scaled.join(near.where(F.col("rank") == k).select(F.col("query").alias("id"), (F.col("distance") * (1 - 1e-10)).alias("r")), "id")
        reach = durable(reach.select("id", *[(F.col(c) + s * F.col("r")).alias(f"{c}{e}") for c in ("x", "y") for e, s in (("a", -1), ("b", 1))]))
        inside = reach.select("id")
        for c in ("x", "y"):
            ends = reach.select(F.explode(F.array(f"{c}a", f"{c}b")).alias("v")).distinct().withColumn("w", F.lit(0).cast("long"))
            counts = weighted_cumulative(scaled.select(F.col(c).alias("v"), F.lit(1).cast("long").alias("w")).unionByName(ends), "v", ["w"])
            counts = durable(counts.select(F.col("value").alias("v"), F.col("below_w").alias("below"), (F.col("below_w") + F.col("w")).alias("upto")))
            low = counts.select(F.col("v").alias(f"{c}a"), F.col("below").alias("low"))
            high = counts.select(F.col("v").alias(f"{c}b"), F.col("upto").alias("high"))
            found = reach.select("id", f"{c}a", f"{c}b").join(low, f"{c}a").join(high, f"{c}b").select("id", (F.col("high") - F.col("low") - 1).alias(f"n_{c}"))
            inside = inside.join(found, "id")
        mean = F.avg(_harmonic(F.col("n_x")) + _harmonic(F.col("n_y")))
        known = _harmonic(F.lit(size["n"] - 1).cast("long")) + _harmonic(F.lit(k - 1).cast("long"))
        part = inside.agg(F.greatest(F.lit(0.0), known - mean).alias("mutual_information"), F.count(F.lit(1)).alias("n"))
        part = part.select(F.lit(name).alias("feature"), "mutual_information", "n")
        result = part if result is None else result.unionByName(part)
    fixed = df.sparkSession.createDataFrame(rows, schema)
    return fixed if result is None else result.unionByName(fixed) if rows else result


def select_from_model(features: Sequence[str], weights: Sequence[float], rule: str = "mean") -> list[str]:
    """Features whose absolute weight reaches the mean, or is non-zero for ``rule="nonzero"``."""
    size = np.abs(np.asarray(weights, dtype=float))
    limit = size.mean() if rule == "mean" else 1e-10
    return [f for f, w in zip(features, size) if w >= limit]
