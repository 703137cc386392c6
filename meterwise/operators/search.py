"""Hyper-parameter search: grid, random and model-guided draws over Spark jobs."""

from __future__ import annotations

import itertools
import logging
import math
import random
from collections.abc import Callable, Mapping, Sequence
from functools import partial

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.classification import Classifier, OneVsRest
from pyspark.ml.regression import Regressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.session import run_jobs

logger = logging.getLogger(__name__)


def _kind(estimator) -> str:
    if isinstance(estimator, (Classifier, OneVsRest)):
        return "f1"
    if isinstance(estimator, Regressor):
        return "neg_mean_squared_error"
    raise ValueError("the estimator is neither a classifier nor a regressor")


def score_predictions(df: DataFrame, label: str, kind: str) -> float:
    if kind == "f1":
        hit, real = F.col("prediction") == 1, F.col(label) == 1
        row = df.agg(F.count(F.when(hit & real, 1)).alias("tp"), F.count(F.when(hit, 1)).alias("pp"), F.count(F.when(real, 1)).alias("p")).first()
        return 2 * row["tp"] / (row["pp"] + row["p"]) if row["pp"] + row["p"] else 0.0
    return -df.agg(F.avg((F.col(label) - F.col("prediction")) ** 2)).first()[0]


def cv_scores(estimator: Estimator, df: DataFrame, label: str, fold: str, kind: str, params: Mapping | None = None) -> list[float]:
    """Score of each held-out fold; training rows never leave the executors."""
    tuned = estimator.copy({estimator.getParam(k): v for k, v in (params or {}).items()})
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())  # a handful of folds

    def held_out(f) -> float:
        model = tuned.fit(df.filter(F.col(fold) != f))
        return score_predictions(model.transform(df.filter(F.col(fold) == f)), label, kind)

    return run_jobs(df.sparkSession, [partial(held_out, f) for f in folds])


def cross_validate(estimator: Estimator, df: DataFrame, label: str, fold: str) -> DataFrame:
    """(fold, score, mean, std)."""
    scores = cv_scores(estimator, df, label, fold, _kind(estimator))
    mean, std = float(np.mean(scores)), float(np.std(scores))
    return df.sparkSession.createDataFrame(
        [(i, float(s), mean, std) for i, s in enumerate(scores)], "fold int, score double, mean double, std double"
    )


def _points(grid: Mapping[str, Sequence]) -> list[dict]:
    names = sorted(grid)
    return [dict(zip(names, values)) for values in itertools.product(*[grid[n] for n in names])]


def _guided(points: list[dict], grid: Mapping[str, Sequence], evaluate: Callable[[dict], float], draws: int, seed: int) -> list[tuple[dict, float]]:
    """Gaussian-process proposals by expected improvement over the candidate list."""
    names = sorted(grid)
    codes = np.array([[list(grid[n]).index(p[n]) / max(1, len(grid[n]) - 1) for n in names] for p in points])
    rng = random.Random(seed)
    left = list(range(len(points)))
    done: list[tuple[int, float]] = []
    while left and len(done) < draws:
        if len(done) < 2:
            pick = rng.choice(left)
        else:
            x, y = codes[[i for i, _ in done]], np.array([s for _, s in done])
            scale = y.std() or 1.0

            def kernel(a, b):
                return np.exp(-((a[:, None, :] - b[None, :, :]) ** 2).sum(2) / (2 * 0.3**2))

            inverse = np.linalg.inv(kernel(x, x) + 1e-6 * np.eye(len(x)))
            cross = kernel(codes[left], x)
            mean = cross @ inverse @ ((y - y.mean()) / scale)
            spread = np.sqrt(np.maximum(1e-12, 1 - np.einsum("ij,jk,ik->i", cross, inverse, cross)))
            gap = mean - ((y - y.mean()) / scale).max()
            z = gap / spread
            gain = gap * np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z]) + spread * np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
            pick = left[int(np.argmax(gain))]
        left.remove(pick)
        done.append((pick, evaluate(points[pick])))
    return [(points[i], s) for i, s in done]


def compare_searches(
    name: str, estimator: Estimator, grid: Mapping[str, Sequence], train: DataFrame, test: DataFrame, label: str, fold: str,
    draws: int = 5, seed: int = 42,
) -> DataFrame:
    """(model, method, best_params, best_cv_score, metric, test_metric) of three searches.

    A search that fails is skipped with a warning; a model that cannot predict gives a NULL
    metric.  Evaluations shared by the searches run once.
    """
    kind = _kind(estimator)
    cache: dict[str, float] = {}

    def evaluate(point: dict) -> float:
        key = repr(sorted(point.items()))
        if key not in cache:
            cache[key] = float(np.mean(cv_scores(estimator, train, label, fold, kind, point)))
        return cache[key]

    def grid_search() -> list[tuple[dict, float]]:
        return [(p, evaluate(p)) for p in _points(grid)]

    def random_search() -> list[tuple[dict, float]]:
        points = _points(grid)
        return [(p, evaluate(p)) for p in random.Random(seed).sample(points, min(draws, len(points)))]

    def guided_search() -> list[tuple[dict, float]]:
        return _guided(_points(grid), grid, evaluate, draws, seed)

    rows = []
    for method, run in (("grid", grid_search), ("random", random_search), ("bayes", guided_search)):
        try:
            tried = run()
            best, score = max(tried, key=lambda t: t[1])
        except Exception as error:  # a failing search is reported and skipped
            logger.warning("search %s failed: %s", method, error)
            continue
        try:
            tuned = estimator.copy({estimator.getParam(k): v for k, v in best.items()})
            value = score_predictions(tuned.fit(train).transform(test), label, kind)
            metric = value if kind == "f1" else -value
        except Exception as error:
            logger.warning("no test metric for %s: %s", method, error)
            metric = None
        rows.append((name, method, repr(sorted(best.items())), float(score), "f1" if kind == "f1" else "mean_squared_error", metric))
    schema = "model string, method string, best_params string, best_cv_score double, metric string, test_metric double"
    return train.sparkSession.createDataFrame(rows, schema)


def grid_table(estimator: Estimator, grid: Mapping[str, Sequence], df: DataFrame, label: str, fold: str) -> DataFrame:
    """(params, mean_score, std_score, rank) of every grid point."""
    kind = _kind(estimator)
    tried = []
    for point in _points(grid):
        scores = cv_scores(estimator, df, label, fold, kind, point)
        tried.append((repr(sorted(point.items())), float(np.mean(scores)), float(np.std(scores))))
    rows = [(*t, 1 + sum(o[1] > t[1] for o in tried)) for t in tried]
    return df.sparkSession.createDataFrame(rows, "params string, mean_score double, std_score double, rank int")
