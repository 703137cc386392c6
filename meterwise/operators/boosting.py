"""Boosted trees round by round: margins of all rounds in one column, error curves over folds, early stopping."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators.models import gradient_boosting
from meterwise.session import durable, run_jobs


class Trees(NamedTuple):
    """All trees of an ensemble as flat tables: nodes of a tree follow its root; leaves have feature -1."""

    roots: np.ndarray
    weights: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray


def trees_of(model) -> Trees:
    """The trees of a fitted ensemble over continuous features (its size is fixed by rounds and depth)."""
    roots, rows = [], []

    def walk(node) -> int:
        at = len(rows)
        rows.append(None)
        count = float(node.impurityStats().count())
        if node.numDescendants() == 0:
            rows[at] = (-1, 0.0, at, at, float(node.prediction()), 0.0, count)
        else:
            split = node.split()
            feature, threshold, gain = int(split.featureIndex()), float(split.threshold()), float(node.gain())
            rows[at] = (feature, threshold, walk(node.leftChild()), walk(node.rightChild()), float(node.prediction()), gain, count)
        return at

    for tree in model.trees:
        roots.append(walk(tree._call_java("rootNode")))
    columns = [np.array(c) for c in zip(*rows, strict=True)]
    return Trees(np.array(roots), np.array(model.treeWeights, dtype=float), *columns)


def staged(trees: Trees, x: np.ndarray) -> np.ndarray:
    """Margins after every round (rows × rounds): weighted sums of the trees' values so far."""
    out = np.empty((len(x), len(trees.roots)))
    rows = np.arange(len(x))
    for t, root in enumerate(trees.roots):
        at = np.full(len(x), root)
        while True:
            feature = trees.feature[at]
            inner = feature >= 0
            if not inner.any():
                break
            low = x[rows, np.where(inner, feature, 0)] <= trees.threshold[at]
            at = np.where(inner, np.where(low, trees.left[at], trees.right[at]), at)
        out[:, t] = trees.weights[t] * trees.value[at]
    return np.cumsum(out, axis=1)


def staged_margins(model, features: str = "features") -> Column:
    """The margins after every round as one array column; the class is 1 where a margin is above 0."""
    parts = tuple(trees_of(model))

    @F.pandas_udf("array<double>")
    def margins(x: pd.Series) -> pd.Series:
        return pd.Series(list(staged(Trees(*parts), np.array(x.tolist(), dtype=float).reshape(len(x), -1))))

    return margins(vector_to_array(features))


def leaf_of_round(model, round_: int, features: str = "features") -> Column:
    """Value of the leaf that a row falls into in one round's tree."""
    parts = trees_of(model)
    one = tuple(parts._replace(roots=parts.roots[round_ : round_ + 1], weights=np.ones(1)))

    @F.pandas_udf("double")
    def value(x: pd.Series) -> pd.Series:
        return pd.Series(staged(Trees(*one), np.array(x.tolist(), dtype=float).reshape(len(x), -1))[:, 0])

    return value(vector_to_array(features))


def fold_curves(
    df: DataFrame, label: str, fold: str, rounds: int = 100, depth: int = 5, step: float = 0.1, features: str = "features", seed: int = 42
) -> DataFrame:
    """(fold, round, train_loss, test_loss, train_error, test_error): logistic loss and error rate after every round.

    A model is fitted without each fold; then one pass over the rows gives the margins of all rounds of all models, and
    every task adds up its losses by (fold, round). Labels are 0 and 1; the folds are a handful. A fold whose rest has one
    class only is fitted like any other; without rows the result is empty."""
    schema = "fold int, round int, train_loss double, test_loss double, train_error double, test_error double"
    slim = durable(df.select(F.col(label).cast("double").alias("label"), F.col(fold).cast("int").alias("fold"), F.col(features).alias("features")).dropna())
    folds = sorted(r["fold"] for r in slim.select("fold").distinct().collect())
    if len(folds) < 2:
        return df.sparkSession.createDataFrame([], schema)

    def train(f: int):
        return tuple(trees_of(gradient_boosting(slim.where(F.col("fold") != f), "label", None, rounds, depth, step, seed=seed)))

    models = run_jobs(df.sparkSession, [partial(train, f) for f in folds])
    shared = df.sparkSession.sparkContext.broadcast(models)  # folds × rounds × nodes

    def losses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, bool], np.ndarray] = {}
        for pdf in batches:
            x, own, sign = np.array(pdf["x"].tolist(), dtype=float).reshape(len(pdf), -1), pdf["fold"].to_numpy(), 2 * pdf["label"].to_numpy() - 1
            for f, parts in zip(folds, shared.value, strict=True):
                margin = staged(Trees(*parts), x) * sign[:, None]
                for held in (False, True):
                    some = margin[(own == f) == held]
                    # the margin stands for half the log-odds
                    found = np.stack([np.logaddexp(0, -2 * some).sum(axis=0), (some <= 0).sum(axis=0), np.full(some.shape[1], len(some))])
                    # a margin of exactly 0 is class 0
                    found[1] -= ((some == 0) & (sign[(own == f) == held, None] < 0)).sum(axis=0)
                    sums[f, held] = sums.get((f, held), 0) + found
        for (f, held), s in sums.items():
            yield pd.DataFrame({"fold": f, "held": held, "round": np.arange(1, s.shape[1] + 1), "loss": s[0], "wrong": s[1], "n": s[2]})

    parts = slim.select("label", "fold", vector_to_array("features").alias("x")).mapInPandas(losses, "fold int, held boolean, round int, loss double, wrong double, n double")
    sums = parts.groupBy("fold", "round", "held").agg(*[F.sum(c).alias(c) for c in ("loss", "wrong", "n")])

    def share(column: str, held: bool) -> Column:
        return F.max(F.when(F.col("held") == held, F.try_divide(column, "n")))

    return sums.groupBy("fold", "round").agg(
        share("loss", False).alias("train_loss"), share("loss", True).alias("test_loss"), share("wrong", False).alias("train_error"), share("wrong", True).alias("test_error")
    )


def curve_summary(curves: DataFrame, patience: int = 15) -> DataFrame:
    """(round, train_mean, train_std, test_mean, test_std, best): means over the folds up to the best round.

    Rounds stop when the mean loss on the held-out folds has not got smaller for `patience` rounds; the best round is the
    earliest with the smallest mean until then."""
    means = curves.groupBy("round").agg(
        *[f(f"{c}_loss").alias(f"{c}_{n}") for c in ("train", "test") for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    )
    so_far = Window.partitionBy(F.lit(0)).orderBy("round")  # one row per round
    record = F.min("test_mean").over(so_far)
    before = F.min("test_mean").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    marked = means.withColumn("better", before.isNull() | (F.col("test_mean") < before)).withColumn("record", record)
    marked = marked.withColumn("last", F.max(F.when(F.col("better"), F.col("round"))).over(so_far))
    stopped = F.min(F.when(F.col("round") - F.col("last") >= patience, F.col("round"))).over(Window.partitionBy(F.lit(0)))
    alive = marked.withColumn("stop", stopped).where("stop IS NULL OR round <= stop")
    best = F.max(F.when(F.col("better"), F.col("round"))).over(Window.partitionBy(F.lit(0)))
    kept = alive.withColumn("b", best).where("round <= b")
    return kept.select("round", "train_mean", "train_std", "test_mean", "test_std", (F.col("round") == F.col("b")).alias("best"))


def importance_by_type(model, columns: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance, weight, gain, cover, total_gain, total_cover).

    weight is the number of splits; total_cover the rows that reach them, total_gain their impurity decrease times those
    rows; gain and cover are means per split; importance is the model's own share."""
    trees, own = trees_of(model), model.featureImportances.toArray()
    inner = trees.feature >= 0
    weight, total_gain, total_cover = (
        np.bincount(trees.feature[inner], weights=w, minlength=len(columns)) for w in (None, (trees.gain * trees.cover)[inner], trees.cover[inner])
    )
    rows = [
        (c, float(own[i]), int(weight[i]), *(float(t[i] / weight[i]) if weight[i] else 0.0 for t in (total_gain, total_cover)), float(total_gain[i]), float(total_cover[i]))
        for i, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, weight int, gain double, cover double, total_gain double, total_cover double")
