"""Distributed training: thin wrappers for built-in learners, loops for the rest."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.operators.features import hash_unit
from meterwise.session import durable, run_jobs


def with_features(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip").transform(df)


# ---- linear models ----


def linear_regression(df: DataFrame, label: str, alpha: float = 0.0, l1_ratio: float = 0.0, features: str = "features"):
    """Least squares, lasso (``l1_ratio=1``) or elastic net with unscaled penalties."""
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=alpha, elasticNetParam=l1_ratio, standardization=False,
        solver="auto" if alpha else "normal", maxIter=200, tol=1e-8,
    ).fit(df)


def coefficient_table(model, columns: Sequence[str], df: DataFrame) -> DataFrame:
    rows = [("Intercept", float(model.intercept))] + [(c, float(b)) for c, b in zip(columns, model.coefficients)]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


def logistic_regression(
    df: DataFrame, label: str, c: float = 1.0, weight: str | None = None, features: str = "features"
):
    """Binary or multinomial; ``c`` is the inverse penalty of the usual formulation."""
    n = df.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
    estimator = LogisticRegression(
        featuresCol=features, labelCol=label, regParam=1.0 / (c * n), standardization=False, maxIter=200
    )
    return (estimator.setWeightCol(weight) if weight else estimator).fit(df)


# ---- support vector machines ----


def random_fourier_features(df: DataFrame, vector: str, output: str, gamma: float, size: int = 256, seed: int = 42) -> DataFrame:
    """Feature map whose dot products approach the RBF kernel exp(-gamma |x-y|²) (published method)."""
    width = df.select(F.size(vector_to_array(vector))).first()[0]
    rng = np.random.default_rng(seed)
    weights = rng.normal(0, math.sqrt(2 * gamma), (width, size))
    shift = rng.uniform(0, 2 * math.pi, size)

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        return pd.Series(list(math.sqrt(2 / size) * np.cos(np.array(x.tolist(), dtype=float).reshape(len(x), width) @ weights + shift)))

    return df.withColumn(output, array_to_vector(project(vector_to_array(vector))))


def svm(df: DataFrame, label: str, kernel: str = "linear", features: str = "features", penalty: float = 0.01, degree: int = 2, gamma: float | None = None) -> tuple:
    """(model, mapped table): a linear machine, one against the rest, on mapped features."""
    mapped = df
    if kernel == "poly":
        mapped = PolynomialExpansion(degree=degree, inputCol=features, outputCol="__map").transform(df)
    elif kernel == "rbf":
        if gamma is None:
            gamma = 1.0 / df.select(F.size(vector_to_array(features))).first()[0]
        mapped = random_fourier_features(df, features, "__map", gamma)
    elif kernel != "linear":
        raise ValueError(f"unknown kernel {kernel!r}")
    column = features if kernel == "linear" else "__map"
    base = LinearSVC(featuresCol=column, labelCol=label, regParam=penalty, maxIter=50)
    return OneVsRest(classifier=base, featuresCol=column, labelCol=label, parallelism=4).fit(mapped), mapped


def mlp(df: DataFrame, label: str, hidden: Sequence[int], classes: int, features: str = "features", seed: int = 42):
    width = df.select(F.size(vector_to_array(features))).first()[0]
    return MultilayerPerceptronClassifier(
        featuresCol=features, labelCol=label, layers=[width, *hidden, classes], maxIter=100, seed=seed
    ).fit(df)


# ---- trees ----


def decision_tree(df: DataFrame, label: str, depth: int = 5, impurity: str = "gini", weight: str | None = None, features: str = "features", seed: int = 42):
    estimator = DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=depth, impurity=impurity, seed=seed)
    return (estimator.setWeightCol(weight) if weight else estimator).fit(df)


def random_forest(df: DataFrame, label: str, trees: int = 100, depth: int = 10, features: str = "features", seed: int = 42):
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(df)


def importances(model, columns: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance) in descending order."""
    rows = sorted(zip(columns, model.featureImportances.toArray().tolist()), key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in rows], "feature string, importance double")


def gradient_boosting(
    df: DataFrame, label: str, validation: str | None = None, rounds: int = 50, depth: int = 5, step: float = 0.1,
    features: str = "features", seed: int = 42, weight: str | None = None,
):
    """Boosted trees; a boolean ``validation`` column turns on early stopping."""
    estimator = GBTClassifier(
        featuresCol=features, labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed, checkpointInterval=10
    )
    if validation:
        estimator.setValidationIndicatorCol(validation)
    if weight:
        estimator.setWeightCol(weight)
    return estimator.fit(df)


# ---- ensembles ----


def _poisson_weight(key: Column, seed: int) -> Column:
    u = hash_unit(key, seed)
    result, cumulative, term = F.lit(8.0), 0.0, math.exp(-1.0)
    steps = []
    for n in range(8):
        cumulative += term
        steps.append((cumulative, float(n)))
        term /= n + 1
    for edge, n in reversed(steps):
        result = F.when(u < edge, n).otherwise(result)
    return result


def bagging_oob(df: DataFrame, label: str, key: str, trees: int = 20, depth: int = 10, features: str = "features", seed: int = 42, classes: int | None = None) -> dict:
    """Bagged trees and their out-of-bag accuracy.

    Row weights are Poisson draws fixed by (key, tree), so any task can be rerun; a row votes
    in the trees where its weight is 0.  Votes are checkpointed every ten trees.
    """
    df = durable(df.select(key, label, features))
    classes = classes or int(df.agg(F.max(label)).first()[0]) + 1
    votes = df.select(key, label, features).withColumn("votes", F.array_repeat(F.lit(0), classes))
    models = []
    for t in range(trees):
        weight = _poisson_weight(F.col(key), seed * 100_003 + t)
        sample = df.select(label, features, weight.alias("__w")).filter("__w > 0")
        model = decision_tree(sample, label, depth, weight="__w", features=features, seed=seed + t)
        models.append(model)
        scored = model.transform(votes).drop("rawPrediction", "probability")
        bumped = F.transform("votes", lambda v, i: v + F.when((weight == 0) & (i == F.col("prediction").cast("int")), 1).otherwise(0))
        votes = scored.withColumn("votes", bumped).drop("prediction")
        if t % 10 == 9:
            votes = durable(votes)
    best = (F.array_position("votes", F.array_max("votes")) - 1).cast("double")
    voted = votes.filter(F.array_max("votes") > 0).withColumn("prediction", best)
    score = voted.agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0]
    return {"models": models, "oob_score": score, "oob": voted.select(key, label, "prediction")}


def adaboost(df: DataFrame, label: str, rounds: int = 20, depth: int = 5, features: str = "features", classes: int | None = None, seed: int = 42) -> dict:
    """Multiclass boosting with exponential reweighting (SAMME) on weighted trees."""
    classes = classes or int(df.agg(F.max(label)).first()[0]) + 1
    current = durable(df.select("*", F.lit(1.0).alias("__w")))
    models, alphas, errors = [], [], []
    for t in range(rounds):
        model = decision_tree(current, label, depth, weight="__w", features=features, seed=seed + t)
        scored = model.transform(current).drop("rawPrediction", "probability")
        miss = (F.col("prediction") != F.col(label)).cast("double")
        row = scored.agg(F.sum(F.col("__w") * miss).alias("e"), F.sum("__w").alias("w")).first()
        error = row["e"] / row["w"]
        if error >= 1 - 1 / classes:
            if not models:
                raise ValueError("the first tree is no better than chance")
            break
        models.append(model)
        errors.append(error)
        if error <= 0:
            alphas.append(1.0)
            break
        alphas.append(math.log((1 - error) / error) + math.log(classes - 1))
        # normalise to mean 1 so weights stay in range
        after = row["w"] + row["e"] * (math.exp(alphas[-1]) - 1)
        rows_scale = row["w"] / after
        current = scored.withColumn("__w", F.col("__w") * F.exp(alphas[-1] * miss) * rows_scale).drop("prediction")
        if t % 10 == 9:
            current = durable(current)
    return {"models": models, "alphas": alphas, "errors": errors, "classes": classes}


def _add_vote(votes: str, weight: float) -> Column:
    return F.transform(votes, lambda v, i: v + F.when(i == F.col("prediction").cast("int"), weight).otherwise(0.0))


def adaboost_predict(boosted: dict, df: DataFrame, features: str = "features") -> DataFrame:
    """Add ``prediction``, the class with the largest sum of tree weights."""
    scored = df.withColumn("__votes", F.array_repeat(F.lit(0.0), boosted["classes"]))
    for t, (model, alpha) in enumerate(zip(boosted["models"], boosted["alphas"])):
        scored = model.transform(scored).drop("rawPrediction", "probability")
        scored = scored.withColumn("__votes", _add_vote("__votes", alpha)).drop("prediction")
        if t % 10 == 9:
            scored = durable(scored)
    best = (F.array_position("__votes", F.array_max("__votes")) - 1).cast("double")
    return scored.withColumn("prediction", best).drop("__votes")


def hard_vote(predictions: Sequence[DataFrame], key: str) -> DataFrame:
    """Majority of several (key, prediction) tables; ties go to the lowest label."""
    stacked = predictions[0].select(key, "prediction")
    for other in predictions[1:]:
        stacked = stacked.unionByName(other.select(key, "prediction"))
    votes = stacked.groupBy(key, "prediction").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy(key).agg(F.min_by("prediction", F.struct(-F.col("n"), F.col("prediction"))).alias("prediction"))


def out_of_fold(estimator: Estimator, df: DataFrame, key: str, fold: str, output: str = "prediction", column: str = "prediction") -> DataFrame:
    """(key, output) predicted by the model that did not see the row's fold."""
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())  # a handful of folds
    fitted = run_jobs(df.sparkSession, [partial(estimator.fit, df.filter(F.col(fold) != f)) for f in folds])
    parts = None
    for f, model in zip(folds, fitted):
        part = model.transform(df.filter(F.col(fold) == f)).select(key, F.col(column).alias(output))
        parts = part if parts is None else parts.unionByName(part)
    return durable(parts)


def stacking(estimators: Sequence[Estimator], df: DataFrame, label: str, key: str, fold: str) -> dict:
    """Out-of-fold class probabilities of every base learner feed a logistic meta-model."""
    df = durable(df)
    table = df.select(key, label)
    names = []
    for i, estimator in enumerate(estimators):
        probabilities = out_of_fold(estimator, df, key, fold, f"p{i}", "probability")
        table = table.join(probabilities, key)
        names.append(f"p{i}")
    meta_input = VectorAssembler(inputCols=names, outputCol="meta").transform(table)
    meta = LogisticRegression(featuresCol="meta", labelCol=label, regParam=1e-6).fit(meta_input)
    return {"bases": [e.fit(df) for e in estimators], "meta": meta, "names": names}


def stacking_predict(stack: dict, df: DataFrame) -> DataFrame:
    scored = df
    for name, model in zip(stack["names"], stack["bases"]):
        scored = model.transform(scored).withColumnRenamed("probability", name).drop("rawPrediction", "prediction")
    assembled = VectorAssembler(inputCols=stack["names"], outputCol="meta").transform(scored)
    return stack["meta"].transform(assembled).drop("meta", "rawPrediction", *stack["names"])


# ---- decisions ----


def argmax_class(probabilities: Column) -> Column:
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def at_least(score: Column, threshold: float) -> Column:
    return (score >= threshold).cast("int")


def positive_probability(df: DataFrame, column: str = "probability", output: str = "score") -> DataFrame:
    return df.withColumn(output, vector_to_array(column)[1])


def predict(model: Model, df: DataFrame, key: str) -> DataFrame:
    return model.transform(df).select(key, "prediction")
