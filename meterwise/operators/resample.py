"""Class rebalancing and the cross-validated comparisons built on it."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import partial
from operator import floordiv, mod

from pyspark.ml import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators.evaluate import stratified_folds
from meterwise.operators.features import hash_unit
from meterwise.operators.models import positive_probability
from meterwise.operators.neighbors import nearest_neighbors
from meterwise.operators.ranking import row_numbers
from meterwise.session import durable, run_jobs

MAX_CLASSES = 10_000
COPIES_PER_TASK = 10_000


def class_sizes(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError("too many classes")
    return {r[label]: r["n"] for r in rows}


def _hash_ranked(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    hashed = df.withColumn("__h", F.xxhash64(F.col(key), F.lit(seed)))
    return row_numbers(hashed, "__h", key, [label], name="__r").drop("__h")


def _per_class(label: str, values: dict):
    result = F.lit(None).cast("long")
    for k, v in values.items():
        result = F.when(F.col(label).eqNullSafe(F.lit(k)), F.lit(v)).otherwise(result)
    return result


def _repeat(df: DataFrame, key: str, copies: str, most: int) -> DataFrame:
    """``copies`` rows per row, numbered by ``copy``; many copies are made by several tasks."""
    if most <= COPIES_PER_TASK:
        return df.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies).cast("long")))).drop(copies)
    starts = F.sequence(F.lit(0).cast("long"), F.col(copies).cast("long") - 1, F.lit(COPIES_PER_TASK).cast("long"))
    blocks = df.withColumn("__start", F.explode(starts))
    blocks = blocks.repartition(F.col(key), F.col("__start"))
    ends = F.least(F.col("__start") + COPIES_PER_TASK, F.col(copies).cast("long"))
    return blocks.withColumn("copy", F.explode(F.sequence(F.col("__start") + 1, ends))).drop(copies, "__start")


def undersample(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Cut the largest class to the size of the smallest, keeping the lowest hash ranks."""
    sizes = class_sizes(df, label)
    small, large = min(sizes.values()), max(sizes.values())
    limits = {k: (small if n == large else n) for k, n in sizes.items()}
    return _hash_ranked(df, label, key, seed).filter(F.col("__r") <= _per_class(label, limits)).drop("__r", "__r_total")


def oversample(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Repeat rows until every class has the size of the largest; adds ``copy``."""
    sizes = class_sizes(df, label)
    large = max(sizes.values())
    whole = _per_class(label, {k: large // n for k, n in sizes.items()})
    rest = _per_class(label, {k: large % n for k, n in sizes.items()})
    copies = whole + F.when(F.col("__r") <= rest, 1).otherwise(0)
    ranked = _hash_ranked(df, label, key, seed).withColumn("__copies", copies)
    return _repeat(ranked, key, "__copies", large // min(sizes.values()) + 1).drop("__r", "__r_total")


def smote(df: DataFrame, label: str, key: str, features: Sequence[str], k: int = 3, seed: int = 42, trace: bool = False) -> DataFrame:
    """Add rows between minority rows and their neighbours until classes match.

    Neighbours are exact, among a row's own class only; the neighbour and the position on the
    segment are fixed by a hash.  Original rows come back with ``synthetic`` false.  New rows
    have a NULL key; with ``trace`` they also tell the keys they lie between (``from_key``, ``to_key``) and where
    (``gap``).  All classes go through one plan; keys are unique values of any type.
    """
    features = list(features)
    sizes = class_sizes(df, label)
    large = max(sizes.values(), default=0)
    if any(n == 1 < large for n in sizes.values()):
        raise ValueError("a class needs two rows to interpolate")
    doubles = [F.col(f).cast("double").alias(f) for f in features]
    kind = dict(df.dtypes)[key]
    nothing = F.lit(None).cast(kind)
    more = [nothing.alias("from_key"), nothing.alias("to_key"), F.lit(None).cast("double").alias("gap")] if trace else []
    out = df.select(key, label, *doubles, F.lit(False).alias("synthetic"), *more)
    small = {c: n for c, n in sizes.items() if n < large}
    if not small:
        return out
    numbers = {c: i for i, c in enumerate(sorted(small, key=str))}
    chosen = df.filter(_per_class(label, dict.fromkeys(small, 1)) == 1)
    ranked = _hash_ranked(chosen, label, key, seed).select(F.col(key).alias("key"), F.col(label).alias("label"), F.col("__r").alias("r"), *doubles)
    # classes lie apart in one more dimension, farther than any two rows of a class
    ends = chosen.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(features) for f, n in ((F.min, "a"), (F.max, "b"))]).first()
    apart = 1.0 + 2.0 * math.sqrt(sum((ends[f"b{i}"] - ends[f"a{i}"]) ** 2 for i in range(len(features)) if ends[f"a{i}"] is not None))
    number = _per_class("label", numbers)
    points = ranked.select("key", "label", "r", (number * F.lit(1 << 40) + F.col("r")).alias("id"), F.array(*[F.col(f) for f in features]).alias("point"), (number * F.lit(apart)).alias("far"))
    points = durable(points.withColumn("vector", F.array_append("point", F.col("far"))).drop("far"))
    near = nearest_neighbors(points, points, min(k, max(small.values()) - 1), exclude_same_key=True)
    partners = _per_class("label", {c: min(k, n - 1) for c, n in small.items()})
    each, rest = (_per_class("label", {c: f(large - n, n) for c, n in small.items()}) for f in (floordiv, mod))
    made = points.withColumn("partners", partners).withColumn("copies", each + F.when(F.col("r") <= rest, 1).otherwise(0)).filter("copies > 0")
    made = _repeat(made, "id", "copies", max((large - n) // n for n in small.values()) + 1)
    made = made.withColumn("rank", (F.pmod(F.xxhash64("id", "copy", F.lit(seed + 1)), F.col("partners")) + 1).cast("int")).withColumn("gap", hash_unit(F.xxhash64("id", "copy"), seed + 2))
    partner = points.select(F.col("id").alias("neighbor"), F.col("point").alias("other"), F.col("key").alias("to_key"))
    linked = made.join(near.select(F.col("query").alias("id"), "rank", "neighbor"), ["id", "rank"]).join(partner, "neighbor")
    mixed = F.zip_with("point", "other", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    linked = linked.withColumn("point", F.transform(mixed, lambda p: p["a"] + F.col("gap") * (p["b"] - p["a"])))
    new = linked.select(
        nothing.alias(key),
        F.col("label").alias(label),
        *[F.col("point")[i].alias(f) for i, f in enumerate(features)],
        F.lit(True).alias("synthetic"),
        *([F.col("key").alias("from_key"), "to_key", "gap"] if trace else []),
    )
    return out.unionByName(new)


def _resamplers(label: str, key: str, features: Sequence[str], seed: int, smote_k: int | None) -> dict[str, Callable]:
    def smoted(train: DataFrame) -> DataFrame:
        smallest = min(class_sizes(train, label).values())
        k = smote_k if smote_k is not None else (min(5, smallest - 1) if smallest > 1 else 1)
        return smote(train, label, key, features, k, seed)

    return {
        "SMOTE": smoted,
        "Oversampling": lambda train: oversample(train, label, key, seed),
        "Undersampling": lambda train: undersample(train, label, key, seed),
    }


def _prepare(df: DataFrame, label: str, key: str, features: Sequence[str], folds: int) -> DataFrame:
    if df.isEmpty():
        raise ValueError("no rows")
    picked = df.select(key, F.col(label).cast("int").alias(label), *[F.col(f).cast("double").alias(f) for f in features])
    return durable(stratified_folds(picked, label, key, folds))


def _fit(estimator: Estimator, train: DataFrame, features: Sequence[str]):
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return assembler, estimator.fit(assembler.transform(train))


def cross_validate_resampling(
    df: DataFrame, label: str, key: str, features: Sequence[str], estimator: Estimator, folds: int = 5, seed: int = 42
) -> DataFrame:
    """(resampler, fold, f1, mean_f1) for three resamplers; only training folds are resampled.

    The estimator reads ``features`` and the label column.
    """
    base = _prepare(df, label, key, features, folds)
    resamplers = _resamplers(label, key, features, seed, smote_k=3)

    def one(name: str, f: int) -> float:
        train = durable(resamplers[name](base.filter(F.col("fold") != f).drop("fold")))
        assembler, model = _fit(estimator, train, features)
        scored = model.transform(assembler.transform(base.filter(F.col("fold") == f)))
        return _f1(scored, label, F.col("prediction") == 1)

    runs = [(name, f) for name in resamplers for f in range(folds)]
    scores = dict(zip(runs, run_jobs(df.sparkSession, [partial(one, *run) for run in runs])))
    rows = [(name, f, s, sum(scores[name, g] for g in range(folds)) / folds) for (name, f), s in scores.items()]
    return df.sparkSession.createDataFrame(rows, "resampler string, fold int, f1 double, mean_f1 double")


def _f1(df: DataFrame, label: str, positive) -> float:
    row = df.agg(
        F.count(F.when(positive & (F.col(label) == 1), 1)).alias("tp"),
        F.count(F.when(positive, 1)).alias("pp"),
        F.count(F.when(F.col(label) == 1, 1)).alias("p"),
    ).first()
    return 2 * row["tp"] / (row["pp"] + row["p"]) if row["pp"] + row["p"] else 0.0


def threshold_scores(df: DataFrame, label: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """(threshold, f1) for a fixed list of thresholds, predicting ``score >= threshold``.

    Rows are counted by the number of thresholds they reach; the running sums see one row per
    threshold.
    """
    cuts = sorted(float(t) for t in thresholds)
    reached = F.size(F.filter(F.array(*[F.lit(t) for t in cuts]), lambda t: t <= F.col(score)))
    counts = df.groupBy(reached.alias("i")).agg(
        F.count(F.lit(1)).alias("pp"), F.count(F.when(F.col(label) == 1, 1)).alias("tp")
    )
    ladder = df.sparkSession.createDataFrame([(i, None if i == 0 else cuts[i - 1]) for i in range(len(cuts) + 1)], "i int, threshold double")
    above = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    full = ladder.join(counts, "i", "left").fillna(0, ["pp", "tp"])
    running = full.select(
        "threshold", F.sum("pp").over(above).alias("pp"), F.sum("tp").over(above).alias("tp"), F.sum("tp").over(Window.partitionBy()).alias("p")
    )
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("pp") + F.col("p")), F.lit(0.0))
    return running.filter("threshold IS NOT NULL").select("threshold", f1.alias("f1"))


def cross_validate_threshold(
    df: DataFrame,
    label: str,
    key: str,
    features: Sequence[str],
    estimator: Estimator,
    thresholds: Sequence[float] | None = None,
    folds: int = 5,
    seed: int = 42,
) -> DataFrame:
    """(resampler, fold, threshold, f1, mean_threshold, mean_f1): best F1 per fold (lowest
    threshold on ties)."""
    thresholds = [i / 100 for i in range(100)] if thresholds is None else list(thresholds)
    base = _prepare(df, label, key, features, folds)
    resamplers = _resamplers(label, key, features, seed, smote_k=None)

    def one(name: str, f: int) -> tuple[float, float]:
        train = durable(resamplers[name](base.filter(F.col("fold") != f).drop("fold")))
        assembler, model = _fit(estimator, train, features)
        scored = positive_probability(model.transform(assembler.transform(base.filter(F.col("fold") == f))))
        best = threshold_scores(scored, label, "score", thresholds).orderBy(F.desc("f1"), "threshold").first()
        return best["threshold"], best["f1"]

    runs = [(name, f) for name in resamplers for f in range(folds)]
    found = dict(zip(runs, run_jobs(df.sparkSession, [partial(one, *run) for run in runs])))

    def mean(name: str, which: int) -> float:
        return sum(found[name, g][which] for g in range(folds)) / folds

    rows = [(name, f, t, s, mean(name, 0), mean(name, 1)) for (name, f), (t, s) in found.items()]
    return df.sparkSession.createDataFrame(
        rows, "resampler string, fold int, threshold double, f1 double, mean_threshold double, mean_f1 double"
    )
