"""Confusion counts, reports, ranking curves, regression metrics and fold assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators.ranking import row_numbers, weighted_cumulative


def confusion(df: DataFrame, label: str, prediction: str, segments: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*segments, label, prediction).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str, prediction: str) -> float:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double"))).first()[0]


def class_report(df: DataFrame, label: str, prediction: str, segments: Sequence[str] = ()) -> DataFrame:
    """Per class: precision, recall, f1, specificity, geometric mean, IBA and support.

    Everything after the first aggregation works on the confusion counts.  Undefined ratios
    are 0, as in the usual report.
    """
    segments = list(segments)
    # predictions are doubles; both sides are named in the type of the label
    kind = df.schema[label].dataType
    named = F.col(prediction).cast(kind).cast("string")
    cells = confusion(df.select(*segments, F.col(label).cast("string").alias("__y"), named.alias("__p")), "__y", "__p", segments)
    sides = cells.select(
        *segments,
        F.explode(
            F.array(
                F.struct(F.col("__y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), F.when(F.col("__y") == F.col("__p"), F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("__p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
            )
        ).alias("s"),
    ).select(*segments, "s.*")
    sums = sides.groupBy(*segments, "class").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    # one row per class and segment
    total = F.sum("support").over(Window.partitionBy(*segments))
    staged = sums.withColumn("total", total)

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tn = F.col("total") - F.col("support") - F.col("predicted") + F.col("tp")
    rated = (
        staged.withColumn("precision", ratio(F.col("tp"), F.col("predicted")))
        .withColumn("recall", ratio(F.col("tp"), F.col("support")))
        .withColumn("specificity", ratio(tn, F.col("total") - F.col("support")))
        .withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
        .withColumn("geo", F.sqrt(F.col("recall") * F.col("specificity")))
        .withColumn("iba", (1 + 0.1 * (F.col("recall") - F.col("specificity"))) * F.col("recall") * F.col("specificity"))
    )
    return rated.select(*segments, "class", "precision", "recall", "f1", "specificity", "geo", "iba", "support")


def report_averages(report: DataFrame, segments: Sequence[str] = ()) -> DataFrame:
    """Macro and support-weighted means of a class report."""
    measures = ["precision", "recall", "f1", "specificity", "geo", "iba"]
    macro = report.groupBy(*segments).agg(F.lit("macro").alias("average"), *[F.avg(m).alias(m) for m in measures])
    weighted = report.groupBy(*segments).agg(
        F.lit("weighted").alias("average"), *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures]
    )
    return macro.unionByName(weighted)


def score_table(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Counts at every distinct score, descending: (groups, threshold, tp, fp, pos, neg, P, N).

    ``tp`` and ``fp`` count rows scored at or above the threshold; ``pos`` and ``neg`` the rows
    exactly at it.  ``label`` is 0/1.
    """
    groups = list(groups)
    base = df.select(
        *groups,
        (-F.col(score).cast("double")).alias("__s"),
        F.col(label).cast("long").alias("pos"),
        (1 - F.col(label)).cast("long").alias("neg"),
    ).filter("__s IS NOT NULL AND pos IS NOT NULL")
    running = weighted_cumulative(base, "__s", ["pos", "neg"], groups)
    return running.select(
        *groups,
        (-F.col("value")).alias("threshold"),
        (F.col("below_pos") + F.col("pos")).alias("tp"),
        (F.col("below_neg") + F.col("neg")).alias("fp"),
        "pos",
        "neg",
        F.col("total_pos").alias("P"),
        F.col("total_neg").alias("N"),
    )


def roc_curve(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    t = score_table(df, label, score, groups)
    return t.select(*groups, "threshold", F.try_divide(F.col("fp"), F.col("N")).alias("fpr"), F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))


def roc_auc(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area; each score adds its own strip, so no ordered pass is needed."""
    t = score_table(df, label, score, groups)
    strip = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    return t.groupBy(*groups).agg(F.try_divide(F.sum(strip), F.first("P") * F.first("N")).alias("auc"))


def one_vs_rest(df: DataFrame, label: str, scores: str, classes: Sequence) -> DataFrame:
    """Long (class, label, score) from an array column of class scores."""
    entries = F.array(
        *[
            F.struct(F.lit(str(c)).alias("class"), (F.col(label) == F.lit(c)).cast("int").alias("label"), F.col(scores)[i].alias("score"))
            for i, c in enumerate(classes)
        ]
    )
    return df.select(F.inline(entries))


def pr_curve(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, threshold, precision, recall, f1) at every distinct score."""
    t = score_table(df, label, score, groups)
    precision, recall = F.col("tp") / (F.col("tp") + F.col("fp")), F.try_divide(F.col("tp"), F.col("P"))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("P")), F.lit(0.0))
    return t.select(*groups, "threshold", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def pr_auc(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under precision-recall, starting at recall 0 and precision 1."""
    t = score_table(df, label, score, groups)
    here = F.col("tp") / (F.col("tp") + F.col("fp"))
    before_tp, before_all = F.col("tp") - F.col("pos"), F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")
    before = F.when(before_all == 0, 1.0).otherwise(before_tp / F.nullif(before_all, F.lit(0)))
    strip = F.col("pos") * (here + before) / 2
    return t.groupBy(*groups).agg(F.try_divide(F.sum(strip), F.first("P")).alias("auc_pr"))


def best_thresholds(df: DataFrame, label: str, score: str, groups: Sequence[str] = ()) -> DataFrame:
    """Threshold with the best F1 per group (ties: lowest threshold)."""
    curve = pr_curve(df, label, score, groups)
    best = F.min_by(F.struct("threshold", "precision", "recall", "f1"), F.struct(-F.round("f1", 12), F.col("threshold")))
    return curve.groupBy(*groups).agg(best.alias("b")).select(*groups, "b.*")


def apply_thresholds(df: DataFrame, score: str, thresholds: DataFrame, groups: Sequence[str], output: str = "prediction") -> DataFrame:
    """Join segment thresholds back (one row per segment) and predict ``score >= threshold``."""
    t = thresholds.select(*groups, F.col("threshold").alias("__t"))
    return df.join(t, list(groups), "left").withColumn(output, (F.col(score) >= F.col("__t")).cast("int")).drop("__t")


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """r2, mse, rmse and mae in one pass."""
    e = F.col(label) - F.col(prediction)
    row = df.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop(label).alias("v"))
    return row.select((1 - F.col("mse") / F.col("v")).alias("r2"), "mse", F.sqrt("mse").alias("rmse"), "mae")


def side_by_side(df: DataFrame, key: str, label: str, prediction: str) -> DataFrame:
    return df.select(key, F.col(label).alias("truth"), F.col(prediction).alias("predicted"))


# ---- folds ----


def contiguous_folds(df: DataFrame, order: str, tie: str, k: int, output: str = "fold") -> DataFrame:
    """k blocks of consecutive rows; the first ``n mod k`` blocks have one row more."""
    r = row_numbers(df, order, tie, name="__r")
    i, n = F.col("__r") - 1, F.col("__r_total")
    size, rest = F.floor(n / k), n % k
    wide = rest * (size + 1)
    fold = F.when(i < wide, F.floor(i / (size + 1))).otherwise(rest + F.floor((i - wide) / F.greatest(size, F.lit(1))))
    return r.withColumn(output, fold.cast("int")).drop("__r", "__r_total")


def shuffled_folds(df: DataFrame, key: str, k: int, seed: int = 42, output: str = "fold") -> DataFrame:
    """k folds by a hash of the key: no shuffle, the same on every run."""
    return df.withColumn(output, F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(k)).cast("int"))


def time_series_folds(df: DataFrame, order: str, tie: str, k: int, output: str = "fold") -> DataFrame:
    """Expanding folds: 0 is only trained on, fold i is tested after training on all before it.

    Each test block has n // (k + 1) rows.
    """
    r = row_numbers(df, order, tie, name="__r")
    i, n = F.col("__r") - 1, F.col("__r_total")
    size = F.floor(n / (k + 1))
    first = n - size * k
    fold = F.when(i < first, 0).otherwise(1 + F.floor((i - first) / F.greatest(size, F.lit(1))))
    return r.withColumn(output, fold.cast("int")).drop("__r", "__r_total")


def stratified_folds(df: DataFrame, label: str, order: str, k: int, output: str = "fold") -> DataFrame:
    """k folds of consecutive rows within each class, sized as if classes were dealt out in turn.

    ``order`` is a unique number.  Class sizes (one row per class) are read once.
    """
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label).limit(10_001).collect()
    if len(sizes) > 10_000:
        raise ValueError("too many classes")
    ranked = row_numbers(df, order, order, [label], name="__r")
    fold, start = F.lit(None).cast("int"), 0
    for row in sizes:
        end = start + row["n"]
        inner, edge = F.lit(k - 1), 0
        edges = []
        for f in range(k):
            edge += (end - f + k - 1) // k - (start - f + k - 1) // k
            edges.append(edge)
        for f in range(k - 2, -1, -1):
            inner = F.when(F.col("__r") <= edges[f], f).otherwise(inner)
        fold = F.when(F.col(label).eqNullSafe(F.lit(row[label])), inner).otherwise(fold)
        start = end
    return ranked.withColumn(output, fold).drop("__r", "__r_total")
