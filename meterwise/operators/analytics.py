"""Pivots, distributions, charts' figures and anomaly rules."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators.joins import semi_join_values
from meterwise.operators.clean import nan_to_null
from meterwise.operators.ranking import MOST_SENT, cumulative_counts, quantiles, weighted_cumulative


def category_values(df: DataFrame, column: str, limit: int = 10_000) -> list:
    """Sorted distinct non-null values for a wide layout; too many values is an error."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"column {column!r} has more than {limit} values")
    return sorted(r[0] for r in rows)


def pivot(
    df: DataFrame, rows: str, columns: str, values: Sequence, measure: Column, fill: float | None = None
) -> DataFrame:
    """Wide table over an explicit list of column values."""
    wide = df.groupBy(rows).pivot(columns, list(values)).agg(measure)
    return wide if fill is None else wide.fillna(fill, [str(v) for v in values])


def crosstab(df: DataFrame, a: str, b: str, normalize: str | None = None, keep_null: bool = False) -> DataFrame:
    """Long crosstab (a, b, n, share); ``normalize`` is None, "all", "index" or "columns"."""
    base = df if keep_null else df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    counts = base.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    if normalize is None:
        return counts
    if normalize == "all":
        return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())
    by = {"index": a, "columns": b}[normalize]
    # the crosstab is the reduced table: rows = pairs of category values
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(by)))


def category_share_by_period(df: DataFrame, period: Column, category: str, values: Sequence) -> DataFrame:
    """Share of each category per period, one column per category, 0 where absent."""
    counts = df.groupBy(period.alias("period")).agg(
        F.count(category).alias("__all"),
        *[F.count(F.when(F.col(category) == F.lit(v), 1)).alias(str(v)) for v in values],
    )
    return counts.select("period", *[F.try_divide(F.col(str(v)), F.col("__all")).alias(str(v)) for v in values])


def hierarchy_totals(df: DataFrame, levels: Sequence[str], measure: str) -> DataFrame:
    """Totals of every level of a hierarchy; ``depth`` 0 is the grand total."""
    depth = F.lit(len(levels)) - F.bit_count(F.grouping_id())
    return df.rollup(*levels).agg(F.sum(measure).alias("total"), depth.cast("int").alias("depth"))


def ecdf(df: DataFrame, column: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, value, share of rows at or below the value)."""
    ranks = cumulative_counts(df, column, groups)
    return ranks.select(*groups, "value", ((F.col("below") + F.col("n")) / F.col("total")).alias("ecdf"))


def histogram(df: DataFrame, column: str, bins: int, groups: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over the column's range; the last bin is closed on the right.  NULL and NaN are left out."""
    df = nan_to_null(df.withColumn(column, F.col(column).cast("double")))
    value = F.col(column)
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = span["lo"], span["hi"]
    if lo is None:
        raise ValueError("no values")
    width = (hi - lo) / bins or 1.0
    index = F.least(F.floor((value - lo) / width), F.lit(bins - 1)).cast("int")
    counted = df.filter(value.isNotNull()).groupBy(*groups, index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        *groups, "bin", (lo + F.col("bin") * width).alias("low"), (lo + (F.col("bin") + 1) * width).alias("high"), "n"
    )


def gaussian_kde(df: DataFrame, column: str, points: int = 50, cut: float = 3.0) -> DataFrame:
    """Density on an even grid (Scott bandwidth): the sum of normal kernels over the values.

    Equal values are counted first; each task then adds its kernels to one number per grid
    point, so only ``points`` partial sums leave a task.  NULL and NaN are left out.
    """
    df = nan_to_null(df.select(F.col(column).cast("double").alias(column)))
    value = F.col(column)
    s = df.agg(F.count(value).alias("n"), F.stddev_samp(value).alias("s"), F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    h = s["s"] * s["n"] ** -0.2
    lo, hi = s["lo"] - cut * h, s["hi"] + cut * h
    grid = np.linspace(lo, hi, points)
    factor = 1.0 / (s["n"] * h * math.sqrt(2 * math.pi))
    counts = df.filter(value.isNotNull()).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n"))

    def kernels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(points)
        for pdf in batches:
            gap = (grid[:, None] - pdf["v"].to_numpy()[None, :]) / h
            total += np.exp(-0.5 * gap * gap) @ pdf["n"].to_numpy(dtype=float)
        yield pd.DataFrame({"i": np.arange(points), "x": grid, "s": total})

    parts = counts.mapInPandas(kernels, "i int, x double, s double")
    return parts.groupBy("i").agg(F.first("x").alias("x"), (F.sum("s") * factor).alias("density")).drop("i")


def box_stats(df: DataFrame, column: str, groups: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (last points within 1.5 IQR) and outlier count per group."""
    groups = list(groups)
    base = df.select(*groups, F.col(column).cast("double").alias("v")).dropna()
    q = quantiles(base, "v", [0.25, 0.5, 0.75], groups)
    reach = 1.5 * (F.col("q2") - F.col("q0"))
    inside = F.col("v").between(F.col("q0") - reach, F.col("q2") + reach)
    if q.count() <= MOST_SENT:
        q = F.broadcast(q)
    return (
        base.join(q, groups)
        .groupBy(*groups)
        .agg(
            F.first("q0").alias("q1"),
            F.first("q1").alias("median"),
            F.first("q2").alias("q3"),
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.count(F.when(~inside, 1)).alias("outliers"),
        )
    )


def mean_interval(df: DataFrame, groups: Sequence[str], column: str, z: float = 1.959963984540054) -> DataFrame:
    """Group mean with a 95 % normal interval.  NULL and NaN are left out."""
    df = nan_to_null(df.select(*groups, F.col(column).cast("double").alias(column)))
    g = df.groupBy(*groups).agg(
        F.avg(column).alias("mean"), (z * F.stddev_samp(column) / F.sqrt(F.count(column))).alias("__half")
    )
    return g.select(*groups, "mean", (F.col("mean") - F.col("__half")).alias("low"), (F.col("mean") + F.col("__half")).alias("high"))


def anomalous_days(daily: DataFrame, value: str, width: float = 2.0) -> DataFrame:
    """Days outside mean ± width · sample standard deviation, with both limits."""
    s = daily.agg(F.avg(value).alias("m"), F.stddev_samp(value).alias("s"))
    low = s.select(F.col("m") - width * F.col("s"))
    high = s.select(F.col("m") + width * F.col("s"))
    flagged = daily.withColumn("low", low.scalar()).withColumn("high", high.scalar())
    return flagged.filter((F.col(value) < F.col("low")) | (F.col(value) > F.col("high")))


def tercile_classes(df: DataFrame, site: str, value: str, labels: Sequence[str] = ("low", "medium", "high")) -> DataFrame:
    """Site means classed by their 33 % and 66 % quantiles (inclusive upper edges)."""
    means = df.groupBy(site).agg(F.avg(value).alias("mean"))
    edges = quantiles(means, "mean", [0.33, 0.66])
    m = F.col("mean")
    return means.withColumn(
        "class",
        F.when(m <= edges.select("q0").scalar(), labels[0]).when(m <= edges.select("q1").scalar(), labels[1]).otherwise(labels[2]),
    )


def bayesian_average(df: DataFrame, item: str, rating: str) -> DataFrame:
    """Item mean shrunk to the mean of item means by the mean number of ratings."""
    stats = df.groupBy(item).agg(F.count(rating).alias("n"), F.sum(rating).alias("s"), F.avg(rating).alias("mean"))
    prior = stats.agg(F.avg("n").alias("c"), F.avg("mean").alias("m"))
    c = prior.select("c").scalar()
    cm = prior.select(F.col("c") * F.col("m")).scalar()
    return stats.select(item, "n", "mean", ((cm + F.col("s")) / (c + F.col("n"))).alias("bayesian_avg"))


def frequent_only(df: DataFrame, user: str, item: str, min_user: int, min_item: int) -> DataFrame:
    """Rows of users and items seen more often than the limits, both counted before filtering."""

    def frequent(column: str, limit: int) -> DataFrame:
        return df.groupBy(column).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit).select(column)

    return semi_join_values(semi_join_values(df, user, frequent(user, min_user)), item, frequent(item, min_item))


def top_sums(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """The k largest group sums (ties: smallest group)."""
    return df.groupBy(group).agg(F.sum(value).alias("total")).orderBy(F.desc("total"), group).limit(k)


def only_top_groups(df: DataFrame, group: str, k: int) -> DataFrame:
    """Rows of the k most frequent groups."""
    top = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), group).limit(k)
    return semi_join_values(df, group, top.select(group))


def running_total(df: DataFrame, group: str, value: str) -> DataFrame:
    """Cumulative sum over sorted groups (text or numbers), by the bucketed running sums."""
    weighted = df.filter(F.col(group).isNotNull()).select(F.col(group), F.col(value).alias("total"))
    running = weighted_cumulative(weighted, group, ["total"])
    return running.select(F.col("value").alias(group), "total", (F.col("below_total") + F.col("total")).alias("running"))


def group_apply(df: DataFrame, groups: Sequence[str], **measures: Column) -> DataFrame:
    """Named aggregate expressions per group, the counterpart of a group function."""
    return df.groupBy(*groups).agg(*[c.alias(name) for name, c in measures.items()])
