"""Resampling, lags, decomposition and autocorrelation.

Readings are first aggregated to one row per (series, bucket).  Lags, rolling means and the like number the
rows of a series exactly (``ranking.row_numbers``) and cut it into blocks of consecutive rows; each block also
gets the rows before (and behind) it that its windows reach.  No task sees a whole series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.functions.calendar import DEFAULT_ZONE, as_instant, hour_bucket, hour_period, wall_clock, week_ending_sunday
from meterwise.operators.joins import null_safe_join
from meterwise.operators.ranking import row_numbers


def _by(series: Sequence[str], order: str):
    return Window.partitionBy(*series).orderBy(order)


def _fill_gaps(sums: DataFrame, series: list[str], bucket: str, value: str, step: str) -> DataFrame:
    """Add the missing buckets between observed ones, with a NULL value.

    Each observed row spans the buckets up to the next one, so the readings are scanned once
    and nothing is joined.
    """
    following = F.lead(bucket).over(_by(series, bucket))
    last = F.coalesce(following - F.expr(step), F.col(bucket))
    spans = sums.withColumn("__last", last.cast(sums.schema[bucket].dataType))
    filled = spans.withColumn("__b", F.explode(F.sequence(F.col(bucket), F.col("__last"), F.expr(step))))
    return filled.select(*series, F.col("__b").alias(bucket), F.when(F.col("__b") == F.col(bucket), F.col(value)).alias(value))


def resample_hours(df: DataFrame, instant: str, value: str, series: Sequence[str] = ()) -> DataFrame:
    """Hourly sums on instants, gaps filled by 0."""
    series = list(series)
    sums = df.groupBy(*series, hour_bucket(as_instant(df, instant)).alias("bucket")).agg(F.sum(value).alias(value))
    sums = sums.filter("bucket IS NOT NULL")
    return _fill_gaps(sums, series, "bucket", value, "INTERVAL 1 HOUR").fillna(0, [value])


def resample_days(
    df: DataFrame, instant: str, value: str, series: Sequence[str] = (), zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Sums per local day, gaps filled by 0."""
    series = list(series)
    day = F.to_date(wall_clock(as_instant(df, instant), zone))
    sums = df.groupBy(*series, day.alias("bucket")).agg(F.sum(value).alias(value)).filter("bucket IS NOT NULL")
    return _fill_gaps(sums, series, "bucket", value, "INTERVAL 1 DAY").fillna(0, [value])


def resample_weeks(
    df: DataFrame, instant: str, value: str, series: Sequence[str] = (), zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Mean per week, labelled by the Sunday that ends it; empty weeks are NULL."""
    series = list(series)
    week = week_ending_sunday(F.to_date(wall_clock(as_instant(df, instant), zone)))
    means = df.groupBy(*series, week.alias("bucket")).agg(F.avg(value).alias(value)).filter("bucket IS NOT NULL")
    return _fill_gaps(means, series, "bucket", value, "INTERVAL 7 DAY")


def period_sums(
    df: DataFrame, instant: str, values: Sequence[str], series: Sequence[str] = (), zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Sums per wall-clock hour, observed hours only."""
    period = hour_period(as_instant(df, instant), zone)
    return df.groupBy(*series, period.alias("period")).agg(*[F.sum(v).alias(v) for v in values])


BLOCK_ROWS = 8_192


def _blocks(df: DataFrame, order: str, series: Sequence[str], before: int, after: int = 0) -> DataFrame:
    """Rows with their position (``__i`` from 0), in their block and as neighbours in the blocks next to it.

    ``__own`` marks a row in its own block; windows over (series, ``__block``) by ``__i`` see at least ``before``
    rows before and ``after`` rows behind every own row, as far as the series has them."""
    numbered = row_numbers(df, order, order, series, "__i").withColumn("__i", F.col("__i") - 1).withColumnRenamed("__i_total", "__n")
    return _cut(numbered, before, after)


def _cut(numbered: DataFrame, before: int, after: int = 0) -> DataFrame:
    """Blocks, as in ``_blocks``, of rows that have their position ``__i`` from 0."""
    size = max(BLOCK_ROWS, before, after)
    own, at = F.floor(F.col("__i") / size), F.col("__i") % size
    also = F.array(F.when(at >= size - before, own + 1), F.when(at < after, own - 1))
    placed = numbered.withColumn("__home", own).withColumn("__block", F.explode(F.array_compact(F.concat(F.array(own), also))))
    return placed.withColumn("__own", F.col("__block") == F.col("__home")).drop("__home")


def _in_block(series: Sequence[str]):
    return Window.partitionBy(*series, "__block").orderBy("__i")


def _owned(blocks: DataFrame) -> DataFrame:
    return blocks.filter("__own").drop("__own", "__block", "__i", "__n")


def lagged(
    df: DataFrame, value: str, order: str, k: int = 1, series: Sequence[str] = (), name: str = "lag1", resampled: bool = False
) -> DataFrame:
    """Add the value ``k`` rows earlier in the series.

    ``resampled`` tells that a series has at most one row per hour, day or week, so that it is short: it is not numbered
    and cut into blocks, and windows over the same series follow each other without a shuffle."""
    if resampled:
        return df.withColumn(name, F.lag(value, k).over(_by(series, order)))
    blocks = _blocks(df, order, series, k)
    return _owned(blocks.withColumn(name, F.lag(value, k).over(_in_block(series))))


def seasonal_difference(
    df: DataFrame, value: str, order: str, lags: Sequence[int], series: Sequence[str] = ()
) -> DataFrame:
    """Chained differences over observed rows; rows without a value or a full history are dropped."""
    reach = sum(lags)
    out = _blocks(df.filter(F.col(value).isNotNull()), order, series, reach)
    for k in lags:
        out = out.withColumn(value, F.col(value) - F.lag(value, k).over(_in_block(series)))
    return _owned(out.filter(F.col("__i") >= reach))


def rolling_mean(
    df: DataFrame, value: str, order: str, window: int, series: Sequence[str] = (), name: str = "rolling", resampled: bool = False
) -> DataFrame:
    """Mean of the last ``window`` rows; NULL until the window is full or where it has a gap. ``resampled``: see ``lagged``."""
    blocks = df if resampled else _blocks(df, order, series, window - 1)
    w = (_by(series, order) if resampled else _in_block(series)).rowsBetween(-(window - 1), 0)
    rolled = blocks.withColumn(name, F.when(F.count(value).over(w) == window, F.avg(value).over(w)))
    return rolled if resampled else _owned(rolled)


def decompose(df: DataFrame, value: str, order: str, period: int = 24, series: Sequence[str] = ()) -> DataFrame:
    """Additive trend, seasonal and residual parts of an evenly spaced series.

    Trend is the centred average over one period (half weights at both ends for an even
    period); seasonal is the mean detrended value per phase, centred to sum 0.
    """
    series = list(series)
    half = period // 2
    blocks = _blocks(df, order, series, half, half)
    w = _in_block(series)
    full = w.rowsBetween(-half, half)
    if period % 2 == 0:
        middle = F.sum(value).over(w.rowsBetween(-(half - 1), half - 1))
        ends = 0.5 * (F.lag(value, half).over(w) + F.lead(value, half).over(w))
        trend = (middle + ends) / period
    else:
        trend = F.avg(value).over(full)
    complete = F.count(value).over(full) == 2 * half + 1
    staged = blocks.withColumn("trend", F.when(complete, trend)).withColumn("phase", F.col("__i") % period)
    staged = _owned(staged).withColumn("__detrended", F.col(value) - F.col("trend"))
    means = staged.groupBy(*series, "phase").agg(F.avg("__detrended").alias("__m"))
    # ``period`` rows per series
    centred = means.select(*series, "phase", (F.col("__m") - F.avg("__m").over(Window.partitionBy(*series))).alias("seasonal"))
    joined = null_safe_join(staged, F.broadcast(centred) if not series else centred, [*series, "phase"], "left", never_null=["phase"])
    return joined.withColumn("resid", F.col("__detrended") - F.col("seasonal")).drop("__detrended")


def acf(df: DataFrame, value: str, order: str, max_lag: int, series: Sequence[str] = ()) -> DataFrame:
    """Autocorrelation to ``max_lag`` with the white-noise band and the Bartlett standard error.

    Lagged products are added up block by block (a block also gets the ``max_lag`` rows before it) and summed;
    output (series, lag, acf, band, bartlett_se).
    """
    series = list(series)
    base = df.select(*series, F.col(order).alias("__o"), F.col(value).cast("double").alias("__y"))
    centre = base.groupBy(*series).agg(F.avg("__y").alias("__m"))
    centred = null_safe_join(base, centre, series, "left").withColumn("__y", F.col("__y") - F.col("__m")).drop("__m")
    blocks = _blocks(centred, "__o", series, max_lag)
    keys = [*series, "__block"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.select(*keys).schema)

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__i")
        y, own = pdf["__y"].to_numpy(), pdf["__own"].to_numpy()
        start = int(np.argmax(own)) if own.any() else len(y)
        lags = np.arange(min(max_lag, int(pdf["__n"].iloc[0]) - 1) + 1)
        sums = [float(y[max(start, k) :] @ y[max(start, k) - k : len(y) - k]) if k < len(y) else 0.0 for k in lags]
        out = pd.DataFrame({"lag": lags, "__s": sums, "__n": pdf["__n"].iloc[0]})
        for key in reversed(keys):
            out.insert(0, key, pdf[key].iloc[0])
        return out

    parts = blocks.groupBy(*keys).applyInPandas(products, f"{fields}, lag int, __s double, __n long")
    sums = parts.groupBy(*series, "lag").agg(F.sum("__s").alias("__s"), F.max("__n").alias("__n"))
    by_lag = Window.partitionBy(*series).orderBy("lag")  # max_lag + 1 rows per series
    total = F.first("__s").over(by_lag.rowsBetween(Window.unboundedPreceding, 0))
    r = sums.select(*series, "lag", "__n", F.when(total != 0, F.col("__s") / total).otherwise(F.lit(math.nan)).alias("acf"))
    before = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(by_lag.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    se = F.when(F.col("lag") == 0, 0.0).otherwise(F.sqrt((1 + 2 * before) / F.col("__n")))
    return r.select(*series, "lag", "acf", (1.96 / F.sqrt("__n")).alias("band"), se.alias("bartlett_se"))


def pacf(df: DataFrame, value: str, order: str, max_lag: int, series: Sequence[str] = ()) -> DataFrame:
    """Partial autocorrelation by the Levinson-Durbin recursion on the autocorrelations."""
    series = list(series)
    r = acf(df, value, order, max_lag, series)
    keys = series or ["__all"]
    if not series:
        r = r.withColumn("__all", F.lit(0))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in r.select(*keys).schema)

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        rho = pdf.sort_values("lag")["acf"].to_numpy()
        result, phi, error = [1.0], np.zeros(0), 1.0
        for k in range(1, len(rho)):
            reflect = (rho[k] - phi @ rho[k - 1 : 0 : -1]) / error if k > 1 else rho[1]
            phi = np.append(phi - reflect * phi[::-1], reflect)
            error *= 1 - reflect**2
            result.append(float(reflect))
        out = pd.DataFrame({"lag": range(len(rho)), "pacf": result})
        for key in reversed(keys):
            out.insert(0, key, pdf[key].iloc[0])
        return out

    result = r.groupBy(*keys).applyInPandas(per_series, f"{fields}, lag int, pacf double")
    return result if series else result.drop("__all")


def adf_test(df: DataFrame, value: str, order: str, max_lag: int | None = None) -> dict:
    """Augmented Dickey-Fuller test (constant; lag count by AIC on a common sample).

    Lagged products are summed by Spark; only the (lags+2)² sums reach the driver.
    """
    from meterwise.functions.special import norm_sf
    from meterwise.operators.selection import gram_matrix

    n = df.count()
    top = min(max_lag if max_lag is not None else math.ceil(12 * (n / 100) ** 0.25), max(0, n // 2 - 2))
    # block by block: an own row sees the top + 1 rows before it
    w = _in_block(())
    staged = _blocks(df.select(order, F.col(value).cast("double").alias("y")), order, (), top + 1).withColumn("level", F.lag("y", 1).over(w))
    staged = staged.withColumn("dy", F.col("y") - F.col("level"))
    lagged = [f"d{k}" for k in range(1, top + 1)]
    staged = staged.select("*", *[F.lag("dy", k).over(w).alias(f"d{k}") for k in range(1, top + 1)]).filter("__own")
    staged = staged.select("dy", "level", order, *lagged)

    def fit(k: int, sums: np.ndarray):
        # column order of the sums: 1, level, d1..dtop, dy
        use = list(range(k + 2))
        xtx, xty = sums[np.ix_(use, use)], sums[use, -1]
        rows = sums[0, 0]
        beta = np.linalg.solve(xtx, xty)
        sse = sums[-1, -1] - beta @ xty
        return rows, beta, sse, xtx

    # centring keeps the normal equations well conditioned; the constant absorbs the shift
    centre = staged.agg(F.avg("level")).first()[0]
    shifted = staged.withColumn("level", F.col("level") - F.lit(centre))
    common = gram_matrix(shifted.dropna(), ["level", *lagged, "dy"])
    scores = []
    for k in range(top + 1):
        rows, _, sse, _ = fit(k, common)
        scores.append((rows * math.log(sse / rows) + 2 * (k + 2), k))
    best = min(scores)[1]
    own = gram_matrix(shifted.select("level", *lagged[:best], "dy").dropna(), ["level", *lagged[:best], "dy"])
    rows, beta, sse, xtx = fit(best, own)
    variance = sse / (rows - best - 2)
    tau = float(beta[1] / math.sqrt(variance * np.linalg.inv(xtx)[1, 1]))
    # fixed values: published response-surface coefficients for one series with a constant
    if tau <= -1.61:
        z = 2.1659 + 1.4412 * tau + 0.038269 * tau**2
    else:
        z = 1.7339 + 0.93202 * tau - 0.12745 * tau**2 - 0.010368 * tau**3
    critical = {
        "1%": -3.43035 - 6.5393 / rows - 16.786 / rows**2 - 79.433 / rows**3,
        "5%": -2.86154 - 2.8903 / rows - 4.234 / rows**2 - 40.040 / rows**3,
        "10%": -2.56677 - 1.5384 / rows - 2.809 / rows**2,
    }
    return {"statistic": tau, "p_value": norm_sf(-z), "lags": best, "rows": int(rows), "critical": critical}


def _split(df: DataFrame, order: str, test_share: float, series: Sequence[str]) -> tuple[DataFrame, Column]:
    """Rows with ``__i``, ``__i_total`` and ``is_test``, and the number of training rows of a row's series."""
    numbered = row_numbers(df, order, order, series, "__i")
    limit = F.col("__i_total") - F.floor(F.col("__i_total") * F.lit(test_share))
    return numbered.withColumn("is_test", F.col("__i") > limit), limit


def temporal_split(df: DataFrame, order: str, test_share: float = 0.1, series: Sequence[str] = ()) -> DataFrame:
    """Add ``is_test``: the last ``floor(share · rows)`` rows of each aggregated series."""
    return _split(df, order, test_share, series)[0].drop("__i", "__i_total")


def supervised_table(
    df: DataFrame,
    value: str,
    order: str,
    series: Sequence[str] = (),
    window: int = 24,
    test_share: float = 0.1,
    include_current: bool = False,
) -> DataFrame:
    """Lag-1 and rolling-mean features built separately on the train and the test part.

    The rolling mean ends one row before the target unless ``include_current`` is set, which
    lets the target into its own feature.
    """
    parts = [*series, "is_test"]
    # positions within both parts follow from those in the series: rows are numbered once
    split, first_test = _split(df, order, test_share, series)
    place = F.col("__i") - 1 - F.when(F.col("is_test"), first_test).otherwise(F.lit(0))
    size = F.when(F.col("is_test"), F.col("__i_total") - first_test).otherwise(first_test)
    split = _cut(split.withColumns({"__i": place, "__n": size}).drop("__i_total"), window)
    w = _in_block(parts)
    frame = w.rowsBetween(-(window - 1), 0) if include_current else w.rowsBetween(-window, -1)
    earlier = F.lag(value, 1).over(w)
    mean = F.when(F.count(value).over(frame) == window, F.avg(value).over(frame))
    return _owned(split.withColumn(f"{value}_lag1", earlier).withColumn(f"{value}_MA{window}", mean)).dropna()


def seasonal_profile(df: DataFrame, instant: str, value: str, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Mean value per season and local hour, one column per season."""
    from meterwise.functions.calendar import season

    local = wall_clock(as_instant(df, instant), zone)
    staged = df.select(F.hour(local).alias("hour"), season(F.month(local)).alias("season"), value)
    return staged.groupBy("hour").pivot("season", ["winter", "spring", "summer", "autumn"]).agg(F.avg(value))
