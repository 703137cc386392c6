"""Statistical tests: sums and ranks on the executors, closed forms on the totals."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwise.functions.normal import normal_log_cdf, normal_quantile
from meterwise.functions.special import chi2_sf, f_sf, norm_sf, t_two_sided
from meterwise.operators.clean import nan_to_null
from meterwise.operators.ranking import cumulative_counts, quantiles, row_numbers

MAX_FACTOR_LEVELS = 1_000


def _known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles c0, c1, ... of the rows that have a number in each: NULL and NaN are left out."""
    return nan_to_null(df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])).dropna()


def pearson_test(df: DataFrame, x: str, y: str) -> dict:
    """Correlation of the complete pairs, its p-value and their number; rows with a NULL or NaN do not count."""
    row = _known(df, [x, y]).agg(F.corr("c0", "c1").alias("r"), F.count(F.lit(1)).alias("n")).first()
    r, n = row["r"], row["n"]
    if r is None or math.isnan(r) or n < 3:
        return {"statistic": None if r is None or math.isnan(r) else r, "p_value": None, "n": n}
    t = r * math.sqrt((n - 2) / max(1e-300, 1 - r * r))
    return {"statistic": r, "p_value": t_two_sided(t, n - 2), "n": n}


def anderson_darling(df: DataFrame, column: str) -> dict:
    """Normality statistic with critical values at 15, 10, 5, 2.5 and 1 %; NULL and NaN are left out."""
    s = _known(df, [column]).agg(F.count("c0").alias("n"), F.avg("c0").alias("m"), F.stddev_samp("c0").alias("s")).first()
    n = s["n"]
    ranks = cumulative_counts(df, column)
    z = (F.col("value") - s["m"]) / s["s"]
    a, c = F.col("below").cast("double"), F.col("n").cast("double")
    low = (F.pow(a + c, 2) - F.pow(a, 2)) * normal_log_cdf(z)
    high = (F.pow(n - a, 2) - F.pow(n - a - c, 2)) * normal_log_cdf(-z)
    total = ranks.agg(F.sum(low + high).alias("t")).first()["t"]
    # fixed values: published critical values for unknown mean and variance
    levels = {15.0: 0.576, 10.0: 0.656, 5.0: 0.787, 2.5: 0.918, 1.0: 1.092}
    shrink = 1 + 4 / n - 25 / n**2
    return {"statistic": -n - total / n, "critical": {k: v / shrink for k, v in levels.items()}, "n": n}


def qq_points(df: DataFrame, column: str, key: str) -> DataFrame:
    """(key, value, theoretical): each row's normal order-statistic median."""
    base = df.select(F.col(key), F.col(column).cast("double").alias("value")).dropna()
    ranked = row_numbers(base, "value", key, name="i")
    i, n = F.col("i").cast("double"), F.col("i_total").cast("double")
    last = F.pow(F.lit(0.5), 1 / n)
    position = F.when(i == n, last).when(i == 1, 1 - last).otherwise((i - 0.3175) / (n + 0.365))
    return ranked.select(key, "value", normal_quantile(position).alias("theoretical"))


def qq_fit(df: DataFrame, column: str, key: str, band: float = 0.15) -> DataFrame:
    """Slope, intercept and r of the normal plot; share of rows within ``band`` standard
    deviations of the line, and the theoretical range those rows span."""
    points = qq_points(df, column, key)
    line = points.agg(
        F.regr_slope("value", "theoretical").alias("slope"),
        F.regr_intercept("value", "theoretical").alias("intercept"),
        F.corr("value", "theoretical").alias("r"),
        F.stddev_pop("value").alias("s"),
    ).first()
    near = F.abs(F.col("value") - (line["slope"] * F.col("theoretical") + line["intercept"])) <= band * line["s"]
    return points.agg(
        F.lit(line["slope"]).alias("slope"),
        F.lit(line["intercept"]).alias("intercept"),
        F.lit(line["r"]).alias("r"),
        F.avg(near.cast("double")).alias("share_near"),
        F.min(F.when(near, F.col("theoretical"))).alias("near_from"),
        F.max(F.when(near, F.col("theoretical"))).alias("near_to"),
    )


def one_way_f(df: DataFrame, group: str, value: str) -> dict:
    """One-way analysis of variance; the groups' moments are added up on the executors, however many there are.

    Rows with a missing group or value (NULL or NaN) are left out."""
    rows = nan_to_null(df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))).filter("g IS NOT NULL AND v IS NOT NULL")
    grand = rows.agg(F.avg("v")).first()[0]
    size = F.count(F.lit(1))
    groups = rows.groupBy("g").agg(
        size.alias("n"), (F.var_pop("v") * size).alias("ss"), (size * F.pow(F.avg("v") - F.lit(grand), 2)).alias("sb")
    )
    s = groups.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("ss").alias("inside"), F.sum("sb").alias("between")).first()
    k, n = s["k"], s["n"]
    statistic = (s["between"] / (k - 1)) / (s["inside"] / (n - k))
    return {"statistic": statistic, "p_value": f_sf(statistic, k - 1, n - k), "groups": k, "n": n}


def levene(df: DataFrame, group: str, value: str) -> dict:
    """Equality of variances by deviations from exact group medians."""
    base = df.select(group, F.col(value).cast("double").alias("v")).dropna()
    medians = quantiles(base, "v", [0.5], [group])
    deviations = base.join(medians, group).select(
        group, F.abs(F.col("v") - F.col("q0")).alias("z")
    )
    return one_way_f(deviations, group, "z")


def kruskal_wallis(df: DataFrame, group: str, value: str) -> dict:
    """Rank test with tie correction; average ranks come from the distinct-value counts."""
    base = nan_to_null(df.select(group, F.col(value).cast("double").alias("v"))).dropna()
    ranks = cumulative_counts(base, "v").withColumn("rank", F.col("below") + (F.col("n") + 1) / 2)
    ties = ranks.agg(F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("t"), F.max("total").alias("n")).first()
    cells = base.groupBy(group, "v").agg(F.count(F.lit(1)).alias("c"))
    ranked = cells.join(ranks.select(F.col("value").alias("v"), "rank"), "v")
    sums = ranked.groupBy(group).agg(F.sum(F.col("c") * F.col("rank")).alias("r"), F.sum("c").alias("n"))
    total = sums.agg(F.sum(F.col("r") * F.col("r") / F.col("n")).alias("s"), F.count(F.lit(1)).alias("k")).first()
    n, k = ties["n"], total["k"]
    h = 12 / (n * (n + 1)) * total["s"] - 3 * (n + 1)
    h /= 1 - ties["t"] / (float(n) ** 3 - n)
    return {"statistic": h, "p_value": chi2_sf(h, k - 1), "groups": k, "n": n}


def dagostino(df: DataFrame, column: str) -> dict:
    """Omnibus normality test from population skewness and kurtosis; NULL and NaN are left out."""
    row = _known(df, [column]).agg(F.count("c0").alias("n"), F.skewness("c0").alias("g"), F.kurtosis("c0").alias("k")).first()
    n, g1, b2 = row["n"], row["g"], row["k"] + 3
    y = g1 * math.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (beta - 1))
    z1 = math.asinh(y / math.sqrt(2 / (w2 - 1))) / math.sqrt(0.5 * math.log(w2))
    x = (b2 - 3 * (n - 1) / (n + 1)) / math.sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5)))
    q = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / q * (2 / q + math.sqrt(1 + 4 / q**2))
    inner = (1 - 2 / a) / (1 + x * math.sqrt(2 / (a - 4)))
    z2 = ((1 - 2 / (9 * a)) - math.copysign(abs(inner) ** (1 / 3), inner)) / math.sqrt(2 / (9 * a))
    k2 = z1 * z1 + z2 * z2
    return {"statistic": k2, "p_value": chi2_sf(k2, 2), "n": n, "z_skew": z1, "z_kurtosis": z2}


def chi2_independence(df: DataFrame, a: str, b: str, correction: bool = True) -> dict:
    """χ² test of a crosstab, with Yates' correction on 2 × 2; cells with no rows count."""
    pairs = df.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    cells = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).cast("double").alias("o"))
    left = cells.groupBy("x").agg(F.sum("o").alias("nx"))
    right = cells.groupBy("y").agg(F.sum("o").alias("ny"))
    n, rows, columns = cells.agg(F.sum("o"), F.count_distinct("x"), F.count_distinct("y")).first()
    free = (rows - 1) * (columns - 1)
    if not free:
        return {"statistic": 0.0, "p_value": 1.0, "dof": 0, "n": int(n or 0)}
    expected = F.col("nx") * F.col("ny") / F.lit(n)
    yates = 0.5 if correction and free == 1 else 0.0
    gap = F.greatest(F.abs(F.col("o") - expected) - F.lit(yates), F.lit(0.0))
    # a cell without rows adds its expected count: all expected counts together are n
    met = cells.join(left, "x").join(right, "y")
    seen, covered, count = met.agg(F.sum(gap * gap / expected), F.sum(expected), F.count(F.lit(1))).first()
    statistic = seen + (n - covered)
    if yates and count < 4:
        # of a 2 x 2 table with an empty cell: the correction holds there too
        statistic = seen + _empty_cells(met, left, right, n, yates)
    return {"statistic": statistic, "p_value": chi2_sf(statistic, free), "dof": free, "n": int(n)}


def _empty_cells(met: DataFrame, left: DataFrame, right: DataFrame, n: float, yates: float) -> float:
    """Corrected terms of the empty cells of a 2 x 2 table."""
    seen = {(r["x"], r["y"]) for r in met.select("x", "y").collect()}
    columns = right.collect()
    empty = [r["nx"] * c["ny"] / n for r in left.collect() for c in columns if (r["x"], c["y"]) not in seen]
    return sum(max(e - yates, 0.0) ** 2 / e for e in empty)


def cramers_v(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Association of every modality (one against the rest) with the target.

    All modalities are counted in one pass; modalities that never or always occur are left out.
    Output (column, modality, statistic, p_value, v, significant).
    """
    base = df.filter(F.col(target).isNotNull()).select(
        F.col(target).cast("string").alias("__t"), *[F.col(c).cast("string").alias(c) for c in columns]
    )
    cells = base.unpivot(["__t"], list(columns), "column", "modality").groupBy("column", "modality", "__t").agg(
        F.count(F.lit(1)).alias("o")
    )
    # rows below are (column, modality, target value) cells
    by_column = cells.groupBy("column", "__t").agg(F.sum("o").alias("t_n"))
    grid = cells.filter("modality IS NOT NULL").select("column", "modality").distinct().join(by_column, "column")
    full = grid.join(cells, ["column", "modality", "__t"], "left").fillna(0, ["o"])
    one = Window.partitionBy("column", "modality")
    m, n = F.sum("o").over(one), F.sum("t_n").over(one)
    levels = F.count(F.lit(1)).over(one)
    staged = full.select("column", "modality", "o", "t_n", m.alias("m"), n.alias("n"), levels.alias("levels"))
    with_it, without = F.col("t_n") * F.col("m") / F.col("n"), F.col("t_n") * (F.col("n") - F.col("m")) / F.col("n")
    gap = F.abs(F.col("o") - with_it)
    gap = F.when(F.col("levels") == 2, F.greatest(gap - 0.5, F.lit(0.0))).otherwise(gap)
    stats = (
        staged.filter("m < n")
        .groupBy("column", "modality")
        .agg(
            F.sum(gap * gap / with_it + gap * gap / without).alias("statistic"),
            F.first("n").alias("n"),
            (F.first("levels") - 1).alias("dof"),
        )
    )

    @F.pandas_udf("double")
    def tail(x: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([chi2_sf(a, b) if b else 1.0 for a, b in zip(x, dof)])

    scored = stats.withColumn("p_value", tail("statistic", "dof")).withColumn("v", F.sqrt(F.col("statistic") / F.col("n")))
    return scored.select(
        "column", "modality", "statistic", "p_value", "v", ((F.col("p_value") < 0.05) & (F.col("v") > 0.1)).alias("significant")
    )


def anova(df: DataFrame, factors: Sequence[str], target: str) -> dict:
    """Sequential (type I) ANOVA with treatment coding, and the R² of the full model.

    Spark reduces the rows to factor combinations; the products of the level indicators are
    summed on the executors and only the levels × levels matrix reaches the driver.
    """
    factors = list(factors)
    base = df.select(*[F.col(f).cast("string").alias(f) for f in factors], F.col(target).cast("double").alias("__y")).dropna()
    levels: dict[str, list[str]] = {}
    for f in factors:
        found = [r[0] for r in base.select(f).distinct().limit(MAX_FACTOR_LEVELS + 1).collect()]
        if len(found) > MAX_FACTOR_LEVELS:
            raise ValueError(f"{f!r} has more than {MAX_FACTOR_LEVELS} levels")
        levels[f] = sorted(found)
    offsets, size = {}, 1
    for f in factors:
        offsets[f] = size
        size += len(levels[f]) - 1
    index = {f: {v: i for i, v in enumerate(levels[f])} for f in factors}
    cells = base.groupBy(*factors).agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__y").alias("__s"), F.sum(F.col("__y") * F.col("__y")).alias("__q")
    )

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = np.zeros((size + 1, size + 1))
        for pdf in batches:
            n, s = pdf["__n"].to_numpy(float), pdf["__s"].to_numpy(float)
            active = [(np.zeros(len(pdf), dtype=int), np.ones(len(pdf), dtype=bool))]
            for f in factors:
                code = pdf[f].map(index[f]).to_numpy()
                active.append((offsets[f] + code - 1, code > 0))
            for a, ua in active:
                np.add.at(m, (a[ua], size), s[ua])
                for b, ub in active:
                    both = ua & ub
                    np.add.at(m, (a[both], b[both]), n[both])
            m[size, size] += pdf["__q"].sum()
        i, j = np.nonzero(m)
        yield pd.DataFrame({"i": i, "j": j, "s": m[i, j]})

    total = np.zeros((size + 1, size + 1))
    for r in cells.mapInPandas(partial, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        total[r["i"], r["j"]] = r["s"]
    n, yy = total[0, 0], total[size, size]

    def explained(columns: int) -> float:
        xtx, xty = total[:columns, :columns], total[:columns, size]
        return float(xty @ np.linalg.lstsq(xtx, xty, rcond=None)[0])

    steps = [explained(1)]
    for f in factors:
        steps.append(explained(offsets[f] + len(levels[f]) - 1))
    residual = yy - steps[-1]
    free = n - size
    table = []
    for i, f in enumerate(factors):
        ss, dof = steps[i + 1] - steps[i], len(levels[f]) - 1
        statistic = (ss / dof) / (residual / free)
        table.append((f, float(ss), float(dof), float(statistic), f_sf(statistic, dof, free)))
    table.append(("Residual", float(residual), float(free), None, None))
    frame = df.sparkSession.createDataFrame(table, "term string, sum_sq double, df double, f double, p_value double")
    return {"table": frame, "r2": float(1 - residual / (yy - steps[0])), "n": int(n)}


def ols_summary(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(term, coef, se, t, p_value, r2) of a least-squares fit; rows with a NULL or NaN are left out."""
    from meterwise.operators.selection import gram_matrix

    columns = [*features, target]
    known = _known(df, columns)
    centres = known.agg(*[F.avg(c).alias(c) for c in known.columns]).first()
    centred = known.select(*[(F.col(c) - F.lit(centres[c])).alias(c) for c in known.columns])
    sums = gram_matrix(centred, centred.columns)
    p = len(features)
    n, xtx, xty, yy = sums[0, 0], sums[1 : p + 1, 1 : p + 1], sums[1 : p + 1, -1], sums[-1, -1]
    inverse = np.linalg.pinv(xtx)
    beta = inverse @ xty
    sse = yy - beta @ xty
    free = n - p - 1
    variance = sse / free
    m = np.array([centres[i] for i in range(p)], dtype=float)
    intercept = centres[p] - beta @ m
    errors = [math.sqrt(variance * (1 / n + m @ inverse @ m))] + [math.sqrt(variance * inverse[i, i]) for i in range(p)]
    rows = []
    for term, b, e in zip(["Intercept", *features], [intercept, *beta], errors):
        t = float(b / e)
        rows.append((term, float(b), float(e), t, t_two_sided(t, free), float(1 - sse / yy)))
    return df.sparkSession.createDataFrame(rows, "term string, coef double, se double, t double, p_value double, r2 double")


def logit_report(df: DataFrame, features: Sequence[str], target: str, adjustments: dict | None = None) -> dict:
    """Binomial regression report and odds ratios.

    ``adjustments``: {feature: {"type": "normalize", "range": (min, max)}} divides the
    coefficient by the range, {"type": "inverse"} replaces it by -1/exp(coefficient); other
    names and types are ignored.
    """
    assembled = VectorAssembler(inputCols=list(features), outputCol="__x").transform(
        df.select(*features, F.col(target).cast("double").alias("__y")).dropna()
    )
    model = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="__x", labelCol="__y", maxIter=50).fit(
        assembled.select("__x", "__y")
    )
    summary = model.summary
    terms = [*features, "Intercept"]
    coefs = [*model.coefficients.toArray().tolist(), model.intercept]
    rows = []
    for term, b, se, z, p in zip(
        terms, coefs, summary.coefficientStandardErrors, summary.tValues, summary.pValues
    ):
        rows.append((term, float(b), float(se), float(z), float(p)))
    odds = []
    for term, b in zip(terms, coefs):
        rule = (adjustments or {}).get(term, {})
        if rule.get("type") == "normalize":
            low, high = rule["range"]
            b = b / (high - low)
        elif rule.get("type") == "inverse":
            b = -1 / math.exp(b)
        odds.append((term, float(math.exp(b))))
    spark = df.sparkSession
    return {
        "report": spark.createDataFrame(rows, "term string, coef double, se double, z double, p_value double"),
        "odds": spark.createDataFrame(odds, "term string, odds_ratio double"),
        "aic": summary.aic,
        "deviance": summary.deviance,
        "null_deviance": summary.nullDeviance,
    }


def standardised_residuals(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Add ``residual`` and ``std_residual`` (sample standard deviation of the residuals)."""
    r = df.withColumn("residual", F.col(truth) - F.col(prediction))
    s = r.agg(F.avg("residual").alias("m"), F.stddev_samp("residual").alias("s"))
    return r.withColumn("std_residual", (F.col("residual") - s.select("m").scalar()) / s.select("s").scalar())


def normal_p_value(z: float) -> float:
    return 2 * norm_sf(abs(z))


def result_table(df: DataFrame, name: str, result: dict) -> DataFrame:
    """One-row table (test, statistic, p_value, n) of a test result."""
    row = (name, float(result["statistic"]), None if result.get("p_value") is None else float(result["p_value"]), int(result["n"]))
    return df.sparkSession.createDataFrame([row], "test string, statistic double, p_value double, n bigint")
