"""Seasonal forecast per counter: a pooled autoregression rolled forward per series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators.clean import nan_to_null

LAGS = (1, 24, 25, 168)


def _features(df: DataFrame, series: str, order: str, value: str, lags, exogenous) -> DataFrame:
    w = Window.partitionBy(series).orderBy(order)  # one row per hour: calendar bounded
    return df.select(
        series, order, F.col(value).cast("double").alias("__y"),
        *[F.lag(F.col(value).cast("double"), k).over(w).alias(f"lag{k}") for k in lags],
        *exogenous,
    )


def fit_seasonal(df: DataFrame, series: str, order: str, value: str, lags=LAGS, exogenous: list[str] | None = None) -> dict:
    """Ridge-regularised autoregression on seasonal lags (and optional columns), one pass of sums.

    ``df`` has one row per (series, hour) without gaps.
    """
    exogenous = list(exogenous or [])
    table = _features(df, series, order, value, lags, exogenous).dropna()
    names = [f"lag{k}" for k in lags] + exogenous
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(table)
    model = LinearRegression(featuresCol="features", labelCol="__y", regParam=1e-6, solver="normal").fit(assembled)
    error = model.transform(assembled).agg(F.stddev_pop(F.col("__y") - F.col("prediction"))).first()[0]
    return {
        "coefficients": model.coefficients.toArray(), "intercept": model.intercept, "sigma": float(error),
        "lags": list(lags), "exogenous": exogenous,
    }


def forecast(
    model: dict, df: DataFrame, series: str, order: str, value: str, steps: int = 24, z: float = 1.959963984540054,
    future: DataFrame | None = None,
) -> DataFrame:
    """(series, bucket, step, forecast, low, high): the model applied to its own output.

    Each series only contributes its last ``max(lags)`` hours.  ``future`` holds the exogenous
    columns per (series, step) when the model uses them; from the first step that lacks them on, a series is reported with
    NULL forecasts.  Futures of series without a history are left out.
    """
    lags, names = model["lags"], model["exogenous"]
    depth = max(lags)
    tail = df.select(series, F.col(order).alias("__o"), F.col(value).cast("double").alias("__y")).withColumn(
        "__r", F.row_number().over(Window.partitionBy(series).orderBy(F.desc("__o")))
    ).filter(F.col("__r") <= depth)
    beta, intercept, sigma = model["coefficients"], model["intercept"], model["sigma"]
    kind = df.schema[series].dataType.simpleString()
    time_kind = df.schema[order].dataType.simpleString()
    schema = f"`{series}` {kind}, last_bucket {time_kind}, step int, forecast double, low double, high double"

    # impulse weights of the recursion give the variance of each horizon
    psi = np.zeros(steps)
    psi[0] = 1.0
    for h in range(1, steps):
        psi[h] = sum(b * psi[h - k] for b, k in zip(beta, lags) if h >= k)
    width = z * sigma * np.sqrt(np.cumsum(psi**2))

    def roll(pdf: pd.DataFrame, extra: np.ndarray | None) -> pd.DataFrame:
        pdf = pdf.sort_values("__o")
        history = pdf["__y"].tolist()
        if len(history) < depth:
            history = [float(np.mean(history))] * (depth - len(history)) + history
        out = []
        for h in range(steps):
            y = intercept + sum(b * history[-k] for b, k in zip(beta, lags))
            if extra is not None:
                # a step whose columns are not known, and all after it, have no forecast
                y += float(extra[h] @ beta[len(lags) :])
            history.append(y)
            out.append(y)
        centre = np.array(out)
        return pd.DataFrame(
            {
                series: pdf[series].iloc[0], "last_bucket": pdf["__o"].iloc[-1], "step": np.arange(1, steps + 1, dtype="int32"),
                "forecast": centre, "low": centre - width, "high": centre + width,
            }
        )

    if names:
        if future is None:
            raise ValueError("the model needs the future of its exogenous columns")

        def with_future(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left):
                return pd.DataFrame(columns=[series, "last_bucket", "step", "forecast", "low", "high"])
            known = right.set_index("step")[names].astype(float).reindex(range(1, steps + 1)) if len(right) else pd.DataFrame(index=range(steps), columns=names, dtype=float)
            return roll(left, known.to_numpy())

        # fresh column identities: the future may derive from the same table
        ahead = future.select(*[F.col(c).alias(c) for c in (series, "step", *names)])
        rolled = tail.groupBy(series).cogroup(ahead.groupBy(series)).applyInPandas(with_future, schema)
    else:
        rolled = tail.groupBy(series).applyInPandas(lambda pdf: roll(pdf, None), schema)
    bucket = F.col("last_bucket") + F.make_dt_interval(F.lit(0), F.col("step"))
    return nan_to_null(rolled.select(series, bucket.alias("bucket"), "step", "forecast", "low", "high"))
