"""Differenced seasonal models with autoregressive and moving-average parts, per series.

Estimation is the two-stage regression of Hannan and Rissanen. A long autoregression of the differenced series gives
residuals; the differenced value is then regressed on its own lags and on lags of those residuals. Both regressions
need sums of products only. A series is cut into blocks that also hold the rows before them that lags reach; a block is
one row with its values as an array, so sums are taken block by block and added up by Spark, and no task sees a whole
series. Any number of series is fitted at once; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.operators.clean import nan_to_null
from meterwise.operators.joins import null_safe_join
from meterwise.operators.timeseries import BLOCK_ROWS, _blocks
from meterwise.session import durable


#: blocks of one series that meet its coefficients in one task
BLOCKS_JOINED = 256


@dataclass(frozen=True)
class Orders:
    """(p, d, q) and seasonal (P, D, Q) orders; the coefficients of crossed lags (season + 1, ...) are free.

    `long` is the number of lags of the first regression, two seasons and two by default."""

    p: int = 1
    d: int = 1
    q: int = 1
    seasonal_p: int = 1
    seasonal_d: int = 1
    seasonal_q: int = 1
    season: int = 24
    long: int = field(default=0)

    @staticmethod
    def _lags(short: int, seasonal: int, season: int) -> list[int]:
        return sorted({i + k * season for i in range(short + 1) for k in range(seasonal + 1)} - {0})

    @property
    def ar(self) -> list[int]:
        return self._lags(self.p, self.seasonal_p, self.season)

    @property
    def ma(self) -> list[int]:
        return self._lags(self.q, self.seasonal_q, self.season)

    @property
    def first(self) -> int:
        return self.long or 2 * (self.season + 1)

    @property
    def lost(self) -> int:
        """Rows that differencing takes from the start of a series."""
        return self.d + self.seasonal_d * self.season

    @property
    def depth(self) -> int:
        """Rows before a row that its regression reaches."""
        return self.lost + self.first + max([0, *self.ar, *self.ma])

    @property
    def terms(self) -> list[str]:
        return ["constant", *[f"ar{k}" for k in self.ar], *[f"ma{k}" for k in self.ma]]

    def difference(self) -> np.ndarray:
        """Coefficients of (1 - B)^d (1 - B^season)^D, the first one 1."""
        out = np.ones(1)
        for lag in [1] * self.d + [self.season] * self.seasonal_d:
            step = np.zeros(lag + 1)
            step[0], step[-1] = 1.0, -1.0
            out = np.convolve(out, step)
        return out


def _differenced(y: np.ndarray, orders: Orders) -> np.ndarray:
    """Differenced values; entries without a full history are NaN."""
    c = orders.difference()
    out = np.full(len(y), np.nan)
    if len(y) >= len(c):
        out[len(c) - 1 :] = np.convolve(y, c, "valid")
    return out


def _behind(x: np.ndarray, k: int) -> np.ndarray:
    return np.concatenate([np.full(min(k, len(x)), np.nan), x[: max(0, len(x) - k)]])


def _long_residuals(w: np.ndarray, phi: np.ndarray) -> np.ndarray:
    """Residuals of the long autoregression; `phi` begins with the constant."""
    out = w - phi[0]
    for k, b in enumerate(phi[1:], 1):
        out = out - b * _behind(w, k)
    return out


def _products(columns: list[np.ndarray], start: int) -> np.ndarray:
    """Sums of products of the complete own rows, the upper triangle as one array."""
    x = np.stack(columns, axis=1)[start:]
    x = x[~np.isnan(x).any(axis=1)]
    return (x.T @ x)[np.triu_indices(len(columns))]


def _square(flat: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    i, j = np.triu_indices(size)
    out[i, j] = out[j, i] = flat
    return out


def _regress(sums: np.ndarray) -> tuple[np.ndarray, float]:
    """Least squares of the last column on the others (of smallest size where they depend on each other), and its error."""
    xtx, xty = sums[:-1, :-1], sums[:-1, -1]
    scale = np.sqrt(np.maximum(np.diag(xtx), 1e-300))
    beta = np.linalg.lstsq(xtx / np.outer(scale, scale), xty / scale, rcond=1e-12)[0] / scale
    return beta, float(max(0.0, sums[-1, -1] - 2 * beta @ xty + beta @ xtx @ beta))


def _block_rows(df: DataFrame, order: str, value: str, series: list[str], orders: Orders) -> DataFrame:
    """One row per block: series, __block, __parts (of the series' blocks, less one), __last (block of its series), __start
    (rows before its own), __y and __end, its last bucket."""
    clean = nan_to_null(df.select(*series, F.col(order).alias("__o"), F.col(value).cast("double").alias("__y")))
    blocks = _blocks(clean.where(F.col("__y").isNotNull()), "__o", series, orders.depth)
    size = max(BLOCK_ROWS, orders.depth)
    rows = F.array_sort(F.collect_list(F.struct("__i", "__y", "__own", "__o")))
    grouped = blocks.groupBy(*series, "__block", "__n").agg(rows.alias("__r"))
    return grouped.select(
        *series,
        "__block",
        F.floor(F.col("__n") / (size * BLOCKS_JOINED)).alias("__parts"),
        (F.col("__block") == F.floor((F.col("__n") - 1) / size)).alias("__last"),
        F.size(F.filter("__r", lambda x: ~x["__own"])).alias("__start"),
        F.transform("__r", lambda x: x["__y"]).alias("__y"),
        F.element_at(F.col("__r"), -1)["__o"].alias("__end"),
    )


def _added_up(blocks: DataFrame, sums: Column, series: list[str]) -> DataFrame:
    """Element-wise sums of the blocks' arrays per series: (series, __parts, __sums)."""
    parts = blocks.select(*series, "__parts", F.posexplode(sums).alias("__at", "__s")).groupBy(*series, "__parts", "__at").agg(F.sum("__s").alias("__s"))
    ordered = F.array_sort(F.collect_list(F.struct("__at", "__s")))
    return parts.groupBy(*series, "__parts").agg(F.transform(ordered, lambda x: x["__s"]).alias("__sums"))


def fit_blocks(blocks: DataFrame, series: list[str], orders: Orders) -> DataFrame:
    """(series, phi, coefficients, sigma, rows) from the block rows; see `fit`."""
    first, terms = orders.first + 2, len(orders.terms) + 1

    @F.pandas_udf("array<double>")
    def long_sums(y: pd.Series, start: pd.Series) -> pd.Series:
        out = []
        for values, begin in zip(y, start, strict=True):
            w = _differenced(np.asarray(values, dtype=float), orders)
            out.append(_products([np.ones(len(w)), *[_behind(w, k) for k in range(1, orders.first + 1)], w], begin))
        return pd.Series(out)

    @F.pandas_udf("array<double>")
    def long_fit(sums: pd.Series) -> pd.Series:
        return pd.Series([_regress(_square(np.asarray(s), first))[0] for s in sums])

    @F.pandas_udf("array<double>")
    def short_sums(y: pd.Series, start: pd.Series, phi: pd.Series) -> pd.Series:
        out = []
        for values, begin, b in zip(y, start, phi, strict=True):
            w = _differenced(np.asarray(values, dtype=float), orders)
            e = _long_residuals(w, np.asarray(b))
            out.append(_products([np.ones(len(w)), *[_behind(w, k) for k in orders.ar], *[_behind(e, k) for k in orders.ma], w], begin))
        return pd.Series(out)

    @F.pandas_udf("coefficients array<double>, sigma double, rows long")
    def short_fit(sums: pd.Series) -> pd.DataFrame:
        out = []
        for s in sums:
            m = _square(np.asarray(s), terms)
            n = int(round(m[0, 0]))
            beta, sse = _regress(m)
            enough = n >= terms
            out.append((beta if enough else None, (sse / max(1, n - terms + 1)) ** 0.5 if enough else None, n))
        return pd.DataFrame(out, columns=["coefficients", "sigma", "rows"])

    long = durable(_added_up(blocks, long_sums("__y", "__start"), series).select(*series, "__parts", long_fit("__sums").alias("phi")))
    # a long series meets its coefficients in several parts
    copies = long.select(*series, F.explode(F.sequence(F.lit(0).cast("long"), "__parts")).alias("__part"), "phi")
    parted = blocks.select(*series, "__parts", (F.col("__block") % (F.col("__parts") + 1)).alias("__part"), "__start", "__y")
    with_phi = null_safe_join(parted, copies, [*series, "__part"], never_null=["__part"])
    short = _added_up(with_phi, short_sums("__y", "__start", "phi"), series).select(*series, short_fit("__sums").alias("__f")).select(*series, "__f.*")
    return null_safe_join(long.drop("__parts"), short, series)


def fit(df: DataFrame, order: str, value: str, series: Sequence[str] = (), orders: Orders = Orders()) -> DataFrame:
    """Per series: phi (constant and lags of the long autoregression), coefficients (in the order of `orders.terms`),
    sigma of the innovations and the rows of the second regression.

    Rows without a value are left out and the others count as consecutive. A series with fewer rows in the second
    regression than coefficients is reported with null coefficients. Without `series` the table is one series."""
    df, keys = _keyed(df, series)
    return fit_blocks(durable(_block_rows(df, order, value, keys, orders)), keys, orders).select(*series, "phi", "coefficients", "sigma", "rows")


def _keyed(df: DataFrame, series: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The table and its series columns; one constant column if there are none."""
    return (df, list(series)) if series else (df.withColumn("__all", F.lit(0)), ["__all"])


def _path(y: np.ndarray, phi: np.ndarray, beta: np.ndarray, orders: Orders, steps: int) -> np.ndarray:
    """The next values: differenced values go forward with innovations of 0, then differences are undone."""
    w = _differenced(y, orders)
    e = _long_residuals(w, phi)
    w, e, y = list(w), list(np.nan_to_num(e)), list(y)
    c = orders.difference()
    ar, ma = beta[1 : 1 + len(orders.ar)], beta[1 + len(orders.ar) :]
    for _ in range(steps):
        new = beta[0] + sum(b * w[-k] for b, k in zip(ar, orders.ar, strict=True)) + sum(b * e[-k] for b, k in zip(ma, orders.ma, strict=True))
        w.append(new)
        e.append(0.0)
        y.append(new - sum(c[k] * y[-k] for k in range(1, len(c))))
    return np.array(y[-steps:])


def impulse_weights(beta: np.ndarray, orders: Orders, steps: int) -> np.ndarray:
    """Weights of past innovations in the undifferenced value."""
    ar = np.zeros(max([0, *orders.ar]) + 1)
    ar[0] = 1.0
    ar[orders.ar] = -beta[1 : 1 + len(orders.ar)]
    whole = np.convolve(ar, orders.difference())
    ma = np.zeros(steps + max([0, *orders.ma]) + 1)
    ma[0] = 1.0
    ma[orders.ma] = beta[1 + len(orders.ar) :]
    psi = np.zeros(steps)
    for h in range(steps):
        psi[h] = ma[h] - sum(whole[k] * psi[h - k] for k in range(1, min(h, len(whole) - 1) + 1))
    return psi


def forecast(
    df: DataFrame,
    order: str,
    value: str,
    series: Sequence[str] = (),
    orders: Orders = Orders(),
    steps: int = 24,
    step: Column | None = None,
    z: float = 1.959963984540054,
) -> DataFrame:
    """(series, bucket, step, forecast, low, high): `steps` values after the end of every series.

    `step` is the time between rows, an hour by default. A series too short for a fit is reported with null forecasts."""
    df, keys = _keyed(df, series)
    blocks = durable(_block_rows(df, order, value, keys, orders))
    fitted = fit_blocks(blocks, keys, orders)
    joined = null_safe_join(blocks.where("__last").select(*keys, "__end", "__y"), fitted, keys)

    @F.pandas_udf("array<struct<forecast double, low double, high double>>")
    def ahead(y: pd.Series, phi: pd.Series, beta: pd.Series, sigma: pd.Series) -> pd.Series:
        out = []
        for values, p, b, s in zip(y, phi, beta, sigma, strict=True):
            if b is None:
                out.append([{"forecast": None, "low": None, "high": None}] * steps)
                continue
            b = np.asarray(b)
            centre = _path(np.asarray(values, dtype=float), np.asarray(p), b, orders, steps)
            width = z * s * np.sqrt(np.cumsum(impulse_weights(b, orders, steps) ** 2))
            out.append([{"forecast": float(f), "low": float(f - d), "high": float(f + d)} for f, d in zip(centre, width, strict=True)])
        return pd.Series(out)

    rolled = joined.select(*series, "__end", F.posexplode(ahead("__y", "phi", "coefficients", "sigma")).alias("__at", "__f"))
    gap = step if step is not None else F.make_dt_interval(F.lit(0), F.lit(1))
    return rolled.select(*series, (F.col("__end") + gap * (F.col("__at") + 1)).alias("bucket"), (F.col("__at") + 1).alias("step"), "__f.*")
