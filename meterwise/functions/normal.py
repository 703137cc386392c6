"""Normal distribution on whole columns, Arrow-batched."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _erfc_positive(x: np.ndarray) -> np.ndarray:
    """exp(x²)·erfc(x) for x >= 0: power series near zero, continued fraction beyond."""
    out = np.empty_like(x)
    near = x < 2.5
    a = x[near]
    term = total = a.copy()
    for n in range(1, 80):
        term = term * 2 * a * a / (2 * n + 1)
        total = total + term
    out[near] = np.exp(a * a) - 2 / np.sqrt(np.pi) * total
    b = x[~near]
    fraction = np.zeros_like(b)
    for n in range(120, 0, -1):
        fraction = (n / 2) / (b + fraction)
    out[~near] = 1 / (np.sqrt(np.pi) * (b + fraction))
    return out


def log_cdf(z: np.ndarray) -> np.ndarray:
    x = np.abs(z) / np.sqrt(2)
    log_tail = np.log(0.5 * _erfc_positive(x)) - x * x
    return np.where(z <= 0, log_tail, np.log1p(-np.exp(log_tail)))


# fixed values: coefficients of a published rational approximation of the inverse
_A = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00]
_B = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0]


def ppf(p: np.ndarray) -> np.ndarray:
    upper = p > 0.5
    q = np.where(upper, 1 - p, p)
    tail = q < 0.02425
    r = q - 0.5
    z = np.polyval(_A, r * r) * r / np.polyval(_B, r * r)
    t = np.sqrt(-2 * np.log(np.where(tail, q, 0.01)))
    z = np.where(tail, np.polyval(_C, t) / np.polyval(_D, t), z)
    for _ in range(2):  # Halley steps
        error = (np.exp(log_cdf(z)) - q) * np.sqrt(2 * np.pi) * np.exp(z * z / 2)
        z = z - error / (1 + z * error / 2)
    return np.where(upper, -z, z)


def _on_column(function: Callable[[np.ndarray], np.ndarray], value: Column | str) -> Column:
    def batch(x: pd.Series) -> pd.Series:
        return pd.Series(function(x.to_numpy(dtype=float)))

    return F.pandas_udf(batch, T.DoubleType())(value)


def normal_log_cdf(z: Column | str) -> Column:
    return _on_column(log_cdf, z)


def normal_quantile(p: Column | str) -> Column:
    return _on_column(ppf, p)
