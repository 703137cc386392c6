import datetime as dt

import numpy as np
import pytest

from meterwise.operators import forecast as pooled
from meterwise.operators import seasonal_arima as sa

SMALL = sa.Orders(1, 1, 1, 1, 1, 1, season=6)
START = dt.datetime(2024, 1, 1)


def simulated(n, seed, ar=0.5, ma=-0.4, season=6):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n)
    w = np.zeros(n)
    for t in range(season + 1, n):
        w[t] = ar * w[t - 1] + 0.2 * w[t - season] + e[t] + ma * e[t - 1]
    y = w.copy()
    for t in range(season + 1, n):
        y[t] += y[t - 1] + y[t - season] - y[t - season - 1]
    return y


def plain(y, orders):
    """Both regressions on whole arrays."""
    c, m = orders.difference(), orders.first
    w = np.convolve(y, c, "valid")
    x = np.array([[1, *(w[t - k] for k in range(1, m + 1))] for t in range(m, len(w))])
    phi = np.linalg.lstsq(x, w[m:], rcond=None)[0]
    e = np.concatenate([np.full(m, np.nan), w[m:] - x @ phi])
    start = m + max(orders.ar + orders.ma)
    z = np.array([[1, *(w[t - k] for k in orders.ar), *(e[t - k] for k in orders.ma)] for t in range(start, len(w))])
    beta = np.linalg.lstsq(z, w[start:], rcond=None)[0]
    sse = ((w[start:] - z @ beta) ** 2).sum()
    return phi, beta, (sse / (len(z) - z.shape[1])) ** 0.5, w, e


def table(spark, by_series):
    rows = [(s, START + dt.timedelta(hours=i), None if v is None else float(v)) for s, y in by_series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "s string, t timestamp, y double")


@pytest.mark.parametrize("block", [40, 8192])
def test_fit_against_whole_arrays(spark, monkeypatch, block):
    monkeypatch.setattr(sa, "BLOCK_ROWS", block)
    monkeypatch.setattr("meterwise.operators.timeseries.BLOCK_ROWS", block)
    monkeypatch.setattr(sa, "BLOCKS_JOINED", 3)
    data = {"a": simulated(700, 1), "b": simulated(450, 2, 0.3, 0.5) + 1000}
    df = table(spark, {**data, "short": [1.0, 2.0, 3.0], "flat": [5.0] * 200})
    found = {r.s: r for r in sa.fit(df, "t", "y", ["s"], SMALL).collect()}
    assert set(found) == {"a", "b", "short", "flat"} and found["short"].coefficients is None
    assert not any(found["flat"].coefficients) and found["flat"].sigma == 0
    ahead = {}
    for r in sa.forecast(df, "t", "y", ["s"], SMALL, 13).collect():
        ahead.setdefault(r.s, {})[r.step] = r
    assert [ahead["short"][h].forecast for h in range(1, 14)] == [None] * 13
    assert {ahead["flat"][h].forecast for h in range(1, 14)} == {5.0}
    for s, y in data.items():
        phi, beta, sigma, w, e = plain(y, SMALL)
        assert np.allclose(found[s].phi, phi, atol=1e-6) and np.allclose(found[s].coefficients, beta, atol=1e-5)
        assert found[s].sigma == pytest.approx(sigma, rel=1e-6)
        w, e, y = list(w), list(e), list(y)
        for h in range(1, 14):
            w.append(beta[0] + sum(b * w[-k] for b, k in zip(beta[1:4], SMALL.ar, strict=True)) + sum(b * e[-k] for b, k in zip(beta[4:], SMALL.ma, strict=True)))
            e.append(0.0)
            y.append(w[-1] + y[-1] + y[-6] - y[-7])
            r = ahead[s][h]
            assert r.forecast == pytest.approx(y[-1], abs=1e-3) and r.bucket == START + dt.timedelta(hours=len(data[s]) - 1 + h)
        assert ahead[s][1].high - ahead[s][1].forecast == pytest.approx(1.959964 * sigma, rel=1e-4)
        widths = [ahead[s][h].high - ahead[s][h].low for h in range(1, 14)]
        assert widths == sorted(widths)


def test_coefficients_of_a_known_process(spark):
    whole = sa.fit(table(spark, {"x": simulated(20_000, 3)}).drop("s"), "t", "y", orders=sa.Orders(1, 1, 1, 1, 1, 0, season=6)).collect()
    assert len(whole) == 1
    named = dict(zip(sa.Orders(1, 1, 1, 1, 1, 0, season=6).terms, whole[0].coefficients, strict=True))
    assert named["ar1"] == pytest.approx(0.5, abs=0.07) and named["ma1"] == pytest.approx(-0.4, abs=0.07) and named["ar6"] == pytest.approx(0.2, abs=0.05)
    assert whole[0].sigma == pytest.approx(1, abs=0.03)


def test_impulse_weights_undo_the_model():
    beta, steps = np.array([0.0, 0.4, 0.2, -0.1, 0.3, -0.2, 0.1]), 20
    e, w = np.zeros(60), np.zeros(60)
    e[20] = 1.0
    for t in range(20, 60):
        w[t] = e[t] + sum(b * w[t - k] for b, k in zip(beta[1:4], SMALL.ar, strict=True)) + sum(b * e[t - k] for b, k in zip(beta[4:], SMALL.ma, strict=True))
    y = np.zeros(60)
    for t in range(20, 60):
        y[t] = w[t] + y[t - 1] + y[t - 6] - y[t - 7]
    assert np.allclose(sa.impulse_weights(beta, SMALL, steps), y[20:40])


def test_holes_and_empty_table(spark):
    y = simulated(400, 4)
    holes = [*y[:100], None, float("nan"), *y[100:]]
    a, b = (sa.fit(table(spark, {"s": v}), "t", "y", ["s"], SMALL).collect()[0] for v in (y, holes))
    assert a.coefficients == pytest.approx(b.coefficients) and a.rows == b.rows
    assert sa.forecast(table(spark, {"s": y}).limit(0), "t", "y", ["s"], SMALL).count() == 0


def test_short_futures_are_reported(spark):
    y = [10 + 3 * np.sin(i / 4) for i in range(400)]
    df = table(spark, {"a": y, "b": y, "c": y}).selectExpr("s", "t", "y", "cast(hour(t) as double) AS h")
    model = pooled.fit_seasonal(df, "s", "t", "y", exogenous=["h"])
    future = spark.createDataFrame([(s, k, float(k)) for s, n in (("a", 5), ("b", 2), ("z", 5)) for k in range(1, n + 1)], "s string, step int, h double")
    rows = {}
    for r in pooled.forecast(model, df, "s", "t", "y", 5, future=future).collect():
        rows.setdefault(r.s, {})[r.step] = r.forecast
    assert set(rows) == {"a", "b", "c"} and None not in rows["a"].values()
    assert [rows["b"][k] is None for k in range(1, 6)] == [False, False, True, True, True] and set(rows["c"].values()) == {None}
