import math

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from meterwise.operators import analytics, forecast, ranking, timeseries


@pytest.fixture(params=[100_000, 300, 20], ids=["one bucket", "buckets", "many buckets"])
def group_limit(request, monkeypatch):
    """Run a test with groups in one bucket and split into buckets."""
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", request.param)


def skewed(spark, n=6000):
    """One group and one value hold a third of all rows."""
    value = F.when(F.col("id") % 3 == 0, 50.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7.0)
    group = F.when(F.col("id") % 5 < 3, "big").when(F.col("id") % 5 == 3, F.lit(None)).otherwise("small")
    return spark.range(n).select("id", value.alias("v"), group.alias("g"))


def test_quantiles_match_numpy(spark, group_limit):
    df = skewed(spark)
    pdf = df.toPandas()
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = ranking.quantiles(df, "v", probs).first()
    assert list(found) == pytest.approx(list(np.quantile(pdf["v"], probs)))
    by_group = {r.g: list(r)[1:] for r in ranking.quantiles(df, "v", probs, ["g"]).collect()}
    for g, part in pdf.groupby("g", dropna=False):
        assert by_group[None if pd.isna(g) else g] == pytest.approx(list(np.quantile(part["v"], probs)))


def test_row_numbers_split_a_hot_value(spark, group_limit):
    df = skewed(spark)
    pdf = df.toPandas().sort_values(["v", "id"])
    got = {r.id: r.row_number for r in ranking.row_numbers(df, "v", "id").collect()}
    assert [got[i] for i in pdf["id"]] == list(range(1, len(pdf) + 1))
    grouped = {r.id: r.row_number for r in ranking.row_numbers(df, "v", "id", ["g"]).collect()}
    expected = pdf.groupby("g", dropna=False).cumcount() + 1
    assert all(grouped[i] == e for i, e in zip(pdf["id"], expected))


def test_cumulative_counts(spark, group_limit):
    df = skewed(spark)
    pdf = df.toPandas()
    counts = pdf["v"].value_counts().sort_index()
    got = {r.value: (r.n, r.below, r.total) for r in ranking.cumulative_counts(df, "v").collect()}
    below = counts.cumsum() - counts
    assert got == {v: (int(counts[v]), int(below[v]), len(pdf)) for v in counts.index}


def test_missing_and_infinite_values_have_fixed_places(spark, group_limit):
    """NULL first, then -infinity, numbers, infinity, NaN: the same for any number of buckets."""
    special = {0: None, 1: float("-inf"), 2: float("inf"), 3: float("nan")}
    values = [special.get(i % 10, float(i % 97)) for i in range(1000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")

    def place(v):
        return (0, 0.0) if v is None else (2, 0.0) if math.isnan(v) else (1, v)

    order = sorted(range(1000), key=lambda i: (place(values[i]), i))
    got = {r.id: (r.row_number, r.row_number_total) for r in ranking.row_numbers(df, "v", "id").collect()}
    assert got == {i: (k + 1, 1000) for k, i in enumerate(order)}
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    found = ranking.quantiles(df, "v", [0.0, 0.05, 0.5, 0.99, 1.0]).first()
    assert list(found) == [known[0], known[39], (known[399] + known[400]) / 2, float("inf"), float("inf")]


def test_many_groups(spark, group_limit):
    """More than a thousand groups, of which one is large."""
    group = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1301)
    df = spark.range(6000).select("id", group.alias("g"), (F.col("id") * 7 % 1009).cast("double").alias("v"))
    pdf = df.toPandas()
    got = {r.g: r.q0 for r in ranking.quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got == pytest.approx(pdf.groupby("g")["v"].median().to_dict())


def test_results_do_not_depend_on_partitions(spark, group_limit):
    df = skewed(spark, 1000)
    a = rows(ranking.quantiles(df.repartition(1), "v", [0.3, 0.7], ["g"]))
    assert a == rows(ranking.quantiles(df.repartition(13), "v", [0.3, 0.7], ["g"]))


def test_running_total_over_text(spark, group_limit):
    df = spark.range(2000).select(F.format_string("k%04d", F.col("id") % 300).alias("k"), F.col("id").alias("v"))
    pdf = df.toPandas().groupby("k")["v"].sum()
    got = {r.k: r.running for r in analytics.running_total(df, "k", "v").collect()}
    assert got == dict(pdf.cumsum())


def series(spark, values):
    data = [(i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "i int, y double").withColumn("t", F.timestamp_seconds(F.lit(1_700_006_400) + F.col("i") * 3600))


def test_resample_fills_gaps(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('a', TIMESTAMP '2024-01-01 00:10:00', 1.0D), ('a', TIMESTAMP '2024-01-01 00:50:00', 2.0D), ('a', TIMESTAMP '2024-01-01 03:00:00', 5.0D),
        ('b', TIMESTAMP '2024-01-02 00:00:00', 7.0D) AS t(s, ts, v)"""
    )
    hours = rows(timeseries.resample_hours(df, "ts", "v", ["s"]), "s", "v")
    assert hours == [("a", 0.0), ("a", 0.0), ("a", 3.0), ("a", 5.0), ("b", 7.0)]
    weeks = timeseries.resample_weeks(df.filter("s = 'a'"), "ts", "v").collect()
    assert [(str(r.bucket), r.v) for r in weeks] == [("2024-01-07", pytest.approx(8 / 3))]


def test_autumn_change_keeps_instants_apart(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP '2024-10-26 22:00:00', TIMESTAMP '2024-10-27 03:00:00', INTERVAL 1 HOUR)) AS ts, 1.0D AS v")
    assert timeseries.resample_hours(df, "ts", "v").count() == 6
    assert timeseries.period_sums(df, "ts", ["v"]).count() == 5
    assert max(r.v for r in timeseries.period_sums(df, "ts", ["v"]).collect()) == 2.0


def test_decomposition_recovers_a_seasonal_series(spark):
    season = [math.sin(2 * math.pi * h / 24) for h in range(24)]
    df = series(spark, [10 + 0.5 * i + season[i % 24] for i in range(240)])
    parts = timeseries.decompose(df, "y", "t", 24).filter("trend IS NOT NULL").orderBy("t").collect()
    assert len(parts) == 240 - 24
    assert all(abs(r.trend - (10 + 0.5 * r.i)) < 1e-9 and abs(r.seasonal - season[r.i % 24]) < 1e-9 and abs(r.resid) < 1e-9 for r in parts)


def test_partial_autocorrelation_solves_yule_walker(spark):
    rng = np.random.default_rng(1)
    y = np.zeros(600)
    for i in range(2, 600):
        y[i] = 0.6 * y[i - 1] - 0.3 * y[i - 2] + rng.normal()
    df = series(spark, y)
    rho = [r.acf for r in timeseries.acf(df, "y", "t", 6).orderBy("lag").collect()]
    got = [r.pacf for r in timeseries.pacf(df, "y", "t", 6).orderBy("lag").collect()]
    for k in range(1, 7):
        matrix = np.array([[rho[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k] == pytest.approx(np.linalg.solve(matrix, rho[1 : k + 1])[-1])


def test_stationarity_tells_noise_from_a_walk(spark):
    rng = np.random.default_rng(2)
    noise = rng.normal(size=400)
    assert timeseries.adf_test(series(spark, noise), "y", "t")["p_value"] < 0.01
    walk = timeseries.adf_test(series(spark, np.cumsum(noise)), "y", "t", max_lag=1)
    assert walk["p_value"] > 0.05 and walk["lags"] <= 1


def test_dickey_fuller_statistic_without_lags(spark):
    rng = np.random.default_rng(3)
    y = np.cumsum(rng.normal(size=200))
    found = timeseries.adf_test(series(spark, y), "y", "t", max_lag=0)
    x = np.column_stack([np.ones(199), y[:-1]])
    dy = np.diff(y)
    beta, sse = np.linalg.lstsq(x, dy, rcond=None)[:2]
    se = math.sqrt(sse[0] / 197 * np.linalg.inv(x.T @ x)[1, 1])
    assert found["statistic"] == pytest.approx(beta[1] / se)


def test_supervised_table_does_not_leak_the_target(spark):
    df = series(spark, range(100))
    built = timeseries.supervised_table(df, "y", "t").filter("NOT is_test").orderBy("i").collect()
    assert built[0].i == 24 and built[0].y_lag1 == 23 and built[0].y_MA24 == np.mean(range(24))
    assert timeseries.supervised_table(df, "y", "t").filter("is_test").count() == 0
    current = timeseries.supervised_table(df, "y", "t", include_current=True).orderBy("i").first()
    assert current.i == 23 and current.y_MA24 == np.mean(range(24))


def test_forecast_follows_a_seasonal_series(spark):
    data = [(s, i, 100.0 + 20 * math.sin(2 * math.pi * i / 24) + 5 * s) for s in (0, 1) for i in range(24 * 21)]
    df = spark.createDataFrame(data, "s int, i int, y double").withColumn("t", F.timestamp_seconds(F.lit(1_700_006_400) + F.col("i") * 3600))
    model = forecast.fit_seasonal(df, "s", "t", "y")
    found = forecast.forecast(model, df, "s", "t", "y", 24).orderBy("s", "step").collect()
    assert len(found) == 48
    for r in found:
        expected = 100 + 20 * math.sin(2 * math.pi * (24 * 21 + r.step - 1) / 24) + 5 * r.s
        assert r.forecast == pytest.approx(expected, abs=0.5) and r.low <= r.forecast <= r.high


def test_box_statistics(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    r = analytics.box_stats(df, "v", ["g"]).first()
    assert (r.q1, r["median"], r.q3, r.whisker_low, r.whisker_high, r.outliers) == (2, 3, 4, 1, 4, 1)


def test_shares_sum_to_one(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"))
    shares = analytics.crosstab(df, "a", "b", "columns").groupBy("b").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in shares)


@pytest.fixture(params=[8_192, 24], ids=["one block", "blocks"])
def block_rows(request, monkeypatch):
    monkeypatch.setattr(timeseries, "BLOCK_ROWS", request.param)


def test_blocks_see_their_neighbours(spark, block_rows):
    """Lags, differences, rolling means and autocorrelations of several series, cut into blocks, against pandas."""
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"s": np.repeat(["a", "b"], 150), "t": np.tile(np.arange(150), 2), "y": rng.standard_normal(300).cumsum()})
    df = spark.createDataFrame(pdf).repartition(5)
    by = pdf.groupby("s")["y"]

    def same(table, name, expected):
        got = table.toPandas().set_index(["s", "t"])[name].sort_index()
        want = pd.Series(expected.to_numpy(), index=pd.MultiIndex.from_frame(pdf[["s", "t"]])).reindex(got.index)
        assert len(got) and np.allclose(got.astype(float), want, equal_nan=True)

    same(timeseries.lagged(df, "y", "t", 30, ["s"]), "lag1", by.shift(30))
    same(timeseries.rolling_mean(df, "y", "t", 7, ["s"]), "rolling", by.transform(lambda x: x.rolling(7).mean()))
    differences = timeseries.seasonal_difference(df, "y", "t", [1, 24], ["s"])
    assert differences.count() == 250
    same(differences, "y", by.transform(lambda x: x.diff().diff(24)))
    found = {(r.s, r.lag): r.acf for r in timeseries.acf(df, "y", "t", 40, ["s"]).collect()}
    for s, y in by:
        d = y.to_numpy() - y.mean()
        assert all(found[s, k] == pytest.approx(d[k:] @ d[: len(d) - k] / (d @ d)) for k in range(41))
    test = timeseries.temporal_split(df, "t", 0.1, ["s"]).filter("is_test").select("s", "t")
    assert rows(test) == [(s, t) for s in "ab" for t in range(135, 150)]
    one = df.filter("s = 'a'")
    trend = timeseries.decompose(one, "y", "t", 5).toPandas().set_index("t")["trend"].sort_index()
    assert np.allclose(trend, pdf[pdf.s == "a"]["y"].rolling(5, center=True).mean(), equal_nan=True)


def test_resampled_series_are_shuffled_once(spark):
    """Lags and rolling means of resampled series need no shuffle of their own, and are those of cut series."""
    rng = np.random.default_rng(3)
    hours = pd.Timestamp("2024-03-30") + pd.to_timedelta(rng.integers(0, 400, 300), unit="h")
    df = spark.createDataFrame(pd.DataFrame({"s": rng.integers(0, 3, 300), "ts": hours, "y": rng.normal(size=300)}))
    hourly = timeseries.resample_hours(df, "ts", "y", ["s"])
    short, cut = (
        timeseries.lagged(timeseries.rolling_mean(hourly, "y", "bucket", 24, ["s"], **more), "y", "bucket", 2, ["s"], **more)
        for more in ({"resampled": True}, {})
    )
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    assert plan(short) == plan(hourly)
    columns = ["s", "bucket", "lag1", "rolling"]
    for a, b in zip(rows(short, *columns), rows(cut, *columns), strict=True):
        assert a[:3] == b[:3] and (a[3] == b[3] or a[3] == pytest.approx(b[3], abs=1e-12))
