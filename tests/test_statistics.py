import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterwise.functions import normal, special
from meterwise.operators import selection, stats


def test_tail_probabilities():
    assert special.t_two_sided(2.0, 10) == pytest.approx(0.07338803477074037)
    assert special.f_sf(3.0, 2, 10) == pytest.approx((1 + 2 * 3 / 10) ** -5)
    assert special.chi2_sf(3.0, 2) == pytest.approx(math.exp(-1.5))
    assert special.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05)
    assert special.norm_sf(1.959963984540054) == pytest.approx(0.025)


def test_normal_columns():
    z = np.array([-40.0, -8.0, -2.5, -0.1, 0.0, 0.7, 3.0, 9.0])
    exact = [math.log(0.5 * math.erfc(-v / math.sqrt(2))) if v > -37 else None for v in z]
    got = normal.log_cdf(z)
    assert got[0] == pytest.approx(-804.608442, rel=1e-6)
    assert list(got[1:]) == pytest.approx(exact[1:], rel=1e-11, abs=1e-18)
    p = np.array([1e-9, 0.01, 0.3, 0.5, 0.8, 0.999])
    assert list(normal.ppf(p)) == pytest.approx([special.norm_ppf(v) for v in p], abs=1e-12)


def sample(spark, seed=0, n=400):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    data = [(i, "abc"[i % 3], "xy"[i % 7 > 2], float(x[i]), float(2 * x[i] + (i % 3) + rng.normal())) for i in range(n)]
    return spark.createDataFrame(data, "id int, g string, h string, x double, y double"), data


def test_sequential_variance_table(spark):
    df, data = sample(spark)
    found = stats.anova(df, ["g", "h"], "y")
    y = np.array([r[4] for r in data])
    g = np.array([[r[1] == "b", r[1] == "c"] for r in data], dtype=float)
    h = np.array([[r[2] == "y"] for r in data], dtype=float)

    def sse(*blocks):
        design = np.hstack([np.ones((len(y), 1)), *blocks])
        return float(((y - design @ np.linalg.lstsq(design, y, rcond=None)[0]) ** 2).sum())

    table = {r.term: r for r in found["table"].collect()}
    assert table["g"].sum_sq == pytest.approx(sse() - sse(g))
    assert table["h"].sum_sq == pytest.approx(sse(g) - sse(g, h))
    assert table["Residual"].sum_sq == pytest.approx(sse(g, h))
    assert found["r2"] == pytest.approx(1 - sse(g, h) / sse())
    assert table["g"].f == pytest.approx((sse() - sse(g)) / 2 / (sse(g, h) / (len(y) - 4)))


def test_least_squares_summary(spark):
    df, data = sample(spark)
    x = np.column_stack([np.ones(len(data)), [r[3] for r in data]])
    y = np.array([r[4] for r in data])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    s2 = ((y - x @ beta) ** 2).sum() / (len(y) - 2)
    se = np.sqrt(s2 * np.diag(np.linalg.inv(x.T @ x)))
    found = {r.term: r for r in stats.ols_summary(df, ["x"], "y").collect()}
    assert (found["Intercept"].coef, found["x"].coef) == pytest.approx(tuple(beta))
    assert (found["Intercept"].se, found["x"].se) == pytest.approx(tuple(se))


def test_rank_test_with_ties(spark):
    data = [("a", 1.0), ("a", 2.0), ("a", 2.0), ("b", 2.0), ("b", 3.0), ("b", 4.0)]
    found = stats.kruskal_wallis(spark.createDataFrame(data, "g string, v double"), "g", "v")
    # ranks 1 3 3 | 3 5 6 by hand
    h = (12 / 42 * (49 / 3 + 196 / 3) - 21) / (1 - 24 / 210)
    assert found["statistic"] == pytest.approx(h)


def test_yates_correction(spark):
    data = [(0, 0)] * 10 + [(0, 1)] * 20 + [(1, 0)] * 30 + [(1, 1)] * 15
    df = spark.createDataFrame(data, "a int, b int")
    n, ad_bc = 75, abs(10 * 15 - 20 * 30)
    expected = n * (ad_bc - n / 2) ** 2 / (30 * 45 * 40 * 35)
    assert stats.chi2_independence(df, "a", "b")["statistic"] == pytest.approx(expected)
    plain = stats.chi2_independence(df, "a", "b", correction=False)["statistic"]
    assert plain == pytest.approx(n * ad_bc**2 / (30 * 45 * 40 * 35))
    association = stats.cramers_v(df.withColumn("c", F.lit("only")), ["a", "c"], "b").collect()
    assert {(r.column, r.modality) for r in association} == {("a", "0"), ("a", "1")}
    assert all(r.statistic == pytest.approx(expected) and r.significant for r in association)


def test_normality_of_normal_and_uniform_data(spark):
    rng = np.random.default_rng(5)
    normal_df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.normal(size=800))], "id int, v double")
    uniform_df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.uniform(size=800))], "id int, v double")
    good, bad = stats.anderson_darling(normal_df, "v"), stats.anderson_darling(uniform_df, "v")
    assert good["statistic"] < good["critical"][5.0] and bad["statistic"] > bad["critical"][1.0]
    v = np.sort([r.v for r in normal_df.collect()])
    z = (v - v.mean()) / v.std(ddof=1)
    phi = np.array([0.5 * math.erfc(-a / math.sqrt(2)) for a in z])
    i = np.arange(1, 801)
    assert good["statistic"] == pytest.approx(-800 - ((2 * i - 1) * (np.log(phi) + np.log(1 - phi[::-1]))).sum() / 800)
    assert stats.dagostino(normal_df, "v")["p_value"] > 0.01 > stats.dagostino(uniform_df, "v")["p_value"]
    assert stats.qq_fit(normal_df, "v", "id").first().r > 0.99


def test_levene_against_hand_values(spark):
    data = [("a", v) for v in (1.0, 2.0, 3.0, 4.0)] + [("b", v) for v in (0.0, 5.0, 10.0, 20.0)]
    found = stats.levene(spark.createDataFrame(data, "g string, v double"), "g", "v")
    a, b = np.array([1.5, 0.5, 0.5, 1.5]), np.array([7.5, 2.5, 2.5, 12.5])
    grand = np.concatenate([a, b]).mean()
    between = 4 * (a.mean() - grand) ** 2 + 4 * (b.mean() - grand) ** 2
    inside = ((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()
    assert found["statistic"] == pytest.approx(between / (inside / 6))


def test_logit_report_and_adjustments(spark):
    rng = np.random.default_rng(0)
    data = []
    for _ in range(300):
        a, b = int(rng.integers(0, 10)), int(rng.integers(0, 10))
        data.append((a, b, int(rng.random() < 1 / (1 + math.exp(-(0.4 * a - 2))))))
    df = spark.createDataFrame(data, "a int, b int, y int")
    rules = {"a": {"type": "normalize", "range": (0, 9)}, "b": {"type": "inverse"}, "zz": {"type": "inverse"}}
    plain, adjusted = stats.logit_report(df, ["a", "b"], "y"), stats.logit_report(df, ["a", "b"], "y", rules)
    coef = {r.term: r.coef for r in plain["report"].collect()}
    odds = {r.term: r.odds_ratio for r in adjusted["odds"].collect()}
    assert odds["a"] == pytest.approx(math.exp(coef["a"] / 9)) and odds["b"] == pytest.approx(math.exp(-1 / math.exp(coef["b"])))
    assert odds["Intercept"] == pytest.approx(math.exp(coef["Intercept"]))
    other = stats.logit_report(df, ["a", "b"], "y", {"a": {"type": "unknown"}})
    assert {r.term: r.odds_ratio for r in other["odds"].collect()}["a"] == pytest.approx(math.exp(coef["a"]))


def test_elimination_keeps_the_signal(spark):
    rng = np.random.default_rng(7)
    data = []
    for i in range(300):
        x = rng.normal(size=4)
        data.append((*map(float, x), float(3 * x[0] - 2 * x[2] + 0.1 * rng.normal()), i % 5))
    df = spark.createDataFrame(data, "a double, b double, c double, d double, y double, fold int")
    names = ["a", "b", "c", "d"]
    ranks = {r.feature: r.ranking for r in selection.recursive_elimination(df, names, "y", 2).collect()}
    assert ranks["a"] == ranks["c"] == 1 and {ranks["b"], ranks["d"]} == {2, 3}
    folded = selection.recursive_elimination_cv(df, names, "y", "fold", expanding=False).collect()
    assert folded[0].n_features >= 2 and folded[0].cv_r2 > 0.98
    best = selection.k_best(selection.f_regression(df, names, "y"), "f", 2).collect()
    assert {r.feature for r in best} == {"a", "c"}
    information = {r.feature: r.mutual_information for r in selection.mutual_information(df, names, "y", 8).collect()}
    assert information["a"] > information["b"] and information["c"] > information["d"]
    path = selection.ridge_path(df, names, "y", [0.0, 1e6], "fold").collect()
    assert path[0].coefficients == pytest.approx([3, 0, -2, 0], abs=0.05) and max(map(abs, path[1].coefficients)) < 0.01
    assert selection.select_from_model(names, [3.0, 0.0, -2.0, 1e-12], "nonzero") == ["a", "c"]


def test_tests_take_any_number_of_groups(spark):
    """2 000 groups and two columns of many categories, against plain formulas."""
    import numpy as np

    df = spark.range(8000).selectExpr("id % 2000 AS g", "cast(id * 37 % 1009 AS double) AS v", "id % 1201 AS a", "id * 31 % 7 AS b")
    pdf = df.toPandas()
    ranks = pdf["v"].rank()
    n = len(pdf)
    h = 12 / (n * (n + 1)) * (ranks.groupby(pdf["g"]).sum() ** 2 / pdf.groupby("g").size()).sum() - 3 * (n + 1)
    t = pdf["v"].value_counts()
    found = stats.kruskal_wallis(df, "g", "v")
    assert found["groups"] == 2000 and found["statistic"] == pytest.approx(h / (1 - (t**3 - t).sum() / (n**3 - n)))
    table = np.zeros((1201, 7))
    np.add.at(table, (pdf["a"], pdf["b"]), 1)
    expected = np.outer(table.sum(1), table.sum(0)) / n
    found = stats.chi2_independence(df, "a", "b")
    assert found["dof"] == 1200 * 6 and found["statistic"] == pytest.approx(((table - expected) ** 2 / expected).sum())
    means = pdf.groupby("g")["v"].agg(["mean", "size", "var"])
    between = (means["size"] * (means["mean"] - pdf["v"].mean()) ** 2).sum() / 1999
    inside = (means["var"] * (means["size"] - 1)).sum() / (n - 2000)
    assert stats.one_way_f(df, "g", "v")["statistic"] == pytest.approx(between / inside)


def test_yates_correction_with_an_empty_cell(spark):
    rows = [("x", "p")] * 6 + [("x", "q")] * 3 + [("y", "p")] * 5
    table, n = [[6, 3], [5, 0]], 14
    expected = [[11 * 9 / n, 3 * 9 / n], [11 * 5 / n, 3 * 5 / n]]
    want = sum(max(abs(table[i][j] - expected[i][j]) - 0.5, 0) ** 2 / expected[i][j] for i in range(2) for j in range(2))
    assert stats.chi2_independence(spark.createDataFrame(rows, "a string, b string"), "a", "b")["statistic"] == pytest.approx(want)
