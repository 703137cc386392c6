import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterwise.operators import ranking

PROBS = [0.0, 0.001, 0.25, 0.5, 0.9, 1.0]


def table(spark, by_group):
    rows = [(g, float(v)) for g, values in by_group.items() for v in values]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(8)
    return {
        "wide": rng.normal(size=9_000),
        "ties": rng.integers(0, 5, 7_000),
        "one": np.full(3_000, 2.5),
        "edge": rng.normal(size=ranking.LEAST_ROWS),
        "small": rng.normal(size=37),
        "lone": [4.0],
        None: rng.exponential(size=2_500),
    }


@pytest.mark.parametrize("sent", [0, 50_000])
def test_against_whole_groups(spark, groups, monkeypatch, sent):
    monkeypatch.setattr(ranking, "MOST_SENT", sent)
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 40)
    df = table(spark, groups).unionByName(spark.createDataFrame([("small", None), ("small", float("nan")), ("void", None)], "g string, v double"))
    found = {r.g: r for r in ranking.quantiles(df, "v", PROBS, ["g"], {"n": F.count("value"), "top": F.max("value")}).collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        want = np.quantile(np.asarray(values, dtype=float), PROBS)
        assert np.allclose([found[g][f"q{i}"] for i in range(len(PROBS))], want, atol=1e-12), g
        assert (found[g].n, found[g].top) == (len(values), max(values))
    whole = ranking.quantiles(df, "v", [0.5]).collect()
    assert whole[0].q0 == pytest.approx(np.quantile(np.concatenate([np.asarray(v, dtype=float) for v in groups.values()]), 0.5))


def test_few_values_are_ranked(spark, groups):
    base = table(spark, {"wide": groups["wide"]}).select("g", F.col("v").alias("value"))
    _, cells = ranking._bracketed(base, ["g"], [0.25, 0.5], {})
    assert cells.agg(F.sum("n")).first()[0] == 9_000 and cells.count() < 9_000 * 2 * 4 * ranking.MARGIN


def test_infinite_values_long_columns_and_empty_tables(spark):
    odd = table(spark, {"a": [-np.inf, 1, 2, np.inf] * 600})
    assert [ranking.quantiles(odd, "v", [p]).first().q0 for p in (0.0, 0.3, 0.6, 1.0)] == [-np.inf, 1.0, 2.0, np.inf]
    whole = spark.range(10_001)
    assert ranking.quantiles(whole, "id", [0.5, 0.12345]).first() == (5000.0, 1234.5)
    assert ranking.quantiles(odd.limit(0), "v", [0.5]).first().q0 is None
    assert ranking.quantiles(odd.limit(0), "v", [0.5], ["g"]).count() == 0


def test_a_sketch_beyond_its_error_fails(spark, groups, monkeypatch):
    monkeypatch.setattr(ranking, "MARGIN", -0.05)
    with pytest.raises(PySparkException, match="sketch"):
        ranking.quantiles(table(spark, groups), "v", [0.5], ["g"]).collect()
