import numpy as np

from meterwise.llm import quality


def test_rules_of_four_tests_are_kept(spark):
    """A label that needs four statistics at once is learned by a rule of four tests."""
    rng = np.random.default_rng(1)
    names = list(quality.STATISTICS)
    rows = [(int((x[:4] > 0.2).all()), *map(float, x)) for x in rng.random((2000, len(names)))]
    flat = spark.createDataFrame(rows, "label int, " + ", ".join(f"{n} double" for n in names))
    model = quality.fit(flat.selectExpr("label", f"struct({', '.join(names)}) AS `__stats`"))
    assert max(len(rule.tests) for rule, _ in model.weights) == 4
