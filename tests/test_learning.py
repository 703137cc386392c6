import math

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from meterwise.operators import boosting, cluster, evaluate, features, models, neighbors, recommend, resample, search


def vectors(spark, n=300, width=3, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    data = [(i, [float(x) for x in rng.normal(size=width)]) for i in range(n)]
    data += [(n + i, [0.25] * width) for i in range(copies)]
    return spark.createDataFrame(data, "id long, vector array<double>"), data


def brute(data, queries, k, metric, exclude):
    out = []
    for q, v in queries:
        gaps = []
        for p, w in data:
            if exclude and p == q:
                continue
            d = np.abs(np.array(v) - np.array(w))
            gaps.append((math.sqrt((d * d).sum()) if metric == "euclidean" else d.sum() if metric == "manhattan" else d.max(), p))
        out += [(q, p, round(float(d), 9), r + 1) for r, (d, p) in enumerate(sorted(gaps)[:k])]
    return sorted(out)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev"])
def test_neighbors_match_brute_force(spark, monkeypatch, metric):
    monkeypatch.setattr(neighbors, "POINTS_PER_CHUNK", 40)  # many cells, chunks and blocks
    monkeypatch.setattr(neighbors, "QUERIES_PER_BLOCK", 50)
    df, data = vectors(spark, copies=120)
    found = neighbors.nearest_neighbors(df, df, 4, metric=metric, exclude_same_key=True)
    got = sorted((r.query, r.neighbor, round(r.distance, 9), r.rank) for r in found.collect())
    assert got == brute(data, data, 4, metric, True)


def test_queries_are_not_copied_per_cell(spark, monkeypatch):
    """A query is in one row of one block, however many cells it visits."""
    monkeypatch.setattr(neighbors, "POINTS_PER_CHUNK", 10)
    monkeypatch.setattr(neighbors, "QUERIES_PER_BLOCK", 20)
    df, data = vectors(spark, n=200, width=8)
    found = neighbors.nearest_neighbors(df, df, 5, exclude_same_key=True)
    plan = found._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInPandas" not in plan and "FlatMapGroupsInPandas" in plan
    assert sorted((r.query, r.neighbor, round(r.distance, 9), r.rank) for r in found.collect()) == brute(data, data, 5, "euclidean", True)


@pytest.mark.parametrize("metric", ["manhattan", "chebyshev"])
@pytest.mark.parametrize("scale", [1e-35, 1.0, 1e6, 1e35])
def test_candidates_hold_the_nearest(metric, scale):
    """Single precision chooses candidates; far from its range double precision does. Equal points are all candidates."""
    rng = np.random.default_rng(2)
    a, b = scale * rng.normal(size=(50, 6)), scale * (1 + rng.normal(size=(300, 6)))
    b[200:280] = b[199]
    exact = neighbors._distances(a, b, metric)
    row, near = neighbors._candidates(a, b, metric, np.full(50, np.inf), 4)
    found = set(zip(row.tolist(), near.tolist(), strict=True))
    kth = np.sort(exact, axis=1)[:, 3]
    assert {(i, j) for i, j in zip(*np.nonzero(exact <= kth[:, None]), strict=True)} <= found
    assert len(found) < 50 * 100


def test_neighbors_of_other_points(spark):
    df, data = vectors(spark, n=50)
    other, queries = vectors(spark, n=20, seed=9)
    found = neighbors.nearest_neighbors(other, df, 100)
    got = sorted((r.query, r.neighbor, round(r.distance, 9), r.rank) for r in found.collect())
    assert got == brute(data, queries, 100, "euclidean", False)


def test_nearer_points_are_counted(spark, monkeypatch):
    """Rows of the own group below a squared distance, with equal rows and ties, against all pairs."""
    monkeypatch.setattr(neighbors, "POINTS_PER_CHUNK", 16)
    rng = np.random.default_rng(12)
    x, group = np.round(rng.normal(size=(150, 3)), 1), rng.choice(["a", "b"], 150)
    x[100:120], group[100:120] = x[99], "a"
    points = spark.createDataFrame([(i, str(group[i]), [float(v) for v in x[i]]) for i in range(150)], "id long, group string, vector array<double>")
    square = {(i, j): float(((x[i] - x[j]) ** 2).sum()) for i in range(150) for j in rng.choice(150, 3) if i != j}
    pairs = [(i, int(j), str(group[i]), [float(v) for v in x[i]], d) for (i, j), d in square.items()]
    pairs = spark.createDataFrame(pairs, "id long, other long, group string, vector array<double>, square double")
    found = neighbors.count_nearer(pairs, points)
    assert "Join" not in found._jdf.queryExecution().toString()
    got = {(r.id, r.other): r.nearer for r in found.collect()}
    gaps = [[sum((x[i, c] - x[j, c]) * (x[i, c] - x[j, c]) for c in range(3)) for j in range(150)] for i in range(150)]
    assert got == {(i, j): sum(gaps[i][k] < d for k in range(150) if k != i and group[k] == group[i]) for (i, j), d in square.items()}


def test_votes_prefer_the_lowest_label(spark):
    near = spark.createDataFrame([(0, 1, 0.1, 1), (0, 2, 0.2, 2)], "query long, neighbor long, distance double, rank int")
    labels = spark.createDataFrame([(1, 5), (2, 3)], "id long, label int")
    assert rows(neighbors.knn_votes(near, labels, "id", "label", [1, 2]), "k", "prediction") == [(1, 5), (2, 3)]


@pytest.mark.parametrize("entries, hot", [(2_000_000, 250_000), (40, 9)])
def test_cosine_pairs_of_any_keys(spark, monkeypatch, entries, hot):
    """Text keys, negative values, entities too large for a block, top partners with ties."""
    monkeypatch.setattr(recommend, "ENTITIES_PER_BLOCK", 7)
    monkeypatch.setattr(recommend, "ENTRIES_PER_BLOCK", entries)
    monkeypatch.setattr(recommend, "HOT_ENTRIES", hot)
    rng = np.random.default_rng(5)
    m = rng.integers(-3, 4, size=(26, 15)) * (rng.random((26, 15)) < 0.35)
    m[3], m[4], m[9] = m[8], rng.integers(1, 4, 15), rng.integers(1, 4, 15)
    name = [f"user {i:02}" for i in range(26)]
    rows_of = [(name[u], f"item {i}", float(m[u, i])) for u in range(26) for i in range(15)]
    triples = spark.createDataFrame([*rows_of, (None, "item 1", 2.0), ("user 05", None, 2.0), ("user 06", "item 99", float("nan"))], "u string, i string, r double")
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    unit = m / np.where(norm == 0, 1, norm)
    expected = unit @ unit.T
    for top in (None, 4):
        found = {}
        for r in recommend.cosine_pairs(triples, "u", "i", "r", top).collect():
            found.setdefault(r.a, {})[r.b] = r.similarity
        for a in range(26):
            partners = sorted((b for b in range(26) if b != a and abs(expected[a, b]) > 1e-14), key=lambda b: (-round(expected[a, b], 12), b))[:top]
            got = {b: s for b, s in found.get(name[a], {}).items() if abs(s) > 1e-14}
            assert set(got) == {name[b] for b in partners} or top and len(found.get(name[a], {})) == top
            assert all(got[name[b]] == pytest.approx(expected[a, b]) for b in partners if name[b] in got)


def blocked_triples(spark, monkeypatch):
    """A sparse random table, and settings by which it is cut into many blocks, runs and products."""
    monkeypatch.setattr(recommend, "ENTITIES_PER_BLOCK", 5)
    monkeypatch.setattr(recommend, "ENTRIES_AT_ONCE", 20, raising=False)
    monkeypatch.setattr(recommend, "PRODUCTS_AT_ONCE", 30, raising=False)
    rng = np.random.default_rng(17)
    m = rng.integers(1, 6, size=(60, 45)) * (rng.random((60, 45)) < 0.1)
    return m, spark.createDataFrame([(u, i, float(m[u, i])) for u in range(60) for i in range(45) if m[u, i]], "u long, i long, r double")


def best_partners(m, top):
    unit = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    s = unit @ unit.T
    return sorted((a, b) for a in range(len(m)) for b in sorted((b for b in range(len(m)) if b != a and s[a, b] > 0), key=lambda b: (-round(s[a, b], 12), b))[:top])


def test_entries_are_not_copied_per_block(spark, monkeypatch):
    """The product of items reads each stored entry; none is sent once per block."""
    m, triples = blocked_triples(spark, monkeypatch)
    pairs = recommend.cosine_pairs(triples, "i", "u", "r", 3)
    assert "explode" not in pairs._jdf.queryExecution().toString().lower()
    assert sorted(rows(pairs, "a", "b")) == best_partners(m.T, 3)


def test_users_are_not_copied_per_block(spark, monkeypatch):
    """Also where some users have too many entries for a block and meet the others in a join."""
    m, triples = blocked_triples(spark, monkeypatch)
    near = recommend.nearest_entities(triples, "u", "i", "r", 3)
    assert "explode" not in near._jdf.queryExecution().toString().lower()
    assert sorted(rows(near, "a", "b")) == best_partners(m, 3)
    monkeypatch.setattr(recommend, "HOT_ENTRIES", 6)
    assert sorted(rows(recommend.nearest_entities(triples, "u", "i", "r", 3), "a", "b")) == best_partners(m, 3)


def test_cosine_pairs_match_numpy(spark, monkeypatch):
    monkeypatch.setattr(recommend, "ENTITIES_PER_BLOCK", 7)
    monkeypatch.setattr(recommend, "HOT_ENTRIES", 14)
    rng = np.random.default_rng(4)
    m = rng.integers(0, 6, size=(30, 20)) * (rng.random((30, 20)) < 0.4)
    m[:, 0] = 3  # a feature every entity has
    triples = spark.createDataFrame([(u, i, float(m[u, i])) for u in range(30) for i in range(20) if m[u, i]], "u long, i long, r double")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    expected = unit @ unit.T
    found = recommend.cosine_pairs(triples, "u", "i", "r").collect()
    assert len(found) == 30 * 29
    assert all(r.similarity == pytest.approx(expected[r.a, r.b]) for r in found)
    # prediction for one user from the three most similar users
    order = sorted((u for u in range(30) if u != 7), key=lambda u: (-round(expected[7, u], 12), u))[:3]
    weight = expected[7, order]
    got = {r.i: r.prediction for r in recommend.predict_for_user(triples, "u", "i", "r", 7, 3).collect()}
    assert set(got) == {i for i in range(20) if m[7, i] == 0}
    assert all(p == pytest.approx(weight @ m[order, i] / weight.sum()) for i, p in got.items())


def test_item_predictions_match_numpy(spark):
    rng = np.random.default_rng(8)
    m = rng.integers(1, 6, size=(25, 12)) * (rng.random((25, 12)) < 0.5)
    triples = spark.createDataFrame([(u, i, float(m[u, i])) for u in range(25) for i in range(12) if m[u, i]], "u long, i long, r double")
    unit = m / np.linalg.norm(m, axis=0, keepdims=True)
    s = unit.T @ unit
    got = {r.i: r.prediction for r in recommend.predict_from_items(triples, "u", "i", "r", 7, 3).collect()}
    for i in range(12):
        if m[7, i] == 0:
            near = sorted((j for j in range(12) if j != i), key=lambda j: (-round(s[i, j], 12), j))[:3]
            assert got[i] == pytest.approx(s[i, near] @ m[7, near] / s[i, near].sum())


def test_item_predictions_of_many_blocks(spark, monkeypatch):
    m, triples = blocked_triples(spark, monkeypatch)
    found = recommend.predict_from_items(triples, "u", "i", "r", 7, 3)
    assert "explode" not in found._jdf.queryExecution().toString().lower()
    got = {r.i: r.prediction for r in found.collect()}
    near = {}
    for a, b in best_partners(m.T, 3):
        near.setdefault(a, []).append(b)
    unit = m / np.maximum(np.linalg.norm(m, axis=0, keepdims=True), 1e-300)
    s = unit.T @ unit
    assert set(got) == {i for i in near if m[7, i] == 0}
    assert all(got[i] == pytest.approx(s[i, near[i]] @ m[7, near[i]] / s[i, near[i]].sum()) for i in got)


def test_truncated_svd(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(40, 5)) @ np.diag([9, 6, 4, 2, 1]) @ rng.normal(size=(5, 30))
    triples = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(40) for j in range(30)], "i long, j long, v double")
    found = features.truncated_svd(triples, "i", "j", "v", k=3, extra=4)
    u, s, _ = np.linalg.svd(m)
    assert list(found["singular_values"]) == pytest.approx(list(s[:3]), rel=1e-8)
    factors = np.array([r.factors for r in found["row_factors"].orderBy("i").collect()])
    assert np.abs(factors) == pytest.approx(np.abs(u[:, :3] * s[:3]), abs=1e-6)


def test_truncated_svd_of_blocks(spark, monkeypatch):
    """Text keys, several blocks, columns and entries some at a time; vectors are never joined with entries."""
    for name, n in (("ENTRIES_PER_BLOCK", 200), ("VECTORS_AT_ONCE", 7), ("PRODUCTS_AT_ONCE", 50)):
        monkeypatch.setattr(features.subspace, name, n) if hasattr(features, "subspace") else None
    rng = np.random.default_rng(6)
    m = rng.normal(size=(45, 4)) @ np.diag([9, 6, 4, 2]) @ rng.normal(size=(4, 35)) * (rng.random((45, 35)) < 0.6)
    triples = [(f"row {i:02}", f"column {j}", float(m[i, j])) for i in range(45) for j in range(35) if m[i, j]]
    triples = spark.createDataFrame([*triples, (None, "column 1", 4.0), ("row 01", None, 4.0), ("row 01", "column 1", None)], "i string, j string, v double")
    found = features.truncated_svd(triples, "i", "j", "v", k=3, extra=20, rounds=8)
    u, s, _ = np.linalg.svd(m)
    assert list(found["singular_values"]) == pytest.approx(list(s[:3]), rel=1e-6)
    factors = {r.i: r.factors for r in found["row_factors"].collect()}
    assert sorted(factors) == [f"row {i:02}" for i in range(45)]
    assert np.abs([factors[i] for i in sorted(factors)]) == pytest.approx(np.abs(u[:, :3] * s[:3]), abs=1e-4)
    assert features.truncated_svd(triples.limit(0), "i", "j", "v", k=2, extra=1)["row_factors"].count() == 0


def test_singular_equations_write_what_is_pushed(spark, monkeypatch):
    """Each pushed vector is written before the next join, so shuffle files of one step at a time are on disk."""
    from meterwise.plans import QUERIES, preparation

    written, kept = [], getattr(preparation, "stored", None)
    monkeypatch.setattr(preparation, "stored", lambda df, name: written.append(name) or kept(df, name), raising=False)
    found = rows(QUERIES["singular_equations"](spark, "/root/testdata/sf0.001"))
    assert written == ["triples", "factors", "there", "back"]
    assert found[0][1] == 0.0


def test_factor_similarities_of_many_tiles(spark, monkeypatch):
    """Best partners by dense products, chosen in single precision, are those of double precision; equal rows go by id."""
    monkeypatch.setattr(recommend, "ENTITIES_PER_BLOCK", 400)
    rng = np.random.default_rng(13)
    m = rng.normal(size=(1300, 6)) * [5, 3, 2, 1, 1, 1]
    m[700:760] = m[40:100]
    m[900:904] = m[899] * (1 + 1e-9)
    factors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "i long, factors array<double>")
    pairs = recommend.factor_similarities(factors, "i", 6, top=3)
    assert "generate" not in pairs._jdf.queryExecution().toString().lower()  # no copies per tile
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = np.round(unit @ unit.T, 12)
    np.fill_diagonal(near, -2)
    for a, b, similarity in rows(pairs, "a", "b", "similarity"):
        assert similarity == pytest.approx(unit[a] @ unit[b], abs=1e-12)
        assert (near[a] > near[a, b] + 1e-12).sum() < 3
    assert pairs.groupBy("a").count().filter("count = 3").count() == 1300


def blobs(spark, n=240, classes=3):
    rng = np.random.default_rng(11)
    data = [(i, i % classes, float(rng.normal(4 * (i % classes))), float(rng.normal(-3 * (i % classes)))) for i in range(n)]
    df = spark.createDataFrame(data, "id long, label int, x double, y double")
    return VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df.coalesce(1))


def test_learners_beat_the_majority(spark):
    df = blobs(spark).cache()
    oob = models.bagging_oob(df, "label", "id", trees=6, depth=4)
    assert oob["oob_score"] > 0.85
    boosted = models.adaboost(df, "label", rounds=4, depth=2)
    assert evaluate.accuracy(models.adaboost_predict(boosted, df), "label", "prediction") > 0.9


def test_stacking_and_machines(spark):
    df = blobs(spark, 120).cache()
    folded = evaluate.shuffled_folds(df, "id", 2)
    stack = models.stacking([DecisionTreeClassifier(labelCol="label", maxDepth=3), LogisticRegression(labelCol="label")], folded, "label", "id", "fold")
    assert evaluate.accuracy(models.stacking_predict(stack, df), "label", "prediction") > 0.9
    for kernel in ("poly", "rbf"):
        model, mapped = models.svm(df, "label", kernel, gamma=0.1)
        assert evaluate.accuracy(model.transform(mapped), "label", "prediction") > 0.85
    binary = df.withColumn("label", (F.col("label") == 1).cast("int")).withColumn("held", F.col("id") % 4 == 0)
    gbt = models.gradient_boosting(binary, "label", "held", rounds=8, depth=2)
    table = boosting.importance_by_type(gbt, ["x", "y"], df).collect()
    assert sum(r.importance for r in table) == pytest.approx(1) and sum(r.weight for r in table) > 0
    assert all(r.total_gain == pytest.approx(r.gain * r.weight) and r.total_cover == pytest.approx(r.cover * r.weight) for r in table)


def test_boosting_curves_over_folds(spark):
    """Losses of every round and fold are those of the fitted models, by their own evaluation."""
    rng = np.random.default_rng(30)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + 0.8 * rng.normal(size=300) > 0).astype(int)
    rows_ = [(*map(float, r), int(c), i % 3) for i, (r, c) in enumerate(zip(x, y, strict=True))] + [(1.0, 2.0, 3.0, None, 0), (1.0, 2.0, 3.0, 1, None)]
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(spark.createDataFrame(rows_, "a double, b double, c double, y int, fold int"))
    curves = boosting.fold_curves(df, "y", "fold", rounds=12, depth=2, step=0.5).cache()
    found = {(r.fold, r.round): r for r in curves.collect()}
    assert set(found) == {(f, k) for f in range(3) for k in range(1, 13)}
    clean = df.dropna(subset=["y", "fold"])
    model = models.gradient_boosting(clean.where("fold <> 1"), "y", None, 12, 2, 0.5)
    for part, loss, error in (("fold = 1", "test_loss", "test_error"), ("fold <> 1", "train_loss", "train_error")):
        own = model.evaluateEachIteration(clean.where(part))
        assert [found[1, k][loss] for k in range(1, 13)] == pytest.approx([v / 2 for v in own])
        wrong = 1 - evaluate.accuracy(model.transform(clean.where(part)), "y", "prediction")
        assert found[1, 12][error] == pytest.approx(wrong)
    means = [np.mean([found[f, k].test_loss for f in range(3)]) for k in range(1, 13)]
    for patience in (1, 2, 50):
        best, last = 0, next((k for k in range(12) if k - int(np.argmin(means[: k + 1])) >= patience), 11)
        best = int(np.argmin(means[: last + 1]))
        summary = boosting.curve_summary(curves, patience).orderBy("round").collect()
        assert [r.round for r in summary] == list(range(1, best + 2)) and [r.best for r in summary] == [False] * best + [True]
        assert [r.test_mean for r in summary] == pytest.approx(means[: best + 1])
    assert boosting.fold_curves(df.limit(0), "y", "fold").count() == 0


def test_boosting_weights_follow_the_formula(spark):
    # depth 1 on one feature: the first tree misses a known share of the rows
    data = [(i, float(i), int(i >= 6) if i not in (0, 11) else int(i < 6)) for i in range(12)]
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame(data, "id long, x double, label int"))
    boosted = models.adaboost(df, "label", rounds=1, depth=1)
    assert boosted["errors"][0] == pytest.approx(2 / 12)
    assert boosted["alphas"][0] == pytest.approx(math.log((1 - 2 / 12) / (2 / 12)))


def test_hard_vote_ties(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 1.0)], "id int, prediction double")
    b = spark.createDataFrame([(1, 1.0), (2, 1.0)], "id int, prediction double")
    assert rows(models.hard_vote([a, b], "id")) == [(1, 1.0), (2, 1.0)]


def test_pca_scores_are_centred(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3)) @ np.diag([3, 2, 1]) + 5
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    found = features.pca(df, ["a", "b", "c"], 2)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    shares = [r.ratio for r in found["explained"].orderBy("component").collect()]
    assert shares == pytest.approx(list(values[:2] / values.sum()))
    scores = np.array([r.scores for r in found["scores"].orderBy("id").collect()])
    assert scores.mean(0) == pytest.approx([0, 0], abs=1e-9) and scores.var(0, ddof=1) == pytest.approx(values[:2])


def test_scaler_survives_saving(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    model = features.PopulationScaler(columns=["a", "b"]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    from meterwise.sources.files import load_model

    assert rows(load_model(spark, str(tmp_path / "m")).transform(df)) == [(-1.0, 0.0), (1.0, 0.0)]


def test_mean_shift_finds_separate_modes(spark):
    rng = np.random.default_rng(2)
    data = [(float(rng.normal(c[0], 0.3)), float(rng.normal(c[1], 0.3)), k) for k, c in enumerate([(0, 0), (5, 5), (0, 5)]) for _ in range(60)]
    df = spark.createDataFrame(data, "x double, y double, k int")
    found = cluster.mean_shift(df, ["x", "y"], 1.5)
    assert found["centers"].count() == 3
    groups = found["labels"].groupBy("k").agg(F.count_distinct("cluster").alias("c")).collect()
    assert all(r.c == 1 for r in groups)


def test_elbow_and_sites(spark):
    df = spark.createDataFrame([(x + dx, y, 1) for x, y in [(0.0, 0.0), (10.0, 0.0)] for dx in (0.0, 0.1) for _ in range(50)], "x double, y double, n int")
    labels = cluster.kmeans_sites(df, ["x", "y"], 2)["labels"]
    assert labels.groupBy("cluster").count().count() == 2 and labels.count() == 200
    table = cluster.elbow(cluster.assemble(df, ["x", "y"]), [2, 3]).collect()
    assert table[0].distortion == pytest.approx(0.05) and isinstance(KMeans(), KMeans)


def test_folds(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(53)], "id long, y int")
    sizes = [r["count"] for r in evaluate.contiguous_folds(df, "id", "id", 5).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [11, 11, 11, 10, 10]
    sizes = [r["count"] for r in evaluate.time_series_folds(df, "id", "id", 5).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [13, 8, 8, 8, 8, 8]
    strat = evaluate.stratified_folds(df, "y", "id", 5).groupBy("y", "fold").count().collect()
    ones = sorted(r["count"] for r in strat if r.y == 1)
    assert ones == [1, 1, 1, 1, 2] and max(r["count"] for r in strat if r.y == 0) - min(r["count"] for r in strat if r.y == 0) <= 1


def imbalanced(spark, n=100):
    rng = np.random.default_rng(42)
    data = [(i, int(rng.random() < 0.3), float(rng.normal()), float(rng.integers(0, 5))) for i in range(n)]
    return spark.createDataFrame(data, "id long, target int, f1 double, f2 double")


def test_resampling_sizes_and_bounds(spark):
    df = imbalanced(spark)
    sizes = {r.target: r["count"] for r in df.groupBy("target").count().collect()}
    large, small = max(sizes.values()), min(sizes.values())
    assert {r["count"] for r in resample.oversample(df, "target", "id").groupBy("target").count().collect()} == {large}
    assert {r["count"] for r in resample.undersample(df, "target", "id").groupBy("target").count().collect()} == {small}
    made = resample.smote(df, "target", "id", ["f1", "f2"], 3)
    assert {r["count"] for r in made.groupBy("target").count().collect()} == {large}
    limits = df.filter("target = 1").agg(F.min("f1"), F.max("f1")).first()
    fresh = made.filter("synthetic").collect()
    assert len(fresh) == large - small and all(limits[0] <= r.f1 <= limits[1] for r in fresh)
    assert rows(made) == rows(resample.smote(df.repartition(7), "target", "id", ["f1", "f2"], 3))


def test_smote_of_several_classes_with_text_keys(spark):
    rng = np.random.default_rng(21)
    sizes = {"many": 40, "some": 13, "few": 2}
    points = {f"{c} {i:02}": (c, rng.normal(size=2) + 3 * j) for j, (c, n) in enumerate(sizes.items()) for i in range(n)}
    df = spark.createDataFrame([(name, c, float(x[0]), float(x[1])) for name, (c, x) in points.items()], "id string, y string, f1 double, f2 double")
    made = resample.smote(df, "y", "id", ["f1", "f2"], 3, trace=True)
    assert {r.y: r["count"] for r in made.groupBy("y").count().collect()} == dict.fromkeys(sizes, 40)
    for r in made.filter("synthetic").collect():
        (c, a), (d, b) = points[r.from_key], points[r.to_key]
        assert r.id is None and c == d == r.y and r.from_key != r.to_key and 0 <= r.gap <= 1
        assert np.allclose([r.f1, r.f2], a + r.gap * (b - a))
        nearer = [n for n, (e, x) in points.items() if e == c and n != r.from_key and ((x - a) ** 2).sum() < ((b - a) ** 2).sum()]
        assert len(nearer) < 3
    with pytest.raises(ValueError):
        resample.smote(df.filter("y <> 'few' OR id = 'few 00'"), "y", "id", ["f1", "f2"])


@pytest.mark.parametrize("wanted", [1, 7, 60])
def test_upper_bounds_of_neighbour_distances(wanted):
    rng = np.random.default_rng(22)
    counts = np.array([3, 0, 9, 1, *rng.integers(0, 6, 40)])
    starts = np.concatenate([[0], np.cumsum(counts)])
    close = np.concatenate([np.sort(rng.random(n)) for n in counts])
    d = rng.random((30, len(counts)))
    found = neighbors._upper_bounds(d, starts, close, wanted)
    every = np.sort(np.concatenate([d[:, [c]] + close[starts[c] : starts[c + 1]] for c in range(len(counts))], axis=1), axis=1)
    assert (found >= every[:, wanted - 1] - 1e-12).all() and np.isfinite(found).all()


def test_cross_validated_resampling(spark):
    df = imbalanced(spark)
    estimator = LogisticRegression(labelCol="target", maxIter=5)
    found = resample.cross_validate_resampling(df, "target", "id", ["f1", "f2"], estimator, folds=3).collect()
    assert {r.resampler for r in found} == {"SMOTE", "Oversampling", "Undersampling"} and all(0 <= r.f1 <= 1 for r in found)
    found = resample.cross_validate_threshold(df, "target", "id", ["f1", "f2"], estimator, [0.3, 0.5, 0.7], folds=3).collect()
    assert all(r.threshold in (0.3, 0.5, 0.7) and 0 <= r.f1 <= 1 for r in found)
    with pytest.raises(ValueError):
        resample.cross_validate_resampling(df.limit(0), "target", "id", ["f1", "f2"], estimator)


def test_search_comparison(spark):
    df = evaluate.shuffled_folds(models.with_features(imbalanced(spark), ["f1", "f2"]), "id", 3).cache()
    grid = {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 1.0]}
    found = search.compare_searches("logistic", LogisticRegression(labelCol="target", maxIter=5), grid, df, df, "target", "fold").collect()
    assert [r.method for r in found] == ["grid", "random", "bayes"] and all(r.test_metric is not None for r in found)
    bad = search.compare_searches("logistic", LogisticRegression(labelCol="target"), {"nonsense": [1]}, df, df, "target", "fold")
    assert bad.count() == 0
    with pytest.raises(ValueError):
        search.compare_searches("x", KMeans(), grid, df, df, "target", "fold")
    from pyspark.ml.regression import LinearRegression

    found = search.compare_searches("line", LinearRegression(labelCol="f1"), {"fitIntercept": [True, False]}, df, df, "f1", "fold").collect()
    assert {r.metric for r in found} == {"mean_squared_error"} and all(r.test_metric >= 0 for r in found)


def test_ranking_curves(spark):
    data = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.4), (0, 0.2), (0, 0.1)]
    df = spark.createDataFrame(data, "y int, s double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / 9
    assert evaluate.roc_auc(df, "y", "s").first().auc == pytest.approx(auc)
    best = evaluate.best_thresholds(df, "y", "s").first()
    assert (best.threshold, best.f1) == (0.4, pytest.approx(6 / 7))
    scan = resample.threshold_scores(df, "y", "s", [0.0, 0.4, 0.85]).orderBy("threshold").collect()
    assert [r.f1 for r in scan] == pytest.approx([6 / 9, 6 / 7, 2 / 4])


def test_report(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0), (2, 0.0)], "y int, p double")
    found = {r["class"]: r for r in evaluate.class_report(df, "y", "p").collect()}
    assert set(found) == {"0", "1", "2"}
    assert found["1"].precision == pytest.approx(2 / 3) and found["1"].recall == 1 and found["2"].f1 == 0
    assert found["0"].specificity == pytest.approx(2 / 3) and found["0"].geo == pytest.approx(math.sqrt(0.5 * 2 / 3))
    averages = {r.average: r for r in evaluate.report_averages(evaluate.class_report(df, "y", "p")).collect()}
    assert averages["macro"].recall == pytest.approx(0.5) and averages["weighted"].recall == pytest.approx(3 / 5)


def test_many_copies_are_made_by_several_tasks(spark, monkeypatch):
    df = spark.createDataFrame([(i, int(i == 0)) for i in range(101)], "id long, y int")
    monkeypatch.setattr(resample, "COPIES_PER_TASK", 7)
    more = resample.oversample(df, "y", "id")
    assert {r["count"] for r in more.groupBy("y").count().collect()} == {100}
    assert more.filter("y = 1").select("copy").distinct().count() == 100


def test_hierarchical_clustering_finds_every_count(spark):
    from meterwise.operators.agglomerative import hierarchical_scan

    spots = [(x, y) for x in (0.0, 10.0) for y in (0.0, 10.0)]
    df = spark.createDataFrame([(x + i % 5 * 0.1, y + i % 7 * 0.1) for i in range(70) for x, y in spots], "x double, y double")
    found = {r.k: (r.clusters, r.silhouette) for r in hierarchical_scan(df, ["x", "y"], [2, 3, 4]).collect()}
    assert [found[k][0] for k in (2, 3, 4)] == [2, 3, 4] and found[4][1] > 0.95 and found[4][1] > found[2][1]
