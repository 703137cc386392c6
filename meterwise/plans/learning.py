"""Supervised models on embeddings, line items and labelled documents."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.operators import boosting, evaluate, features, models, penalty_paths
from meterwise.operators.neighbors import knn_votes, nearest_neighbors
from meterwise.plans.registry import Tables, query, r6
from meterwise.session import durable


def vectors(t: Tables) -> DataFrame:
    """(id, label, features, vector) of the embeddings."""
    return t.embeddings.select(
        F.col("vec_id").alias("id"), "label", features.as_vector(F.col("embedding")).alias("features"), F.col("embedding").cast("array<double>").alias("vector")
    )


DOC_FEATURES = ["n_chars", "words", "long_words", "digits", "lines", "words_per_line"]


def documents(t: Tables) -> DataFrame:
    """Labelled documents with counts taken over the whole texts."""
    text = F.col("text")
    words, lines = F.size(F.split(text, r"\s+")).cast("double"), F.size(F.split(text, "\n")).cast("double")
    measured = t.documents.select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"), words.alias("words"), F.regexp_count(text, F.lit(r"\p{L}{8,}")).cast("double").alias("long_words"),
        F.regexp_count(text, F.lit(r"\d")).cast("double").alias("digits"), lines.alias("lines"), (words / lines).alias("words_per_line"), "source", "lang",
    )
    return durable(t.labels.join(measured, "doc_id"))


def scaled_documents(t: Tables) -> DataFrame:
    base = documents(t)
    return features.PopulationScaler(columns=DOC_FEATURES).fit(base).transform(base)


def line_table(t: Tables) -> DataFrame:
    base = t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    scaled = features.PopulationScaler(columns=["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).fit(base).transform(base)
    assembled = VectorAssembler(inputCols=["l_quantity", "l_extendedprice", "l_discount", "l_tax"], outputCol="features").transform(scaled)
    return evaluate.shuffled_folds(assembled, "l_orderkey", 5)


def _report(scored: DataFrame, label: str = "label") -> DataFrame:
    return evaluate.class_report(scored, label, "prediction")


@query(
    "linear_regression",
    "SELECT round(regr_intercept(o_totalprice, o_custkey), 4) AS intercept, round(regr_slope(o_totalprice, o_custkey), 6) AS slope, round(regr_r2(o_totalprice, o_custkey), 8) AS r2 FROM orders",
)
def linear_regression(t: Tables) -> DataFrame:
    table = models.with_features(t.orders.select("o_custkey", "o_totalprice"), ["o_custkey"])
    model = models.linear_regression(table, "o_totalprice")
    row = (float(model.intercept), float(model.coefficients[0]), float(model.summary.r2))
    return t.literal([row], "intercept double, slope double, r2 double").select(
        r6("intercept", 4).alias("intercept"), r6("slope").alias("slope"), r6("r2", 8).alias("r2")
    )


@query("linear_regression_many")
def linear_regression_many(t: Tables) -> DataFrame:
    table = line_table(t)
    model = models.linear_regression(table, "net")
    return models.coefficient_table(model, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], t.lineitem)


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("linear_regression_residuals", " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(0 AS DOUBLE) AS correlation" for c in LINE_FEATURES))
def linear_regression_residuals(t: Tables) -> DataFrame:
    """Normal equations: the residuals of a least-squares fit are uncorrelated with every feature."""
    table = line_table(t)
    scored = models.linear_regression(table, "net").transform(table).withColumn("residual", F.col("net") - F.col("prediction"))
    found = scored.agg(*[F.corr(c, "residual").alias(c) for c in LINE_FEATURES])
    return found.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), r6(c, 5).alias("correlation")) for c in LINE_FEATURES])))


@query(
    "linear_regression_two",
    """WITH m AS (SELECT l_quantity AS a, l_discount AS b, l_extendedprice * (1 - l_discount) AS y FROM lineitem),
    s AS (SELECT var_pop(a) AS saa, var_pop(b) AS sbb, covar_pop(a, b) AS sab, covar_pop(a, y) AS say, covar_pop(b, y) AS sby, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM m),
    k AS (SELECT (sbb * say - sab * sby) / (saa * sbb - sab * sab) AS x, (saa * sby - sab * say) / (saa * sbb - sab * sab) AS z, * FROM s)
    SELECT 'l_quantity' AS term, round(x, 4) AS coefficient FROM k UNION ALL SELECT 'l_discount', round(z, 4) FROM k UNION ALL SELECT 'Intercept', round(my - x * ma - z * mb, 4) FROM k""",
)
def linear_regression_two(t: Tables) -> DataFrame:
    base = t.lineitem.select("l_quantity", "l_discount", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    model = models.linear_regression(models.with_features(base, ["l_quantity", "l_discount"]), "net")
    return models.coefficient_table(model, ["l_quantity", "l_discount"], t.lineitem).withColumn("coefficient", r6("coefficient", 4))


@query(
    "ridge_one_feature",
    """WITH s AS (SELECT covar_pop(l_quantity, l_extendedprice) * count(*) AS sxy, var_pop(l_quantity) * count(*) AS sxx, avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem)
    SELECT a.alpha, round(sxy / (sxx + a.alpha), 6) AS coefficient, round(my - sxy / (sxx + a.alpha) * mx, 4) AS intercept FROM s, (VALUES (0.001::DOUBLE), (1::DOUBLE), (10000::DOUBLE)) a(alpha)""",
)
def ridge_one_feature(t: Tables) -> DataFrame:
    from meterwise.operators.selection import ridge_path as path

    found = path(t.lineitem, ["l_quantity"], "l_extendedprice", [0.001, 1.0, 10000.0])
    return found.select("alpha", r6(F.col("coefficients")[0]).alias("coefficient"), r6("intercept", 4).alias("intercept"))


@query("ridge_path")
def ridge_path(t: Tables) -> DataFrame:
    from meterwise.operators.selection import ridge_path as path

    alphas = [0.001, 0.01, 0.1, 0.3, 0.7, 1.0, 10.0, 50.0, 100.0]
    return path(line_table(t), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "net", alphas, "fold")


MIXES = (0.1, 0.25, 0.5, 0.7, 0.75, 0.8, 0.85, 0.9, 0.99)
PENALTIES = (0.001, 0.01, 0.02, 0.025, 0.05, 0.1, 0.25, 0.5, 0.8, 1.0)


def ten_folds(t: Tables) -> DataFrame:
    """Line items with scaled features and ten folds."""
    return line_table(t).withColumn("fold", F.pmod("l_orderkey", F.lit(10)))


def eight_folds(t: Tables) -> DataFrame:
    """Like `ten_folds` with eight, the target in thousands, so that the listed penalties matter."""
    return line_table(t).withColumn("fold", F.pmod("l_orderkey", F.lit(8))).withColumn("net", F.col("net") / 1000)


@query("lasso_search")
def lasso_search(t: Tables) -> DataFrame:
    """The whole error path: 100 penalties by 10 folds, the mean over folds and the chosen penalty."""
    paths = durable(penalty_paths.penalty_paths(ten_folds(t), LINE_FEATURES, "net", "fold"))
    means = penalty_paths.penalty_scores(paths).select("k", F.col("mse").alias("mean_mse"), (F.col("rank") == 1).alias("chosen"))
    return paths.where("fold IS NOT NULL").join(means, "k").select("k", "alpha", "fold", "mse", "mean_mse", "chosen")


@query("lasso_chosen")
def lasso_chosen(t: Tables) -> DataFrame:
    """Coefficients at the chosen penalty."""
    paths = durable(penalty_paths.penalty_paths(ten_folds(t), LINE_FEATURES, "net", "fold"))
    return penalty_paths.best_penalty(paths, LINE_FEATURES)


@query("lasso_optimality", "SELECT CAST(f AS INTEGER) AS fold, CAST(k AS INTEGER) AS k, CAST(0 AS DOUBLE) AS excess FROM range(-1, 10) a(f), range(1, 101) b(k)")
def lasso_optimality(t: Tables) -> DataFrame:
    """Every fit of the path (fold -1: all rows) against the optimality conditions on the rows."""
    table = ten_folds(t)
    paths = penalty_paths.penalty_paths(table, LINE_FEATURES, "net", "fold")
    found = penalty_paths.optimality(paths, table, LINE_FEATURES, "net", "fold")
    return found.select(F.coalesce("fold", F.lit(-1)).alias("fold"), "k", r6("excess", 7).alias("excess"))


@query("elastic_net_search")
def elastic_net_search(t: Tables) -> DataFrame:
    """Mean error over 8 folds of 9 ratios by 10 penalties, with the coefficients on all rows."""
    paths = durable(penalty_paths.penalty_paths(eight_folds(t), LINE_FEATURES, "net", "fold", MIXES, PENALTIES))
    return penalty_paths.penalty_scores(paths)


@query(
    "elastic_net_optimality",
    f"SELECT m AS l1_ratio, CAST(f AS INTEGER) AS fold, CAST(k AS INTEGER) AS k, CAST(0 AS DOUBLE) AS excess FROM (SELECT unnest([{', '.join(f'{m}::DOUBLE' for m in MIXES)}]) AS m), range(-1, 8) a(f), range(1, {len(PENALTIES) + 1}) b(k)",
)
def elastic_net_optimality(t: Tables) -> DataFrame:
    table = eight_folds(t)
    paths = penalty_paths.penalty_paths(table, LINE_FEATURES, "net", "fold", MIXES, PENALTIES)
    found = penalty_paths.optimality(paths, table, LINE_FEATURES, "net", "fold")
    return found.select("l1_ratio", F.coalesce("fold", F.lit(-1)).alias("fold"), "k", r6("excess", 7).alias("excess"))


# with one feature the fit has a closed form: the covariance, shrunk by the l1 part, over the variance plus the l2 part
_FOLD_SUMS = """f AS (SELECT l_orderkey % {folds} AS fold, l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem),
    h AS (SELECT fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy FROM f GROUP BY 1),
    a AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM h),
    r AS (SELECT h.*, (a.sxy - h.sxy) / (a.n - h.n) - (a.sx - h.sx) / (a.n - h.n) * ((a.sy - h.sy) / (a.n - h.n)) AS cxy,
      (a.sxx - h.sxx) / (a.n - h.n) - power((a.sx - h.sx) / (a.n - h.n), 2) AS cxx, (a.sx - h.sx) / (a.n - h.n) AS mx, (a.sy - h.sy) / (a.n - h.n) AS my FROM h, a),
    b AS (SELECT p.*, fold, n, sx, sy, sxx, sxy, syy, sign(cxy) * greatest(abs(cxy) - alpha * ratio, 0) / (cxx + alpha * (1 - ratio)) AS b, mx, my FROM r, p),
    e AS (SELECT ratio, k, alpha, fold, (syy - 2 * b * sxy - 2 * (my - b * mx) * sy + b * b * sxx + 2 * b * (my - b * mx) * sx + n * power(my - b * mx, 2)) / n AS mse FROM b)"""


def _one_feature(t: Tables, folds: int) -> DataFrame:
    return t.lineitem.select(F.pmod("l_orderkey", F.lit(folds)).alias("fold"), "l_quantity", (F.col("l_extendedprice") / 1000).alias("y"))


@query(
    "lasso_path_one_feature",
    f"""WITH p AS (SELECT 1.0::DOUBLE AS ratio, CAST(k AS INTEGER) AS k, abs((SELECT covar_pop(l_quantity, l_extendedprice / 1000) FROM lineitem)) * power(0.001::DOUBLE, (k - 1) / 99.0) AS alpha FROM range(1, 101) b(k)),
    {_FOLD_SUMS.format(folds=10)}, m AS (SELECT k, avg(mse) AS mean_mse FROM e GROUP BY 1)
    SELECT e.k, round(alpha, 6) AS alpha, CAST(fold AS INTEGER) AS fold, round(mse, 6) AS mse, round(mean_mse, 6) AS mean_mse, mean_mse = (SELECT min(mean_mse) FROM m) AS chosen FROM e JOIN m USING (k)""",
)
def lasso_path_one_feature(t: Tables) -> DataFrame:
    """The 10-fold error path and its choice, against the closed form."""
    paths = durable(penalty_paths.penalty_paths(_one_feature(t, 10), ["l_quantity"], "y", "fold"))
    means = penalty_paths.penalty_scores(paths).select("k", F.col("mse").alias("mean_mse"), (F.col("rank") == 1).alias("chosen"))
    found = paths.where("fold IS NOT NULL").join(means, "k")
    return found.select("k", r6("alpha").alias("alpha"), "fold", r6("mse").alias("mse"), r6("mean_mse").alias("mean_mse"), "chosen")


@query(
    "elastic_net_one_feature",
    f"""WITH p AS (SELECT ratio, CAST(row_number() OVER (PARTITION BY ratio ORDER BY alpha DESC) AS INTEGER) AS k, alpha FROM (SELECT unnest([{', '.join(f'{m}::DOUBLE' for m in MIXES)}]) AS ratio), (SELECT unnest([{', '.join(f'{a}::DOUBLE' for a in PENALTIES)}]) AS alpha)),
    {_FOLD_SUMS.format(folds=8)}, m AS (SELECT ratio, k, alpha, avg(mse) AS mse FROM e GROUP BY ALL)
    SELECT ratio AS l1_ratio, alpha, round(mse, 6) AS mse, CAST(row_number() OVER (ORDER BY mse, ratio DESC, k) AS INTEGER) AS rank FROM m""",
)
def elastic_net_one_feature(t: Tables) -> DataFrame:
    """The mean error of the whole grid and its ranks, against the closed form."""
    paths = penalty_paths.penalty_paths(_one_feature(t, 8), ["l_quantity"], "y", "fold", MIXES, PENALTIES)
    return penalty_paths.penalty_scores(durable(paths)).select("l1_ratio", "alpha", r6("mse").alias("mse"), "rank")


@query("logistic_weighted")
def logistic_weighted(t: Tables) -> DataFrame:
    table = models.with_features(features.balanced_weights(scaled_documents(t), "quality"), DOC_FEATURES)
    scored = models.logistic_regression(table, "quality", 1.0, "weight").transform(table)
    return _report(scored, "quality")


@query("logistic_score_equations", " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(0 AS DOUBLE) AS gradient" for c in ["Intercept", *DOC_FEATURES]))
def logistic_score_equations(t: Tables) -> DataFrame:
    """At the weighted, penalised optimum the gradient of the likelihood is 0 in every coefficient."""
    from pyspark.ml.functions import vector_to_array

    table = models.with_features(features.balanced_weights(scaled_documents(t), "quality"), DOC_FEATURES)
    model = models.logistic_regression(table, "quality", 1.0, "weight")
    error = F.col("weight") * (vector_to_array("probability")[1] - F.col("quality"))
    total = F.sum("weight")
    sums = model.transform(table).agg(
        (F.sum(error) / total).alias("Intercept"),
        *[((F.sum(error * F.col(c)) + F.lit(float(b))) / total).alias(c) for c, b in zip(DOC_FEATURES, model.coefficients.toArray(), strict=True)],
    )
    names = ["Intercept", *DOC_FEATURES]
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), r6(c, 2).alias("gradient")) for c in names])))


@query("logistic_multinomial")
def logistic_multinomial(t: Tables) -> DataFrame:
    table = vectors(t)
    return _report(models.logistic_regression(table, "label", 10.0).transform(table))


@query("svm_kernels")
def svm_kernels(t: Tables) -> DataFrame:
    table = models.with_features(scaled_documents(t), DOC_FEATURES)
    result = None
    for kernel in ("linear", "poly", "rbf"):
        model, mapped = models.svm(table, "quality", kernel)
        report = _report(model.transform(mapped), "quality").withColumn("kernel", F.lit(kernel))
        result = report if result is None else result.unionByName(report)
    return result


@query("multilayer_perceptron")
def multilayer_perceptron(t: Tables) -> DataFrame:
    table = vectors(t)
    return _report(models.mlp(table, "label", [16], 10).transform(table))


def _knn_sql(distance: str) -> str:
    return f"""WITH e AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    d AS (SELECT a.id AS query, b.id AS other, b.label, {distance} AS d FROM e a JOIN e b ON a.id <> b.id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY d, other) AS r FROM d),
    k AS (SELECT query, CAST(k AS INTEGER) AS k, label, count(*) AS n FROM r, range(1, 41) t(k) WHERE r <= k GROUP BY 1, 2, 3)
    SELECT query, k, arg_min(label, struct_pack(a := -n, b := label)) AS prediction FROM k GROUP BY 1, 2"""


def _knn(t: Tables, metric: str) -> DataFrame:
    table = vectors(t)
    near = nearest_neighbors(table, table, 40, metric=metric, exclude_same_key=True)
    return knn_votes(near, table, "id", "label", list(range(1, 41)))


@query("knn_euclidean", _knn_sql("list_distance(a.v, b.v)"))
def knn_euclidean(t: Tables) -> DataFrame:
    return _knn(t, "euclidean")


@query("knn_manhattan", _knn_sql("list_sum(list_transform(list_zip(a.v, b.v), lambda x: abs(x[1] - x[2])))"))
def knn_manhattan(t: Tables) -> DataFrame:
    return _knn(t, "manhattan")


@query("knn_chebyshev", _knn_sql("list_max(list_transform(list_zip(a.v, b.v), lambda x: abs(x[1] - x[2])))"))
def knn_chebyshev(t: Tables) -> DataFrame:
    return _knn(t, "chebyshev")


@query("decision_tree")
def decision_tree(t: Tables) -> DataFrame:
    table = vectors(t)
    model = models.decision_tree(table, "label", 5, "entropy")
    ranked = models.importances(model, [f"x{i}" for i in range(64)], t.embeddings)
    score = evaluate.accuracy(model.transform(table), "label", "prediction")
    return ranked.filter("importance > 0").withColumn("accuracy", F.lit(score))


@query("decision_tree_leaves", "SELECT label, count(*) AS n, CAST(0 AS DOUBLE) AS off FROM embeddings GROUP BY 1")
def decision_tree_leaves(t: Tables) -> DataFrame:
    """A leaf's probabilities are the shares of the classes among the rows that reach it."""
    table = vectors(t)
    scored = models.decision_tree(table, "label", 5, "entropy").transform(table)
    leaf = scored.select("label", F.to_json(vector_to_array("rawPrediction")).alias("leaf"), vector_to_array("probability").alias("p"))
    sizes = leaf.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))
    own = leaf.groupBy("leaf", "label").agg(F.count(F.lit(1)).alias("n"), F.first(F.col("p")[F.col("label").cast("int")]).alias("p"))
    return own.join(sizes, "leaf").groupBy("label").agg(F.sum("n").alias("n"), r6(F.max(F.abs(F.col("n") / F.col("size") - F.col("p"))), 9).alias("off"))


@query("random_forest")
def random_forest(t: Tables) -> DataFrame:
    table = vectors(t)
    return _report(models.random_forest(table, "label", 30, 8).transform(table))


@query("bagging_out_of_bag")
def bagging_out_of_bag(t: Tables) -> DataFrame:
    found = models.bagging_oob(vectors(t), "label", "id", trees=8, depth=6)
    return found["oob"].groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")).withColumn("oob_score", F.lit(found["oob_score"]))


@query("adaboost")
def adaboost(t: Tables) -> DataFrame:
    table = vectors(t)
    boosted = models.adaboost(table, "label", rounds=6, depth=5)
    return _report(models.adaboost_predict(boosted, table))


@query("gradient_boosting")
def gradient_boosting(t: Tables) -> DataFrame:
    """Boosted trees with a held-out part for early stopping."""
    table = models.with_features(evaluate.shuffled_folds(documents(t), "doc_id", 5), DOC_FEATURES)
    table = table.withColumn("held_out", F.col("fold") == 0)
    model = models.gradient_boosting(table, "quality", "held_out", rounds=15, depth=3)
    return _report(model.transform(table), "quality")


@query("boosting_importances")
def boosting_importances(t: Tables) -> DataFrame:
    table = models.with_features(documents(t), DOC_FEATURES)
    model = models.gradient_boosting(table, "quality", rounds=8, depth=3)
    return boosting.importance_by_type(model, DOC_FEATURES, t.documents)


@query("boosting_fold_curves")
def boosting_fold_curves(t: Tables) -> DataFrame:
    """Mean and deviation over 3 folds of the losses of up to 100 rounds, until 15 rounds bring nothing."""
    table = evaluate.shuffled_folds(models.with_features(documents(t), DOC_FEATURES), "doc_id", 3)
    return boosting.curve_summary(durable(boosting.fold_curves(table, "quality", "fold", rounds=100, depth=3)), 15)


@query("boosting_margins", "SELECT quality, count(*) AS n, CAST(0 AS DOUBLE) AS off FROM labels JOIN documents USING (doc_id) GROUP BY 1")
def boosting_margins(t: Tables) -> DataFrame:
    """The last of the staged margins is the model's own raw prediction, and each class has all its rows."""
    table = models.with_features(documents(t), DOC_FEATURES)
    model = models.gradient_boosting(table, "quality", rounds=8, depth=3)
    scored = model.transform(table).withColumn("margins", boosting.staged_margins(model))
    off = F.abs(F.element_at("margins", -1) - vector_to_array("rawPrediction")[1])
    return scored.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), r6(F.max(off), 8).alias("off"))


@query("boosting_first_leaves", "SELECT count(*) AS n, CAST(sum(2 * quality - 1) AS BIGINT) AS signs, CAST(0 AS DOUBLE) AS off FROM labels JOIN documents USING (doc_id)")
def boosting_first_leaves(t: Tables) -> DataFrame:
    """The first tree fits the classes as -1 and 1: a leaf's value is the mean of its rows."""
    table = models.with_features(documents(t), DOC_FEATURES)
    model = models.gradient_boosting(table, "quality", rounds=3, depth=3)
    leaves = table.select((2 * F.col("quality") - 1).cast("long").alias("sign"), boosting.leaf_of_round(model, 0).alias("leaf"))
    each = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum("sign").alias("signs"))
    return each.agg(F.sum("n").alias("n"), F.sum("signs").alias("signs"), r6(F.max(F.abs(F.col("leaf") - F.col("signs") / F.col("n"))), 8).alias("off"))


@query("hard_voting")
def hard_voting(t: Tables) -> DataFrame:
    table = vectors(t)
    fitted = [
        models.decision_tree(table, "label", 5),
        models.random_forest(table, "label", 10, 5),
        LogisticRegression(labelCol="label", maxIter=20).fit(table),
    ]
    voted = models.hard_vote([models.predict(m, table, "id") for m in fitted], "id")
    return _report(table.select("id", "label").join(voted, "id"))


@query(
    "hard_vote_rules",
    """WITH v AS (SELECT event_id, unnest([event_id % 3, event_id % 4, event_id % 5]) AS p FROM events), n AS (SELECT event_id, p, count(*) AS n FROM v GROUP BY 1, 2)
    SELECT event_id, arg_min(p, struct_pack(a := -n, b := p)) AS prediction FROM n GROUP BY 1""",
)
def hard_vote_rules(t: Tables) -> DataFrame:
    """Votes of three rules for every event; ties go to the lowest label."""
    return models.hard_vote([t.events.select("event_id", (F.col("event_id") % k).alias("prediction")) for k in (3, 4, 5)], "event_id")


@query("stacking")
def stacking(t: Tables) -> DataFrame:
    table = evaluate.shuffled_folds(models.with_features(scaled_documents(t), DOC_FEATURES), "doc_id", 5)
    bases = [DecisionTreeClassifier(labelCol="quality", maxDepth=3), RandomForestClassifier(labelCol="quality", numTrees=8, seed=42)]
    stack = models.stacking(bases, table, "quality", "doc_id", "fold")
    return _report(models.stacking_predict(stack, table), "quality")


@query(
    "probability_rules",
    """SELECT argmax, flag, count(*) AS n FROM (SELECT CAST(CASE WHEN p >= 0.5 THEN 0 ELSE 1 END AS INTEGER) AS argmax, CAST(1 - p >= 0.3 AS INTEGER) AS flag
    FROM (SELECT (event_id % 101) / 101.0 AS p FROM events)) GROUP BY 1, 2""",
)
def probability_rules(t: Tables) -> DataFrame:
    """Class by largest probability, and by a threshold."""
    p = (F.col("event_id") % 101) / 101.0
    staged = t.events.select(F.array(p, 1 - p).alias("p"))
    return staged.groupBy(models.argmax_class(F.col("p")).alias("argmax"), models.at_least(F.col("p")[1], 0.3).alias("flag")).agg(F.count(F.lit(1)).alias("n"))


@query("forest_probabilities")
def forest_probabilities(t: Tables) -> DataFrame:
    table = vectors(t)
    scored = models.random_forest(table, "label", 10, 5).transform(table)
    return scored.select("id", F.array_max(vector_to_array("probability")).alias("top_probability"), "prediction")
