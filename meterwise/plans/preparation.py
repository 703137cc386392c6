"""Feature preparation and selection."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.operators import features, models, selection
from meterwise.operators.passes import stored
from meterwise.plans.registry import Tables, query, r6


@query(
    "population_scaler",
    """WITH s AS (SELECT avg(p_size) AS a, stddev_pop(p_size) AS b, avg(p_retailprice) AS c, stddev_pop(p_retailprice) AS d FROM part)
    SELECT p_partkey, round((p_size - a) / b, 6) + 0.0 AS p_size, round((p_retailprice - c) / d, 6) + 0.0 AS p_retailprice FROM part, s""",
)
def population_scaler(t: Tables) -> DataFrame:
    scaled = features.PopulationScaler(columns=["p_size", "p_retailprice"]).fit(t.part).transform(t.part)
    return scaled.select("p_partkey", r6("p_size").alias("p_size"), r6("p_retailprice").alias("p_retailprice"))


@query(
    "range_and_quartile_scalers",
    """WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS m, quantile_cont(o_totalprice, 0.75) AS b FROM orders)
    SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) AS ranged, round((o_totalprice - m) / (b - a), 6) + 0.0 AS robust FROM orders, s""",
)
def range_and_quartile_scalers(t: Tables) -> DataFrame:
    both = t.orders.select("o_orderkey", F.col("o_totalprice").alias("ranged"), F.col("o_totalprice").alias("robust"))
    model = Pipeline(stages=[features.RangeScaler(columns=["ranged"]), features.QuartileScaler(columns=["robust"])]).fit(both)
    return model.transform(both).select("o_orderkey", r6("ranged").alias("ranged"), r6("robust").alias("robust"))


@query(
    "one_hot",
    """WITH r AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS i FROM (SELECT DISTINCT p_brand FROM part))
    SELECT p.p_partkey, CAST(CASE WHEN p.p_size > 40 THEN -1 ELSE r.i END AS BIGINT) AS hot FROM part p JOIN r ON p.p_brand = r.p_brand""",
)
def one_hot(t: Tables) -> DataFrame:
    """Position of the 1; a brand not seen in fitting becomes all zeros (-1)."""
    model = features.one_hot(["p_brand"], "v").fit(t.part)
    renamed = F.when(F.col("p_size") > 40, F.lit("never seen")).otherwise(F.col("p_brand"))
    coded = model.transform(t.part.withColumn("p_brand", renamed))
    return coded.select("p_partkey", (F.array_position(vector_to_array("v"), F.lit(1.0)) - 1).alias("hot"))


@query(
    "one_hot_drop_first",
    """WITH r AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 2 AS i FROM (SELECT DISTINCT p_type FROM part)) SELECT p.p_partkey, CAST(CASE WHEN r.i < 0 THEN -1 ELSE r.i END AS BIGINT) AS hot FROM part p JOIN r ON p.p_type = r.p_type""",
)
def one_hot_drop_first(t: Tables) -> DataFrame:
    coded = features.one_hot(["p_type"], "v", drop_first=True).fit(t.part).transform(t.part)
    return coded.select("p_partkey", (F.array_position(vector_to_array("v"), F.lit(1.0)) - 1).alias("hot"))


@query(
    "dummies",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS "o_orderstatus_F", CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O", CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders""",
)
def dummies(t: Tables) -> DataFrame:
    return features.dummies(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus")


@query("label_binarise", "SELECT vec_id, " + ", ".join(f"CAST(label = {i} AS INTEGER) AS is_{i}" for i in range(10)) + " FROM embeddings")
def label_binarise(t: Tables) -> DataFrame:
    return features.binarize_labels(t.embeddings.select("vec_id", "label"), "label").drop("label")


@query(
    "imputers",
    """WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status FROM orders),
    m AS (SELECT priority FROM b WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM b)), 6) AS price, coalesce(priority, (SELECT priority FROM m)) AS priority, coalesce(status, 'missing') AS status FROM b""",
)
def imputers(t: Tables) -> DataFrame:
    holes = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("priority"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("status"),
    )
    stages = [
        features.FillMissing(columns=["price"], strategy="mean"),
        features.FillMissing(columns=["priority"], strategy="most_frequent"),
        features.FillMissing(columns=["status"], strategy="constant", value="missing"),
    ]
    return Pipeline(stages=stages).fit(holes).transform(holes).withColumn("price", r6("price"))


@query("feature_chain")
def feature_chain(t: Tables) -> DataFrame:
    """Imputing, scaling, encoding and a classifier as one pipeline."""
    from pyspark.ml.classification import LogisticRegression

    base = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    stages = [
        features.FillMissing(columns=["o_totalprice"], strategy="mean"),
        features.PopulationScaler(columns=["o_totalprice"]),
        features.one_hot(["o_orderpriority"], "coded"),
        VectorAssembler(inputCols=["o_totalprice", "coded"], outputCol="features"),
        LogisticRegression(labelCol="label", maxIter=20),
    ]
    fitted = Pipeline(stages=stages).fit(base)
    return fitted.transform(base).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query(
    "balanced_weights",
    "SELECT quality, round((SELECT count(*) FROM labels) / (2.0 * count(*)), 6) AS weight, count(*) AS n, round(1.0 / (quality + 1), 6) AS inverse FROM labels GROUP BY 1",
)
def balanced_weights(t: Tables) -> DataFrame:
    weighted = features.balanced_weights(t.labels, "quality").withColumn("inverse", features.inverse_grade_weight(F.col("quality")))
    return weighted.groupBy("quality", r6("weight").alias("weight"), r6("inverse").alias("inverse")).agg(F.count(F.lit(1)).alias("n"))


@query("random_split", "SELECT CAST(3 AS BIGINT) AS parts, count(*) AS n FROM orders")
def random_split(t: Tables) -> DataFrame:
    """Three disjoint parts that together hold every row."""
    parts = features.random_split(t.orders.select("o_orderkey"), "o_orderkey", [0.7, 0.2, 0.1])
    union = parts[0].withColumn("p", F.lit(0))
    for i, part in enumerate(parts[1:], 1):
        union = union.unionByName(part.withColumn("p", F.lit(i)))
    return union.agg(F.count_distinct("p").alias("parts"), F.count_distinct("o_orderkey").alias("n"))


@query(
    "stratified_split",
    "SELECT quality, CAST(round(count(*) * 0.2) AS BIGINT) AS test, count(*) - CAST(round(count(*) * 0.2) AS BIGINT) AS train FROM labels GROUP BY 1",
)
def stratified_split(t: Tables) -> DataFrame:
    split = features.stratified_split(t.labels, "doc_id", "quality", 0.2)
    return split.groupBy("quality").agg(
        F.count(F.when(F.col("is_test"), 1)).alias("test"), F.count(F.when(~F.col("is_test"), 1)).alias("train")
    )


def _numbers(t: Tables) -> DataFrame:
    """Line rows with three derived measures that carry signal."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) + 100 * F.col("l_quantity")).alias("charge"),
    )


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net"]


@query("principal_components")
def principal_components(t: Tables) -> DataFrame:
    scaled = features.PopulationScaler(columns=NUMBERS).fit(_numbers(t)).transform(_numbers(t))
    found = features.pca(scaled, NUMBERS, 3)
    return found["components"].join(F.broadcast(found["explained"]), "component")


@query(
    "principal_scores",
    """WITH c AS (SELECT var_pop(l_quantity) AS aa, var_pop(l_discount) AS bb, var_pop(l_tax) AS cc, covar_pop(l_quantity, l_discount) AS ab,
      covar_pop(l_quantity, l_tax) AS ac, covar_pop(l_discount, l_tax) AS bc FROM lineitem)
    SELECT (SELECT count(*) FROM lineitem) AS n, CAST(0 AS DOUBLE) AS mean_0, CAST(0 AS DOUBLE) AS mean_1, CAST(0 AS DOUBLE) AS covariance, true AS largest_first, true AS below_trace FROM c""",
)
def principal_scores(t: Tables) -> DataFrame:
    """Scores are centred and uncorrelated, the first varies most, and together they vary less than the columns do."""
    columns = ["l_quantity", "l_discount", "l_tax"]
    scores = features.pca(_numbers(t), columns, 2)["scores"].select(F.col("scores")[0].alias("a"), F.col("scores")[1].alias("b"))
    trace = sum(_numbers(t).agg(*[F.var_pop(c) for c in columns]).first())
    return scores.agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("a")).alias("mean_0"), r6(F.avg("b")).alias("mean_1"), r6(F.covar_pop("a", "b")).alias("covariance"),
        (F.var_pop("a") >= F.var_pop("b")).alias("largest_first"), (F.var_pop("a") + F.var_pop("b") <= F.lit(trace * (1 + 1e-9))).alias("below_trace"),
    )


@query(
    "principal_shares_of_two",
    """SELECT CAST(0 AS INTEGER) AS component, round((1 + abs(corr(l_quantity, l_extendedprice))) / 2, 8) AS ratio FROM lineitem
    UNION ALL SELECT 1, round((1 - abs(corr(l_quantity, l_extendedprice))) / 2, 8) FROM lineitem""",
)
def principal_shares_of_two(t: Tables) -> DataFrame:
    """Two scaled columns explain (1 ± |r|) / 2 of their variance."""
    pair = ["l_quantity", "l_extendedprice"]
    scaled = features.PopulationScaler(columns=pair).fit(t.lineitem).transform(t.lineitem)
    return features.pca(scaled, pair, 2)["explained"].select("component", r6("ratio", 8).alias("ratio"))


@query("truncated_svd")
def truncated_svd(t: Tables) -> DataFrame:
    triples = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.avg("l_quantity").alias("q"))
    found = features.truncated_svd(triples, "l_partkey", "l_suppkey", "q", 12)
    return found["row_factors"].select("l_partkey", F.posexplode("factors").alias("component", "value"))


@query("principal_equations", "SELECT CAST(i AS INTEGER) AS component, CAST(0 AS DOUBLE) AS off, CAST(0 AS DOUBLE) AS overlap FROM range(3) r(i)")
def principal_equations(t: Tables) -> DataFrame:
    """Covariances times a component are its variance times the component; components are of length 1 and at right angles."""
    scaled = features.PopulationScaler(columns=NUMBERS).fit(_numbers(t)).transform(_numbers(t))
    found = features.pca(scaled, NUMBERS, 3)
    total = sum(scaled.agg(*[F.var_samp(c) for c in NUMBERS]).first())
    pairs = [(a, b) for a in NUMBERS for b in NUMBERS]
    row = scaled.agg(*[F.covar_samp(a, b) for a, b in pairs]).first()
    covariance = t.literal([(a, b, float(x)) for (a, b), x in zip(pairs, row, strict=True)], "variable string, other string, c double")
    parts = found["components"].join(F.broadcast(found["explained"]), "component").select("component", "variable", "weight", (F.col("ratio") * total).alias("variance"))
    turned = parts.join(covariance, "variable").groupBy("component", F.col("other").alias("variable")).agg(F.sum(F.col("c") * F.col("weight")).alias("turned"))
    off = parts.join(turned, ["component", "variable"]).groupBy("component").agg(F.max(F.abs(F.col("turned") - F.col("variance") * F.col("weight"))).alias("off"))
    two = parts.select("variable", F.col("component").alias("j"), F.col("weight").alias("w"))
    dots = parts.join(two, "variable").groupBy("component", "j").agg((F.sum(F.col("weight") * F.col("w")) - F.first((F.col("component") == F.col("j")).cast("double"))).alias("d"))
    overlap = dots.groupBy("component").agg(F.max(F.abs("d")).alias("overlap"))
    return off.join(overlap, "component").select("component", r6("off", 8).alias("off"), r6("overlap", 8).alias("overlap"))


@query("singular_equations", "SELECT CAST(0 AS DOUBLE) AS off, CAST(0 AS DOUBLE) AS overlap")
def singular_equations(t: Tables) -> DataFrame:
    """Pushing the first factor through the matrix and back multiplies it by its square; different factors are at right angles."""
    triples = stored(t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.avg("l_quantity").alias("q")), "triples")
    found = stored(features.truncated_svd(triples, "l_partkey", "l_suppkey", "q", 12)["row_factors"], "factors")
    first = found.select("l_partkey", F.col("factors")[0].alias("f"))
    there = stored(triples.join(first, "l_partkey").groupBy("l_suppkey").agg(F.sum(F.col("q") * F.col("f")).alias("g")), "there")
    back = stored(triples.join(there, "l_suppkey").groupBy("l_partkey").agg(F.sum(F.col("q") * F.col("g")).alias("h")), "back")
    both = back.join(first, "l_partkey").agg(F.sum(F.col("h") * F.col("h")).alias("hh"), F.sum(F.col("h") * F.col("f")).alias("hf"), F.sum(F.col("f") * F.col("f")).alias("ff"))
    # the share of the pushed factor that is not the factor's square times the factor
    off = F.sqrt(F.greatest(F.lit(0.0), F.col("hh") - 2 * F.col("ff") * F.col("hf") + F.pow("ff", 3))) / F.sqrt("hh")
    cells = found.select("factors", F.posexplode("factors").alias("i", "x")).select("i", "x", F.posexplode("factors").alias("j", "y"))
    dots = cells.groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("d"))
    size = dots.where("i = j").select("i", F.sqrt("d").alias("a"))
    apart = dots.where("i < j").join(size, "i").join(size.select(F.col("i").alias("j"), F.col("a").alias("b")), "j")
    return both.select(r6(off, 4).alias("off")).join(apart.agg(r6(F.max(F.try_divide(F.abs("d"), F.col("a") * F.col("b"))), 6).alias("overlap")))


# ---- selection ----


@query(
    "k_best_regression",
    """SELECT feature, round(f, 4) AS f FROM (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, pow(corr({c}, y), 2) * (count(*) - 2) / (1 - pow(corr({c}, y), 2)) AS f FROM (SELECT *, l_extendedprice * (1 - l_discount) * (1 + l_tax) + 100 * l_quantity AS y FROM lineitem)"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ) + ") ORDER BY f DESC LIMIT 3",
)
def k_best_regression(t: Tables) -> DataFrame:
    scores = selection.f_regression(_numbers(t), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "charge")
    return selection.k_best(scores, "f", 3).select("feature", r6("f", 4).alias("f"))


def _information_sql() -> str:
    shares = "[" + ", ".join(str(i / 16) for i in range(1, 16)) + "]"
    columns = [*NUMBERS, "charge"]
    base = "b AS (SELECT *, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) + 100 * l_quantity AS charge FROM lineitem)"
    edges = ", ".join(f"list_distinct(quantile_cont(CAST({c} AS DOUBLE), {shares})) AS e_{c}" for c in columns)
    codes = ", ".join(f"len(list_filter(e_{c}, lambda x: {c} > x)) AS {c}" for c in columns)
    joint = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, charge AS y, count(*) AS n FROM c GROUP BY 2, 3" for c in NUMBERS)
    return f"""WITH {base}, q AS (SELECT {edges} FROM b), c AS (SELECT {codes} FROM b, q), j AS ({joint}),
    p AS (SELECT feature, n, CAST(sum(n) OVER (PARTITION BY feature) AS DOUBLE) AS t, CAST(sum(n) OVER (PARTITION BY feature, x) AS DOUBLE) AS nx, CAST(sum(n) OVER (PARTITION BY feature, y) AS DOUBLE) AS ny FROM j)
    SELECT feature, round(sum(n / t * ln(n * t / (nx * ny))), 6) AS mutual_information FROM p GROUP BY 1 ORDER BY 2 DESC LIMIT 3"""


@query("k_best_information", _information_sql())
def k_best_information(t: Tables) -> DataFrame:
    best = selection.k_best(selection.mutual_information(_numbers(t), NUMBERS, "charge"), "mutual_information", 3)
    return best.select("feature", r6("mutual_information").alias("mutual_information"))


@query("recursive_elimination")
def recursive_elimination(t: Tables) -> DataFrame:
    scaled = features.PopulationScaler(columns=NUMBERS).fit(_numbers(t)).transform(_numbers(t))
    return selection.recursive_elimination(scaled, NUMBERS, "charge", 2)


@query("recursive_elimination_cv")
def recursive_elimination_cv(t: Tables) -> DataFrame:
    from meterwise.operators.evaluate import time_series_folds

    keyed = _numbers(t).withColumn("row", F.xxhash64(*_numbers(t).columns)).withColumn("order", F.col("l_orderkey"))
    folded = time_series_folds(keyed, "order", "row", 5)
    return selection.recursive_elimination_cv(folded, NUMBERS, "charge", "fold")


@query("select_from_model")
def select_from_model(t: Tables) -> DataFrame:
    scaled = features.PopulationScaler(columns=NUMBERS).fit(_numbers(t)).transform(_numbers(t))
    table = models.with_features(scaled, NUMBERS)
    lasso = models.linear_regression(table, "charge", 50.0, 1.0)
    kept = selection.select_from_model(NUMBERS, lasso.coefficients.toArray(), "nonzero")
    strong = selection.select_from_model(NUMBERS, lasso.coefficients.toArray(), "mean")
    rows = [(c, float(b), c in kept, c in strong) for c, b in zip(NUMBERS, lasso.coefficients)]
    return t.literal(rows, "feature string, coefficient double, nonzero boolean, above_mean boolean")




@query(
    "neighbour_information",
    """WITH s AS (SELECT stddev_pop(p_size) AS a, stddev_pop(p_retailprice) AS b, stddev_pop(p_partkey % 50 + p_size) AS c FROM part),
    p AS (SELECT p_partkey AS i, p_size / a AS y, unnest([{'f': 'p_retailprice', 'x': p_retailprice / b}, {'f': 'mixed', 'x': (p_partkey % 50 + p_size) / c}]) AS u FROM part, s),
    d AS (SELECT p.u.f AS f, p.i, abs(p.u.x - o.u.x) AS dx, abs(p.y - o.y) AS dy FROM p JOIN p o ON p.u.f = o.u.f AND p.i <> o.i),
    r AS (SELECT f, i, min(greatest(dx, dy), 3)[3] * (1 - 1e-10) AS r FROM d GROUP BY 1, 2),
    n AS (SELECT d.f, d.i, count(*) FILTER (WHERE dx <= r + 1e-15) AS nx, count(*) FILTER (WHERE dy <= r + 1e-15) AS ny FROM d JOIN r ON d.f = r.f AND d.i = r.i GROUP BY 1, 2),
    h AS (SELECT 0 AS m, 0.0::DOUBLE AS h UNION ALL SELECT m, sum(1.0::DOUBLE / m) OVER (ORDER BY m) FROM range(1, (SELECT count(*) FROM part)) t(m))
    SELECT n.f AS feature, round(greatest(0, (SELECT h FROM h WHERE m = (SELECT count(*) - 1 FROM part)) + 1.5 - avg(a.h + b.h)), 6) AS mutual_information, count(*) AS n
    FROM n JOIN h a ON a.m = nx JOIN h b ON b.m = ny GROUP BY 1""",
)
def neighbour_information(t: Tables) -> DataFrame:
    """What a part's price, and a mixture with its size, tell about its size."""
    table = t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice", (F.col("p_partkey") % 50 + F.col("p_size")).cast("double").alias("mixed"))
    found = selection.neighbour_information(table, ["p_retailprice", "mixed"], "p_size", "p_partkey", 3)
    return found.select("feature", r6("mutual_information").alias("mutual_information"), "n")
