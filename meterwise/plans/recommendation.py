"""Neighbourhood recommendation: customers rate parts by the mean quantity they bought."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.operators import features, recommend
from meterwise.plans.registry import Tables, query, r6

USER = 7
TRIPLES = "m AS (SELECT o_custkey AS u, l_partkey AS i, avg(l_quantity) AS r FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"


def triples(t: Tables) -> DataFrame:
    bought = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i"), F.col("l_quantity").alias("r")
    )
    return recommend.rating_triples(bought, "u", "i", "r")


@query("rating_triples", f"WITH {TRIPLES} SELECT u, i, round(r, 6) AS r FROM m")
def rating_triples(t: Tables) -> DataFrame:
    return triples(t).withColumn("r", r6("r"))


def _pairs_sql(entity: str, feature: str) -> str:
    return f"""WITH {TRIPLES}, n AS (SELECT {entity} AS e, sqrt(sum(r * r)) AS norm FROM m GROUP BY 1), w AS (SELECT {entity} AS e, {feature} AS f, r / norm AS v FROM m JOIN n ON {entity} = e),
    p AS (SELECT x.e AS a, y.e AS b, sum(x.v * y.v) AS s FROM w x JOIN w y ON x.f = y.f AND x.e <> y.e GROUP BY 1, 2),
    k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(s, 12) DESC, b) AS rank FROM p) SELECT a, b, round(s, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 3"""


@query("similar_users", _pairs_sql("u", "i"))
def similar_users(t: Tables) -> DataFrame:
    return recommend.nearest_entities(triples(t), "u", "i", "r", 3).withColumn("similarity", r6("similarity"))


@query("similar_items", _pairs_sql("i", "u"))
def similar_items(t: Tables) -> DataFrame:
    return recommend.nearest_entities(triples(t), "i", "u", "r", 3).withColumn("similarity", r6("similarity"))


@query(
    "predict_from_users",
    f"""WITH {TRIPLES}, n AS (SELECT u, sqrt(sum(r * r)) AS norm FROM m GROUP BY 1), own AS (SELECT i, r FROM m WHERE u = {USER}),
    s AS (SELECT m.u, sum(m.r * own.r) / any_value(n.norm) / (SELECT norm FROM n WHERE u = {USER}) AS s FROM m JOIN own ON m.i = own.i JOIN n ON m.u = n.u WHERE m.u <> {USER} GROUP BY 1),
    top AS (SELECT * FROM s ORDER BY round(s, 12) DESC, u LIMIT 3), p AS (SELECT m.i, sum(m.r * top.s) AS x FROM m JOIN top ON m.u = top.u GROUP BY 1)
    SELECT d.i, round(coalesce(p.x, 0) / (SELECT sum(abs(s)) FROM top), 6) AS prediction FROM (SELECT DISTINCT i FROM m WHERE i NOT IN (SELECT i FROM own)) d LEFT JOIN p ON d.i = p.i""",
)
def predict_from_users(t: Tables) -> DataFrame:
    return recommend.predict_for_user(triples(t), "u", "i", "r", USER, 3).withColumn("prediction", r6("prediction"))


@query(
    "predict_from_items",
    f"""WITH {TRIPLES}, n AS (SELECT i AS e, sqrt(sum(r * r)) AS norm FROM m GROUP BY 1), w AS (SELECT i AS e, u AS f, r / norm AS v FROM m JOIN n ON i = e),
    p AS (SELECT x.e AS a, y.e AS b, sum(x.v * y.v) AS s FROM w x JOIN w y ON x.f = y.f AND x.e <> y.e GROUP BY 1, 2),
    k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(s, 12) DESC, b) AS rank FROM p), own AS (SELECT i, r FROM m WHERE u = {USER})
    SELECT k.a AS i, round(sum(k.s * coalesce(own.r, 0)) / sum(abs(k.s)), 6) AS prediction FROM k LEFT JOIN own ON k.b = own.i WHERE rank <= 3 AND k.a NOT IN (SELECT i FROM own) GROUP BY 1""",
)
def predict_from_items(t: Tables) -> DataFrame:
    return recommend.predict_from_items(triples(t), "u", "i", "r", USER, 3).withColumn("prediction", r6("prediction"))


@query("predict_from_factors")
def predict_from_factors(t: Tables) -> DataFrame:
    """Item neighbours in the space of 12 singular vectors."""
    table = triples(t)
    factors = features.truncated_svd(table, "i", "u", "r", 12)["row_factors"]
    pairs = recommend.factor_similarities(factors, "i", 12, top=3)
    return recommend.predict_from_items(table, "u", "i", "r", USER, 3, pairs)


@query("liked_items", f"WITH {TRIPLES} SELECT u, i, round(r, 6) AS r FROM m WHERE u = {USER} AND r >= 4")
def liked_items(t: Tables) -> DataFrame:
    return recommend.liked_items(triples(t), "u", "i", "r", USER, 4).withColumn("r", r6("r"))
