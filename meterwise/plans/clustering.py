"""Clustering of sites, parts and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.operators import agglomerative, cluster
from meterwise.plans.registry import Tables, query, r6


def sites(t: Tables) -> DataFrame:
    return t.events.select("event_id", (F.col("user_id") % 10).cast("double").alias("x"), F.floor(F.col("user_id") / 10).cast("double").alias("y"))


def parts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), (F.col("p_retailprice") / 20).alias("price"))


@query("site_clusters")
def site_clusters(t: Tables) -> DataFrame:
    found = cluster.kmeans_sites(sites(t), ["x", "y"], 5)
    return found["labels"].groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"))


@query("site_assignment", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS wrong, CAST(5 AS BIGINT) AS clusters FROM events")
def site_assignment(t: Tables) -> DataFrame:
    """Every event is in the cluster whose centre is nearest to it."""
    found = cluster.kmeans_sites(sites(t), ["x", "y"], 5, scale=False)
    squares = [F.pow(F.col("x") - float(c[0]), 2) + F.pow(F.col("y") - float(c[1]), 2) for c in found["centers"]]
    own = F.element_at(F.array(*squares), F.col("cluster") + 1)
    wrong = F.count_if(own > F.least(*squares) + 1e-9)
    return found["labels"].agg(F.count(F.lit(1)).alias("n"), wrong.alias("wrong"), F.count_distinct("cluster").alias("clusters"))


@query("elbow")
def elbow(t: Tables) -> DataFrame:
    points = cluster.assemble(cluster.weighted_sites(sites(t), ["x", "y"]), ["x", "y"])
    return cluster.elbow(points, [2, 3, 4, 5, 6, 7])


@query("hierarchical_scan")
def hierarchical_scan(t: Tables) -> DataFrame:
    """Ward clusters of the parts for 2 to 14 clusters with their exact silhouettes."""
    return agglomerative.hierarchical_scan(parts(t), ["size", "price"], list(range(2, 15)))


@query("ward_merges")
def ward_merges(t: Tables) -> DataFrame:
    return agglomerative.ward_tree(parts(t), ["size", "price"]).merge_table(t.part)


@query("ward_total", "SELECT round(var_pop(p_size) * count(*) + var_pop(p_retailprice / 20) * count(*), 4) AS squares FROM part")
def ward_total(t: Tables) -> DataFrame:
    """Half the squared heights of all merges, and what lies inside the leaves, are the squares about the mean."""
    tree = agglomerative.ward_tree(parts(t), ["size", "price"])
    total = tree.merge_table(t.part).agg((F.coalesce(F.sum(F.col("height") * F.col("height")), F.lit(0.0)) / 2).alias("h"))
    return total.select(r6(F.col("h") + F.lit(tree.within()), 4).alias("squares"))


@query("ward_squares_by_k", "SELECT CAST(k AS INTEGER) AS k, CAST(k AS INTEGER) AS clusters, CAST(0 AS DOUBLE) AS difference FROM range(2, 15) r(k)")
def ward_squares_by_k(t: Tables) -> DataFrame:
    """The squares inside the clusters of every k, taken from the labelled rows, against the heights of the merges made."""
    ks = list(range(2, 15))
    tree = agglomerative.ward_tree(parts(t), ["size", "price"])
    rows = tree.labelled(parts(t), ks).select("size", "price", F.posexplode("clusters").alias("at", "cluster"))
    inside = rows.groupBy("at", "cluster").agg((F.count(F.lit(1)) * (F.var_pop("size") + F.var_pop("price"))).alias("q"))
    found = inside.groupBy("at").agg(F.sum("q").alias("q"), F.count(F.lit(1)).cast("int").alias("clusters"))
    steps = tree.merge_table(t.part)
    made = t.literal([(i, k, len(tree.features) - k) for i, k in enumerate(ks)], "at int, k int, steps int")
    heights = made.join(steps, F.col("step") <= F.col("steps")).groupBy("at", "k").agg((F.sum(F.col("height") * F.col("height")) / 2).alias("h"))
    return found.join(heights, "at").select("k", "clusters", r6((F.col("q") - F.col("h") - F.lit(tree.within())) / F.col("q"), 6).alias("difference"))


@query(
    "silhouette_euclidean",
    """WITH s AS (SELECT stddev_samp(p_size) AS a, stddev_samp(p_retailprice / 20) AS b FROM part),
    p AS (SELECT p_partkey AS i, CAST(p_size // 20 AS INTEGER) AS c, p_size / a AS x, p_retailprice / 20 / b AS y FROM part, s),
    d AS (SELECT p.i, p.c AS own, o.c, sum(sqrt((p.x - o.x) ** 2 + (p.y - o.y) ** 2)) AS t, count(*) AS n FROM p, p o GROUP BY ALL),
    w AS (SELECT i, min(t / (n - 1)) FILTER (WHERE c = own) AS a, min(t / n) FILTER (WHERE c <> own) AS b FROM d GROUP BY 1)
    SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM w""",
)
def silhouette_euclidean(t: Tables) -> DataFrame:
    """Exact silhouette with standardised plain distances."""
    labelled = parts(t).withColumn("cluster", F.floor(F.col("size") / 20).cast("int"))
    found = agglomerative.silhouette(labelled, ["size", "price"], "cluster")
    return t.literal([(found,)], "silhouette double").select(r6("silhouette").alias("silhouette"))


@query(
    "silhouette",
    """WITH s AS (SELECT stddev_pop(p_size) AS a, stddev_pop(p_retailprice / 20) AS b, avg(p_size) AS ma, avg(p_retailprice / 20) AS mb FROM part),
    p AS (SELECT p_partkey, CAST(p_size > 25 AS INTEGER) AS c, (p_size - ma) / a AS x, (p_retailprice / 20 - mb) / b AS y FROM part, s),
    g AS (SELECT c AS g, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(x * x + y * y) AS q FROM p GROUP BY 1),
    d AS (SELECT p.p_partkey, p.c = g.g AS own, (p.x * p.x + p.y * p.y - 2 * (p.x * g.mx + p.y * g.my) + g.q) * CASE WHEN p.c = g.g THEN g.n / (g.n - 1.0) ELSE 1 END AS d FROM p, g),
    w AS (SELECT p_partkey, min(d) FILTER (WHERE own) AS a, min(d) FILTER (WHERE NOT own) AS b FROM d GROUP BY 1) SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM w""",
)
def silhouette(t: Tables) -> DataFrame:
    labelled = parts(t).withColumn("cluster", (F.col("size") > 25).cast("int"))
    found = t.literal([(cluster.silhouette(labelled, ["size", "price"], "cluster"),)], "silhouette double")
    return found.select(r6("silhouette").alias("silhouette"))


@query("mean_shift")
def mean_shift(t: Tables) -> DataFrame:
    points = parts(t)
    width = cluster.estimate_bandwidth(points, ["size", "price"], 0.3)
    found = cluster.mean_shift(points, ["size", "price"], width)
    return found["labels"].groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("size"), F.avg("price").alias("price"))


@query(
    "quantise",
    "SELECT p_partkey, CASE WHEN p_size > 25 THEN 38.0 ELSE 13.0 END::DOUBLE AS size, CASE WHEN p_size > 25 THEN 60.5 ELSE 59.5 END::DOUBLE AS price FROM part",
)
def quantise(t: Tables) -> DataFrame:
    labelled = parts(t).withColumn("cluster", (F.col("size") > 25).cast("int"))
    return cluster.quantise(labelled, ["size", "price"], "cluster", [(13.0, 59.5), (38.0, 60.5)]).drop("cluster")
