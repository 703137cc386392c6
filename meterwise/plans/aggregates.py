"""Profiles, pivots, distributions and anomaly rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.operators import analytics, profile
from meterwise.operators.joins import semi_join_values
from meterwise.operators.ranking import quantiles
from meterwise.plans.registry import Tables, long, query, r6

HOLED = "(SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders)"


def holed(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_totalprice")).alias("price"),
    )


@query(
    "group_statistics",
    """SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS mean, max(value) AS largest FROM events GROUP BY 1""",
)
def group_statistics(t: Tables) -> DataFrame:
    return analytics.group_apply(
        t.events, ["event_type"], n=F.count(F.lit(1)), total=r6(F.sum("value"), 4), mean=r6(F.avg("value")), largest=F.max("value")
    )


@query("group_non_null_counts", f"SELECT priority, count(o_orderkey) AS o_orderkey, count(price) AS price FROM {HOLED} WHERE priority IS NOT NULL GROUP BY 1")
def group_non_null_counts(t: Tables) -> DataFrame:
    return profile.non_null_counts(holed(t), ["priority"])


@query(
    "nested_combinations",
    """SELECT l_suppkey, count(*) AS combinations, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2, 3)
    GROUP BY 1 HAVING count(*) > 1""",
)
def nested_combinations(t: Tables) -> DataFrame:
    return profile.nested_combinations(t.lineitem, "l_suppkey", ["l_returnflag", "l_linestatus"])


@query(
    "dependency_check",
    """SELECT 'c_nationkey' AS side, CAST(c_nationkey AS VARCHAR) AS value, count(DISTINCT c_mktsegment) AS partners FROM customer GROUP BY 1, 2 HAVING count(DISTINCT c_mktsegment) > 1
    UNION ALL SELECT 'c_mktsegment', c_mktsegment, count(DISTINCT c_nationkey) FROM customer GROUP BY 1, 2 HAVING count(DISTINCT c_nationkey) > 1""",
)
def dependency_check(t: Tables) -> DataFrame:
    return profile.dependency_violations(t.customer, "c_nationkey", "c_mktsegment")


@query(
    "general_info",
    f"""SELECT 'o_orderkey' AS "column", 'bigint' AS type, count(o_orderkey) AS non_null, count(*) AS rows FROM {HOLED}
    UNION ALL SELECT 'priority', 'string', count(priority), count(*) FROM {HOLED} UNION ALL SELECT 'price', 'double', count(price), count(*) FROM {HOLED}""",
)
def general_info(t: Tables) -> DataFrame:
    return profile.general_info(holed(t)).select("column", "type", "non_null", "rows")


@query(
    "missing_profile",
    f"""WITH h AS (SELECT priority, price FROM {HOLED}), c AS (SELECT count(*) AS n, count(*) - count(priority) AS a, count(*) - count(price) AS b,
      count(*) FILTER (WHERE priority IS NULL OR price IS NULL) AS any_, count(*) FILTER (WHERE priority IS NULL AND price IS NULL) AS all_ FROM h)
    SELECT 'missing_percent' AS metric, NULL::VARCHAR AS "column", round(CAST(100.0 * (a + b) AS DOUBLE) / (2 * n), 2) AS value FROM c
    UNION ALL SELECT 'rows_any_missing', NULL, CAST(any_ AS DOUBLE) FROM c UNION ALL SELECT 'rows_all_missing', NULL, CAST(all_ AS DOUBLE) FROM c
    UNION ALL SELECT 'column_missing_percent', 'priority', round(CAST(100.0 * a AS DOUBLE) / n, 2) FROM c
    UNION ALL SELECT 'column_missing_percent', 'price', round(CAST(100.0 * b AS DOUBLE) / n, 2) FROM c""",
)
def missing_profile(t: Tables) -> DataFrame:
    return profile.missing_profile(holed(t), ["priority", "price"])


@query(
    "duplicate_counts",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS beyond_first, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS all_repeated FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def duplicate_counts(t: Tables) -> DataFrame:
    return profile.duplicate_counts(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_groups",
    f"""WITH h AS (SELECT o.o_orderkey, h.priority, o.o_orderstatus, CAST(o.o_custkey % 50 AS BIGINT) AS c FROM orders o JOIN {HOLED} h ON o.o_orderkey = h.o_orderkey),
    g AS (SELECT priority, o_orderstatus, c, min(o_orderkey) AS group_key, count(*) AS group_rows FROM h GROUP BY 1, 2, 3 HAVING count(*) > 1)
    SELECT g.group_key, g.group_rows, h.o_orderkey FROM h JOIN g ON h.priority IS NOT DISTINCT FROM g.priority AND h.o_orderstatus = g.o_orderstatus AND h.c = g.c""",
)
def duplicate_groups(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("priority"), "o_orderstatus", (F.col("o_custkey") % 50).alias("c")
    )
    return profile.duplicate_groups(rows, "o_orderkey")


@query(
    "duplicate_documents",
    """SELECT g.group_key, g.n AS group_rows, d.doc_id FROM documents d JOIN (SELECT text, min(doc_id) AS group_key, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1) g ON d.text = g.text""",
)
def duplicate_documents(t: Tables) -> DataFrame:
    """Exact copies over whole texts."""
    return profile.duplicate_groups(t.documents.select("doc_id", "text"), "doc_id")


@query(
    "variable_info",
    """WITH u AS (SELECT 'l_returnflag' AS "column", l_returnflag AS value, NULL::DOUBLE AS num FROM lineitem UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), CAST(l_linenumber AS DOUBLE) FROM lineitem),
    c AS (SELECT "column", value, any_value(num) AS num, count(*) AS n FROM u GROUP BY 1, 2),
    r AS (SELECT *, count(*) OVER (PARTITION BY "column") AS n_unique, sum(n) OVER (PARTITION BY "column") AS total,
      row_number() OVER (PARTITION BY "column" ORDER BY num, value) AS ps, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, num, value) AS pt FROM c)
    SELECT "column", n_unique, 'sorted' AS kind, CAST(ps AS INTEGER) AS position, value, round(CAST(n AS DOUBLE) / total, 6) AS share FROM r WHERE ps <= 5
    UNION ALL SELECT "column", n_unique, 'top', CAST(pt AS INTEGER), value, round(CAST(n AS DOUBLE) / total, 6) FROM r WHERE pt <= 5""",
)
def variable_info(t: Tables) -> DataFrame:
    return profile.variable_info(t.lineitem, ["l_returnflag", "l_linenumber"], 5).withColumn("share", r6("share"))


@query(
    "value_shares",
    f"SELECT priority, count(*) AS n, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders), 6) AS share FROM {HOLED} GROUP BY 1",
)
def value_shares(t: Tables) -> DataFrame:
    return profile.value_shares(holed(t), "priority").withColumn("share", r6("share"))


@query(
    "distinct_counts",
    "SELECT count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem",
)
def distinct_counts(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers")
    )


@query(
    "modes",
    """SELECT 'c_mktsegment' AS "column", c_mktsegment AS mode FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1)
    UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1)""",
)
def modes(t: Tables) -> DataFrame:
    from meterwise.operators.clean import modes as find

    return find(t.customer, ["c_mktsegment", "c_nationkey"])


def _describe_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS std, min({column}) AS min,
    round(quantile_cont({column}, 0.25), 6) AS q25, round(quantile_cont({column}, 0.5), 6) AS q50, round(quantile_cont({column}, 0.75), 6) AS q75, max({column}) AS max FROM lineitem"""


@query("describe_numeric", " UNION ALL ".join(_describe_sql(c) for c in ("l_quantity", "l_extendedprice", "l_tax")))
def describe_numeric(t: Tables) -> DataFrame:
    found = profile.describe_numeric(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"])
    return found.withColumns({c: r6(c) for c in ("mean", "std", "q25", "q50", "q75")})


def _categorical_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique", arg_min(v, struct_pack(a := -n, b := v)) AS top, max(n) AS freq FROM (SELECT {column} AS v, count(*) AS n FROM part GROUP BY 1)"""


@query("describe_categorical", " UNION ALL ".join(_categorical_sql(c) for c in ("p_name", "p_brand", "p_type")))
def describe_categorical(t: Tables) -> DataFrame:
    return profile.describe_categorical(t.part)


_PAIRS = [(a, b) for a in ("l_quantity", "l_extendedprice", "l_discount") for b in ("l_quantity", "l_extendedprice", "l_discount")]


@query("correlation_matrix", " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem" for a, b in _PAIRS))
def correlation_matrix(t: Tables) -> DataFrame:
    return profile.correlation_matrix(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("r", r6("r"))


@query(
    "exact_quantiles",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.01), 6) AS q0, round(quantile_cont(l_extendedprice, 0.5), 6) AS q1, round(quantile_cont(l_extendedprice, 0.99), 6) AS q2 FROM lineitem GROUP BY 1""",
)
def exact_quantiles(t: Tables) -> DataFrame:
    q = quantiles(t.lineitem, "l_extendedprice", [0.01, 0.5, 0.99], ["l_returnflag"])
    return q.select("l_returnflag", *[r6(f"q{i}").alias(f"q{i}") for i in range(3)])


@query(
    "pivot_counts",
    """SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'error') AS error,
    count(*) FILTER (WHERE event_type = 'purchase') AS purchase, count(*) FILTER (WHERE event_type = 'signup') AS signup, count(*) FILTER (WHERE event_type = 'view') AS view FROM events GROUP BY 1""",
)
def pivot_counts(t: Tables) -> DataFrame:
    types = ["click", "error", "purchase", "signup", "view"]
    staged = t.events.select(long(F.hour("ts")).alias("hour"), "event_type")
    return analytics.pivot(staged, "hour", "event_type", types, F.count(F.lit(1)), 0)


@query(
    "pivot_means",
    """SELECT l_linenumber, round(coalesce(avg(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0), 6) AS "A", round(coalesce(avg(l_quantity) FILTER (WHERE l_returnflag = 'N'), 0), 6) AS "N",
    round(coalesce(avg(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0), 6) AS "R" FROM lineitem GROUP BY 1""",
)
def pivot_means(t: Tables) -> DataFrame:
    wide = analytics.pivot(t.lineitem, "l_linenumber", "l_returnflag", analytics.category_values(t.lineitem, "l_returnflag"), F.avg("l_quantity"), 0)
    return wide.select("l_linenumber", *[r6(c).alias(c) for c in "ANR"])


@query(
    "crosstab_shares",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share_all,
    round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY l_linestatus), 6) AS share_column FROM lineitem GROUP BY 1, 2""",
)
def crosstab_shares(t: Tables) -> DataFrame:
    whole = analytics.crosstab(t.lineitem, "l_returnflag", "l_linestatus", "all").withColumnRenamed("share", "share_all")
    by_column = analytics.crosstab(t.lineitem, "l_returnflag", "l_linestatus", "columns").drop("n").withColumnRenamed("share", "share_column")
    both = whole.join(by_column, ["l_returnflag", "l_linestatus"])
    return both.withColumns({"share_all": r6("share_all"), "share_column": r6("share_column")})


@query(
    "crosstab_with_missing",
    f"SELECT h.priority, o.o_orderstatus, count(*) AS n FROM {HOLED} h JOIN orders o ON h.o_orderkey = o.o_orderkey GROUP BY 1, 2",
)
def crosstab_with_missing(t: Tables) -> DataFrame:
    both = holed(t).join(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey")
    return analytics.crosstab(both, "priority", "o_orderstatus", keep_null=True)


@query(
    "category_share_by_period",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS period, round(CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) / count(*), 6) AS click,
    round(CAST(count(*) FILTER (WHERE event_type = 'view') AS DOUBLE) / count(*), 6) AS view FROM events GROUP BY 1""",
)
def category_share_by_period(t: Tables) -> DataFrame:
    shares = analytics.category_share_by_period(t.events, F.date_format("ts", "yyyy-MM-dd"), "event_type", ["click", "view"])
    return shares.select("period", r6("click").alias("click"), r6("view").alias("view"))


@query(
    "conditional_shares",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) AS share FROM orders GROUP BY 1, 2""",
)
def conditional_shares(t: Tables) -> DataFrame:
    return profile.conditional_shares(t.orders, "o_orderstatus", "o_orderpriority").withColumn("share", r6("share"))


@query(
    "cross_distributions",
    f"""WITH b AS (SELECT o.o_orderstatus AS r, h.priority, CAST(o.o_custkey % 5 AS VARCHAR) AS c FROM orders o JOIN {HOLED} h ON o.o_orderkey = h.o_orderkey),
    u AS (SELECT 'priority' AS "column", priority AS value, r FROM b WHERE priority IS NOT NULL UNION ALL SELECT 'c', c, r FROM b)
    SELECT "column", value, r AS reference, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY "column", value), 6) AS share FROM u GROUP BY 1, 2, 3""",
)
def cross_distributions(t: Tables) -> DataFrame:
    both = holed(t).join(t.orders, "o_orderkey").select("o_orderstatus", "priority", (F.col("o_custkey") % 5).alias("c"), F.array("o_custkey").alias("list"))
    return profile.cross_distributions(both, "o_orderstatus").withColumn("share", r6("share"))


@query(
    "reference_analysis",
    """WITH c AS (SELECT c_mktsegment AS g, count(*) AS n FROM customer GROUP BY 1),
    m AS (SELECT c_mktsegment AS g, s, count(*) AS n FROM (SELECT c_mktsegment, substr(c_name, 18, 1) AS s FROM customer) GROUP BY 1, 2)
    SELECT 'share' AS section, g AS "group", 'c_mktsegment' AS "column", round(CAST(n AS DOUBLE) / (SELECT count(*) FROM customer), 6) AS number, NULL::VARCHAR AS text FROM c
    UNION ALL SELECT 'median', c_mktsegment, 'c_acctbal', round(quantile_cont(c_acctbal, 0.5), 6), NULL FROM customer GROUP BY c_mktsegment
    UNION ALL SELECT 'mode', g, 'last_digit', NULL, arg_min(s, struct_pack(a := -n, b := s)) FROM m GROUP BY g""",
)
def reference_analysis(t: Tables) -> DataFrame:
    base = t.customer.select("c_mktsegment", "c_acctbal", F.substring("c_name", 18, 1).alias("last_digit"))
    found = profile.reference_analysis(base, "c_mktsegment")
    is_text = F.col("section") == "mode"
    return found.select(
        "section", "group", "column", F.when(~is_text, r6(F.col("value").try_cast("double"))).alias("number"), F.when(is_text, F.col("value")).alias("text")
    )


@query(
    "hierarchy_totals",
    """SELECT r.r_name, n.n_name, c.c_mktsegment, round(sum(c.c_acctbal), 4) AS total, CAST(3 - grouping(r.r_name) - grouping(n.n_name) - grouping(c.c_mktsegment) AS INTEGER) AS depth
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY ROLLUP (r.r_name, n.n_name, c.c_mktsegment)""",
)
def hierarchy_totals(t: Tables) -> DataFrame:
    # nation and region are fixed reference tables
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return analytics.hierarchy_totals(named, ["r_name", "n_name", "c_mktsegment"], "c_acctbal").withColumn("total", r6("total", 4))


@query(
    "empirical_distribution",
    """SELECT value, round(CAST(sum(n) OVER (ORDER BY value) AS DOUBLE) / sum(n) OVER (), 6) AS ecdf FROM (SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def empirical_distribution(t: Tables) -> DataFrame:
    return analytics.ecdf(t.lineitem, "l_quantity").withColumn("ecdf", r6("ecdf"))


@query(
    "histogram",
    """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
    SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin, count(*) AS n FROM lineitem, s GROUP BY 1""",
)
def histogram(t: Tables) -> DataFrame:
    return analytics.histogram(t.lineitem, "l_extendedprice", 30).select("bin", "n")


@query(
    "density_grid",
    """WITH s AS (SELECT count(*) AS n, stddev_samp(l_quantity) * pow(count(*), -0.2) AS h, min(l_quantity) AS mn, max(l_quantity) AS mx FROM lineitem),
    v AS (SELECT l_quantity AS v, count(*) AS c FROM lineitem GROUP BY 1), g AS (SELECT i, mn - 3 * h + (mx - mn + 6 * h) * i / 49.0 AS x FROM s, range(50) t(i))
    SELECT CAST(g.i AS INTEGER) AS position, round(sum(v.c * exp(-0.5 * pow((g.x - v.v) / s.h, 2))) / (any_value(s.n) * any_value(s.h) * sqrt(2 * pi())), 8) AS density FROM g, v, s GROUP BY g.i""",
)
def density_grid(t: Tables) -> DataFrame:
    grid = analytics.gaussian_kde(t.lineitem, "l_quantity", 50)
    lo = grid.agg(F.min("x"), F.max("x")).first()
    position = F.round((F.col("x") - lo[0]) / ((lo[1] - lo[0]) / 49)).cast("int")
    return grid.select(position.alias("position"), F.round("density", 8).alias("density"))


@query(
    "box_statistics",
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.5) AS m, quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem GROUP BY 1)
    SELECT l.l_returnflag, round(any_value(a), 6) AS q1, round(any_value(m), 6) AS median, round(any_value(b), 6) AS q3,
    min(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)) AS whisker_low,
    max(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)) AS whisker_high,
    count(*) FILTER (WHERE NOT l_extendedprice BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)) AS outliers FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag GROUP BY 1""",
)
def box_statistics(t: Tables) -> DataFrame:
    return analytics.box_stats(t.lineitem, "l_extendedprice", ["l_returnflag"]).withColumns({c: r6(c) for c in ("q1", "median", "q3")})


@query(
    "mean_interval",
    """SELECT l_linenumber, round(avg(l_quantity), 6) AS mean, round(avg(l_quantity) - 1.959963984540054 * stddev_samp(l_quantity) / sqrt(count(*)), 6) AS low,
    round(avg(l_quantity) + 1.959963984540054 * stddev_samp(l_quantity) / sqrt(count(*)), 6) AS high FROM lineitem GROUP BY 1""",
)
def mean_interval(t: Tables) -> DataFrame:
    return analytics.mean_interval(t.lineitem, ["l_linenumber"], "l_quantity").withColumns({c: r6(c) for c in ("mean", "low", "high")})


@query("two_category_counts", "SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def two_category_counts(t: Tables) -> DataFrame:
    return t.orders.groupBy(long(F.year("o_orderdate")).alias("year"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "anomalous_days",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1), s AS (SELECT avg(n) AS m, stddev_samp(n) AS s FROM d)
    SELECT strftime(day, '%Y-%m-%d') AS day, n, round(m - 2 * s, 6) AS low, round(m + 2 * s, 6) AS high FROM d, s WHERE n < m - 2 * s OR n > m + 2 * s""",
)
def anomalous_days(t: Tables) -> DataFrame:
    daily = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return analytics.anomalous_days(daily, "n").withColumns({"low": r6("low"), "high": r6("high")})


@query(
    "tercile_sites",
    """WITH m AS (SELECT user_id, avg(value) AS mean FROM events GROUP BY 1), q AS (SELECT quantile_cont(mean, 0.33) AS a, quantile_cont(mean, 0.66) AS b FROM m)
    SELECT user_id, round(mean, 6) AS mean, CASE WHEN mean <= a THEN 'low' WHEN mean <= b THEN 'medium' ELSE 'high' END AS class FROM m, q""",
)
def tercile_sites(t: Tables) -> DataFrame:
    return analytics.tercile_classes(t.events, "user_id", "value").withColumn("mean", r6("mean"))


@query(
    "bayesian_average",
    """WITH s AS (SELECT l_partkey, count(*) AS n, sum(l_quantity) AS s, avg(l_quantity) AS m FROM lineitem GROUP BY 1), p AS (SELECT avg(n) AS c, avg(m) AS mm FROM s)
    SELECT l_partkey, n, round((c * mm + s) / (c + n), 6) AS bayesian_avg FROM s, p""",
)
def bayesian_average(t: Tables) -> DataFrame:
    return analytics.bayesian_average(t.lineitem, "l_partkey", "l_quantity").select("l_partkey", "n", r6("bayesian_avg").alias("bayesian_avg"))


@query(
    "frequent_pairs",
    """WITH u AS (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(*) > 300), i AS (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) > 20)
    SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT * FROM u) AND l_partkey IN (SELECT * FROM i) GROUP BY 1""",
)
def frequent_pairs(t: Tables) -> DataFrame:
    kept = analytics.frequent_only(t.lineitem.select("l_suppkey", "l_partkey"), "l_suppkey", "l_partkey", 300, 20)
    return kept.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("top_sums", "SELECT l_partkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1 ORDER BY sum(l_extendedprice) DESC, l_partkey LIMIT 30")
def top_sums(t: Tables) -> DataFrame:
    return analytics.top_sums(t.lineitem, "l_partkey", "l_extendedprice", 30).withColumn("total", r6("total", 2))


@query(
    "top_group_profile",
    """SELECT l.l_partkey, l.l_returnflag, count(*) AS n FROM lineitem l WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_partkey LIMIT 5) GROUP BY 1, 2""",
)
def top_group_profile(t: Tables) -> DataFrame:
    top = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l_partkey").limit(5)
    kept = semi_join_values(t.lineitem, "l_partkey", top.select("l_partkey"))
    return kept.groupBy("l_partkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "running_total",
    """SELECT month, round(total, 2) AS total, round(sum(total) OVER (ORDER BY month), 2) AS running FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice) AS total FROM orders GROUP BY 1)""",
)
def running_total(t: Tables) -> DataFrame:
    monthly = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_totalprice")
    return analytics.running_total(monthly, "month", "o_totalprice").withColumns({"total": r6("total", 2), "running": r6("running", 2)})


