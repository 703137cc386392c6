"""Statistical tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.operators import models, stats
from meterwise.operators.selection import f_regression
from meterwise.plans.registry import ORACLE, Tables, query, r6


def _one(t: Tables, name: str, result: dict) -> DataFrame:
    return stats.result_table(t.lineitem, name, result)


@query("pearson_test", "SELECT 'pearson' AS test, round(corr(l_quantity, l_extendedprice), 8) AS statistic, count(*) AS n FROM lineitem")
def pearson_test(t: Tables) -> DataFrame:
    found = _one(t, "pearson", stats.pearson_test(t.lineitem, "l_quantity", "l_extendedprice"))
    return found.select("test", r6("statistic", 8).alias("statistic"), "n")


@query(
    "anderson_darling",
    """WITH s AS (SELECT count(*) AS n, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem),
    v AS (SELECT l_extendedprice AS v, count(*) AS c FROM lineitem GROUP BY 1), r AS (SELECT v, CAST(c AS DOUBLE) AS c, CAST(sum(c) OVER (ORDER BY v) - c AS DOUBLE) AS a FROM v),
    z AS (SELECT r.*, (v - m) / s AS z, abs((v - m) / s) / sqrt(2) AS x, CAST(n AS DOUBLE) AS n FROM r, s),
    e AS (SELECT *, 2 / sqrt(pi()) * exp(-x * x) * list_sum(list_transform(range(0, 60), lambda k: CASE WHEN x = 0 THEN 0 ELSE exp(k * ln(2) + (2 * k + 1) * ln(x) - (lgamma(2 * k + 3) - (k + 1) * ln(2) - lgamma(k + 2))) END)) AS erf FROM z),
    p AS (SELECT *, 0.5 * (1 + sign(z) * erf) AS up, 0.5 * (1 - sign(z) * erf) AS down FROM e)
    SELECT round(-any_value(n) - sum((pow(a + c, 2) - pow(a, 2)) * ln(up) + (pow(n - a, 2) - pow(n - a - c, 2)) * ln(down)) / any_value(n), 5) AS statistic, round(0.576 / any_value(1 + 4 / n - 25 / (n * n)), 8) AS critical_15, round(0.656 / any_value(1 + 4 / n - 25 / (n * n)), 8) AS critical_10,
    round(0.787 / any_value(1 + 4 / n - 25 / (n * n)), 8) AS critical_5, round(0.918 / any_value(1 + 4 / n - 25 / (n * n)), 8) AS critical_2_5, round(1.092 / any_value(1 + 4 / n - 25 / (n * n)), 8) AS critical_1 FROM p""",
)
def anderson_darling(t: Tables) -> DataFrame:
    found = stats.anderson_darling(t.lineitem, "l_extendedprice")
    levels = {"critical_15": 15.0, "critical_10": 10.0, "critical_5": 5.0, "critical_2_5": 2.5, "critical_1": 1.0}
    row = (float(found["statistic"]), *(float(found["critical"][level]) for level in levels.values()))
    table = t.literal([row], ", ".join(f"{name} double" for name in ["statistic", *levels]))
    return table.select(r6("statistic", 5).alias("statistic"), *[r6(name, 8).alias(name) for name in levels])


@query("normal_plot_fit")
def normal_plot_fit(t: Tables) -> DataFrame:
    return stats.qq_fit(t.orders, "o_totalprice", "o_orderkey")


@query(
    "normal_plot_positions",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS i, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey, round(CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END, 6) AS position FROM r""",
)
def normal_plot_positions(t: Tables) -> DataFrame:
    """The plotting positions, recovered from the theoretical quantiles by the normal distribution."""
    from meterwise.functions.normal import normal_log_cdf

    points = stats.qq_points(t.orders, "o_totalprice", "o_orderkey")
    return points.select("o_orderkey", r6(F.exp(normal_log_cdf("theoretical"))).alias("position"))


@query(
    "one_way_variance",
    """WITH g AS (SELECT l_returnflag, count(*) AS n, avg(l_extendedprice) AS m, var_pop(l_extendedprice) * count(*) AS ss FROM lineitem GROUP BY 1),
    t AS (SELECT sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS grand, sum(ss) AS inside FROM g),
    f AS (SELECT (SELECT sum(g.n * pow(g.m - t.grand, 2)) FROM g, t) / (k - 1) / (inside / (n - k)) AS f, n, k FROM t)
    SELECT round(f, 6) AS statistic, CASE WHEN k = 3 THEN round(pow(1 + 2 * f / (n - 3), -(n - 3) / 2.0), 8) END AS p_value, CAST(n AS BIGINT) AS n FROM f""",
)
def one_way_variance(t: Tables) -> DataFrame:
    found = _one(t, "f", stats.one_way_f(t.lineitem, "l_returnflag", "l_extendedprice"))
    return found.select(r6("statistic").alias("statistic"), r6("p_value", 8).alias("p_value"), "n")


@query(
    "factor_variance",
    """WITH t AS (SELECT count(*) AS n, avg(l_extendedprice) AS m, var_pop(l_extendedprice) * count(*) AS total FROM lineitem),
    a AS (SELECT sum(g.n * pow(g.m - t.m, 2)) AS ss FROM (SELECT count(*) AS n, avg(l_extendedprice) AS m FROM lineitem GROUP BY l_returnflag) g, t)
    SELECT 'l_returnflag' AS term, round(ss / 1e6, 4) AS sum_sq, CAST(2 AS DOUBLE) AS df FROM a""",
)
def factor_variance(t: Tables) -> DataFrame:
    """First line of the sequential table; its sum of squares has a closed form."""
    table = stats.anova(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"], "l_extendedprice")["table"]
    return table.filter("term = 'l_returnflag'").select("term", r6(F.col("sum_sq") / 1e6, 4).alias("sum_sq"), "df")


@query("factor_variance_table")
def factor_variance_table(t: Tables) -> DataFrame:
    found = stats.anova(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"], "l_extendedprice")
    return found["table"].withColumn("r2", F.lit(found["r2"]))


@query(
    "least_squares_summary",
    """WITH r AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, regr_avgx(y, x) AS mx, regr_r2(y, x) AS r2, CAST(count(*) AS DOUBLE) AS n,
      (regr_syy(y, x) - pow(regr_sxy(y, x), 2) / regr_sxx(y, x)) / (count(*) - 2) AS v FROM (SELECT l_extendedprice AS y, l_quantity AS x FROM lineitem)),
    t AS (SELECT 'l_quantity' AS term, b AS coef, sqrt(v / sxx) AS se, r2 FROM r UNION ALL SELECT 'Intercept', a, sqrt(v * (1 / n + mx * mx / sxx)), r2 FROM r)
    SELECT term, round(coef, 5) AS coef, round(se, 6) AS se, round(coef / se, 5) AS t, round(r2, 8) AS r2 FROM t""",
)
def least_squares_summary(t: Tables) -> DataFrame:
    found = stats.ols_summary(t.lineitem, ["l_quantity"], "l_extendedprice")
    return found.select("term", r6("coef", 5).alias("coef"), r6("se").alias("se"), r6("t", 5).alias("t"), r6("r2", 8).alias("r2"))


@query(
    "levene",
    """WITH m AS (SELECT l_returnflag AS g, quantile_cont(l_extendedprice, 0.5) AS md FROM lineitem GROUP BY 1), z AS (SELECT g, abs(l_extendedprice - md) AS z FROM lineitem JOIN m ON l_returnflag = g),
    s AS (SELECT g, count(*) AS n, avg(z) AS m, var_pop(z) * count(*) AS ss FROM z GROUP BY 1), t AS (SELECT sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS grand, sum(ss) AS inside FROM s),
    f AS (SELECT (SELECT sum(s.n * pow(s.m - t.grand, 2)) FROM s, t) / (k - 1) / (inside / (n - k)) AS f, n, k FROM t)
    SELECT round(f, 6) AS statistic, CASE WHEN k = 3 THEN round(pow(1 + 2 * f / (n - 3), -(n - 3) / 2.0), 8) END AS p_value, CAST(n AS BIGINT) AS n FROM f""",
)
def levene(t: Tables) -> DataFrame:
    found = _one(t, "levene", stats.levene(t.lineitem, "l_returnflag", "l_extendedprice"))
    return found.select(r6("statistic").alias("statistic"), r6("p_value", 8).alias("p_value"), "n")


@query(
    "kruskal_wallis",
    """WITH v AS (SELECT l_quantity AS v, count(*) AS c FROM lineitem GROUP BY 1), r AS (SELECT v, c, sum(c) OVER (ORDER BY v) - c + (c + 1) / 2.0 AS rk FROM v),
    g AS (SELECT l_returnflag, CAST(sum(rk) AS DOUBLE) AS s, count(*) AS n FROM lineitem JOIN r ON l_quantity = v GROUP BY 1), t AS (SELECT CAST(sum(n) AS DOUBLE) AS n, sum(s * s / n) AS q FROM g), e AS (SELECT sum(pow(c, 3) - c) AS ties FROM v),
    h AS (SELECT (12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - ties / (pow(n, 3) - n)) AS h, n FROM t, e)
    SELECT round(h, 5) AS statistic, round(exp(-h / 2), 7) AS p_value, CAST(n AS BIGINT) AS n FROM h""",
)
def kruskal_wallis(t: Tables) -> DataFrame:
    """Three groups: two degrees of freedom, whose tail is exp(-h / 2)."""
    found = _one(t, "kruskal", stats.kruskal_wallis(t.lineitem, "l_returnflag", "l_quantity"))
    return found.select(r6("statistic", 5).alias("statistic"), r6("p_value", 7).alias("p_value"), "n")


@query(
    "kruskal_wallis_many_groups",
    """WITH v AS (SELECT l_quantity AS v, count(*) AS c FROM lineitem GROUP BY 1), r AS (SELECT v, c, sum(c) OVER (ORDER BY v) - c + (c + 1) / 2.0 AS rk FROM v),
    g AS (SELECT l_partkey, CAST(sum(rk) AS DOUBLE) AS s, count(*) AS n FROM lineitem JOIN r ON l_quantity = v GROUP BY 1), t AS (SELECT CAST(sum(n) AS DOUBLE) AS n, sum(s * s / n) AS q, count(*) AS k FROM g), e AS (SELECT sum(pow(c, 3) - c) AS ties FROM v)
    SELECT round((12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - ties / (pow(n, 3) - n)), 3) AS statistic, CAST(k AS BIGINT) AS "groups" FROM t, e""",
)
def kruskal_wallis_many_groups(t: Tables) -> DataFrame:
    """A group per part: far more groups than a list could hold."""
    found = stats.kruskal_wallis(t.lineitem, "l_partkey", "l_quantity")
    return t.literal([(float(found["statistic"]), int(found["groups"]))], "statistic double, groups bigint").select(r6("statistic", 3).alias("statistic"), "groups")


@query(
    "dagostino",
    """WITH m AS (SELECT avg(l_quantity) AS m FROM lineitem), c AS (SELECT count(*) AS n, avg(pow(l_quantity - m, 2)) AS m2, avg(pow(l_quantity - m, 3)) AS m3, avg(pow(l_quantity - m, 4)) AS m4 FROM lineitem, m),
    g AS (SELECT CAST(n AS DOUBLE) AS n, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2 FROM c),
    s AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y, 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS bb,
      (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / (pow(n + 1, 2) * (n + 3) * (n + 5))) AS x,
      6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS q FROM g),
    w AS (SELECT *, -1 + sqrt(2 * (bb - 1)) AS w2, 6 + 8 / q * (2 / q + sqrt(1 + 4 / (q * q))) AS a FROM s),
    z AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1, (1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))) AS inner_ FROM w)
    SELECT round(z1, 6) AS z_skew, round(((1 - 2 / (9 * a)) - sign(inner_) * pow(abs(inner_), 1.0 / 3)) / sqrt(2 / (9 * a)), 4) AS z_kurtosis,
      round(pow(z1, 2) + pow(((1 - 2 / (9 * a)) - sign(inner_) * pow(abs(inner_), 1.0 / 3)) / sqrt(2 / (9 * a)), 2), 2) AS statistic,
      round(exp(-(pow(z1, 2) + pow(((1 - 2 / (9 * a)) - sign(inner_) * pow(abs(inner_), 1.0 / 3)) / sqrt(2 / (9 * a)), 2)) / 2), 8) AS p_value FROM z""",
)
def dagostino(t: Tables) -> DataFrame:
    found = stats.dagostino(t.lineitem, "l_quantity")
    row = tuple(float(found[name]) for name in ("z_skew", "z_kurtosis", "statistic", "p_value"))
    return t.literal([row], "z_skew double, z_kurtosis double, statistic double, p_value double").select(
        r6("z_skew").alias("z_skew"), r6("z_kurtosis", 4).alias("z_kurtosis"), r6("statistic", 2).alias("statistic"), r6("p_value", 8).alias("p_value")
    )


@query(
    "chi_square_yates",
    """WITH c AS (SELECT l_linestatus AS a, l_returnflag = 'A' AS b, CAST(count(*) AS DOUBLE) AS o FROM lineitem GROUP BY 1, 2), e AS (SELECT o, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM c)
    SELECT round(sum(pow(greatest(abs(o - e) - 0.5, 0), 2) / e), 6) AS statistic, CAST(sum(o) AS BIGINT) AS n FROM e""",
)
def chi_square_yates(t: Tables) -> DataFrame:
    base = t.lineitem.select("l_linestatus", (F.col("l_returnflag") == "A").alias("is_a"))
    return _one(t, "chi2", stats.chi2_independence(base, "l_linestatus", "is_a")).select(r6("statistic").alias("statistic"), "n")


@query(
    "chi_square",
    """WITH c AS (SELECT o_orderstatus AS a, o_orderpriority AS b, CAST(count(*) AS DOUBLE) AS o FROM orders GROUP BY 1, 2), e AS (SELECT o, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM c),
    x AS (SELECT sum(pow(o - e, 2) / e) AS x, CAST(sum(o) AS BIGINT) AS n FROM e)
    SELECT round(x, 6) AS statistic, round(exp(-x / 2) * (1 + x / 2 + pow(x / 2, 2) / 2 + pow(x / 2, 3) / 6), 8) AS p_value, n FROM x""",
)
def chi_square(t: Tables) -> DataFrame:
    """Three by five categories: eight degrees of freedom, whose tail is a finite sum."""
    found = _one(t, "chi2", stats.chi2_independence(t.orders, "o_orderstatus", "o_orderpriority"))
    return found.select(r6("statistic").alias("statistic"), r6("p_value", 8).alias("p_value"), "n")


@query(
    "chi_square_many_categories",
    """WITH c AS (SELECT l_partkey AS a, l_shipdate AS b, CAST(count(*) AS DOUBLE) AS o FROM lineitem GROUP BY 1, 2), x AS (SELECT a, sum(o) AS na FROM c GROUP BY 1), y AS (SELECT b, sum(o) AS nb FROM c GROUP BY 1),
    n AS (SELECT sum(o) AS n FROM c), e AS (SELECT o, na * nb / n AS e, n FROM c JOIN x ON c.a = x.a JOIN y ON c.b = y.b, n)
    SELECT round((sum(pow(o - e, 2) / e) + any_value(n) - sum(e)) / 1e3, 4) AS statistic, CAST((SELECT count(*) - 1 FROM x) * (SELECT count(*) - 1 FROM y) AS BIGINT) AS dof FROM e""",
)
def chi_square_many_categories(t: Tables) -> DataFrame:
    """Parts by shipping days: millions of cells, most of them empty."""
    found = stats.chi2_independence(t.lineitem, "l_partkey", "l_shipdate")
    return t.literal([(float(found["statistic"]), int(found["dof"]))], "statistic double, dof bigint").select(r6(F.col("statistic") / 1e3, 4).alias("statistic"), "dof")


@query(
    "modality_association",
    """WITH u AS (SELECT 'o_orderpriority' AS "column", o_orderpriority AS m, o_orderstatus = 'F' AS t FROM orders UNION ALL SELECT 'd', CAST(o_custkey % 4 AS VARCHAR), o_orderstatus = 'F' FROM orders),
    n AS (SELECT "column", t, CAST(count(*) AS DOUBLE) AS tn FROM u GROUP BY 1, 2), d AS (SELECT DISTINCT "column", m FROM u),
    f AS (SELECT d."column", d.m, n.tn, CAST((SELECT count(*) FROM u WHERE u."column" = d."column" AND u.m = d.m AND u.t = n.t) AS DOUBLE) AS o FROM d JOIN n ON d."column" = n."column"),
    g AS (SELECT *, sum(o) OVER (PARTITION BY "column", m) AS mn, sum(tn) OVER (PARTITION BY "column", m) AS nn FROM f),
    x AS (SELECT "column", m, nn, greatest(abs(o - tn * mn / nn) - 0.5, 0) AS gap, tn * mn / nn AS e1, tn * (nn - mn) / nn AS e2 FROM g)
    SELECT "column", m AS modality, round(sum(gap * gap / e1 + gap * gap / e2), 6) AS statistic, round(sqrt(sum(gap * gap / e1 + gap * gap / e2) / any_value(nn)), 6) AS v FROM x GROUP BY 1, 2""",
)
def modality_association(t: Tables) -> DataFrame:
    base = t.orders.select("o_orderpriority", (F.col("o_custkey") % 4).alias("d"), (F.col("o_orderstatus") == "F").alias("target"))
    found = stats.cramers_v(base, ["o_orderpriority", "d"], "target")
    return found.select("column", "modality", r6("statistic").alias("statistic"), r6("v").alias("v"))


@query("logit_report")
def logit_report(t: Tables) -> DataFrame:
    base = t.lineitem.select("l_quantity", "l_tax", (F.col("l_returnflag") == "A").cast("int").alias("returned"))
    found = stats.logit_report(base, ["l_quantity", "l_tax"], "returned", {"l_quantity": {"type": "normalize", "range": (1, 50)}, "l_tax": {"type": "inverse"}, "other": {"type": "inverse"}})
    return found["report"].join(found["odds"], "term").withColumn("aic", F.lit(found["aic"]))


@query(
    "univariate_f_scores",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(pow(corr({c}, l_extendedprice), 2) * (count(*) - 2) / (1 - pow(corr({c}, l_extendedprice), 2)), 6) AS f FROM lineitem"
        for c in ("l_quantity", "l_discount", "l_tax")
    ),
)
def univariate_f_scores(t: Tables) -> DataFrame:
    return f_regression(t.lineitem, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice").select("feature", r6("f").alias("f"))


@query(
    "residual_histogram",
    """WITH p AS (SELECT regr_slope(o_totalprice, o_custkey) AS b, regr_intercept(o_totalprice, o_custkey) AS a FROM orders), r AS (SELECT o_totalprice - a - b * o_custkey AS r FROM orders, p),
    s AS (SELECT stddev_samp(r) AS s, avg(r) AS m FROM r) SELECT CAST(floor((r - m) / s * 4) AS BIGINT) AS bin, count(*) AS n FROM r, s GROUP BY 1""",
)
def residual_histogram(t: Tables) -> DataFrame:
    table = models.with_features(t.orders.select("o_custkey", "o_totalprice"), ["o_custkey"])
    scored = models.linear_regression(table, "o_totalprice").transform(table)
    residuals = stats.standardised_residuals(scored, "o_totalprice", "prediction")
    return residuals.groupBy(F.floor(F.col("std_residual") * 4).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


# ---- the same tests on columns with holes ----

_KNOWN = "(SELECT * FROM lineitem WHERE l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0) lineitem"


class _Holes(Tables):
    """Line items whose quantity is NULL in some orders and whose price is NaN in others."""

    @property
    def lineitem(self) -> DataFrame:
        table, key = Tables.__getattr__(self, "lineitem"), F.col("l_orderkey")
        either = (key % 7 == 0) | (key % 11 == 0)
        hole = F.when(key % 7 == 0, F.lit(None)).otherwise(F.lit(float("nan")))
        return table.withColumns({c: F.when(either, hole).otherwise(F.col(c).cast("double")) for c in ("l_quantity", "l_extendedprice")})


def _with_holes(name: str) -> None:
    run = globals()[name]

    @query(f"{name}_with_holes", ORACLE[name].replace("FROM lineitem", f"FROM {_KNOWN}"))
    def holes(t: Tables) -> DataFrame:
        """NULL and NaN are left out."""
        return run(_Holes(t.spark, t.folder))


for _name in ("pearson_test", "anderson_darling", "dagostino", "least_squares_summary"):
    _with_holes(_name)
