"""Projections, filters, row repairs, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.functions import text
from meterwise.operators import clean
from meterwise.plans.registry import Tables, long, query


@query("keep_columns", "SELECT l_orderkey, l_quantity FROM lineitem")
def keep_columns(t: Tables) -> DataFrame:
    return clean.keep_columns(t.lineitem, ["l_orderkey", "l_quantity"])


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def drop_columns(t: Tables) -> DataFrame:
    return t.orders.drop("o_orderstatus", "o_orderdate")


@query("drop_sparse_columns", "SELECT o_orderkey, o_orderpriority FROM orders")
def drop_sparse_columns(t: Tables) -> DataFrame:
    sparse = t.orders.select(
        "o_orderkey", "o_orderpriority", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("half_empty")
    )
    return clean.drop_sparse_columns(sparse, 0.4)


@query("normalized_names", "SELECT p_partkey AS n_station, p_name AS adresse_complete, p_size AS etat_general FROM part")
def normalized_names(t: Tables) -> DataFrame:
    raw = t.part.select(
        F.col("p_partkey").alias("N° Station"), F.col("p_name").alias("Adresse (complète)"), F.col("p_size").alias("État Général")
    )
    return text.normalize_column_names(raw)


@query(
    "boolean_filter",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_quantity > 30 AND l_returnflag <> 'A' AND NOT (l_discount < 0.05 OR l_linestatus = 'F')""",
)
def boolean_filter(t: Tables) -> DataFrame:
    keep = (F.col("l_quantity") > 30) & (F.col("l_returnflag") != "A")
    drop = (F.col("l_discount") < 0.05) | (F.col("l_linestatus") == "F")
    return t.lineitem.filter(keep & ~drop).select("l_orderkey", "l_linenumber", "l_quantity")


@query("membership_filter", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def membership_filter(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@query("prefix_filter", "SELECT p_partkey FROM part WHERE p_name LIKE 'red%' OR p_name LIKE 'small%' OR contains(p_name, 'ring')")
def prefix_filter(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.filter(text.starts_with_any(name, ["red", "small"]) | text.contains_text(name, "ring")).select("p_partkey")


@query(
    "row_containment",
    """SELECT p_partkey FROM (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS a,
    CASE WHEN p_partkey % 2 = 0 THEN concat(p_brand, ' ', p_type) ELSE p_brand END AS b FROM part) WHERE a IS NULL OR contains(b, a)""",
)
def row_containment(t: Tables) -> DataFrame:
    pairs = t.part.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).alias("a"),
        F.when(F.col("p_partkey") % 2 == 0, F.concat_ws(" ", "p_brand", "p_type")).otherwise(F.col("p_brand")).alias("b"),
    )
    return pairs.filter(text.contained_or_null("a", "b")).select("p_partkey")


@query("numeric_columns_only", "SELECT p_partkey, p_size, p_retailprice FROM part")
def numeric_columns_only(t: Tables) -> DataFrame:
    return t.part.select(*clean.numeric_columns(t.part))


@query("outlier_rule", "SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN o_totalprice / 10 ELSE o_totalprice END AS o_totalprice FROM orders")
def outlier_rule(t: Tables) -> DataFrame:
    return clean.rescale_outliers(t.orders, "o_totalprice", 300000.0, 10.0).select("o_orderkey", "o_totalprice")


@query("sentinel_rows", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def sentinel_rows(t: Tables) -> DataFrame:
    marked = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "?").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return clean.sentinel_to_null(marked, "?").dropna("any")


@query(
    "casts",
    """SELECT o_orderkey, CAST(CAST(CAST(o_custkey AS DOUBLE) AS BIGINT) AS VARCHAR) AS id_text, CAST(floor(o_totalprice) AS DOUBLE) AS amount,
    CAST(o_orderkey % 200 AS DOUBLE) AS minutes, TRY_CAST(o_orderstatus AS DOUBLE) AS status_number FROM orders""",
)
def casts(t: Tables) -> DataFrame:
    raw = t.orders.select(
        "o_orderkey", F.col("o_custkey").cast("double").alias("id"), F.format_number(F.floor("o_totalprice"), 0).alias("amount"),
        F.concat((F.col("o_orderkey") % 200).cast("string"), F.lit(" min")).alias("minutes"), "o_orderstatus",
    )
    return raw.select(
        "o_orderkey",
        text.id_text(F.col("id")).alias("id_text"),
        text.number_without_separators(F.col("amount")).alias("amount"),
        text.number_before_unit(F.col("minutes"), " min").alias("minutes"),
        F.col("o_orderstatus").try_cast("double").alias("status_number"),
    )


@query(
    "fill_missing_values",
    """WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS p, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS v FROM orders),
    m AS (SELECT p FROM b WHERE p IS NOT NULL GROUP BY p ORDER BY count(*) DESC, p LIMIT 1)
    SELECT o_orderkey, coalesce(p, (SELECT p FROM m)) AS priority, coalesce(v, 0) AS price FROM b""",
)
def fill_missing_values(t: Tables) -> DataFrame:
    holes = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"),
    )
    return clean.fill_mode(holes, ["priority"]).fillna(0, ["price"])


@query(
    "row_differences",
    """WITH a AS (SELECT * FROM orders WHERE o_orderkey = 3), b AS (SELECT * FROM orders WHERE o_orderkey = 5)
    SELECT 'o_custkey' AS "column" FROM a, b WHERE a.o_custkey <> b.o_custkey
    UNION ALL SELECT 'o_orderstatus' FROM a, b WHERE a.o_orderstatus <> b.o_orderstatus
    UNION ALL SELECT 'o_totalprice' FROM a, b WHERE a.o_totalprice <> b.o_totalprice
    UNION ALL SELECT 'o_orderdate' FROM a, b WHERE a.o_orderdate <> b.o_orderdate
    UNION ALL SELECT 'o_orderpriority' FROM a, b WHERE a.o_orderpriority <> b.o_orderpriority""",
)
def row_differences(t: Tables) -> DataFrame:
    return clean.row_differences(t.orders, "o_orderkey", 3, 5)


@query("rename_columns", "SELECT s_suppkey AS supplier, s_acctbal AS balance FROM supplier")
def rename_columns(t: Tables) -> DataFrame:
    return t.supplier.withColumnsRenamed({"s_suppkey": "supplier", "s_acctbal": "balance"}).select("supplier", "balance")


@query("row_label", "SELECT concat(o_orderstatus, ' ', o_orderpriority) AS label, count(*) AS n FROM orders GROUP BY 1")
def row_label(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("label")).agg(F.count(F.lit(1)).alias("n"))


# ---- sorting and limits ----


@query(
    "domain_order",
    "SELECT dayname(o_orderdate) AS day, isodow(o_orderdate) - 1 AS position, count(*) AS n FROM orders GROUP BY 1, 2",
)
def domain_order(t: Tables) -> DataFrame:
    """Weekday names sorted by their position in the week, not by spelling."""
    by_day = t.orders.groupBy(
        F.date_format("o_orderdate", "EEEE").alias("day"), long(F.weekday("o_orderdate")).alias("position")
    ).agg(F.count(F.lit(1)).alias("n"))
    return by_day.orderBy("position")


@query("sorted_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def sorted_head(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("sorted_values", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey")
def sorted_values(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", "s_acctbal").orderBy("s_acctbal", "s_suppkey")


@query("sorted_group_keys", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2")
def sorted_group_keys(t: Tables) -> DataFrame:
    counts = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("l_returnflag", "l_linestatus")


@query(
    "positional_slice",
    "SELECT event_id, value FROM (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) AS r FROM events) WHERE r > 100 AND r <= 400",
)
def positional_slice(t: Tables) -> DataFrame:
    """Rows 101..400 of the time-ordered table by exact distributed row numbers."""
    from meterwise.operators.ranking import row_numbers

    numbered = row_numbers(t.events.select("event_id", "ts", "value"), "ts", "event_id", name="r")
    return numbered.filter((F.col("r") > 100) & (F.col("r") <= 400)).select("event_id", "value")


# ---- set operations ----


@query("union_rows", "SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def union_rows(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    return a.unionByName(t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation")))


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", "l_returnflag").dropDuplicates()


@query("distinct_values", "SELECT DISTINCT event_type FROM events")
def distinct_values(t: Tables) -> DataFrame:
    return t.events.select("event_type").distinct()


@query("column_set_difference", "SELECT count(*) AS n, CAST(1 AS BIGINT) AS missing_columns FROM orders")
def column_set_difference(t: Tables) -> DataFrame:
    missing = clean.column_set_difference(t.orders, ["o_orderkey", "o_weight"])
    return t.orders.agg(F.count(F.lit(1)).alias("n")).withColumn("missing_columns", F.lit(len(missing)).cast("long"))


@query(
    "first_row_per_key",
    "SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1",
)
def first_row_per_key(t: Tables) -> DataFrame:
    return clean.first_per_key(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_orderkey")


@query(
    "top_row_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1""",
)
def top_row_per_group(t: Tables) -> DataFrame:
    return clean.top_per_group(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", "o_orderkey")


