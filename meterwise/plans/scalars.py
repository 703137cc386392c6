"""Scalar functions and recoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.functions import calendar as cal
from meterwise.functions import codes, text
from meterwise.operators import clean, features
from meterwise.plans.registry import Tables, long, paris_events, query, r6, text_time


@query("utc_localisation", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris', '%Y-%m-%d %H:%M:%S') AS paris FROM events")
def utc_localisation(t: Tables) -> DataFrame:
    instant = cal.as_instant(t.events, "ts")
    return t.events.select("event_id", text_time(instant).alias("utc"), text_time(cal.wall_clock(instant)).alias("paris"))


@query(
    "strict_instants",
    "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS parsed FROM events",
)
def strict_instants(t: Tables) -> DataFrame:
    """ISO texts with three offset spellings parse to the same instants."""
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    shifted = F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOUR"), "yyyy-MM-dd'T'HH:mm:ss")
    spelled = F.when(F.col("event_id") % 3 == 0, F.concat(local, F.lit("Z"))).when(
        F.col("event_id") % 3 == 1, F.concat(shifted, F.lit("+0200"))
    ).otherwise(F.concat(shifted, F.lit("+02:00")))
    written = t.events.select("event_id", spelled.alias("at"))
    return written.select("event_id", text_time(cal.as_instant(written, "at")).alias("parsed"))


@query(
    "date_span",
    """SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day,
    CAST(max(year(o_orderdate)) - min(year(o_orderdate)) + 1 AS BIGINT) AS n_years FROM orders""",
)
def date_span(t: Tables) -> DataFrame:
    span = cal.date_span(t.orders, "o_orderdate", zone="UTC")
    return span.select("first_day", "last_day", long(F.size("years")).alias("n_years"))


@query("english_date_year", "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders")
def english_date_year(t: Tables) -> DataFrame:
    written = F.concat(F.lit(" "), F.date_format("o_orderdate", "MMMM d, yyyy"))
    return t.orders.select("o_orderkey", long(cal.english_date_year(written)).alias("year"))


@query(
    "weather_categories",
    """SELECT CASE WHEN c BETWEEN 0 AND 3 THEN 'cloud_variation' WHEN c = 4 THEN 'smoke_or_pollution' WHEN c = 5 THEN 'dry_haze' WHEN c BETWEEN 6 AND 9 THEN 'dust_or_sandstorm'
     WHEN c BETWEEN 10 AND 12 THEN 'drizzle_or_local_fog' WHEN c = 13 THEN 'lightning_no_thunder' WHEN c BETWEEN 14 AND 16 THEN 'visible_precipitation'
     WHEN c BETWEEN 17 AND 19 THEN 'storm_or_gusts' WHEN c BETWEEN 20 AND 29 THEN 'non_violent_rain_or_fog' WHEN c BETWEEN 30 AND 39 THEN 'evolving_fog'
     WHEN c BETWEEN 40 AND 49 THEN 'light_to_heavy_rain' WHEN c BETWEEN 50 AND 59 THEN 'freezing_drizzle_or_rain' WHEN c BETWEEN 60 AND 69 THEN 'rain_snow_combination'
     WHEN c BETWEEN 70 AND 79 THEN 'snow_or_sleet' WHEN c BETWEEN 80 AND 89 THEN 'showers_or_small_hail' WHEN c BETWEEN 90 AND 99 THEN 'thunderstorm_or_hail' ELSE 'unknown' END AS category,
     count(*) AS n FROM (SELECT event_id % 102 - 1 AS c FROM events) GROUP BY 1""",
)
def weather_categories(t: Tables) -> DataFrame:
    code = F.col("event_id") % 102 - 1
    return t.events.groupBy(codes.weather_category(code).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "season_of_month",
    "SELECT ['winter','spring','summer','autumn'][(month(o_orderdate) % 12) // 3 + 1] AS season, count(*) AS n FROM orders GROUP BY 1",
)
def season_of_month(t: Tables) -> DataFrame:
    return t.orders.groupBy(cal.season(F.month("o_orderdate")).alias("season")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "weekend_and_weekday",
    """SELECT CAST(CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS weekend,
    ['Lundi','Mardi','Mercredi','Jeudi','Vendredi','Samedi','Dimanche'][isodow(o_orderdate)] AS jour, count(*) AS n FROM orders GROUP BY 1, 2""",
)
def weekend_and_weekday(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders.groupBy(cal.is_weekend(day).alias("weekend"), cal.weekday_label(day).alias("jour")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "string_difference",
    """SELECT p_partkey, CASE WHEN s IS NULL THEN '[source] EMPTY' WHEN contains(tgt, s) THEN trim(replace(tgt, s, ''), ' \t\n') ELSE concat('[', s, '] NOT FOUND') END AS difference
    FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN p_type ELSE p_brand END AS s, concat(p_brand, '  ', p_name, chr(9)) AS tgt FROM part)""",
)
def string_difference(t: Tables) -> DataFrame:
    pairs = t.part.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 7 == 0, None).when(F.col("p_partkey") % 5 == 0, F.col("p_type")).otherwise(F.col("p_brand")).alias("source"),
        F.concat("p_brand", F.lit("  "), "p_name", F.lit("\t")).alias("target"),
    )
    return pairs.select("p_partkey", text.text_difference("source", "target").alias("difference"))


@query(
    "split_coordinates",
    "SELECT event_id, CAST(round(48 + user_id * 0.001, 3) AS DOUBLE) AS latitude, CAST(round(2 + user_id * 0.002, 3) AS DOUBLE) AS longitude FROM events",
)
def split_coordinates(t: Tables) -> DataFrame:
    written = t.events.select(
        "event_id",
        F.concat_ws(", ", F.format_string("%.3f", 48 + F.col("user_id") * 0.001), F.format_string("%.3f", 2 + F.col("user_id") * 0.002)).alias("geo"),
    )
    parsed = text.split_coordinates(written, "geo")
    return parsed.select("event_id", r6("latitude", 3).alias("latitude"), r6("longitude", 3).alias("longitude"))


@query("explode_list", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1")
def explode_list(t: Tables) -> DataFrame:
    return text.explode_list(t.part.select(F.col("p_name").alias("word")), "word", " ").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "person_names",
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN '' ELSE 'Sur' || c_nationkey END AS "Surname",
    CASE WHEN c_custkey % 4 = 3 THEN '' ELSE ['Mr', 'Ms', 'Dr'][CAST(c_custkey % 4 + 1 AS INTEGER)] END AS "Title",
    CASE WHEN c_custkey % 4 = 3 THEN c_name ELSE c_mktsegment || ' Ann' END AS "Firstname(s)",
    CASE WHEN c_custkey % 4 = 3 THEN '' ELSE ['Mr', 'Miss', 'Special'][CAST(c_custkey % 4 + 1 AS INTEGER)] END AS grouped FROM customer""",
)
def person_names(t: Tables) -> DataFrame:
    pick = F.when(F.col("c_custkey") % 4 == 0, "Mr. ").when(F.col("c_custkey") % 4 == 1, "Ms. ").otherwise("Dr. ")
    named = F.concat(F.lit("Sur"), F.col("c_nationkey"), F.lit(", "), pick, F.col("c_mktsegment"), F.lit(' ("Ann")'))
    people = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 4 == 3, F.col("c_name")).otherwise(named).alias("name"))
    parsed = text.parse_person_name(people, "name")
    return parsed.select("c_custkey", "Surname", "Title", "Firstname(s)", codes.title_group(F.col("Title")).alias("grouped"))


@query(
    "cabin_split",
    """SELECT p_partkey, substr(c, 1, 1) AS cabin_letter, CASE WHEN n % 2 = 0 THEN 'Babord' WHEN n % 2 = 1 THEN 'Tribord' END AS cabin_parite
    FROM (SELECT p_partkey, c, TRY_CAST(regexp_extract(substr(c, 2, 4), '([0-9]+)', 1) AS INTEGER) AS n FROM
     (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'T' ELSE chr(CAST(65 + p_size % 7 AS INTEGER)) || p_size END AS c FROM part))""",
)
def cabin_split(t: Tables) -> DataFrame:
    letter = F.char(65 + F.col("p_size") % 7)
    cabins = t.part.select(
        "p_partkey", F.when(F.col("p_partkey") % 9 == 0, "T").otherwise(F.concat(letter, F.col("p_size").cast("string"))).alias("cabin")
    )
    return text.split_cabin(cabins, "cabin").select("p_partkey", "cabin_letter", "cabin_parite")


@query(
    "fixed_bins",
    """SELECT p_partkey, CASE WHEN p_size > 1 AND p_size <= 12 THEN 'small' WHEN p_size > 12 AND p_size <= 30 THEN 'medium' WHEN p_size > 30 AND p_size <= 50 THEN 'large' END AS bin FROM part""",
)
def fixed_bins(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", clean.cut(F.col("p_size"), [1, 12, 30, 50], ["small", "medium", "large"]).alias("bin"))


@query(
    "quartile_bins",
    """WITH q AS (SELECT min(v) AS a, quantile_cont(v, 0.25) AS b, quantile_cont(v, 0.5) AS c, quantile_cont(v, 0.75) AS d, max(v) AS e FROM (SELECT o_totalprice AS v FROM orders))
    SELECT o_orderkey, CASE WHEN o_totalprice > a AND o_totalprice <= b THEN 'q1' WHEN o_totalprice > b AND o_totalprice <= c THEN 'q2'
    WHEN o_totalprice > c AND o_totalprice <= d THEN 'q3' WHEN o_totalprice > d AND o_totalprice <= e THEN 'q4' END AS bin FROM orders, q""",
)
def quartile_bins(t: Tables) -> DataFrame:
    return clean.cut_quartiles(t.orders, "o_totalprice", ["q1", "q2", "q3", "q4"], "bin").select("o_orderkey", "bin")


@query(
    "value_regroup",
    """SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast' WHEN o_orderpriority = '5-LOW' THEN 'slow' ELSE o_orderpriority END AS grp,
    CAST(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 WHEN 'P' THEN 0 END AS INTEGER) AS grade, count(*) AS n FROM orders GROUP BY 1, 2""",
)
def value_regroup(t: Tables) -> DataFrame:
    groups = {"fast": ["1-URGENT", "2-HIGH"], "slow": ["5-LOW"]}
    return t.orders.groupBy(
        codes.regroup(F.col("o_orderpriority"), groups).alias("grp"), codes.ordinal(F.col("o_orderstatus"), ["F", "O", "P"]).alias("grade")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "mapped_values",
    """SELECT c.c_custkey, coalesce(r.r_name, 'unknown') AS region FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
def mapped_values(t: Tables) -> DataFrame:
    """Countries to regions through a mapping table."""
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return clean.map_values(t.customer, "c_nationkey", regions, "region", "unknown").select("c_custkey", "region")


@query("family_size", "SELECT l_orderkey, l_linenumber, CAST(l_linenumber + coalesce(CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey END, 0) + 1 AS BIGINT) AS family FROM lineitem")
def family_size(t: Tables) -> DataFrame:
    base = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey")).alias("others"))
    return base.select("l_orderkey", "l_linenumber", clean.family_size(["l_linenumber", "others"]).cast("long").alias("family"))


@query("binary_labels", "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders")
def binary_labels(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", clean.binary_label(F.col("o_orderstatus"), "F").alias("label"))


@query(
    "joint_share_recode",
    """WITH s AS (SELECT l_shipmonth FROM (SELECT month(l_shipdate) AS l_shipmonth, l_returnflag FROM lineitem) GROUP BY 1
      HAVING count(*) FILTER (WHERE l_returnflag = 'A') >= 0.028 * (SELECT count(*) FROM lineitem))
    SELECT month(l_shipdate) AS l_shipmonth, CAST(month(l_shipdate) IN (SELECT l_shipmonth FROM s) AS INTEGER) AS flag, count(*) AS n
    FROM lineitem GROUP BY 1, 2""",
)
def joint_share_recode(t: Tables) -> DataFrame:
    """Ship months whose returned rows are at least 2.8 % of all line items."""
    months = t.lineitem.select(F.month("l_shipdate").cast("long").alias("l_shipmonth"), "l_returnflag")
    coded = features.recode_by_joint_share(months, "l_shipmonth", "l_returnflag", "A", 0.028)
    return coded.groupBy("l_shipmonth", F.col("l_shipmonth_flag").alias("flag")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "plain_text_values",
    """SELECT n_nationkey, lower(replace(strip_accents('Éta' || n_name), ' ', '_')) AS cleaned FROM nation""",
)
def plain_text_values(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", text.plain_text(F.concat(F.lit("Éta"), "n_name")).alias("cleaned"))


@query(
    "document_accents",
    "SELECT doc_id, length(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')) AS n FROM documents",
)
def document_accents(t: Tables) -> DataFrame:
    """Length of whole texts folded to ASCII."""
    return t.documents.select("doc_id", long(F.length(text.ascii_fold(F.col("text")))).alias("n"))


@query(
    "formula_functions",
    """SELECT event_id, round(abs(value - 50), 6) AS a, round(sqrt(value), 6) AS b, round(exp(value / 100), 6) AS c, event_id % 12 // 3 + 1 AS d FROM events""",
)
def formula_functions(t: Tables) -> DataFrame:
    v = F.col("value")
    return t.events.select(
        "event_id", r6(F.abs(v - 50)).alias("a"), r6(F.sqrt(v)).alias("b"), r6(F.exp(v / 100)).alias("c"), (F.floor(F.col("event_id") % 12 / 3) + 1).alias("d")
    )


@query(
    "clock_change_periods",
    """SELECT strftime(date_trunc('hour', (ts + INTERVAL 300 DAY) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris'), '%Y-%m-%d %H:%M:%S') AS period,
    count(DISTINCT date_trunc('hour', ts)) AS instants, round(sum(value), 4) AS total FROM events GROUP BY 1""",
)
def clock_change_periods(t: Tables) -> DataFrame:
    """Across the autumn change one wall-clock hour holds two instant hours."""
    moved = paris_events(t, 300)
    return moved.groupBy(text_time(cal.hour_period(F.col("ts"))).alias("period")).agg(
        F.count_distinct(cal.hour_bucket(F.col("ts"))).alias("instants"), r6(F.sum("value"), 4).alias("total")
    )
