"""Calendar, weather, attribute and spatial joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.functions import calendar as cal
from meterwise.functions import geo
from meterwise.operators import clean, enrich, joins, spatial
from meterwise.plans.registry import Tables, long, paris_events, query, r6, text_time

# fixed values: French public holidays that fall in the shifted range of the events
HOLIDAYS = [
    ("metropole", "2024-04-01", "Lundi de Pâques"),
    ("metropole", "2024-05-01", "1er mai"),
    ("metropole", "2024-05-08", "8 mai"),
    ("metropole", "2024-03-29", "Jour d'essai"),
    ("alsace-moselle", "2024-03-28", "Vendredi saint"),
]
PERIODS = [
    ("Paris", "Zone C", "2024-03-25", "2024-03-30T00:00:00", "Vacances A", 1),
    ("Paris", "Zone C", "2024-03-29", "2024-04-06", "Vacances B", 2),
    ("Paris", "Zone A", "2024-04-08", "2024-04-12", "Autre zone", 3),
    ("Lyon", "Zone C", "2024-04-08", "2024-04-12", "Autre ville", 4),
    ("Paris", "Zone C", "illisible", "2024-04-12", "Sans date", 5),
    ("Paris", "Zone C", "2024-04-15", "2024-04-17", "Vacances C", 6),
]
LOCAL = "((ts + INTERVAL 85 DAY) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris')"
HOLIDAY_VALUES = ", ".join(f"('{c}', DATE '{d}')" for c, d, _ in HOLIDAYS)


def holidays(t: Tables) -> DataFrame:
    return t.literal(HOLIDAYS, "country_code string, date string, name string")


@query(
    "hourly_holiday_profile",
    f"""WITH h(country, d) AS (VALUES {HOLIDAY_VALUES}), e AS (
      SELECT {LOCAL} AS l, value FROM events)
    SELECT CAST(extract('hour' FROM l) AS BIGINT) AS hour,
      CAST(CASE WHEN CAST(l AS DATE) IN (SELECT d FROM h WHERE country = 'metropole') THEN 1 ELSE 0 END AS BIGINT) AS jour_ferie,
      count(*) AS n, round(avg(value), 6) AS mean_value
    FROM e GROUP BY 1, 2""",
)
def hourly_holiday_profile(t: Tables) -> DataFrame:
    flagged = enrich.add_holiday_flag(paris_events(t).select("ts", "value"), "ts", holidays(t))
    return (
        flagged.groupBy(long(F.hour(cal.wall_clock(F.col("ts")))).alias("hour"), long("jour_ferie").alias("jour_ferie"))
        .agg(F.count(F.lit(1)).alias("n"), r6(F.avg("value")).alias("mean_value"))
    )


@query(
    "holiday_flag_days",
    f"""WITH h(country, d) AS (VALUES {HOLIDAY_VALUES})
    SELECT event_id, CAST(CASE WHEN CAST({LOCAL} AS DATE) IN (SELECT d FROM h WHERE country = 'metropole') THEN 1 ELSE 0 END AS INTEGER) AS jour_ferie
    FROM events""",
)
def holiday_flag_days(t: Tables) -> DataFrame:
    return enrich.add_holiday_flag(paris_events(t), "ts", holidays(t)).select("event_id", "jour_ferie")


@query(
    "vacation_interval_join",
    f"""WITH p(a, b, label, ord) AS (VALUES (DATE '2024-03-25', DATE '2024-03-30', 'Vacances A', 1),
       (DATE '2024-03-29', DATE '2024-04-06', 'Vacances B', 2), (DATE '2024-04-15', DATE '2024-04-17', 'Vacances C', 6)),
    e AS (SELECT event_id, CAST({LOCAL} AS DATE) AS d FROM events)
    SELECT e.event_id, coalesce(arg_min(p.label, p.ord), 'aucune') AS vacances_scolaires
    FROM e LEFT JOIN p ON e.d BETWEEN p.a AND p.b GROUP BY e.event_id""",
)
def vacation_interval_join(t: Tables) -> DataFrame:
    periods = t.literal(PERIODS, "location string, zones string, start_date string, end_date string, description string, ord int")
    return enrich.add_school_vacation(paris_events(t), "ts", periods).select("event_id", "vacances_scolaires")


@query(
    "weather_join",
    """WITH w AS (SELECT lat, lon, h, avg(v) AS temperature FROM (
        SELECT round(48.8 + (user_id % 10) * 0.01, 6) AS lat, round(2.3 + (user_id % 7) * 0.01, 6) AS lon,
          date_trunc('hour', ts) AS h, CAST(extract('hour' FROM ts) AS DOUBLE) + (user_id % 10) AS v
        FROM events WHERE event_type = 'click') GROUP BY lat, lon, h)
    SELECT e.event_id, round(w.temperature, 6) AS temperature_2m_c FROM events e LEFT JOIN w
      ON round(48.8 + (e.user_id % 10) * 0.01, 6) = w.lat AND round(2.3 + (e.user_id % 7) * 0.01, 6) = w.lon
      AND date_trunc('hour', e.ts) = w.h""",
)
def weather_join(t: Tables) -> DataFrame:
    sites = {
        "latitude": 48.8 + (F.col("user_id") % 10) * 0.01,
        "longitude": 2.3 + (F.col("user_id") % 7) * 0.01,
    }
    readings = t.events.withColumns(sites)
    hours = {**{k: F.round(v, 6) for k, v in sites.items()}, "hour": F.date_trunc("hour", "ts").cast("timestamp_ntz")}
    weather = (
        t.events.filter("event_type = 'click'").withColumns(hours)
        .groupBy("latitude", "longitude", F.col("hour").alias("ts"))
        .agg(F.avg(F.hour("ts").cast("double") + F.col("user_id") % 10).alias("temperature_2m_c"))
    )
    joined = enrich.add_weather(readings, weather, instant="ts")
    return joined.select("event_id", r6("temperature_2m_c").alias("temperature_2m_c"))


@query(
    "composite_key_join",
    """SELECT l.l_orderkey, l.l_linenumber, o.o_custkey AS key_x, s.s_nationkey AS key_y, count(*) AS n
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN supplier s ON l.l_suppkey = s.s_suppkey
      JOIN customer c ON o.o_custkey = c.c_custkey AND s.s_nationkey = c.c_nationkey
    GROUP BY 1, 2, 3, 4""",
)
def composite_key_join(t: Tables) -> DataFrame:
    left = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        joins.broadcast_if_small(t.supplier.select("s_suppkey", "s_nationkey")), F.col("l_suppkey") == F.col("s_suppkey")
    )
    left = left.select("l_orderkey", "l_linenumber", F.col("o_custkey").alias("key"), F.col("s_nationkey").alias("nation"))
    right = t.customer.select(F.col("c_custkey"), F.col("c_nationkey").alias("key"))
    both = joins.join_with_suffixes(left, right, ["key", "nation"], ["c_custkey", "key"], "inner")
    return both.groupBy("l_orderkey", "l_linenumber", "key_x", "key_y").agg(F.count(F.lit(1)).alias("n"))


@query(
    "left_join_titles",
    """SELECT l.l_orderkey, l.l_partkey, p.p_name, l.l_quantity FROM lineitem l
    LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l.l_partkey = p.p_partkey""",
)
def left_join_titles(t: Tables) -> DataFrame:
    titles = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return t.lineitem.join(titles, "l_partkey", "left").select("l_orderkey", "l_partkey", "p_name", "l_quantity")


@query(
    "semi_join_top_set",
    """WITH top AS (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 10)
    SELECT l_suppkey, count(*) AS n, round(sum(l_quantity), 4) AS qty FROM lineitem
    WHERE l_suppkey IN (SELECT l_suppkey FROM top) GROUP BY 1""",
)
def semi_join_top_set(t: Tables) -> DataFrame:
    from meterwise.operators.analytics import only_top_groups

    kept = only_top_groups(t.lineitem.select("l_suppkey", "l_quantity"), "l_suppkey", 10)
    return kept.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("l_quantity"), 4).alias("qty"))


@query(
    "keyed_column_concat",
    """SELECT o.o_orderkey, o.o_totalprice, x.lines, round(x.qty, 4) AS qty FROM orders o
    LEFT JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS qty FROM lineitem GROUP BY 1) x ON o.o_orderkey = x.l_orderkey""",
)
def keyed_column_concat(t: Tables) -> DataFrame:
    """Index-aligned concat becomes a join on the explicit key."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("qty")
    )
    return t.orders.select("o_orderkey", "o_totalprice").join(lines, "o_orderkey", "left").withColumn("qty", r6("qty", 4))


@query(
    "group_fill",
    """WITH base AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS cabin FROM orders),
    f AS (SELECT o_custkey, arg_min(cabin, o_orderkey) AS cabin FROM base WHERE cabin IS NOT NULL GROUP BY 1)
    SELECT b.o_orderkey, f.cabin FROM base b LEFT JOIN f ON b.o_custkey = f.o_custkey""",
)
def group_fill(t: Tables) -> DataFrame:
    base = t.orders.select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("cabin")
    )
    return clean.fill_from_group(base, "o_custkey", "cabin", "o_orderkey").select("o_orderkey", "cabin")


@query(
    "representative_rows",
    """WITH src AS (SELECT p_brand, arg_min(p_size, p_partkey) AS p_size, arg_min(p_type, p_partkey) AS p_type FROM part
      WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1),
    m(s, d) AS (VALUES ('Brand#1', 'Brand#11'), ('Brand#2', 'Brand#12'), ('Absent', 'Brand#13'))
    SELECT p.p_partkey, p.p_brand, coalesce(x.p_size, p.p_size) AS p_size, coalesce(x.p_type, p.p_type) AS p_type
    FROM part p LEFT JOIN (SELECT m.d, src.* FROM m JOIN src ON m.s = src.p_brand) x ON p.p_brand = x.d""",
)
def representative_rows(t: Tables) -> DataFrame:
    pairs = [("Brand#1", "Brand#11"), ("Brand#2", "Brand#12"), ("Absent", "Brand#13")]
    fixed = clean.propagate_representative(t.part, "p_brand", "p_partkey", pairs, ["p_size", "p_type"])
    return fixed.select("p_partkey", "p_brand", "p_size", "p_type")


# ---- spatial ----

# two rectangles that overlap, and one with a square hole
SHAPES = [
    ("west", [[[2.30, 48.80], [2.34, 48.80], [2.34, 48.86], [2.30, 48.86], [2.30, 48.80]]], 1),
    ("east", [[[2.33, 48.82], [2.37, 48.82], [2.37, 48.90], [2.33, 48.90], [2.33, 48.82]],
              [[2.345, 48.845], [2.365, 48.845], [2.365, 48.865], [2.345, 48.865], [2.345, 48.845]]], 2),
]


def shapes(t: Tables, rows=None) -> DataFrame:
    return t.literal(rows or SHAPES, "commune string, rings array<array<array<double>>>, ord long")


def sites(t: Tables) -> DataFrame:
    # a half-step offset keeps every point off the polygon edges
    return t.events.select(
        "event_id",
        (F.lit(2.2905) + (F.col("user_id") % 10) * F.lit(0.01)).alias("longitude"),
        (F.lit(48.7905) + F.floor(F.col("user_id") / 10) * F.lit(0.01)).alias("latitude"),
    )


@query(
    "polygon_join",
    """WITH e AS (SELECT event_id, 2.2905 + (user_id % 10) * CAST(0.01 AS DOUBLE) AS x, 48.7905 + (user_id // 10) * CAST(0.01 AS DOUBLE) AS y FROM events)
    SELECT event_id, CASE WHEN x > 2.30 AND x < 2.34 AND y > 48.80 AND y < 48.86 THEN 'west'
      WHEN x > 2.33 AND x < 2.37 AND y > 48.82 AND y < 48.90 AND NOT (x > 2.345 AND x < 2.365 AND y > 48.845 AND y < 48.865) THEN 'east' END AS commune FROM e""",
)
def polygon_join(t: Tables) -> DataFrame:
    return spatial.assign_polygons(sites(t), shapes(t)).select("event_id", "commune")


@query(
    "polygon_fallback",
    """SELECT event_id, CASE WHEN user_id % 4 = 0 THEN 'corner' END AS commune FROM events""",
)
def polygon_fallback(t: Tables) -> DataFrame:
    """Points only on a corner: no strict match anywhere, so touching polygons count."""
    points = t.events.select(
        "event_id",
        F.when(F.col("user_id") % 4 == 0, 2.0).otherwise(9.0).alias("longitude"),
        F.lit(48.0).alias("latitude"),
    )
    square = [("corner", [[[2.0, 48.0], [3.0, 48.0], [3.0, 49.0], [2.0, 49.0], [2.0, 48.0]]], 1)]
    return spatial.assign_polygons(points, shapes(t, square)).select("event_id", "commune")


@query(
    "point_lookup",
    """SELECT count(*) AS n, 'west' AS commune FROM events WHERE 2.2905 + (user_id % 10) * CAST(0.01 AS DOUBLE) > 2.30
    AND 2.2905 + (user_id % 10) * CAST(0.01 AS DOUBLE) < 2.34 AND 48.7905 + (user_id // 10) * CAST(0.01 AS DOUBLE) > 48.80
    AND 48.7905 + (user_id // 10) * CAST(0.01 AS DOUBLE) < 48.86""",
)
def point_lookup(t: Tables) -> DataFrame:
    label = spatial.find_polygon(shapes(t), 2.31, 48.81)
    west = geo.within(F.col("longitude"), F.col("latitude"), F.lit(SHAPES[0][1]).cast("array<array<array<double>>>"))
    return sites(t).filter(west).agg(F.count(F.lit(1)).alias("n")).withColumn("commune", F.lit(label))


@query(
    "mercator_points",
    """SELECT event_id, round(radians(2.3 + user_id * 0.001) * 6378137, 4) AS x,
    round(6378137 * ln(tan(pi() / 4 + radians(48.8 + user_id * 0.001) / 2)), 4) AS y FROM events""",
)
def mercator_points(t: Tables) -> DataFrame:
    point = geo.lonlat_to_mercator(F.lit(2.3) + F.col("user_id") * 0.001, F.lit(48.8) + F.col("user_id") * 0.001)
    return t.events.select("event_id", r6(point[0], 4).alias("x"), r6(point[1], 4).alias("y"))


_STEP = "2 * atan(pow((1 + 0.08181919104281579 * sin(f{0})) / (1 - 0.08181919104281579 * sin(f{0})), 0.08181919104281579 / 2) * base) - pi() / 2 AS f{1}"


def _lambert_sql() -> str:
    inner = (
        "SELECT event_id, lon, base, 2 * atan(base) - pi() / 2 AS f0 FROM (SELECT event_id, 3 + degrees(atan(dx / dy) / 0.7256077650532670) AS lon, "
        "exp(-ln(sqrt(dx * dx + dy * dy) / 11754255.4261) / 0.7256077650532670) AS base FROM (SELECT event_id, "
        "CAST(600000 + user_id * 1000 - 700000 AS DOUBLE) AS dx, 12655612.0499 - (6600000 + user_id * 500) AS dy FROM events))"
    )
    for i in range(6):
        inner = f"SELECT event_id, lon, base, {_STEP.format(i, i + 1)} FROM ({inner})"
    return f"SELECT event_id, round(lon, 6) AS lon, round(degrees(f6), 6) AS lat FROM ({inner})"


@query("lambert_points", _lambert_sql())
def lambert_points(t: Tables) -> DataFrame:
    point = geo.lambert93_to_lonlat(
        (600000 + F.col("user_id") * 1000).cast("double"), (6600000 + F.col("user_id") * 500).cast("double")
    )
    return t.events.select("event_id", r6(point[0]).alias("lon"), r6(point[1]).alias("lat"))


@query(
    "reprojected_polygon_join",
    """SELECT event_id, CASE WHEN abs(-0.2 + (user_id % 41) * 0.01) < degrees(atan(5000.0 / (12655612.049876 - 6600000.0))) / 0.7256077650532670 THEN 'origin' END AS commune
    FROM events""",
)
def reprojected_polygon_join(t: Tables) -> DataFrame:
    """A square of 10 km around the projection's origin, reprojected from metres; points on its middle parallel."""
    ring = [[700_000.0 + 5000 * x, 6_600_000.0 + 5000 * y] for x, y in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]
    points = t.events.select(
        "event_id", (F.lit(2.8) + (F.col("user_id") % 41) * 0.01).alias("longitude"), F.lit(46.5).alias("latitude")
    )
    return spatial.assign_polygons(points, shapes(t, [("origin", [ring], 1)]), crs="EPSG:2154").select("event_id", "commune")


@query(
    "dated_features",
    f"""SELECT event_id, strftime({LOCAL}, '%Y-%m-%d %H:%M:%S') AS ts_local, year(l) AS ts_year, month(l) AS ts_month, day(l) AS ts_day,
      dayofyear(l) AS ts_day_of_year, isodow(l) - 1 AS ts_day_of_week, hour(l) AS ts_hour, week(l) AS ts_week,
      dayname(l) AS ts_dayname, monthname(l) AS ts_monthname
    FROM (SELECT event_id, ts, {LOCAL} AS l FROM events)""",
)
def dated_features(t: Tables) -> DataFrame:
    built = cal.datetime_features(paris_events(t).select("event_id", "ts"), "ts")
    numbers = ["year", "month", "day", "day_of_year", "day_of_week", "hour", "week"]
    return built.select(
        "event_id", text_time("ts_local").alias("ts_local"), *[long(f"ts_{n}").alias(f"ts_{n}") for n in numbers], "ts_dayname", "ts_monthname"
    )


@query(
    "enrichment_chain",
    f"""WITH h(country, d) AS (VALUES {HOLIDAY_VALUES}), e AS (SELECT event_id, {LOCAL} AS l, CAST(floor(value) AS BIGINT) % 100 AS code FROM events)
    SELECT event_id, hour(l) AS ts_hour, CAST(CASE WHEN CAST(l AS DATE) IN (SELECT d FROM h WHERE country = 'metropole') THEN 1 ELSE 0 END AS INTEGER) AS jour_ferie,
      CASE WHEN code BETWEEN 0 AND 3 THEN 'cloud_variation' WHEN code = 4 THEN 'smoke_or_pollution' WHEN code = 5 THEN 'dry_haze'
       WHEN code BETWEEN 6 AND 9 THEN 'dust_or_sandstorm' WHEN code BETWEEN 10 AND 12 THEN 'drizzle_or_local_fog' WHEN code = 13 THEN 'lightning_no_thunder'
       WHEN code BETWEEN 14 AND 16 THEN 'visible_precipitation' WHEN code BETWEEN 17 AND 19 THEN 'storm_or_gusts' WHEN code BETWEEN 20 AND 29 THEN 'non_violent_rain_or_fog'
       WHEN code BETWEEN 30 AND 39 THEN 'evolving_fog' WHEN code BETWEEN 40 AND 49 THEN 'light_to_heavy_rain' WHEN code BETWEEN 50 AND 59 THEN 'freezing_drizzle_or_rain'
       WHEN code BETWEEN 60 AND 69 THEN 'rain_snow_combination' WHEN code BETWEEN 70 AND 79 THEN 'snow_or_sleet' WHEN code BETWEEN 80 AND 89 THEN 'showers_or_small_hail'
       WHEN code BETWEEN 90 AND 99 THEN 'thunderstorm_or_hail' ELSE 'unknown' END AS code_category FROM e""",
)
def enrichment_chain(t: Tables) -> DataFrame:
    """The row-wise steps as one ML pipeline over the fact table."""
    from pyspark.ml import Pipeline

    from meterwise.operators import transformers as tr

    holidays(t).createOrReplaceTempView("__holidays")
    base = paris_events(t).select("event_id", "ts", "value")
    stages = [
        tr.SqlColumns(columns={"Code": "CAST(floor(value) AS BIGINT) % 100"}),
        tr.KeepColumns(columns=["event_id", "ts", "Code"]),
        tr.NormalizeNames(),
        tr.DatetimeFeatures(column="ts"),
        tr.HolidayFlag(column="ts", table="__holidays"),
        tr.WeatherCategory(column="code"),
    ]
    built = Pipeline(stages=stages).fit(base).transform(base)
    return built.select("event_id", long("ts_hour").alias("ts_hour"), "jour_ferie", "code_category")
