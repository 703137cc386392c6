"""Time-series queries on the events table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators import forecast as fc
from meterwise.operators import seasonal_arima
from meterwise.operators import timeseries as ts
from meterwise.plans.registry import ORACLE, Tables, long, paris_events, query, r6, text_time

PARIS = "((ts + INTERVAL 85 DAY) AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris')"
# dense hourly table of all events, numbered from 0
HOURLY = """h AS (SELECT s.bucket, CAST(row_number() OVER (ORDER BY s.bucket) - 1 AS BIGINT) AS i, coalesce(x.v, 0) AS y FROM
 (SELECT unnest(generate_series(min(date_trunc('hour', ts)), max(date_trunc('hour', ts)), INTERVAL 1 HOUR)) AS bucket FROM events) s
 LEFT JOIN (SELECT date_trunc('hour', ts) AS bucket, sum(value) AS v FROM events GROUP BY 1) x ON s.bucket = x.bucket)"""


def hourly(t: Tables) -> DataFrame:
    return ts.resample_hours(t.events, "ts", "value")


@query(
    "resample_hours",
    """WITH g AS (SELECT user_id, min(date_trunc('hour', ts)) AS a, max(date_trunc('hour', ts)) AS b FROM events GROUP BY 1),
    s AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS bucket FROM g)
    SELECT s.user_id, strftime(s.bucket, '%Y-%m-%d %H:%M:%S') AS bucket, round(coalesce(x.v, 0), 4) AS value FROM s
    LEFT JOIN (SELECT user_id, date_trunc('hour', ts) AS bucket, sum(value) AS v FROM events GROUP BY 1, 2) x ON s.user_id = x.user_id AND s.bucket = x.bucket""",
)
def resample_hours(t: Tables) -> DataFrame:
    return ts.resample_hours(t.events, "ts", "value", ["user_id"]).select("user_id", text_time("bucket").alias("bucket"), r6("value", 4).alias("value"))


@query(
    "resample_days",
    f"""WITH x AS (SELECT event_type, CAST({PARIS} AS DATE) AS d, sum(value) AS v FROM events GROUP BY 1, 2),
    s AS (SELECT event_type, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM x GROUP BY 1)
    SELECT s.event_type, strftime(s.d, '%Y-%m-%d') AS bucket, round(coalesce(x.v, 0), 4) AS value FROM s LEFT JOIN x ON s.event_type = x.event_type AND s.d = x.d""",
)
def resample_days(t: Tables) -> DataFrame:
    days = ts.resample_days(paris_events(t), "ts", "value", ["event_type"])
    return days.select("event_type", F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), r6("value", 4).alias("value"))


@query(
    "resample_weeks",
    f"""WITH x AS (SELECT CAST({PARIS} AS DATE) AS d, value FROM events)
    SELECT strftime(d + CAST((7 - isodow(d)) AS INTEGER), '%Y-%m-%d') AS bucket, round(avg(value), 6) AS value FROM x GROUP BY 1""",
)
def resample_weeks(t: Tables) -> DataFrame:
    weeks = ts.resample_weeks(paris_events(t), "ts", "value")
    return weeks.select(F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), r6("value").alias("value"))


@query(
    "period_sums",
    f"SELECT event_type, strftime(date_trunc('hour', {PARIS}), '%Y-%m-%d %H:%M:%S') AS period, round(sum(value), 4) AS value FROM events GROUP BY 1, 2",
)
def period_sums(t: Tables) -> DataFrame:
    sums = ts.period_sums(paris_events(t), "ts", ["value"], ["event_type"])
    return sums.select("event_type", text_time("period").alias("period"), r6("value", 4).alias("value"))


@query("lag_and_rolling", f"""WITH {HOURLY} SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, round(lag(y) OVER (ORDER BY i), 4) AS lag1,
    CASE WHEN i >= 23 THEN round(avg(y) OVER (ORDER BY i ROWS 23 PRECEDING), 6) END AS rolling FROM h""")
def lag_and_rolling(t: Tables) -> DataFrame:
    rolled = ts.rolling_mean(hourly(t), "value", "bucket", 24)
    return ts.lagged(rolled, "value", "bucket").select(text_time("bucket").alias("bucket"), r6("lag1", 4).alias("lag1"), r6("rolling").alias("rolling"))


@query("seasonal_difference", f"""WITH {HOURLY}, a AS (SELECT bucket, i, y - lag(y, 24) OVER (ORDER BY i) AS d FROM h), b AS (SELECT * FROM a WHERE d IS NOT NULL),
    c AS (SELECT bucket, d - lag(d, 168) OVER (ORDER BY i) AS value FROM b) SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, round(value, 4) + 0.0 AS value FROM c WHERE value IS NOT NULL""")
def seasonal_difference(t: Tables) -> DataFrame:
    return ts.seasonal_difference(hourly(t), "value", "bucket", [24, 168]).select(text_time("bucket").alias("bucket"), r6("value", 4).alias("value"))


@query("cumulative_by_day", """SELECT day, round(total, 4) AS total, round(sum(total) OVER (ORDER BY day), 4) AS running FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, sum(value) AS total FROM events GROUP BY 1)""")
def cumulative_by_day(t: Tables) -> DataFrame:
    from meterwise.operators.analytics import running_total

    daily = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
    return running_total(daily, "day", "value").withColumns({"total": r6("total", 4), "running": r6("running", 4)})


@query("decomposition", f"""WITH {HOURLY}, n AS (SELECT max(i) AS m FROM h),
    a AS (SELECT bucket, i, y, CASE WHEN i >= 12 AND i <= (SELECT m FROM n) - 12 THEN (sum(y) OVER (ORDER BY i ROWS BETWEEN 11 PRECEDING AND 11 FOLLOWING) + 0.5 * (lag(y, 12) OVER (ORDER BY i) + lead(y, 12) OVER (ORDER BY i))) / 24 END AS trend FROM h),
    p AS (SELECT i % 24 AS phase, avg(y - trend) AS m FROM a GROUP BY 1), s AS (SELECT phase, m - (SELECT avg(m) FROM p) AS seasonal FROM p)
    SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, round(trend + 1e-9, 5) AS trend, round(seasonal + 1e-9, 5) + 0.0 AS seasonal, round(y - trend - seasonal + 1e-9, 5) + 0.0 AS resid FROM a JOIN s ON a.i % 24 = s.phase""")
def decomposition(t: Tables) -> DataFrame:
    parts = ts.decompose(hourly(t), "value", "bucket", 24)
    return parts.select(text_time("bucket").alias("bucket"), *[r6(F.col(c) + 1e-9, 5).alias(c) for c in ("trend", "seasonal", "resid")])


def _acf_sql(top: int) -> str:
    return f"""WITH {HOURLY}, m AS (SELECT avg(y) AS m, count(*) AS n FROM h), c AS (SELECT i, y - m AS d FROM h, m), v AS (SELECT sum(d * d) AS v FROM c), k AS (SELECT CAST(k AS INTEGER) AS k FROM range({top + 1}) t(k))
    SELECT k.k AS lag, round(sum(a.d * b.d) / any_value(v.v), 8) + 0.0 AS acf, round(any_value(1.96 / sqrt(m.n)), 8) AS band FROM k JOIN c a ON true JOIN c b ON b.i = a.i + k.k, v, m GROUP BY 1"""


@query("autocorrelation_96", _acf_sql(96))
def autocorrelation_96(t: Tables) -> DataFrame:
    return ts.acf(hourly(t), "value", "bucket", 96).select("lag", r6("acf", 8).alias("acf"), r6("band", 8).alias("band"))


@query("autocorrelation_672", _acf_sql(672))
def autocorrelation_672(t: Tables) -> DataFrame:
    return ts.acf(hourly(t), "value", "bucket", 672).select("lag", r6("acf", 8).alias("acf"), r6("band", 8).alias("band"))


USER_HOURLY = """g AS (SELECT user_id, min(date_trunc('hour', ts)) AS a, max(date_trunc('hour', ts)) AS b FROM events GROUP BY 1),
 s AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS bucket FROM g),
 h AS (SELECT s.user_id, s.bucket, CAST(row_number() OVER (PARTITION BY s.user_id ORDER BY s.bucket) - 1 AS BIGINT) AS i, coalesce(x.v, 0) AS y FROM s
  LEFT JOIN (SELECT user_id, date_trunc('hour', ts) AS bucket, sum(value) AS v FROM events GROUP BY 1, 2) x ON s.user_id = x.user_id AND s.bucket = x.bucket)"""


def user_hourly(t: Tables) -> DataFrame:
    return ts.resample_hours(t.events, "ts", "value", ["user_id"])


@query("lag_and_rolling_by_user", f"""WITH {USER_HOURLY} SELECT user_id, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, round(lag(y) OVER (PARTITION BY user_id ORDER BY i), 4) AS lag1,
    CASE WHEN i >= 23 THEN round(avg(y) OVER (PARTITION BY user_id ORDER BY i ROWS 23 PRECEDING), 6) END AS rolling FROM h""")
def lag_and_rolling_by_user(t: Tables) -> DataFrame:
    rolled = ts.rolling_mean(user_hourly(t), "value", "bucket", 24, ["user_id"], resampled=True)
    rolled = ts.lagged(rolled, "value", "bucket", 1, ["user_id"], resampled=True)
    return rolled.select("user_id", text_time("bucket").alias("bucket"), r6("lag1", 4).alias("lag1"), r6("rolling").alias("rolling"))


@query("seasonal_difference_by_user", f"""WITH {USER_HOURLY}, a AS (SELECT user_id, bucket, i, y - lag(y, 24) OVER (PARTITION BY user_id ORDER BY i) AS d FROM h)
    SELECT user_id, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, round(d, 4) + 0.0 AS value FROM a WHERE d IS NOT NULL""")
def seasonal_difference_by_user(t: Tables) -> DataFrame:
    differences = ts.seasonal_difference(user_hourly(t), "value", "bucket", [24], ["user_id"])
    return differences.select("user_id", text_time("bucket").alias("bucket"), r6("value", 4).alias("value"))


@query("temporal_split_by_user", f"""WITH {USER_HOURLY}, n AS (SELECT user_id, count(*) AS n FROM h GROUP BY 1)
    SELECT h.user_id, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, CAST(i >= n - floor(n * 0.1) AS INTEGER) AS is_test FROM h JOIN n ON h.user_id = n.user_id""")
def temporal_split_by_user(t: Tables) -> DataFrame:
    split = ts.temporal_split(user_hourly(t), "bucket", 0.1, ["user_id"])
    return split.select("user_id", text_time("bucket").alias("bucket"), F.col("is_test").cast("int").alias("is_test"))


@query("autocorrelation_by_type", """WITH g AS (SELECT event_type, min(date_trunc('hour', ts)) AS a, max(date_trunc('hour', ts)) AS b FROM events GROUP BY 1),
    s AS (SELECT event_type, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS bucket FROM g),
    h AS (SELECT s.event_type, row_number() OVER (PARTITION BY s.event_type ORDER BY s.bucket) AS i, coalesce(x.v, 0) AS y FROM s
     LEFT JOIN (SELECT event_type, date_trunc('hour', ts) AS bucket, sum(value) AS v FROM events GROUP BY 1, 2) x ON s.event_type = x.event_type AND s.bucket = x.bucket),
    m AS (SELECT event_type, avg(y) AS m FROM h GROUP BY 1), c AS (SELECT h.event_type, i, y - m AS d FROM h JOIN m ON h.event_type = m.event_type),
    v AS (SELECT event_type, sum(d * d) AS v FROM c GROUP BY 1), k AS (SELECT CAST(k AS INTEGER) AS k FROM range(49) t(k))
    SELECT a.event_type, k.k AS lag, round(sum(a.d * b.d) / any_value(v.v), 8) + 0.0 AS acf FROM k JOIN c a ON true JOIN c b ON b.event_type = a.event_type AND b.i = a.i + k.k
    JOIN v ON v.event_type = a.event_type GROUP BY 1, 2""")
def autocorrelation_by_type(t: Tables) -> DataFrame:
    by_type = ts.resample_hours(t.events, "ts", "value", ["event_type"])
    return ts.acf(by_type, "value", "bucket", 48, ["event_type"]).select("event_type", "lag", r6("acf", 8).alias("acf"))


@query("partial_autocorrelation")
def partial_autocorrelation(t: Tables) -> DataFrame:
    by_type = ts.resample_hours(t.events, "ts", "value", ["event_type"])
    return ts.pacf(by_type, "value", "bucket", 48, ["event_type"])


_ACF = ORACLE["autocorrelation_by_type"].replace("round(sum(a.d * b.d) / any_value(v.v), 8) + 0.0", "sum(a.d * b.d) / any_value(v.v)")


@query(
    "partial_autocorrelation_three",
    f"""WITH a AS ({_ACF}), r AS (SELECT event_type, max(acf) FILTER (WHERE lag = 1) AS x, max(acf) FILTER (WHERE lag = 2) AS y, max(acf) FILTER (WHERE lag = 3) AS z FROM a GROUP BY 1)
    SELECT event_type, 0::INTEGER AS lag, 1.0::DOUBLE AS pacf FROM r UNION ALL SELECT event_type, 1, round(x, 7) FROM r UNION ALL SELECT event_type, 2, round((y - x * x) / (1 - x * x), 7) FROM r
    UNION ALL SELECT event_type, 3, round((x * x * x - 2 * x * y + x * y * y + z - x * x * z) / (1 - 2 * x * x - y * y + 2 * x * x * y), 7) FROM r""",
)
def partial_autocorrelation_three(t: Tables) -> DataFrame:
    """The first lags of the recursion, against the quotients of determinants."""
    by_type = ts.resample_hours(t.events, "ts", "value", ["event_type"])
    return ts.pacf(by_type, "value", "bucket", 48, ["event_type"]).where("lag <= 3").select("event_type", "lag", r6("pacf", 7).alias("pacf"))


@query("stationarity")
def stationarity(t: Tables) -> DataFrame:
    found = ts.adf_test(hourly(t), "value", "bucket")
    row = (float(found["statistic"]), float(found["p_value"]), int(found["lags"]), float(found["critical"]["5%"]))
    return t.literal([row], "statistic double, p_value double, lags int, critical_5 double")


@query("temporal_split", f"""WITH {HOURLY}, n AS (SELECT count(*) AS n FROM h) SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, CAST(i >= n - floor(n * 0.1) AS INTEGER) AS is_test FROM h, n""")
def temporal_split(t: Tables) -> DataFrame:
    return ts.temporal_split(hourly(t), "bucket").select(text_time("bucket").alias("bucket"), F.col("is_test").cast("int").alias("is_test"))


def _supervised_sql(frame: str, need: int) -> str:
    return f"""WITH {HOURLY}, n AS (SELECT count(*) AS n FROM h), s AS (SELECT *, i >= n - floor(n * 0.1) AS is_test FROM h, n),
    w AS (SELECT bucket, y, is_test, lag(y) OVER (PARTITION BY is_test ORDER BY i) AS l, avg(y) OVER (PARTITION BY is_test ORDER BY i ROWS BETWEEN {frame}) AS m, row_number() OVER (PARTITION BY is_test ORDER BY i) AS r FROM s)
    SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, round(y, 4) AS value, CAST(is_test AS INTEGER) AS is_test, round(l, 4) AS lag1, round(m, 6) AS ma24 FROM w WHERE r > {need} AND l IS NOT NULL"""


def _supervised(t: Tables, include_current: bool) -> DataFrame:
    built = ts.supervised_table(hourly(t), "value", "bucket", include_current=include_current)
    return built.select(
        text_time("bucket").alias("bucket"), r6("value", 4).alias("value"), F.col("is_test").cast("int").alias("is_test"), r6("value_lag1", 4).alias("lag1"), r6("value_MA24").alias("ma24")
    )


@query("supervised_table", _supervised_sql("24 PRECEDING AND 1 PRECEDING", 24))
def supervised_table(t: Tables) -> DataFrame:
    return _supervised(t, False)


@query("supervised_table_current", _supervised_sql("23 PRECEDING AND CURRENT ROW", 23))
def supervised_table_current(t: Tables) -> DataFrame:
    return _supervised(t, True)


@query(
    "seasonal_profile",
    """SELECT CAST(hour(l) AS BIGINT) AS hour, round(avg(value) FILTER (WHERE month(l) IN (12, 1, 2)), 6) AS winter, round(avg(value) FILTER (WHERE month(l) IN (3, 4, 5)), 6) AS spring
    FROM (SELECT ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris' AS l, value FROM events UNION ALL SELECT """ + PARIS + """, value FROM events) GROUP BY 1""",
)
def seasonal_profile(t: Tables) -> DataFrame:
    both = paris_events(t, 0).unionByName(paris_events(t))
    wide = ts.seasonal_profile(both, "ts", "value")
    return wide.select(long("hour").alias("hour"), r6("winter").alias("winter"), r6("spring").alias("spring"))


@query("seasonal_forecast")
def seasonal_forecast(t: Tables) -> DataFrame:
    table = ts.resample_hours(t.events, "ts", "value", ["event_type"])
    return fc.forecast(fc.fit_seasonal(table, "event_type", "bucket", "value"), table, "event_type", "bucket", "value", 24)


@query("seasonal_forecast_exogenous")
def seasonal_forecast_exogenous(t: Tables) -> DataFrame:
    """With calendar columns; their future is known."""
    table = ts.resample_hours(t.events, "ts", "value", ["event_type"])
    calendar = {"hour_of_day": F.hour("bucket").cast("double"), "weekend": (F.weekday("bucket") >= 5).cast("double")}
    table = table.withColumns(calendar)
    model = fc.fit_seasonal(table, "event_type", "bucket", "value", exogenous=["hour_of_day", "weekend"])
    ends = table.groupBy("event_type").agg(F.max("bucket").alias("last"))
    steps = ends.select("event_type", "last", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("step"))
    ahead = steps.withColumn("bucket", F.col("last") + F.make_dt_interval(F.lit(0), F.col("step"))).withColumns(calendar)
    return fc.forecast(model, table, "event_type", "bucket", "value", 24, future=ahead)


SEASONAL = seasonal_arima.Orders(1, 1, 1, 1, 1, 1, 24)


@query("seasonal_arima_forecast")
def seasonal_arima_forecast(t: Tables) -> DataFrame:
    """(1,1,1)(1,1,1,24) per event type, 24 hours ahead."""
    table = ts.resample_hours(t.events, "ts", "value", ["event_type"])
    return seasonal_arima.forecast(table, "bucket", "value", ["event_type"], SEASONAL, 24)


@query("seasonal_arima_coefficients")
def seasonal_arima_coefficients(t: Tables) -> DataFrame:
    table = ts.resample_hours(t.events, "ts", "value", ["event_type"])
    found = seasonal_arima.fit(table, "bucket", "value", ["event_type"], SEASONAL)
    terms = F.array(*[F.lit(x) for x in SEASONAL.terms])
    return found.select("event_type", "sigma", "rows", F.inline(F.arrays_zip(terms.alias("term"), F.col("coefficients").alias("coefficient"))))


@query(
    "seasonal_arima_scores",
    f"""SELECT event_type, term, CAST(0 AS DOUBLE) AS score FROM (SELECT DISTINCT event_type FROM events), (SELECT unnest([{', '.join(f"'{x}'" for x in [*(f'long{k}' for k in range(SEASONAL.first + 1)), *SEASONAL.terms])}]) AS term)""",
)
def seasonal_arima_scores(t: Tables) -> DataFrame:
    """Both regressions against their score equations, with lags taken by windows: every residual sum with a term is 0."""
    table = ts.resample_hours(t.events, "ts", "value", ["event_type"])
    found = seasonal_arima.fit(table, "bucket", "value", ["event_type"], SEASONAL)
    w = ts.seasonal_difference(table, "value", "bucket", [1, 24], ["event_type"])
    ordered = Window.partitionBy("event_type").orderBy("bucket")  # one row per hour of the calendar

    def lags(column: str, numbers) -> list:
        return [F.lag(column, k).over(ordered) for k in numbers]

    def dot(values, weights: str, start: int) -> Column:
        return sum((v * F.get(weights, F.lit(start + i)) for i, v in enumerate(values)), F.lit(0.0))

    w = w.join(F.broadcast(found.select("event_type", "phi", "coefficients")), "event_type")
    first = w.select("*", F.array(F.lit(1.0), *lags("value", range(1, SEASONAL.first + 1))).alias("x1"))
    first = first.withColumn("e", F.col("value") - dot([F.get("x1", F.lit(k)) for k in range(SEASONAL.first + 1)], "phi", 0))
    second = first.select("*", F.array(F.lit(1.0), *lags("value", SEASONAL.ar), *lags("e", SEASONAL.ma)).alias("x2"))
    second = second.withColumn("u", F.col("value") - dot([F.get("x2", F.lit(k)) for k in range(len(SEASONAL.terms))], "coefficients", 0))

    def scores(x: str, e: str, names: list[str]) -> DataFrame:
        rows = second.where(F.col(e).isNotNull()).select("event_type", F.col(e).alias("r"), F.posexplode(x).alias("at", "v"))
        score = F.sum(F.col("r") * F.col("v")) / F.sqrt(F.sum(F.col("r") * F.col("r")) * F.sum(F.col("v") * F.col("v")))
        return rows.groupBy("event_type", "at").agg(r6(score).alias("score")).select("event_type", F.get(F.array(*[F.lit(n) for n in names]), F.col("at")).alias("term"), "score")

    return scores("x1", "e", [f"long{k}" for k in range(SEASONAL.first + 1)]).unionByName(scores("x2", "u", SEASONAL.terms))
