"""Calendar expressions on instants and local wall-clock time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ZONE = "Europe/Paris"
# accepts +0100, +02:00 and Z; ANSI mode rejects anything else
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss[XXX][XX]"


def as_instant(df: DataFrame, column: str) -> Column:
    """Column as an instant: ISO text is parsed strictly, naive timestamps are taken as UTC."""
    kind = dict(df.dtypes)[column]
    if kind == "string":
        return F.to_timestamp(column, ISO_INSTANT)
    if kind == "timestamp_ntz":
        return _ntz_utc(column)
    if kind == "timestamp":
        return F.col(column)
    raise ValueError(f"column {column!r} must be a timestamp or ISO text, not {kind}")


def _ntz_utc(column: str) -> Column:
    # re-express the UTC wall clock in the session zone, then read it as an instant
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column)).cast("timestamp")


def wall_clock(instant: Column, zone: str = DEFAULT_ZONE) -> Column:
    """TIMESTAMP_NTZ in the zone; the two hours of an autumn clock change share one value."""
    return F.convert_timezone(None, F.lit(zone), instant)


def datetime_features(df: DataFrame, column: str, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Eleven calendar columns named ``<column>_*`` from an instant column or ISO text."""
    instant = as_instant(df, column)
    local = wall_clock(instant, zone)
    columns = {
        "utc": instant,
        "local": local,
        "year": F.year(local),
        "month": F.month(local),
        "day": F.dayofmonth(local),
        "day_of_year": F.dayofyear(local),
        "day_of_week": F.weekday(local),
        "hour": F.hour(local),
        "week": F.weekofyear(local),
        "dayname": F.date_format(local, "EEEE"),
        "monthname": F.date_format(local, "MMMM"),
    }
    return df.withColumns({f"{column}_{name}": expr for name, expr in columns.items()})


def hour_bucket(instant: Column) -> Column:
    """Hour of the instant: keeps both hours of an autumn clock change apart."""
    return F.date_trunc("hour", instant)


def hour_period(instant: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Wall-clock hour: merges both hours of an autumn clock change."""
    return F.date_trunc("hour", wall_clock(instant, zone)).cast("timestamp_ntz")


def week_ending_sunday(day: Column) -> Column:
    return F.next_day(F.date_sub(day, 1), "Sunday")


def season(month: Column) -> Column:
    # fixed values: meteorological seasons
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .when(month.isin(9, 10, 11), "autumn")
    )


def is_weekend(day: Column) -> Column:
    return (F.weekday(day) >= 5).cast("int")


def weekday_label(day: Column) -> Column:
    # fixed values: Monday = 0
    names = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.weekday(day) + 1)


def english_date_year(text: Column) -> Column:
    """Year of a date such as ' September 9, 2019'; NULL when it does not parse."""
    return F.year(F.try_to_timestamp(F.trim(text), F.lit("MMMM d, yyyy")))


def date_span(df: DataFrame, column: str, zone: str = DEFAULT_ZONE) -> DataFrame:
    """First and last local day, and the list of years they cover."""
    day = F.to_date(wall_clock(as_instant(df, column), zone))
    span = df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return span.withColumn("years", F.sequence(F.year("first_day"), F.year("last_day")))
