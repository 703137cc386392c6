"""Calendar and weather enrichment of a readings table by joins with reference tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.functions.calendar import DEFAULT_ZONE, as_instant, wall_clock
from meterwise.operators.joins import broadcast_if_small

NO_VACATION = "aucune"
SOURCE_FAILED = "erreur_api"


def _local_day(df: DataFrame, column: str, zone: str):
    if not dict(df.dtypes)[column].startswith("timestamp"):
        raise ValueError(f"column {column!r} must be a timestamp")
    return F.to_date(wall_clock(as_instant(df, column), zone))


def add_holiday_flag(
    df: DataFrame, column: str, holidays: DataFrame | None, country: str = "metropole", zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Add ``jour_ferie`` 0/1: the local day is in the (country_code, date, name) table.

    A missing table, or a year the table does not cover, gives 0.
    """
    day = _local_day(df, column, zone)
    if holidays is None:
        return df.withColumn("jour_ferie", F.lit(0))
    dates = (
        holidays.filter(F.col("country_code") == country)
        .select(F.col("date").cast("date").alias("__day"), F.lit(1).alias("__hit"))
        .distinct()
    )
    joined = df.withColumn("__day", day).join(broadcast_if_small(dates), "__day", "left")
    return joined.withColumn("jour_ferie", F.coalesce("__hit", F.lit(0))).drop("__day", "__hit")


def vacation_days(periods: DataFrame, location: str, zone_name: str) -> DataFrame:
    """One row per day covered by a matching period; the first period in ``ord`` order wins.

    Periods whose dates do not parse are skipped.
    """
    chosen = periods.filter((F.col("location") == location) & (F.col("zones") == zone_name))
    dated = chosen.select(
        F.to_date(F.col("start_date").cast("string").try_cast("timestamp")).alias("a"),
        F.to_date(F.col("end_date").cast("string").try_cast("timestamp")).alias("b"),
        "description",
        "ord",
    ).filter("a IS NOT NULL AND b IS NOT NULL AND a <= b AND description IS NOT NULL")
    days = dated.select(F.explode(F.sequence("a", "b")).alias("__day"), "description", "ord")
    return days.groupBy("__day").agg(F.min_by("description", "ord").alias("__vacation"))


def add_school_vacation(
    df: DataFrame,
    column: str,
    periods: DataFrame | None,
    location: str = "Paris",
    zone_name: str = "Zone C",
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Add ``vacances_scolaires``: the period (both ends included) that covers the local day.

    ``periods`` has location, zones, start_date, end_date, description and ``ord``, the
    position in the source.  The interval join becomes an equi-join on days.
    """
    day = _local_day(df, column, zone)
    if periods is None:
        return df.withColumn("vacances_scolaires", F.lit(SOURCE_FAILED))
    days = broadcast_if_small(vacation_days(periods, location, zone_name))
    joined = df.withColumn("__day", day).join(days, "__day", "left")
    label = F.coalesce("__vacation", F.lit(NO_VACATION))
    return joined.withColumn("vacances_scolaires", label).drop("__day", "__vacation")


def add_weather(
    df: DataFrame,
    weather: DataFrame | None,
    lat: str = "latitude",
    lon: str = "longitude",
    instant: str = "date_et_heure_de_comptage_utc",
    digits: int = 6,
) -> DataFrame:
    """Left join hourly weather on rounded coordinates and the hour of the instant.

    No weather table, or an empty one, returns the input unchanged.
    """
    if weather is None or weather.isEmpty():
        return df

    def keys(table: DataFrame) -> dict:
        return {
            "__lat": F.round(F.col(lat).cast("double"), digits),
            "__lon": F.round(F.col(lon).cast("double"), digits),
            "__hour": F.date_trunc("hour", as_instant(table, instant)),
        }

    right = weather.withColumns(keys(weather)).drop(lat, lon, instant)
    joined = df.withColumns(keys(df)).join(broadcast_if_small(right), ["__lat", "__lon", "__hour"], "left")
    return joined.drop("__lat", "__lon", "__hour")


def distinct_sites(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct coordinates, for lookups that must not run once per reading."""
    return df.select(*columns).dropna().distinct()
