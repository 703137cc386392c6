"""The enrichment operators as ML pipeline stages."""

from __future__ import annotations

import json

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.functions.calendar import DEFAULT_ZONE, datetime_features
from meterwise.functions.codes import weather_category
from meterwise.functions.text import normalize_column_names
from meterwise.operators.clean import keep_columns
from meterwise.operators.enrich import add_holiday_flag, add_school_vacation, add_weather


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Stage whose settings live in one JSON parameter, so every stage saves and loads.

    Reference tables are named by their catalog or temporary-view name.
    """

    settings = Param(Params._dummy(), "settings", "stage settings as JSON", TypeConverters.toString)

    def __init__(self, **values):
        super().__init__()
        self._setDefault(settings="{}")
        if values:
            self._set(settings=json.dumps(values, sort_keys=True))

    def setting(self, name: str, default=None):
        return json.loads(self.getOrDefault(self.settings)).get(name, default)

    def _table(self, df: DataFrame, name: str) -> DataFrame | None:
        table = self.setting(name)
        return df.sparkSession.table(table) if table and df.sparkSession.catalog.tableExists(table) else None


class KeepColumns(_Stage):
    """settings: columns"""

    def _transform(self, df: DataFrame) -> DataFrame:
        return keep_columns(df, self.setting("columns", []))


class NormalizeNames(_Stage):
    def _transform(self, df: DataFrame) -> DataFrame:
        return normalize_column_names(df)


class DatetimeFeatures(_Stage):
    """settings: column, zone"""

    def _transform(self, df: DataFrame) -> DataFrame:
        return datetime_features(df, self.setting("column"), self.setting("zone", DEFAULT_ZONE))


class HolidayFlag(_Stage):
    """settings: column, table, country, zone"""

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_holiday_flag(
            df,
            self.setting("column", "datetime"),
            self._table(df, "table"),
            self.setting("country", "metropole"),
            self.setting("zone", DEFAULT_ZONE),
        )


class SchoolVacation(_Stage):
    """settings: column, table, location, zone_name, zone"""

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_school_vacation(
            df,
            self.setting("column", "datetime"),
            self._table(df, "table"),
            self.setting("location", "Paris"),
            self.setting("zone_name", "Zone C"),
            self.setting("zone", DEFAULT_ZONE),
        )


class WeatherJoin(_Stage):
    """settings: lat, lon, instant, table"""

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_weather(
            df, self._table(df, "table"), self.setting("lat"), self.setting("lon"), self.setting("instant")
        )


class WeatherCategory(_Stage):
    """settings: column; output ``<column>_category``"""

    def _transform(self, df: DataFrame) -> DataFrame:
        column = self.setting("column")
        return df.withColumn(f"{column}_category", weather_category(F.col(column)))


class SqlColumns(_Stage):
    """settings: columns, a map from output name to SQL expression (row functions as a stage)"""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({name: F.expr(text) for name, text in self.setting("columns", {}).items()})
