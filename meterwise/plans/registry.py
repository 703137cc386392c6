"""Named queries over the driver's tables, with their SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.functions.calendar import _ntz_utc
from meterwise.session import scratch_folder

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Lazy readers of one data folder; each attribute is a table."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def literal(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    def scratch(self, name: str) -> str:
        """New folder in the shared checkpoint location, deleted when the application ends."""
        return scratch_folder(self.spark, name)


def query(name: str, sql: str | None = None):
    def register(plan: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plan(Tables(spark, folder))

        run.__doc__ = plan.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return plan

    return register


def r6(column: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; adding 0 turns a negative zero positive."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def text_time(column: Column | str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def long(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("long")


def paris_events(t: Tables, days: int = 85) -> DataFrame:
    """Events moved across the spring clock change, as instants."""
    moved = t.events.withColumn("ts", _ntz_utc("ts") + F.make_dt_interval(F.lit(days)))
    return moved
