"""Composite weather files, polygon files, pixel tables and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WEATHER_BLOCK_HEADER = "location_id"


def parse_weather_blocks(
    files: DataFrame, sites: DataFrame, schema: str, instant: str = "date_et_heure_de_comptage_utc"
) -> DataFrame:
    """Hourly weather from files that stack a station block over a readings block.

    ``files`` has (path, value) with one whole file per row; ``sites`` has (location_id,
    latitude, longitude), the position of each requested coordinate.  ``schema`` declares the
    readings block and starts ``location_id BIGINT, time STRING``.  Rows without a time go.
    """
    body = F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), r"\r?\n")
    kept = F.filter(F.transform(body, lambda line: F.trim(line)), lambda line: line != "")
    parts = files.select("path", kept.alias("lines"))
    # place of the header that opens the second block (1-based)
    heads = F.filter(
        F.sequence(F.lit(2), F.greatest(F.size("lines"), F.lit(2))),
        lambda i: F.get(F.col("lines"), i - 1).startswith(WEATHER_BLOCK_HEADER),
    )
    parts = parts.withColumn("second", F.element_at(heads, 1))
    elevation_at = F.array_position(F.transform(F.split(F.get("lines", F.lit(0)), ","), lambda name: F.trim(name)), "elevation").cast("int")
    stations = parts.select(
        "path", elevation_at.alias("__at"), F.explode(F.slice("lines", F.lit(2), F.col("second") - 2)).alias("line")
    ).select(
        "path",
        F.get(F.split("line", ","), F.lit(0)).cast("bigint").alias("location_id"),
        F.element_at(F.split("line", ","), F.col("__at")).cast("double").alias("elevation"),
    )
    readings = parts.select("path", F.explode(F.slice("lines", F.col("second") + 1, F.size("lines"))).alias("line"))
    rows = (
        readings.select("path", F.from_csv("line", schema, {"mode": "FAILFAST"}).alias("r"))
        .select("path", "r.*")
        .withColumn(instant, F.to_timestamp_ntz("time"))
        .filter(F.col(instant).isNotNull())
        .drop("time")
    )
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(instant)).cast("timestamp")
    joined = rows.withColumn(instant, utc).join(stations, ["path", "location_id"], "left").join(sites, "location_id", "left")
    return joined.drop("path", "location_id")


def read_weather_files(spark: SparkSession, path: str, sites: DataFrame, schema: str, **kwargs) -> DataFrame:
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return parse_weather_blocks(files, sites, schema, **kwargs)


def site_positions(spark: SparkSession, coordinates: Sequence[tuple[float, float]]) -> DataFrame:
    """(location_id, latitude, longitude) in request order, numbered from 0."""
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(coordinates)]
    return spark.createDataFrame(rows, "location_id bigint, latitude double, longitude double")


def read_polygons(spark: SparkSession, path: str, label: str = "commune", lines: bool = False) -> DataFrame:
    """GeoJSON feature collections (one per file, or one per line) to (label, rings, ord).

    The rings of all parts of a polygon share one array.  ``ord`` (file, position of the collection, position of
    the feature, as text) orders the polygons of all files and lines, so "the first polygon" is one of them.
    """
    # coordinates stay text until the geometry type tells their depth
    schema = (
        "features ARRAY<STRUCT<properties: MAP<STRING, STRING>, geometry: STRUCT<type: STRING, coordinates: STRING>>>"
    )
    raw = spark.read.schema(schema).options(multiLine=not lines, mode="FAILFAST").json(path)
    # the row number inside a partition follows the lines of a file
    raw = raw.select("features", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"))
    features = raw.select("file", "line", F.posexplode("features").alias("ord", "f"))
    text = F.col("f.geometry.coordinates")
    single = F.from_json(text, "ARRAY<ARRAY<ARRAY<DOUBLE>>>")
    multi = F.flatten(F.from_json(text, "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"))
    return features.select(
        F.col("f.properties")[label].alias(label),
        F.when(F.col("f.geometry.type") == "MultiPolygon", multi).otherwise(single).alias("rings"),
        F.concat_ws("|", "file", F.lpad(F.col("line").cast("string"), 20, "0"), F.lpad(F.col("ord").cast("string"), 10, "0")).alias("ord"),
    )


def pixel_table(df: DataFrame, x: str, y: str, channels: Sequence[str]) -> DataFrame:
    """Pixel rows as (x, y, channel...) doubles; the alpha channel is left out by the caller."""
    return df.select(x, y, *[F.col(c).cast("double").alias(c) for c in channels])


def write_table(
    df: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = (), mode: str = "error", **options
) -> None:
    """Write csv, json, parquet or orc, optionally partitioned by columns."""
    writer = df.write.mode(mode).format(kind).options(**({"header": True} if kind == "csv" else {}), **options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str):
    """Load any saved stage, model or pipeline."""
    from pyspark.ml.util import DefaultParamsReader

    return DefaultParamsReader.loadParamsInstance(path, spark)
