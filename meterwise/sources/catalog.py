"""Open datasets by logical name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("csv", "json", "parquet", "orc")


def file_format(path: str) -> str:
    return path.rstrip("/").split(".")[-1].lower()


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    header: bool = True,
    schema: str | None = None,
    index_name: str | None = None,
    **options,
) -> DataFrame:
    """Delimited text; ``index_name`` names a first column without header.

    Without a schema the types are inferred by an extra pass over the files.
    """
    reader = spark.read.options(sep=sep, header=header, inferSchema=schema is None, mode="FAILFAST", **options)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.withColumnRenamed(df.columns[0], index_name) if index_name else df


def read_json_records(
    spark: SparkSession, path: str, schema: str | None = None, lines: bool = False, strict: bool = True, **options
) -> DataFrame:
    """A JSON array of records per file (or one record per line); malformed input fails.

    The plain reader stops after the first value of a file, so text behind it would be lost.
    ``strict`` parses each file as one text and fails unless it is exactly one array; switch it
    off for files too large for that (2 GB).
    """
    reader = spark.read.options(multiLine=not lines, mode="FAILFAST", **options)
    if lines or not strict:
        return (reader.schema(schema) if schema else reader).json(path)
    record = schema or reader.json(path).schema.simpleString()
    kind = record if record.startswith("struct<") else f"struct<{record}>"
    whole = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    bracketed = whole.startswith("[") & whole.endswith("]")
    checked = F.when(bracketed, whole).otherwise(F.raise_error(F.lit("the file is not one JSON array")))
    parsed = F.from_json(checked, f"array<{kind}>", {"mode": "FAILFAST", **{k: str(v) for k, v in options.items()}})
    return spark.read.text(path, wholetext=True).select(F.inline(parsed))


def load_catalog(path: str) -> dict:
    """Catalog file: YAML (when a reader is installed) or JSON, under ``data.input``."""
    import json

    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    try:
        import yaml

        content = yaml.safe_load(text)
    except ImportError:
        content = json.loads(text)
    return content["data"]["input"]


def open_dataset(spark: SparkSession, catalog: Mapping[str, str | Mapping], name: str, **options) -> DataFrame:
    """Resolve a logical name to a path (or ``{path, format, schema, options}``) and read it.

    Unknown names raise KeyError, unknown formats ValueError.
    """
    if name not in catalog:
        raise KeyError(f"dataset {name!r} is not in the catalog")
    entry = catalog[name]
    entry = {"path": entry} if isinstance(entry, str) else dict(entry)
    kind = entry.get("format") or file_format(entry["path"])
    settings = {**entry.get("options", {}), **options}
    if kind == "csv":
        return read_delimited(spark, entry["path"], schema=entry.get("schema"), **settings)
    if kind == "json":
        return read_json_records(spark, entry["path"], schema=entry.get("schema"), **settings)
    if kind not in FORMATS:
        raise ValueError(f"unsupported file format {kind!r}")
    reader = spark.read.options(**settings)
    if entry.get("schema"):
        reader = reader.schema(entry["schema"])
    return reader.format(kind).load(entry["path"])
