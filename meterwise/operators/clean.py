"""Projection, filtering, recoding and row-repair operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise.operators.joins import broadcast_if_small


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def other_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType)]


def is_missing(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    if dict(df.dtypes)[column] in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [c for c, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def drop_sparse_columns(df: DataFrame, max_missing_share: float = 0.4) -> DataFrame:
    """Drop every column whose share of missing values exceeds the limit (one pass)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.when(is_missing(df, c), 1)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    ).first()
    rows = counts["__rows"]
    too_sparse = [c for i, c in enumerate(df.columns) if rows and counts[f"m{i}"] / rows > max_missing_share]
    return df.drop(*too_sparse)


def conditional_update(df: DataFrame, column: str, condition: Column, value: Column) -> DataFrame:
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def rescale_outliers(df: DataFrame, column: str, limit: float = 3000.0, divisor: float = 10.0) -> DataFrame:
    """Readings above the limit are taken as recorded ``divisor`` times too large."""
    c = F.col(column).cast("double")
    return df.withColumn(column, F.when(c > limit, c / divisor).otherwise(c))


def sentinel_to_null(df: DataFrame, sentinel: str = "?") -> DataFrame:
    texts = [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: F.when(F.col(c) != sentinel, F.col(c)) for c in texts}) if texts else df


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-null value of each column as text (ties: smallest value).

    Output (groups..., column, mode).  Counts are combined before the shuffle, and no task
    holds the distinct values of a group.
    """
    groups = list(groups)
    shown = df.select(*groups, *[F.col(c).cast("string").alias(c) for c in columns])
    long = shown.unpivot(groups, list(columns), "column", "value").filter("value IS NOT NULL")
    kinds = dict(df.dtypes)
    numbers = [c for c in columns if kinds[c] not in ("string", "boolean") and not kinds[c].startswith(("date", "time"))]
    order = F.when(F.col("column").isin(numbers), F.col("value").try_cast("double")) if numbers else F.lit(None)
    counts = long.groupBy(*groups, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*groups, "column").agg(
        F.min_by("value", F.struct(-F.col("n"), order.cast("double"), F.col("value"))).alias("mode")
    )


def fill_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing values by the most frequent value of the column."""
    kinds = dict(df.dtypes)
    found = {r["column"]: r["mode"] for r in modes(df, columns).collect()}  # one row per column
    return df.withColumns(
        {
            c: F.coalesce(F.when(~is_missing(df, c), F.col(c)), F.lit(found[c]).cast(kinds[c]))
            for c in columns
            if c in found
        }
    )


def row_differences(df: DataFrame, key: str, first, second, null_safe: bool = False) -> DataFrame:
    """Names of the columns whose values differ between two keyed rows.

    By default NULL differs from everything, itself included, as in the plain comparison
    of two rows; ``null_safe`` treats two NULLs as equal.  Unknown keys raise KeyError.
    """
    chosen = df.filter(F.col(key).isin(first, second))
    known = {r[0] for r in chosen.select(key).distinct().collect()}  # at most two values
    for wanted in (first, second):
        if wanted not in known:
            raise KeyError(wanted)
    columns = [c for c in df.columns if c != key]
    long = chosen.select(key, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [key], columns, "column", "value"
    )
    sides = long.groupBy("column").agg(
        F.max(F.when(F.col(key) == F.lit(first), F.col("value"))).alias("a"),
        F.max(F.when(F.col(key) == F.lit(second), F.col("value"))).alias("b"),
    )
    same = F.col("a").eqNullSafe(F.col("b")) if null_safe else F.coalesce(F.col("a") == F.col("b"), F.lit(False))
    return sides.filter(~same).select("column")


def propagate_representative(
    df: DataFrame, name_col: str, order_col: str, pairs: Sequence[tuple[str, str]], columns: Sequence[str]
) -> DataFrame:
    """Copy ``columns`` from the first row of each source name onto all rows of its target.

    A pair whose source does not occur changes nothing.
    """
    spark = df.sparkSession
    mapping = spark.createDataFrame([(s, t) for s, t in pairs], f"__source {dict(df.dtypes)[name_col]}, __target {dict(df.dtypes)[name_col]}")
    first = (
        df.filter(F.col(name_col).isin([s for s, _ in pairs]))
        .groupBy(F.col(name_col).alias("__source"))
        .agg(F.min_by(F.struct(*columns), order_col).alias("__new"))
    )
    # at most one row per listed pair
    patch = F.broadcast(first.join(F.broadcast(mapping), "__source").select("__target", "__new"))
    joined = df.join(patch, df[name_col] == patch["__target"], "left")
    hit = F.col("__target").isNotNull()
    replaced = {c: F.when(hit, F.col("__new")[c]).otherwise(F.col(c)) for c in columns}
    return joined.select([replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns])


def fill_from_group(df: DataFrame, group: str, value: str, order_col: str) -> DataFrame:
    """Give every member of a group the group's first non-null value in row order."""
    first = (
        df.filter(F.col(value).isNotNull()).groupBy(group).agg(F.min_by(value, order_col).alias("__first"))
    )
    joined = df.join(first, group, "left")
    return joined.withColumn(value, F.col("__first")).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Keep the first row of each key; aggregated on the map side, so hot keys do not pile up.

    Rows without an order value come last: such a row is kept only if the key has no other."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(order_col).isNull(), F.col(order_col))
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def top_per_group(df: DataFrame, groups: Sequence[str], order_col: str, tie: str) -> DataFrame:
    """Row with the largest ``order_col`` in each group (ties: smallest ``tie``; missing values are the smallest)."""
    groups = list(groups)
    rest = [c for c in df.columns if c not in groups]
    missing = is_missing(df, order_col)
    order = F.struct(missing, F.when(~missing, -F.col(order_col)), F.col(tie))
    best = df.groupBy(*groups).agg(F.min_by(F.struct(*rest), order).alias("__row"))
    return best.select(*groups, "__row.*").select(*df.columns)


def map_values(df: DataFrame, column: str, mapping: DataFrame, output: str, default=None) -> DataFrame:
    """Left join onto a (key, label) table, broadcast only when its size allows."""
    key, label = mapping.columns
    renamed = broadcast_if_small(mapping.select(F.col(key).alias(column), F.col(label).alias("__label")))
    joined = df.join(renamed, column, "left")
    result = F.col("__label") if default is None else F.coalesce("__label", F.lit(default))
    return joined.withColumn(output, result).drop("__label")


def cut(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed intervals (a, b]; the lowest edge itself falls outside."""
    result = F.when(F.lit(False), F.lit(""))
    for low, high, label in zip(edges, edges[1:], labels):
        result = result.when((value > F.lit(low)) & (value <= F.lit(high)), label)
    return result


def cut_quartiles(df: DataFrame, column: str, labels: Sequence[str], output: str) -> DataFrame:
    """Bin by the exact quartiles; the minimum itself is outside the first interval."""
    from meterwise.operators.ranking import quantiles

    edges = quantiles(df, column, [0.0, 0.25, 0.5, 0.75, 1.0]).first()
    return df.withColumn(output, cut(F.col(column).cast("double"), list(edges), labels))


def family_size(columns: Sequence[str]) -> Column:
    """Row sum of the columns plus one; missing values count 0."""
    total = F.lit(1)
    for c in columns:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return total


def binary_label(value: Column, positive) -> Column:
    return (value == F.lit(positive)).cast("int")


def column_set_difference(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]
