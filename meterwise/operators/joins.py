"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 8 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring the side's bytes; else leave a shuffle join.

    The size is that of the rows written out as JSON, added up inside each partition, so long
    texts and large arrays count as what they are.
    """
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", never_null: Sequence[str] = ()
) -> DataFrame:
    """Equi-join where NULL keys match each other; keeps the left key columns.

    ``never_null`` keys compare plainly, so an existing partitioning on them can be reused.
    """
    keys = list(keys)
    if keys and set(keys) <= set(never_null):
        return left.join(right, keys, how)
    if not keys:
        # right is a one-row total: a scalar subquery per column, no product of tables
        for name in right.columns:
            left = left.withColumn(name, right.select(name).scalar())
        return left
    marked = right
    for key in keys:
        marked = marked.withColumnRenamed(key, f"__right_{key}")
    condition: Column = F.lit(True)
    for key in keys:
        a, b = F.col(key), F.col(f"__right_{key}")
        condition = condition & (a == b if key in never_null else a.eqNullSafe(b))
    return left.join(marked, condition, how).drop(*[f"__right_{key}" for key in keys])


def join_with_suffixes(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Join on differently named composite keys; clashing payload names get suffixes.

    Key pairs that share one name are kept once.
    """
    shared = {a for a, b in zip(left_keys, right_keys) if a == b}
    clash = (set(left.columns) & set(right.columns)) - shared
    a = left.select([F.col(c).alias(c + suffixes[0] if c in clash else c) for c in left.columns])
    b = right.select(
        [F.col(c).alias(f"__shared_{c}" if c in shared else c + suffixes[1] if c in clash else c) for c in right.columns]
    )
    condition: Column = F.lit(True)
    for lk, rk in zip(left_keys, right_keys):
        lname = lk + suffixes[0] if lk in clash else lk
        rname = f"__shared_{rk}" if rk in shared else rk + suffixes[1] if rk in clash else rk
        condition = condition & (a[lname] == b[rname])
    joined = a.join(b, condition, how)
    if how in ("right", "full", "outer", "full_outer"):
        for key in shared:
            joined = joined.withColumn(key, F.coalesce(key, f"__shared_{key}"))
    return joined.drop(*[f"__shared_{key}" for key in shared])


def semi_join_values(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Keep rows whose value occurs in a one-column table (computed top-k or frequent set)."""
    return df.join(values.select(F.col(values.columns[0]).alias(column)).distinct(), column, "left_semi")
