"""Exact ranks, running counts and quantiles without a single-partition sort.

Rows are first reduced to (group, value, count).  Every group is cut into value buckets: approximate
quantiles of the whole table give the bounds, about one per ROWS_PER_BUCKET rows, so a (group, bucket)
window holds about that many rows however large the table or a group is; the totals of the buckets
before supply the offsets.  The bounds only steer the split: results are exact for any bounds, and the
plan is the same for every size.  NULL comes first, then -infinity, numbers, infinity and NaN.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators.joins import null_safe_join
from meterwise.session import durable

ROWS_PER_BUCKET = 100_000

#: ranks that a sketch may be off (one in so many rows), share of the rows on either side of a wanted rank that its bracket
#: spans, and rows from which a group is bracketed at all: there the bracket is wider than the sketch's error by two ranks
SKETCH, MARGIN, LEAST_ROWS = 2_000, 0.002, 1_500
#: groups whose brackets (a few numbers each) are sent to all tasks; more meet their rows in a join
MOST_SENT = 50_000


def bucket_count(df: DataFrame) -> int:
    return max(1, -(-df.count() // ROWS_PER_BUCKET))


def _bounds(df: DataFrame, column: str, buckets: int) -> list:
    if buckets <= 1:
        return []
    if dict(df.dtypes)[column] == "string":
        # the values with the lowest hashes are an even sample of the distinct values
        distinct = df.select(column).filter(F.col(column).isNotNull()).distinct()
        sample = sorted(r[0] for r in distinct.orderBy(F.xxhash64(column)).limit(8 * buckets).collect())
        return [sample[i * len(sample) // buckets] for i in range(1, buckets)] if sample else []
    shares = [i / buckets for i in range(1, buckets)]
    numbers = df.filter(~F.isnan(F.col(column).cast("double")))
    row = numbers.agg(F.percentile_approx(column, shares, max(1_000, 10 * buckets)).alias("b")).first()
    return list(row["b"] or [])


def bucket_column(column: str, bounds: list) -> Column:
    """Number of bounds below the value (NULL: -1, NaN: above all), by binary search in a constant array."""
    cuts = sorted(set(bounds))
    missing = F.when(F.col(column).isNull(), -1)
    if not cuts:
        return missing.otherwise(0)
    kind = "string" if isinstance(cuts[0], str) else "double" if isinstance(cuts[0], float) else "bigint"
    array = F.from_json(F.lit(json.dumps(cuts)), f"array<{kind}>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])

    def step(low: Column, size: Column) -> Column:
        return F.when((low + size <= len(cuts)) & (F.get(array, low + size - 1) < F.col(column)), low + size).otherwise(low)

    return missing.otherwise(F.aggregate(steps, F.lit(0), step))


def _numeric(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if kind.startswith("timestamp"):
        return F.unix_micros(column)
    if kind == "date":
        return F.unix_date(column).cast("long")
    if kind == "string":
        return F.col(column)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(column).cast("long")
    return F.col(column).cast("double")


def _offsets(table: DataFrame, groups: list[str], sums: dict[str, Column]) -> DataFrame:
    """Sums before each bucket of a group and over the whole group."""
    totals = table.groupBy(*groups, "__bucket").agg(*[c.alias(f"b_{n}") for n, c in sums.items()])
    by_group = Window.partitionBy(*groups)
    before = by_group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *groups,
        "__bucket",
        *[F.coalesce(F.sum(f"b_{n}").over(before), F.lit(0)).alias(f"o_{n}") for n in sums],
        *[F.sum(f"b_{n}").over(by_group).alias(f"t_{n}") for n in sums],
    )


def _running(reduced: DataFrame, base: DataFrame, groups: list[str], weights: list[str]) -> DataFrame:
    """``below_<w>`` (sum over smaller values) and ``total_<w>`` for reduced rows."""
    table = reduced.withColumn("__bucket", bucket_column("value", _bounds(base, "value", bucket_count(base))))
    ordered = Window.partitionBy(*groups, "__bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    offsets = _offsets(table, groups, {w: F.sum(w) for w in weights})
    for w in weights:
        table = table.withColumn(f"below_{w}", F.sum(w).over(ordered) - F.col(w))
    table = null_safe_join(table, offsets, [*groups, "__bucket"], "left", never_null=["__bucket"])
    return table.select(
        *groups,
        "value",
        *weights,
        *[(F.col(f"below_{w}") + F.coalesce(f"o_{w}", F.lit(0))).alias(f"below_{w}") for w in weights],
        *[F.col(f"t_{w}").alias(f"total_{w}") for w in weights],
    )


def cumulative_counts(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Per group and distinct value: ``n``, ``below`` (rows strictly smaller), ``total``.

    NULL and NaN values are left out.
    """
    groups = list(groups)
    base = df.select(*groups, _numeric(df, value).alias("value"))
    base = base.filter(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
    counts = base.groupBy(*groups, "value").agg(F.count(F.lit(1)).alias("n"))
    running = _running(counts, base, groups, ["n"])
    return running.select(*groups, "value", "n", F.col("below_n").alias("below"), F.col("total_n").alias("total"))


def weighted_cumulative(df: DataFrame, value: str, weights: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Running sums of several weights over ascending ``value`` (exclusive), with totals.

    Output: groups, value, each weight, ``below_<w>``, ``total_<w>``.
    """
    groups, weights = list(groups), list(weights)
    base = df.select(*groups, _numeric(df, value).alias("value"), *weights)
    sums = base.groupBy(*groups, "value").agg(*[F.sum(w).alias(w) for w in weights])
    return _running(sums, base, groups, weights)


def _bracketed(base: DataFrame, groups: list[str], probs: Sequence[float], also: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """One scan for brackets around the wanted ranks (and other aggregates), one for the cells they make.

    A cell is (groups, value, n, gap): a value inside a bracket with its rows, or all rows between two brackets with their
    smallest value. Only values inside brackets are kept apart, so cells hold a few thousandths of a large group."""
    shares = [max(0.0, p - MARGIN) for p in probs] + [min(1.0, p + MARGIN) for p in probs]
    brackets = base.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("__rows"), F.percentile_approx("value", [float(x) for x in shares], SKETCH).alias("__b"), *[c.alias(n) for n, c in also.items()]
    )
    brackets = durable(brackets)
    slim = brackets.select(*groups, "__rows", "__b")
    if brackets.count() <= MOST_SENT:
        slim = F.broadcast(slim)
    marked = null_safe_join(base, slim, groups)
    value, k = F.col("value"), len(probs)
    low, high = ([F.get("__b", F.lit(i + off)) for i in range(k)] for off in (0, k))
    inside = F.col("__rows") < LEAST_ROWS
    for i, p in enumerate(probs):
        above = value >= low[i] if p > MARGIN else F.lit(True)
        inside = inside | (above & (value <= high[i]) if p + MARGIN < 1 else above)
    gap = sum(((value > high[i]).cast("int") for i in range(k)), F.lit(0))
    cells = marked.select(*groups, value, F.when(inside, value).alias("__in"), F.when(~inside, gap).alias("__gap"))
    cells = cells.groupBy(*groups, "__in", "__gap").agg(F.min("value").alias("value"), F.count(F.lit(1)).alias("n"))
    return brackets.select(*groups, *also), durable(cells.select(*groups, "value", "n", F.col("__gap").isNotNull().cast("long").alias("gap")))


def _at_ranks(ranks: DataFrame, probs: Sequence[float], groups: list[str]) -> DataFrame:
    """Interpolated values at the wanted ranks from (groups, value, n, below, total, gap).

    A wanted rank never falls into a gap while the sketch keeps its documented error; the plan fails if one does."""

    def hit(position: Column) -> Column:
        return (F.col("below") <= position) & (position < F.col("below") + F.col("n"))

    aggregates, missed = [], F.lit(False)
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("total") - 1)
        lower, upper = hit(F.floor(position)), hit(F.ceil(position))
        aggregates += [F.max(F.when(h, F.col("value").cast("double"))).alias(f"{n}{i}") for h, n in ((lower, "lo"), (upper, "hi"))]
        aggregates.append(F.max(position - F.floor(position)).alias(f"f{i}"))
        missed = missed | (lower | upper) & (F.col("gap") > 0)
    picked = ranks.groupBy(*groups).agg(*aggregates, F.max(missed).alias("__missed"))
    picked = picked.filter(F.when(F.col("__missed"), F.raise_error(F.lit("a quantile sketch was off by more than its error"))).isNull())
    return picked.select(
        *groups,
        *[
            F.when((F.col(f"f{i}") == 0) | (F.col(f"lo{i}") == F.col(f"hi{i}")), F.col(f"lo{i}"))
            .otherwise(F.col(f"lo{i}") + F.col(f"f{i}") * (F.col(f"hi{i}") - F.col(f"lo{i}")))
            .alias(f"q{i}")
            for i in range(len(probs))
        ],
    )


def quantiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (), also: dict[str, Column] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation; one column ``q0, q1, ...`` per probability.

    NULL and NaN are left out.  Between equal values, infinite ones too, there is nothing to interpolate.  The table is
    read twice: a sketch brackets the wanted ranks, then rows are counted below, between and inside the brackets, and only
    values inside are ranked.  ``also`` holds aggregates of ``value`` (per group) that the first scan takes along.
    """
    also = also or {}
    keys = list(groups) or ["__all"]
    base = df.select(*(groups or [F.lit(0).alias("__all")]), _numeric(df, value).alias("value"))
    base = base.filter(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
    more, cells = _bracketed(base, keys, probs, also)
    running = _running(cells.select(*keys, "value", "n", "gap"), cells, keys, ["n", "gap"])
    ranks = running.withColumnsRenamed({"below_n": "below", "total_n": "total"})
    found = _at_ranks(ranks, probs, keys)
    found = null_safe_join(found, more, keys) if also else found
    if not groups:
        # an empty table has one row without values
        found = df.sparkSession.range(1).select(F.lit(0).alias("__all")).join(found, "__all", "left").drop("__all")
    return found


def unpivot_numeric(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep..., column, value double) of several numeric columns."""
    doubled = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubled.unpivot(list(keep), list(columns), "column", "value")


def row_numbers(
    df: DataFrame, order: str, tie: str, groups: Sequence[str] = (), name: str = "row_number"
) -> DataFrame:
    """Exact 1-based position by (order, tie) within each group, plus ``<name>_total``.

    ``tie`` is a unique number.  A value that holds many rows, NULL and NaN too, is split again by ``tie``.
    """
    groups = list(groups)
    keyed = df.withColumn("__order", _numeric(df, order)).withColumn("__tie", _numeric(df, tie))
    slim = keyed.select(*groups, "__order", "__tie")
    buckets = bucket_count(slim)
    bounds = _bounds(slim, "__order", buckets)
    repeated = sorted({b for b in bounds if bounds.count(b) > 1})
    often = F.col("__order").isNull() | F.col("__order").isin(repeated)
    if dict(slim.dtypes)["__order"] == "double":
        often = often | F.isnan("__order")
    inner = _bounds(slim.filter(often), "__tie", buckets)
    sub = F.when(often, 1 + bucket_column("__tie", inner)).otherwise(0)
    keyed = keyed.withColumn("__bucket", bucket_column("__order", bounds).cast("long") * (len(inner) + 3) + sub)
    # rows of a repeated value come after the smaller values of its bucket, which the bounds end there
    part = Window.partitionBy(*groups, "__bucket")
    offsets = _offsets(keyed, groups, {"n": F.count(F.lit(1))})
    numbered = keyed.withColumn("__within", F.row_number().over(part.orderBy("__order", "__tie")))
    joined = null_safe_join(numbered, offsets, [*groups, "__bucket"], "left", never_null=["__bucket"])
    joined = joined.withColumn(name, F.col("o_n") + F.col("__within")).withColumn(f"{name}_total", F.col("t_n"))
    return joined.drop("__order", "__tie", "__within", "o_n", "t_n", "__bucket")
