"""Data-quality profiles: each operator returns a result table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators.clean import is_missing, modes, nan_to_null, numeric_columns, other_columns
from meterwise.operators.ranking import quantiles, unpivot_numeric
from meterwise.session import durable


def _as_text(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    shown = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns])
    return shown.unpivot(list(keep), list(columns), "column", "value")


def general_info(df: DataFrame) -> DataFrame:
    """One row per column: position, type, non-null count, row count."""
    if df is None:
        raise ValueError("no table given")
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.when(~is_missing(df, c), 1)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(f"n{i}").alias("non_null"),
            F.col("__rows").alias("rows"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*entries)))


def missing_profile(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Long table (metric, column, value): overall and per-column missing percentages,
    rows with any and with all values missing.  One aggregation pass."""
    columns = list(subset or df.columns)
    flags = {c: is_missing(df, c) for c in columns}
    any_missing = all_missing = None
    for flag in flags.values():
        any_missing = flag if any_missing is None else any_missing | flag
        all_missing = flag if all_missing is None else all_missing & flag
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(any_missing, 1)).alias("any"),
        F.count(F.when(all_missing, 1)).alias("all"),
        *[F.count(F.when(f, 1)).alias(f"m{i}") for i, f in enumerate(flags.values())],
    )
    total = sum((F.col(f"m{i}") for i in range(1, len(columns))), F.col("m0"))

    def entry(metric: str, column: str | None, value):
        return F.struct(
            F.lit(metric).alias("metric"), F.lit(column).cast("string").alias("column"), value.cast("double").alias("value")
        )

    entries = [
        entry("missing_percent", None, F.round(100 * F.try_divide(total, F.col("rows") * len(columns)), 2)),
        entry("rows_any_missing", None, F.col("any")),
        entry("rows_all_missing", None, F.col("all")),
    ]
    entries += [
        entry("column_missing_percent", c, F.round(100 * F.try_divide(F.col(f"m{i}"), F.col("rows")), 2))
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


def duplicate_counts(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of their group, and all rows of repeated groups (NULLs equal)."""
    columns = list(subset or df.columns)
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("beyond_first"),
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("all_repeated"),
    )


def duplicate_groups(df: DataFrame, key: str, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows of repeated groups as (group_key, group_rows, key), one row per member.

    ``group_key`` is the smallest key of the group.  Members stay separate rows, so a group
    of any size is never gathered into one array.  Groups above 1/1000 of the rows (fewer than
    1000 of them, hence safe to broadcast) are salted: their side is copied once per salt and
    their members spread over the salts.
    """
    columns = list(subset or [c for c in df.columns if c != key])
    # length-prefixed rendering: equal text only for equal rows, NULL apart from any value
    parts = []
    for c in columns:
        text = F.to_json(F.struct(F.col(c).alias("v")))
        parts.append(F.concat(F.length(text).cast("string"), F.lit(":"), text))
    marked = df.select(F.col(key), F.sha2(F.concat(*parts), 256).alias("__row"))
    groups = durable(
        marked.groupBy("__row")
        .agg(F.count(F.lit(1)).alias("group_rows"), F.min(key).alias("group_key"))
        .filter("group_rows > 1")
    )
    limit = max(1.0, df.count() / 1000)
    salted = groups.withColumn("__salts", F.ceil(F.col("group_rows") / limit).cast("int"))
    heavy = F.broadcast(salted.filter("__salts > 1").select("__row", "__salts"))
    salt = F.pmod(F.xxhash64(key), F.coalesce("__salts", F.lit(1))).cast("int")
    members = marked.join(heavy, "__row", "left").select(key, "__row", salt.alias("__salt"))
    copies = salted.select(
        "__row", "group_rows", "group_key", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)).alias("__salt")
    )
    return members.join(copies, ["__row", "__salt"]).select("group_key", "group_rows", key)


def variable_info(df: DataFrame, columns: Sequence[str] | None = None, max_values: int = 10) -> DataFrame:
    """Per column: number of distinct values, the first sorted values and the top shares.

    Output (column, n_unique, kind, position, value, share); ``kind`` is ``sorted`` or ``top``.
    NULL counts as a value and sorts first.
    """
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)
    numbers = [c for c in columns if c in numeric_columns(df.select(*columns))]
    counts = _as_text(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    number = F.when(F.col("column").isin(numbers), F.col("value").try_cast("double")) if numbers else F.lit(None)
    counts = counts.withColumn("__number", number.cast("double"))
    # one combined pass for the totals: one row per column
    totals = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_unique"), F.sum("n").alias("rows")
    )
    by_value = Window.partitionBy("column").orderBy(
        F.col("value").isNotNull(), F.col("__number"), F.col("value")
    )
    by_count = Window.partitionBy("column").orderBy(F.desc("n"), F.col("value").isNotNull(), "__number", "value")
    # row_number <= k is limited inside each input partition before the shuffle
    first = counts.withColumn("position", F.row_number().over(by_value)).filter(F.col("position") <= max_values)
    top = counts.withColumn("position", F.row_number().over(by_count)).filter(F.col("position") <= max_values)
    both = first.withColumn("kind", F.lit("sorted")).unionByName(top.withColumn("kind", F.lit("top")))
    return both.join(F.broadcast(totals), "column").select(
        "column", "n_unique", "kind", "position", "value", (F.col("n") / F.col("rows")).alias("share")
    )


def value_shares(df: DataFrame, column: str, keep_null: bool = True) -> DataFrame:
    """(value, n, share) of one column."""
    base = df if keep_null else df.filter(F.col(column).isNotNull())
    counts = base.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = base.agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / total.scalar())


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max, one row per column."""
    columns = list(columns or numeric_columns(df))
    long = unpivot_numeric(df, columns).filter("value IS NOT NULL AND NOT isnan(value)")
    basic = {"count": F.count("value"), "mean": F.avg("value"), "std": F.stddev_samp("value"), "min": F.min("value"), "max": F.max("value")}
    q = quantiles(long, "value", [0.25, 0.5, 0.75], ["column"], basic)
    return q.select(
        "column", "count", "mean", "std", "min", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max"
    )


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, distinct values, most frequent value (ties: smallest) and its frequency."""
    columns = list(columns or other_columns(df))
    counts = (
        _as_text(df, columns).filter("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.struct(-F.col("n"), F.col("value"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", best).alias("top"),
        F.max("n").alias("freq"),
    )


def nested_combinations(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Names that occur with more than one combination of the columns (NULLs equal)."""
    combos = df.groupBy(name, *columns).agg(F.count(F.lit(1)).alias("rows"))
    return (
        combos.groupBy(name)
        .agg(F.count(F.lit(1)).alias("combinations"), F.sum("rows").alias("rows"))
        .filter("combinations > 1")
    )


def dependency_violations(df: DataFrame, left: str, right: str) -> DataFrame:
    """Values that break a one-to-one relation: (side, value, partners)."""
    pairs = df.select(left, right).filter(F.col(left).isNotNull() & F.col(right).isNotNull()).distinct()

    def side(column: str) -> DataFrame:
        return (
            pairs.groupBy(F.col(column).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("partners"))
            .filter("partners > 1")
            .select(F.lit(column).alias("side"), "value", "partners")
        )

    return side(left).unionByName(side(right))


def reference_analysis(df: DataFrame, reference: str) -> DataFrame:
    """Long table (section, group, column, value): share of each reference value (NULL kept),
    group medians of numeric columns and group modes of the others (NULL group left out)."""
    if reference not in df.columns:
        raise ValueError(f"{reference!r} is not a column")
    group = F.col(reference).cast("string").alias("group")
    shares = value_shares(df, reference).select(
        F.lit("share").alias("section"), group, F.lit(reference).alias("column"), F.col("share").cast("string").alias("value")
    )
    known = df.filter(F.col(reference).isNotNull())
    numbers = [c for c in numeric_columns(df) if c != reference]
    others = [c for c in other_columns(df) if c != reference]
    result = shares
    if numbers:
        long = unpivot_numeric(known, numbers, [reference])
        medians = quantiles(long, "value", [0.5], [reference, "column"])
        result = result.unionByName(
            medians.select(F.lit("median").alias("section"), group, "column", F.col("q0").cast("string").alias("value"))
        )
    if others:
        result = result.unionByName(
            modes(known, others, [reference]).select(
                F.lit("mode").alias("section"), group, "column", F.col("mode").alias("value")
            )
        )
    return result


def conditional_shares(df: DataFrame, condition: str, value: str) -> DataFrame:
    """Share of each ``value`` inside each ``condition`` value; NULLs left out."""
    counts = (
        df.filter(F.col(condition).isNotNull() & F.col(value).isNotNull())
        .groupBy(condition, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy(condition).agg(F.sum("n").alias("__total"))
    return counts.join(totals, condition).select(condition, value, "n", (F.col("n") / F.col("__total")).alias("share"))


def cross_distributions(df: DataFrame, reference: str) -> DataFrame:
    """Share of each reference value within each value of every other column.

    Output (column, value, reference, share); array, map and struct columns are skipped.
    """
    if reference not in df.columns:
        raise ValueError(f"{reference!r} is not a column")
    usable = [c for c, kind in df.dtypes if c != reference and not kind.startswith(("array", "map", "struct"))]
    base = df.filter(F.col(reference).isNotNull()).select(
        F.col(reference).cast("string").alias("__ref"), *[F.col(c).cast("string").alias(c) for c in usable]
    )
    long = base.unpivot(["__ref"], usable, "column", "value").filter("value IS NOT NULL")
    counts = long.groupBy("column", "value", "__ref").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column", "value").agg(F.sum("n").alias("total"))
    return counts.join(totals, ["column", "value"]).select(
        "column", "value", F.col("__ref").alias("reference"), (F.col("n") / F.col("total")).alias("share")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlations of all column pairs, pairwise complete (NaN is missing): (column_a, column_b, r)."""
    columns = list(columns or numeric_columns(df))
    df = nan_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"r{i}").alias("r")))
    return row.select(F.inline(F.array(*entries)))


def non_null_counts(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Non-null count of every other column per group (NULL groups left out)."""
    base = df
    for g in groups:
        base = base.filter(F.col(g).isNotNull())
    return base.groupBy(*groups).agg(*[F.count(c).alias(c) for c in df.columns if c not in groups])


