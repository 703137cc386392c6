"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterwise.llm.common import WORD, fresh, stored
from meterwise.session import parallelism

#: relative demand of a source over training time, by its place in the weight cycle: (time, rate) knots
SCHEDULES: tuple[tuple[tuple[float, float], ...], ...] = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)
ROWS_PER_BUCKET = 50_000


def integrated(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """Segments (start, length, rate at start, slope, demand before), scaled so that the whole demand is 1."""
    area = sum((t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False))
    out, before = [], 0.0
    for (t0, r0), (t1, r1) in zip(knots, knots[1:], strict=False):
        out.append((t0, t1 - t0, r0 / area, (r1 - r0) / area / (t1 - t0), before))
        before += (t1 - t0) * (r0 + r1) / 2 / area
    return out


def time_of(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Training time (0 to 1) at which a source has used a share of its demand: the inverse of the integral."""
    out = None
    for start, _, rate, slope, before in reversed(integrated(knots)):
        left = share - F.lit(before)
        at = F.lit(start) + 2.0 * left / (F.lit(rate) + F.sqrt(F.greatest(F.lit(rate * rate) + 2.0 * F.lit(slope) * left, F.lit(0.0))))
        out = at if out is None else F.when(share < F.lit(before + _ * (rate + slope * _ / 2)), at).otherwise(out)
    return out


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Targets of the sources: columns s (null last), n, source_size, place (in the weight cycle), weight, target.

    Sources are ranked by code point without one global window: by ranges, with the ranges' counts before them.
    Targets share the whole size by weight, stop at `most` times a source's size, and what is cut off goes to
    the others by weight until none is above: the common level is found from two sums per round."""
    spark = sizes.sparkSession
    ordered = sizes.repartitionByRange(parallelism(spark), F.col("s").isNull(), F.col("s")).withColumn("part", F.spark_partition_id())
    ordered = stored(ordered, "sources")
    before = ordered.groupBy("part").count().withColumn(
        "before", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("s").isNull(), F.col("s")))
    ranked = ordered.withColumn("rank", inside).join(before.select("part", "before"), "part")
    place = ((F.col("rank") + F.col("before") - 1) % len(weights)).cast("int")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.select("s", "n", "source_size", place.alias("place"), F.element_at(cycle, place + 1).alias("weight"))
    cap = F.lit(float(most)) * F.col("source_size")
    sized = F.col("source_size") > 0
    total, weight = ranked.agg(F.sum("source_size"), F.sum(F.when(sized, F.col("weight")))).first()
    level, capped = (total / weight if weight else 0.0), -1
    while True:
        above = sized & (cap <= F.lit(level) * F.col("weight"))
        count, taken, free = ranked.agg(F.count(F.when(above, 1)), F.sum(F.when(above, cap)), F.sum(F.when(sized & ~above, F.col("weight")))).first()
        if count == capped or not free:
            break
        level, capped = (total - (taken or 0.0)) / free, count
    return ranked.withColumn("target", F.when(sized, F.least(cap, F.lit(level) * F.col("weight"))).otherwise(F.lit(0.0)))


def mix(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3, whole: bool = False,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per document: its id, th (hash of its text), source, size (words), source_size, target, taken and passes.

    Each source is a stream of its documents in a hashed order, repeated up to `most` times; the mix takes the
    stream's first `target` words, so at most one pass over a source ends inside a document. With `whole` a copy
    is taken in full when its middle lies before the target, else not at all. passes lists the taken copies as
    (pass, words, position): the position is where in training, counted in words of the whole mix, the source's
    schedule has used up what comes before the copy (the schedule's integral, inverted).

    Running sums go by (source, hash range), so a source with a third of all rows is split into ranges of about
    50 000 rows. Null texts and texts without words have size 0 and are never taken; a null source is a source
    of its own, ranked last; null ids are ordered by an empty hash; repeated rows count each; an empty table
    gives an empty result; other columns are not read. The order depends on the ids alone, so reruns agree."""
    key = F.coalesce(F.concat(F.lit("s"), F.col("s")), F.lit("n"))
    rows = docs.select(
        F.col(id_col).alias("i"),
        F.col(source_col).alias("s"),
        F.xxhash64(text_col).alias("th"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.md5(F.col(id_col).cast("string").cast("binary")), F.lit("")).alias("h"),
    ).withColumn("key", key)
    rows = stored(rows, "sizes")
    sources = source_targets(rows.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")), weights, most)
    largest = sources.agg(F.max("n")).first()[0] or 0
    digits = 0
    while ROWS_PER_BUCKET * 16**digits < largest:
        digits += 1
    rows = rows.withColumn("b", F.substring("h", 1, digits) if digits else F.lit(""))
    ranges = rows.groupBy("key", "b").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("key").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    ranges = ranges.join(sources.withColumn("k", key).drop("s", "n"), F.col("key") == F.col("k")).drop("k", "words")
    # as a table of its own it has no partitioning by source that the rows would have to follow
    ranges = stored(ranges, "ranges")
    inside = Window.partitionBy("key", "b").orderBy("h", "size", "th").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(ranges, ["key", "b"]).withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    goal = F.round("target").cast("long")
    copies = []
    for r in range(most):
        at = F.col("at") + F.lit(r) * F.col("source_size")
        words = F.least(F.col("size"), F.greatest(goal - at, F.lit(0)))
        if whole:
            words = F.when(2 * at + F.col("size") <= 2 * goal, F.col("size")).otherwise(F.lit(0))
        copies.append(F.struct(F.lit(r).alias("pass"), words.cast("long").alias("words"), position(at, schedules, sources).alias("position")))
    passes = F.filter(F.array(*copies), lambda c: c["words"] > 0)
    placed = placed.withColumn("passes", passes)
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return placed.select(F.col("i").alias(id_col), "th", F.col("s").alias("source"), "size", "source_size", "target", taken.alias("taken"), "passes")


def position(at: Column, schedules, sources: DataFrame) -> Column:
    """Position of stream offset `at` in the whole mix."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share = F.least(at / F.greatest(F.col("target"), F.lit(1.0)), F.lit(1.0))
    out = None
    for i, knots in enumerate(schedules):
        t = time_of(share, knots)
        out = t if out is None else F.when(F.col("place") % len(schedules) == i, t).otherwise(out)
    return F.floor(out * F.lit(float(total))).cast("long")


def curriculum(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The taken copies of whole documents in training order: the documents' columns, range-sorted by position.

    Rows are matched by id (null matches null) and text hash, so repeated ids keep their own texts."""
    none, number, th, q, r, p = fresh(docs, "__n", "__i", "__t", "__q", "__r", "__p")

    def keyed(df: DataFrame, text_hash: Column) -> DataFrame:
        return df.withColumns({none: F.col(id_col).isNull(), number: F.coalesce(F.col(id_col), F.lit(0)), th: text_hash})

    # equal keys on both sides of the join and of the numbering: the texts are shuffled once before the range sort
    same = [none, number, th]
    copies = keyed(mixed, F.col("th")).withColumn(q, F.row_number().over(Window.partitionBy(*same).orderBy("passes")))
    copies = copies.select(*same, q, F.explode("passes").alias("c")).select(*same, q, F.col("c.position").alias(p))
    rows = keyed(docs, F.xxhash64(text_col)).withColumn(r, F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0))))
    joined = rows.join(copies, same).where(F.col(r) - F.col(q) == 0)
    n = parallelism(docs.sparkSession)
    return joined.repartitionByRange(n, p, number).sortWithinPartitions(p, number).select(*docs.columns)
