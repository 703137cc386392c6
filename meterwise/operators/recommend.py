"""Neighbourhood recommendation on long (user, item, rating) triples."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwise.operators.passes import kept, numbered, ranges, runs_of, stored
from meterwise.session import durable, parallelism

#: entities from which a table is cut into more blocks, as far as there are tasks, and entries of a block; a task holds a block
ENTITIES_PER_BLOCK, ENTRIES_PER_BLOCK = 4_096, 3_000_000
#: entries that are read, and products that are added up, at once
ENTRIES_AT_ONCE, PRODUCTS_AT_ONCE = 200_000, 1_000_000
#: entities with more entries meet all others in a join by feature, as no block could hold them
HOT_ENTRIES = 250_000


def rating_triples(df: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """One row per (user, item) with the mean rating; absent pairs count as 0."""
    return df.filter(F.col(rating).isNotNull()).groupBy(user, item).agg(F.avg(rating).alias(rating))


def _norms(triples: DataFrame, entity: str, value: str) -> DataFrame:
    return triples.groupBy(entity).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))


def cosine_pairs(triples: DataFrame, entity: str, feature: str, value: str, top: int | None = None) -> DataFrame:
    """(a, b, similarity) of all entity pairs that share a feature, in both directions; ids of any type.

    A blocked product: entities are cut into blocks of bounded entries, and a task adds up the products of its block with all
    entities, which it reads from the shared folder, where every entry is stored once.  Nothing is paired inside a feature
    group, so a feature shared by everyone costs no more than its products.  Entities with more entries than a block
    could hold are few (at most one per HOT_ENTRIES rows): their products with all others are sums over a join by
    feature.  With ``top`` only the ``top`` best partners of each entity are returned, and no task emits more.
    """
    base = triples.select(F.col(entity).alias("e"), F.col(feature).alias("f"), F.col(value).cast("double").alias("v"))
    base = base.filter("e IS NOT NULL AND f IS NOT NULL AND v <> 0 AND NOT isnan(v)")
    spark, kind = base.sparkSession, base.schema["e"].dataType.simpleString()
    base, names = numbered(base, "e", "x")
    base = numbered(base, "f", "g")[0].select("x", "g", "v")
    base = stored(base, "entries")  # read by the sizes, the blocks and the hot entities
    counts = base.groupBy("x").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"), F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.count(F.lit(1)).alias("e"), F.sum("n").alias("n"), F.collect_list(F.when(F.col("n") > HOT_ENTRIES, F.col("x"))).alias("hot")).first()
    entries = sizes["n"] or 0
    blocks = max(1, math.ceil(entries / ENTRIES_PER_BLOCK), min(parallelism(spark), math.ceil(sizes["e"] / ENTITIES_PER_BLOCK)))
    placed = base.filter(~F.col("x").isin(sizes["hot"])) if sizes["hot"] else base
    placed = placed.withColumn("b", F.pmod(F.xxhash64("x"), F.lit(blocks)).cast("int"))
    # an entity is in one file, its entries side by side
    path = kept(placed.repartition(blocks, "b").sortWithinPartitions("b", "x"), "entry-blocks", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                for found in _partners(path, block, top):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["a", "b", "similarity"])

    # one task per block
    pairs = spark.range(0, blocks, 1, blocks).mapInArrow(run, "a long, b long, similarity double")
    if sizes["hot"]:
        unit = base.join(counts, "x").select(F.col("x").alias("e"), F.col("g").alias("f"), (F.col("v") / F.col("norm")).alias("v"), (F.col("n") > HOT_ENTRIES).alias("hot"))
        pairs = pairs.unionByName(_hot_pairs(unit, top))
        pairs = pairs if top is None else most_similar(pairs, top).drop("rank")
    if names is None:
        return pairs.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b"), "similarity")
    for end in ("a", "b"):
        pairs = pairs.join(names.select(F.col("x").alias(end), F.col("e").alias(f"__{end}")), end).drop(end).withColumnRenamed(f"__{end}", end)
    return pairs.select("a", "b", "similarity")


def _unit_runs(path: str) -> Iterator[tuple[np.ndarray, ...]]:
    """Whole entities from a stored table: ids, where each begins (and the end), features, values of length 1."""
    for x, f, v in runs_of(path, ["x", "g", "v"], ENTRIES_AT_ONCE):
        starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        bounds = np.append(starts, len(x))
        norm = np.sqrt(np.add.reduceat(v * v, starts))
        yield x[starts], bounds, f, v / np.repeat(norm, np.diff(bounds))


def _partners(path: str, block: int, top: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, similarity) of the entities of one block with all others; with ``top`` only the best of each."""
    mine = list(_unit_runs(f"{path}/b={block}"))
    if not mine:
        return
    rows = _Rows(mine)
    del mine
    best = _Best(len(rows.ids), top) if top is not None else None
    for run in _unit_runs(path):
        for x, ids, dots in rows.products(*run, best):
            if best is None:
                yield rows.ids[x], ids, dots
            else:
                best.add(x, ids, dots)
    if best is not None:
        x, ids, dots = best.settled()
        yield rows.ids[x], ids, dots


class _Best:
    """The best partners of many rows, by similarity (to 12 digits) and then id."""

    def __init__(self, rows: int, top: int):
        self.top, self.held, self.size = top, [], 0
        self.kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        #: what a partner of a row must reach; rows with fewer partners take any
        self.least = np.full(rows, -np.inf)

    def add(self, x: np.ndarray, ids: np.ndarray, dots: np.ndarray) -> None:
        use = np.flatnonzero(np.round(dots, 12) >= self.least[x])
        self.held.append((x[use], ids[use], dots[use]))
        self.size += len(use)
        if self.size > max(PRODUCTS_AT_ONCE // 2, len(self.kept[0]) // 4):
            self.settled()

    def settled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, ids, dots = (np.concatenate(c) for c in zip(self.kept, *self.held, strict=True))
        near = np.round(dots, 12)
        order = np.lexsort((ids, -near, x))
        x, ids, dots, near = x[order], ids[order], dots[order], near[order]
        place = np.arange(len(x)) - np.searchsorted(x, x)
        last = place == self.top - 1
        self.least[x[last]] = near[last]
        use = place < self.top
        self.kept, self.held, self.size = (x[use], ids[use], dots[use]), [], 0
        return self.kept


class _Rows:
    """A block of entities by feature, to be multiplied with runs of entities."""

    def __init__(self, runs: list[tuple[np.ndarray, ...]]):
        self.ids = np.concatenate([r[0] for r in runs])
        sizes = np.concatenate([np.diff(r[1]) for r in runs])
        x = np.repeat(np.arange(len(self.ids)), sizes)
        f, v = (np.concatenate([r[k] for r in runs]) for k in (2, 3))
        order = np.argsort(f, kind="stable")
        f, self.x, self.v = f[order], x[order], v[order]
        self.starts = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
        self.features, self.counts = f[self.starts], np.diff(np.append(self.starts, len(f)))
        self.place = dict(zip(self.ids.tolist(), range(len(self.ids)), strict=True))
        self.dense: list | None = None
        self.singles: list | None = None

    def products(self, ids: np.ndarray, bounds: np.ndarray, f: np.ndarray, v: np.ndarray, best: _Best | None):
        """(row, id, sum) of all pairs of a row and an entity of the run that share a feature, but for a row with itself."""
        at = np.minimum(np.searchsorted(self.features, f), len(self.features) - 1)
        m = np.where(self.features[at] == f, self.counts[at], 0)
        so_far = np.concatenate([[0], np.cumsum(m)])[bounds]
        if so_far[-1] * 4 > len(self.ids) * len(ids) * len(self.features):
            yield from self._dense(ids, bounds, at, np.where(m > 0, v, 0.0), best)
            return
        low = 0
        while low < len(ids):
            # as many whole entities as give a bounded number of products
            high = max(low + 1, int(np.searchsorted(so_far, so_far[low] + PRODUCTS_AT_ONCE, side="right")) - 1)
            part = slice(bounds[low], bounds[high])
            col = np.repeat(np.arange(high - low), np.diff(bounds[low : high + 1]))
            partner = ranges(self.starts[at[part]], m[part])
            x, c = self.x[partner], np.repeat(col, m[part])
            dots = np.repeat(v[part], m[part]) * self.v[partner]
            width, key = high - low, x * (high - low) + c
            if len(key) * 20 > len(self.ids) * width:
                sums = np.bincount(key, dots, len(self.ids) * width)
                key = np.flatnonzero(sums)
                sums = sums[key]
            else:
                order = np.argsort(key)
                key, dots = key[order], dots[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
                sums = np.add.reduceat(dots, first) if len(key) else dots
                key = key[first]
            x, c = np.divmod(key, width)
            c += low
            use = (sums != 0) & (self.ids[x] != ids[c])
            yield x[use], ids[c[use]], sums[use]
            low = high

    def _dense(self, ids: np.ndarray, bounds: np.ndarray, at: np.ndarray, v: np.ndarray, best: _Best | None):
        """The same where most pairs share most features, by products of dense matrices.

        If all features fit one matrix, products of single precision tell which cells may be among the best."""
        width = min(len(self.features), 512)
        slabs, step = -(-len(self.features) // width), 1024 if len(self.features) > 128 else 512
        if self.dense is None:
            f = np.repeat(np.arange(len(self.features)), self.counts)
            order = np.lexsort((f, self.x // step))
            x, f, value = self.x[order], f[order], self.v[order]
            name = x // step * slabs + f // width
            cuts = np.searchsorted(name, np.arange(-(-len(self.ids) // step) * slabs + 1))
            self.dense = [(x[a:b] % step, f[a:b] % width, value[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

        def matrix(x: np.ndarray, f: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
            out = np.zeros((rows, width))
            out[x, f] = value
            return out

        single, slack = best is not None and slabs == 1, 4e-7 * (width + 8)
        own = np.array([self.place.get(i, -1) for i in ids.tolist()])
        # work space that is used again
        cells, lower = np.empty(step * step, np.float32), np.empty(step * step, bool)
        if single and self.singles is None:
            self.singles = [matrix(*d, step).astype(np.float32) for d in self.dense]
        for low in range(0, len(ids), step):
            high = min(low + step, len(ids))
            part = slice(bounds[low], bounds[high])
            col, f, value = np.repeat(np.arange(high - low), np.diff(bounds[low : high + 1])), at[part], v[part]
            right = [matrix(col[s], f[s] % width, value[s], high - low) for s in (np.flatnonzero(f // width == k) for k in range(slabs))]
            small = np.ascontiguousarray(right[0].T, np.float32) if single else None
            for start in range(0, len(self.ids), step):
                n, m = min(step, len(self.ids) - start), high - low
                left = lambda k: matrix(*self.dense[start // step * slabs + k], n)  # noqa: B023, E731
                same = np.flatnonzero((own[low:high] >= start) & (own[low:high] < start + n))
                if not single:
                    total = sum(left(k) @ right[k].T for k in range(slabs))
                    total[own[low:high][same] - start, same] = 0.0
                    may = total != 0 if best is None else (total != 0) & (total >= best.least[start : start + n, None] - 1e-11)
                    x, c = np.nonzero(may)
                    yield x + start, ids[c + low], total[x, c]
                    continue
                total = np.matmul(self.singles[start // step][:n], small, out=cells[: n * m].reshape(n, m))
                total[own[low:high][same] - start, same] = -np.inf
                least = best.least[start : start + n]
                if np.isinf(least).any() and best.top < m:
                    # the top-th largest cell, if it is surely above zero, is reached by all of the best
                    kth = np.partition(total, -best.top, axis=1)[:, -best.top]
                    least = np.maximum(least, np.where(kth > 2 * slack, kth - slack, -np.inf))
                # cells that are not a number are not lower
                np.less(total, (least - slack).astype(np.float32)[:, None], out=lower[: n * m].reshape(n, m))
                x, c = np.divmod(_false(lower[: n * m]), m)
                if len(x):
                    dots = (left(0)[x] * right[0][c]).sum(axis=1)
                    use = (dots != 0) & (own[low:high][c] != x + start)
                    yield x[use] + start, ids[c[use] + low], dots[use]


def _false(flags: np.ndarray) -> np.ndarray:
    """Where few of many flags are false, looked at eight at a time."""
    whole = len(flags) // 8 * 8
    words = np.flatnonzero(flags[:whole].view(np.uint64) != np.uint64(0x0101010101010101))
    near = np.concatenate([(words[:, None] * 8 + np.arange(8)).ravel(), np.arange(whole, len(flags))])
    return near[~flags[near]]


def _hot_pairs(unit: DataFrame, top: int | None) -> DataFrame:
    """Similarities of entities with very many entries to all entities, and back."""
    hot = unit.filter("hot").select(F.col("e").alias("a"), "f", F.col("v").alias("w"))
    dots = unit.join(hot, "f").filter("e <> a").groupBy("a", F.col("e").alias("b")).agg(F.sum(F.col("v") * F.col("w")).alias("similarity"), F.max("hot").alias("both"))
    there = dots.select("a", "b", "similarity")
    # two hot entities already meet both ways
    back = dots.filter("NOT both").select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity")
    return there.unionByName(back)


def nearest_entities(triples: DataFrame, entity: str, feature: str, value: str, k: int) -> DataFrame:
    """(a, b, similarity, rank): the k most similar partners of every entity."""
    return most_similar(cosine_pairs(triples, entity, feature, value, top=k), k)


def most_similar(pairs: DataFrame, k: int) -> DataFrame:
    """The k most similar partners of every entity (ties: smallest id)."""
    order = Window.partitionBy("a").orderBy(F.desc(F.round("similarity", 12)), "b")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def similar_to_one(triples: DataFrame, entity: str, feature: str, value: str, chosen) -> DataFrame:
    """(b, similarity) of one entity against all others: linear in the table."""
    mine = triples.filter(F.col(entity) == F.lit(chosen)).select(feature, F.col(value).cast("double").alias("__mine"))
    dots = triples.join(mine, feature).groupBy(F.col(entity).alias("b")).agg(F.sum(F.col(value) * F.col("__mine")).alias("dot"))
    norms = _norms(triples.withColumn(value, F.col(value).cast("double")), entity, value)
    own = norms.filter(F.col(entity) == F.lit(chosen)).select("norm")
    joined = dots.join(norms.withColumnRenamed(entity, "b"), "b").filter(F.col("b") != F.lit(chosen))
    return joined.select("b", (F.col("dot") / (F.col("norm") * own.scalar())).alias("similarity"))


def predict_for_user(triples: DataFrame, user: str, item: str, rating: str, chosen, k: int) -> DataFrame:
    """Scores of the chosen user's unseen items from the k most similar users.

    An item a neighbour has not rated counts 0; the denominator is the sum of the k
    similarities.  Items no neighbour rated score 0 and are left in.
    """
    triples = durable(triples)  # read five times below
    top = similar_to_one(triples, user, item, rating, chosen).orderBy(F.desc(F.round("similarity", 12)), "b").limit(k)
    top = F.broadcast(top)  # k rows
    seen = triples.filter((F.col(user) == F.lit(chosen)) & (F.col(rating) != 0)).select(item)
    norm = top.agg(F.sum(F.abs("similarity"))).scalar()
    scored = triples.join(top, F.col(user) == F.col("b")).groupBy(item).agg(F.sum(F.col("similarity") * F.col(rating)).alias("__s"))
    items = triples.select(item).distinct().join(seen, item, "left_anti")
    return items.join(scored, item, "left").select(item, F.try_divide(F.coalesce("__s", F.lit(0.0)), norm).alias("prediction"))


def predict_from_items(
    triples: DataFrame, user: str, item: str, rating: str, chosen, k: int, pairs: DataFrame | None = None
) -> DataFrame:
    """Scores of the chosen user's unseen items from each item's k most similar items.

    ``pairs`` may hold other similarities, for example from reduced factors.
    """
    pairs = cosine_pairs(triples, item, user, rating, top=k) if pairs is None else pairs
    mine = triples.filter((F.col(user) == F.lit(chosen)) & (F.col(rating) != 0)).select(
        F.col(item).alias("b"), F.col(rating).alias("__r")
    )
    near = most_similar(pairs, k).join(mine.select(F.col("b").alias("a")), "a", "left_anti")
    scored = near.join(mine, "b", "left").groupBy(F.col("a").alias(item)).agg(
        F.try_divide(F.sum(F.col("similarity") * F.coalesce("__r", F.lit(0.0))), F.sum(F.abs("similarity"))).alias("prediction")
    )
    return scored


def factor_similarities(factors: DataFrame, entity: str, dims: int, top: int | None = None) -> DataFrame:
    """Cosine similarities of dense factor vectors, through the same blocked product."""
    long = factors.select(entity, F.posexplode("factors").alias("dim", "value")).filter(F.col("dim") < dims)
    return cosine_pairs(long, entity, "dim", "value", top)


def liked_items(df: DataFrame, user: str, item: str, rating: str, chosen, limit: float = 4) -> DataFrame:
    return df.filter((F.col(user) == F.lit(chosen)) & (F.col(rating) >= limit)).select(user, item, rating).distinct().orderBy(
        F.desc(rating), item
    )

