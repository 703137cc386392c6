"""Near-duplicate documents: SimHash fingerprints linked by a pigeonring search."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import byte_texts, fresh, stored
from meterwise.llm.components import components, local_forest
from meterwise.session import parallelism

SEGMENTS = 9
MOST_BITS = 2


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles: bit i is set if it is set in over half of their XXH64 values.

    ASCII capitals are lowered, words end at ASCII white space; a text with fewer words than a shingle is one
    shingle, a text without words has fingerprint 0."""
    words = text.lower().split()
    if not words:
        return 0
    shift = [words[i:] for i in range(shingle)]
    shingles = map(b" ".join, zip(*shift, strict=False)) if len(words) >= shingle else iter([b" ".join(words)])
    total = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    hashes = map(partial(xxhash.xxh64_intdigest, seed=seed), shingles)
    for lo in range(0, total, 1 << 16):
        part = np.fromiter(hashes, dtype="<u8", count=min(1 << 16, total - lo))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: i (its id), th (hash of its text, to tell rows with one id apart) and fp (signed 64 bits)."""
    slim = docs.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in byte_texts(batch.column(2))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values.view(np.int64))], names=["i", "th", "fp"])

    return slim.mapInArrow(run, "i long, th long, fp long")


class Ring:
    """Segments of a 64-bit ring and the budgets of chains that start at each of them.

    If two values differ in at most `most` bits, some start has, for every length l, at most
    l * most / segments differing bits in its first l segments. So the first `exact` segments agree, and of
    the next ones, up to the last length with a budget of 1, one half agrees: those bits are a candidate key."""

    def __init__(self, segments: int = SEGMENTS, most: int = MOST_BITS):
        bounds = [64 * i // segments for i in range(segments + 1)]
        masks = [((1 << bounds[i + 1]) - 1) ^ ((1 << bounds[i]) - 1) for i in range(segments)]
        chain = lambda start, first, last: sum(masks[(start + k) % segments] for k in range(first, last))
        budget = [length * most // segments for length in range(segments + 1)]
        exact = max(k for k in range(segments + 1) if budget[k] == 0)
        one = max(k for k in range(segments + 1) if budget[k] <= 1)
        middle = (exact + one) // 2
        self.most = most
        #: key mask, and the masks and budgets of the longer chains, longest budget steps first
        self.variants: list[tuple[int, list[tuple[int, int]]]] = []
        for start in range(segments):
            steps = [(chain(start, 0, k), budget[k]) for k in range(exact + 1, segments + 1) if k == segments or budget[k + 1] > budget[k]]
            halves = {chain(start, 0, exact) | chain(start, lo, hi) for lo, hi in ((exact, middle), (middle, one))}
            self.variants += [(mask, steps) for mask in sorted(halves)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_pairs(values: np.ndarray, steps: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one bucket whose chains keep their budgets, in blocks of bounded size."""
    n = len(values)
    rows = max(1, (1 << 20) // n)
    for lo in range(0, n - 1, rows):
        block = values[lo : lo + rows, None] ^ values[None, lo + 1 :]
        hit = np.ones(block.shape, dtype=bool)
        for mask, budget in steps:
            hit &= np.bitwise_count(block & np.uint64(mask)) <= budget
        a, b = np.nonzero(hit)
        keep = b >= a
        yield a[keep] + lo, b[keep] + lo + 1


def close_neighbours(values: np.ndarray, bucket: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of many small buckets at once, by comparing rows ever further apart."""
    left, right, at, gap = [], [], np.arange(len(values)), 1
    while True:
        at = at[at + gap < len(values)]
        at = at[bucket[at] == bucket[at + gap]]
        if not len(at):
            break
        pair, found = values[at] ^ values[at + gap], at
        for mask, budget in steps:
            keep = np.bitwise_count(pair & np.uint64(mask)) <= budget
            pair, found = pair[keep], found[keep]
        left.append(found)
        right.append(found + gap)
        gap += 1
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return join(left), join(right)


def link_values(distinct: DataFrame, column: str = "fp", ring: Ring | None = None) -> DataFrame:
    """Links between distinct 64-bit values that differ in few bits: columns a, b (a spanning forest per bucket).

    Values meet where one of the ring's keys agrees. A bucket's members share at least 42 of 64 bits (for 9
    segments and 2 bits), so even a large group of near copies falls into many small buckets. From a bucket
    come only the edges of its forest, at most one per member: components are those of all links."""
    ring = ring or Ring()
    variants = [F.struct(F.lit(i).alias("k"), F.col(column).bitwiseAND(F.lit(signed(mask))).alias("p"), F.col(column).alias("v")) for i, (mask, _) in enumerate(ring.variants)]
    spread = distinct.select(F.explode(F.array(*variants)).alias("x")).select("x.*")
    placed = spread.repartition(parallelism(distinct.sparkSession), "k", "p").sortWithinPartitions("k", "p", "v")
    small = 64

    def edges(k: int, values: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        steps = ring.variants[k][1]
        sizes = np.diff(np.append(starts, len(values)))
        bucket = np.repeat(np.arange(len(starts)), sizes)
        few = np.flatnonzero((sizes <= small)[bucket] & (sizes > 1)[bucket])
        if len(few):
            a, b = close_neighbours(values[few], bucket[few], steps)
            roots = local_forest(len(few), a, b)
            own = np.flatnonzero(roots != np.arange(len(few)))
            yield values[few[own]], values[few[roots[own]]]
        for j in np.flatnonzero(sizes > small):
            part = values[starts[j] : starts[j] + sizes[j]]
            roots = np.arange(len(part))
            for a, b in near_pairs(part, steps):
                roots = local_forest(len(part), a, b, roots)
            own = np.flatnonzero(roots != np.arange(len(part)))
            yield part[own], part[roots[own]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3

        def done(k: np.ndarray, p: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
            for kind in np.unique(k):
                rows = k == kind
                parts = p[rows]
                starts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
                for a, b in edges(int(kind), v[rows].view(np.uint64), starts):
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            fresh = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(3)]
            k, p, v = (np.concatenate(x) for x in zip(held, fresh, strict=True))
            # the last bucket may go on in the next batch
            last = len(k) - 1 if len(k) else 0
            cut = int(np.flatnonzero((k != k[last]) | (p != p[last])).max(initial=-1)) + 1 if len(k) else 0
            yield from done(k[:cut], p[:cut], v[:cut])
            held = [k[cut:], p[cut:], v[cut:]]
        yield from done(*held)

    return placed.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segments: int = SEGMENTS, most: int = MOST_BITS) -> DataFrame:
    """Per row: id, th (hash of the text), fp, fingerprint (16 hex digits), component_id (the smallest id that is
    reached over fingerprints that differ in at most `most` bits) and root (a fingerprint that names the component).

    Equal fingerprints are merged before any search, so copies are never paired. Null texts count as empty
    (fingerprint 0, linked like any other). Rows without an id are linked but never name a component; its id is
    null if no row has one. Repeated rows are returned as often; empty tables give an empty result."""
    rows = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("i").alias("first"))
    linked = components(link_values(classes.select("fp"), "fp", Ring(segments, most)))
    rooted = classes.join(linked, classes["fp"] == linked["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "classes")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("f"), "component_id", "root")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, rows["fp"] == named["f"]).select(F.col("i").alias(id_col), "th", "fp", hexed.alias("fingerprint"), "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest id (ties: by text hash) stays,
    with all its columns. Of a component whose rows have no id, one row stays."""
    found = near_duplicates(docs, id_col, text_col)
    chosen = found.groupBy("root").agg(
        F.min(F.struct(F.col(id_col).isNull(), F.col(id_col).alias("i"), "th")).alias("m")
    )
    chosen = chosen.select(F.col("m.i").alias("__id"), F.col("m.th").alias("__th")).distinct()
    (th,) = fresh(docs, "__t")
    keyed = docs.withColumn(th, F.xxhash64(text_col))
    left, right = keyed.alias("l"), chosen.select(F.col("__id").alias("i"), F.col("__th").alias("h")).alias("r")
    kept = left.join(right, F.col(f"l.{id_col}").eqNullSafe(F.col("r.i")) & (F.col(f"l.{th}") == F.col("r.h")), "left_semi")
    return kept.dropDuplicates([id_col, th]).select(*docs.columns)
