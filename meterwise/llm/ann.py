"""Approximate nearest neighbours by cosine: inverted lists scanned by blocks of rotated dimensions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterwise.llm.common import stored

#: the index (lists, rotation, probe count) is fitted on at most so many vectors, chosen by hash; every vector is indexed
SAMPLE = 16_384
MOST_LISTS = 1_024
#: dimensions per column block, and the width of the hypothesis test
BLOCK, EPSILON = 16, 2.1
#: vectors and queries that meet in one task at once
VECTORS_PER_CHUNK, QUERIES_PER_CHUNK = 8_192, 2_048
#: share of the sample's true neighbours that the probed lists must hold
TARGET = 0.97


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, not empty, only finite components, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def unit_rows(arrays: list, width: int) -> np.ndarray:
    """Unit vectors, shorter ones padded with zeros; scaled first so that squares neither overflow nor vanish."""
    out = np.zeros((len(arrays), width))
    for i, a in enumerate(arrays):
        out[i, : len(a)] = a
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


@dataclass
class Index:
    """Rotation, list centres (rotated) and the number of lists to probe."""

    rotation: np.ndarray
    centres: np.ndarray
    probes: int

    def nearest_lists(self, rotated: np.ndarray, count: int) -> np.ndarray:
        closeness = rotated @ self.centres.T
        if count >= closeness.shape[1]:
            return np.argsort(-closeness, axis=1, kind="stable")
        some = np.argpartition(-closeness, count - 1, axis=1)[:, :count]
        return np.take_along_axis(some, np.argsort(-np.take_along_axis(closeness, some, axis=1), axis=1, kind="stable"), axis=1)


def fit_index(sample: np.ndarray, total: int, k: int, seed: int = 11) -> Index:
    """Spherical k-means on the sample, about sqrt(total) lists; the probe count is the least that holds TARGET of the
    true neighbours of 256 sample vectors."""
    rng = np.random.default_rng(seed)
    n, width = sample.shape
    rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
    x = sample @ rotation
    lists = int(max(1, min(MOST_LISTS, np.sqrt(total), n // 16)))
    centres = x[rng.choice(n, lists, replace=False)].copy()
    for _ in range(12):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centres)
    index = Index(rotation, centres, lists)
    own = np.argmax(x @ centres.T, axis=1)
    picked = rng.choice(n, min(n, 256), replace=False)
    closeness = x[picked] @ x.T
    closeness[np.arange(len(picked)), picked] = -2
    true = np.argsort(-closeness, axis=1)[:, : min(k, n - 1)]
    if true.size:
        order = index.nearest_lists(x[picked], lists)
        place = np.argsort(order, axis=1)
        ranks = np.take_along_axis(place, own[true], axis=1)
        index.probes = int(np.quantile(ranks, TARGET, method="higher")) + 1
    return index


def scan(vectors: np.ndarray, queries: np.ndarray, limit: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Near candidates of each query in one chunk: (query, candidate, squared distance), at most `keep` per query.

    The dimensions are taken block by block. After each block a candidate is abandoned if its partial distance,
    scaled to all dimensions, is above the query's k-th best distance by more than chance allows: over d of D
    rotated dimensions, partial * D / d > limit * (1 + EPSILON / sqrt(d))^2."""
    width = vectors.shape[1]
    # column blocks, so that each block is read as a whole
    blocks = [(np.ascontiguousarray(vectors[:, a : a + BLOCK]), np.ascontiguousarray(queries[:, a : a + BLOCK])) for a in range(0, width, BLOCK)]
    # a limit of the chunk's own: the k-th best of its first candidates
    head = 2.0 - 2.0 * queries @ vectors[: 4 * keep].T
    if head.shape[1] >= keep:
        limit = np.minimum(limit, np.partition(head, keep - 1, axis=1)[:, keep - 1] + 1e-9)
    out = []
    step = max(1, (1 << 21) // max(1, len(vectors)))
    for lo in range(0, len(queries), step):
        x, q = blocks[0][0], blocks[0][1][lo : lo + step]
        partial = (q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :] - 2.0 * q @ x.T
        done, bound = min(BLOCK, width), limit[lo : lo + step]
        row, column = np.nonzero(partial * (width / done) <= (bound * (1 + EPSILON / np.sqrt(done)) ** 2)[:, None] if done < width else partial <= bound[:, None])
        distance = partial[row, column]
        for x, q in blocks[1:]:
            difference = q[lo + row] - x[column]
            distance = distance + np.einsum("ij,ij->i", difference, difference)
            done = min(done + BLOCK, width)
            slack = (1 + EPSILON / np.sqrt(done)) ** 2 if done < width else 1.0
            stay = distance * (width / done) <= bound[row] * slack
            row, column, distance = row[stay], column[stay], distance[stay]
        out.append((row + lo, column, distance))
    row, column, distance = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((distance, row))
    row, column, distance = row[order], column[order], distance[order]
    first = np.searchsorted(row, row)
    best = np.arange(len(row)) - first < keep
    return row[best], column[best], distance[best]


def nearest(
    table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest rows by cosine of every query row: query_id, rank (from 1), vec_id, score.

    Rows with a null id and unusable vectors (see `usable`) take no part. Queries are the rows of the table that
    meet `is_query`; candidates are all rows but those with the query's id. Equal vectors are one entry of the
    index with their k + 1 smallest ids, so large groups of copies are neither paired nor gathered. Scores are
    computed in double precision on the original vectors; ties go to the smaller id. Shorter vectors count as
    padded with zeros; rows repeated with id and vector count once; fewer than k candidates give fewer rows; an
    empty table gives an empty result.

    Every query scans its home list first; the distance of its k-th candidate then bounds the scan of the other
    probed lists. Lists and their queries are cut into chunks of bounded size."""
    spark = table.sparkSession
    keep = k + 1
    vector = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("i"), vector.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where(F.col("i").isNotNull() & usable(F.col("v")))
    plain = F.transform("v", lambda x: x + F.lit(0.0))  # a negative zero equals zero
    rows = rows.withColumn("v", plain).withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    rows = stored(rows.groupBy("i", "h1", "h2").agg(F.any_value("v").alias("v"), F.max("q").alias("q")), "vectors")
    # the smallest ids of each distinct vector: cut on the map side, so a very common vector never meets in one task
    few = rows.select("i", "h1", "h2", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("i")).alias("r")).where(F.col("r") <= keep)
    members = few.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("i")).alias("members"), F.min("i").alias("c"))
    classes = stored(members.join(rows.select(F.col("i").alias("c"), F.col("h1").alias("a"), F.col("h2").alias("b"), "v"), "c").where("a = h1 AND b = h2").drop("a", "b"), "classes")
    total, width = classes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    result = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], result)
    # class ids may repeat when one id has several vectors, so classes are named by their hashes' order-free pair
    named = classes.withColumn("n", F.xxhash64("h1", "h2"))
    sample = [r["v"] for r in named.orderBy("n").limit(SAMPLE).select("v").collect()]
    index = spark.sparkContext.broadcast(fit_index(unit_rows(sample, width), total, k))

    @F.pandas_udf("n long, u binary, lists array<int>")
    def place(names: pd.Series, vectors: pd.Series, probes: pd.Series) -> pd.DataFrame:
        u = unit_rows(list(vectors), width) @ index.value.rotation
        lists = index.value.nearest_lists(u, max(1, int(probes.max())))
        return pd.DataFrame({"n": names, "u": [x.astype("<f4").tobytes() for x in u], "lists": [row[:p].tolist() for row, p in zip(lists, probes, strict=True)]})

    asked = rows.where("q").select("i", "h1", "h2")
    wanted = asked.select("h1", "h2").distinct().withColumn("asked", F.lit(True))
    marked = named.join(wanted, ["h1", "h2"], "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    probes = F.when(F.col("asked"), F.lit(index.value.probes)).otherwise(F.lit(1))
    placed = stored(marked.select("asked", place("n", "v", probes).alias("p")).select("asked", "p.*"), "lists")
    entries = placed.select("n", "u", F.get("lists", F.lit(0)).alias("list"))
    probing = placed.where("asked").select("n", "u", F.posexplode("lists").alias("turn", "list"))
    # sizes of at most MOST_LISTS lists decide into how many chunks they are cut
    sizes = {r[0]: r[1] for r in entries.groupBy("list").count().collect()}
    first_size = {r[0]: r[1] for r in probing.where("turn = 0").groupBy("list").count().collect()}
    other_size = {r[0]: r[1] for r in probing.where("turn > 0").groupBy("list").count().collect()}
    chunks = {x: -(-n // VECTORS_PER_CHUNK) for x, n in sizes.items()}

    def scanned(asked: DataFrame, counts: dict[int, int]) -> DataFrame:
        """Candidates (qn, cn, d) of queries (n, u, list, limit)."""
        query_chunks = {x: -(-n // QUERIES_PER_CHUNK) for x, n in counts.items()}
        table_of = spark.createDataFrame([(int(x), chunks.get(x, 0), query_chunks.get(x, 0)) for x in sorted(sizes)], "list int, c int, qc int")
        cut = F.broadcast(table_of)  # one row per list
        vectors = entries.join(cut, "list").where("qc > 0").withColumn("chunk", F.pmod(F.hash("n"), F.col("c")))
        vectors = vectors.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("qc") - 1))).select("list", "chunk", "part", "n", "u")
        asked = asked.join(cut, "list").where("c > 0").withColumn("part", F.pmod(F.hash("n"), F.col("qc")))
        asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
        asked = asked.select(F.col("list").alias("l"), F.col("chunk").alias("ch"), F.col("part").alias("p"), F.col("n").alias("qn"), F.col("u").alias("qu"), "limit")

        def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.table({"qn": pa.array([], pa.int64()), "cn": pa.array([], pa.int64()), "d": pa.array([], pa.float64())})
            unpack = lambda c: np.frombuffer(b"".join(c.to_pylist()), dtype="<f4").reshape(len(c), -1).astype(np.float64)
            a, b, d = scan(unpack(left["u"]), unpack(right["qu"]), right["limit"].to_numpy(), keep + 4)
            return pa.table({"qn": pa.array(right["qn"].to_numpy()[a]), "cn": pa.array(left["n"].to_numpy()[b]), "d": pa.array(d)})

        met = vectors.groupBy("list", "chunk", "part").cogroup(asked.groupBy("l", "ch", "p"))
        found = met.applyInArrow(meet, "qn long, cn long, d double")
        return stored(found, "candidates")

    home = scanned(probing.where("turn = 0").withColumn("limit", F.lit(8.0)), first_size)
    by_distance = Window.partitionBy("qn").orderBy("d", "cn")
    limits = home.withColumn("r", F.row_number().over(by_distance)).where(F.col("r") == keep).select(F.col("qn").alias("n"), (F.col("d") + 1e-6).alias("limit"))
    others = probing.where("turn > 0").join(limits, "n", "left").withColumn("limit", F.coalesce("limit", F.lit(8.0)))
    found = home.union(scanned(others, other_size)).distinct().withColumn("r", F.row_number().over(by_distance)).where(F.col("r") <= keep + 4)
    # exact scores on the original vectors, then the k + 1 best members of each distinct query vector
    left = named.select(F.col("n").alias("qn"), F.col("v").alias("qv"))
    right = named.select(F.col("n").alias("cn"), F.col("v").alias("cv"), "members")
    pairs = found.join(left, "qn").join(right, "cn")

    @F.pandas_udf("double")
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a))
        for j, (x, y) in enumerate(zip(a, b, strict=True)):
            m = min(len(x), len(y))
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            out[j] = x[:m] @ y[:m] / (np.sqrt(x @ x) * np.sqrt(y @ y))
        return pd.Series(out)

    scores = pairs.withColumn("score", cosine("qv", "cv")).select("qn", "score", F.explode("members").alias("i"))
    best = scores.withColumn("r", F.row_number().over(Window.partitionBy("qn").orderBy(F.desc("score"), "i"))).where(F.col("r") <= 2 * keep)
    best = best.groupBy("qn").agg(F.sort_array(F.collect_list(F.struct("r", "i", "score"))).alias("best"))
    answered = asked.withColumn("qn", F.xxhash64("h1", "h2")).join(best, "qn")
    own = F.slice(F.filter("best", lambda x: x["i"] != F.col("query")), 1, k)
    answered = answered.select(F.col("i").alias("query"), "best").select(F.col("query").alias("query_id"), F.posexplode(own).alias("at", "hit"))
    return answered.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.i").alias("vec_id"), F.col("hit.score").alias("score"))
