"""Scaling, encoding, imputing, splitting and projections."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.operators import subspace
from meterwise.operators.analytics import category_values
from meterwise.operators.clean import is_missing, modes
from meterwise.operators.passes import kept, numbered, stored
from meterwise.operators.ranking import quantiles, row_numbers, unpivot_numeric
from meterwise.operators.selection import gram_matrix
from meterwise.operators.transformers import SqlColumns
from meterwise.session import parallelism


class _Fit(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator whose model is a set of column expressions, so it saves and pushes down."""

    settings = Param(Params._dummy(), "settings", "settings as JSON", TypeConverters.toString)

    def __init__(self, **values):
        super().__init__()
        self._setDefault(settings="{}")
        if values:
            self._set(settings=json.dumps(values, sort_keys=True))

    def setting(self, name: str, default=None):
        return json.loads(self.getOrDefault(self.settings)).get(name, default)

    def _columns(self) -> list[str]:
        return list(self.setting("columns", []))

    def _affine(self, centre: Sequence[float], width: Sequence[float]) -> SqlColumns:
        def text(c: str, a: float, b: float) -> str:
            return f"(CAST(`{c}` AS DOUBLE) - CAST('{a!r}' AS DOUBLE)) / CAST('{(b or 1.0)!r}' AS DOUBLE)"

        parts = zip(self._columns(), centre, width)
        return SqlColumns(columns={c: text(c, float(a or 0.0), float(b or 0.0)) for c, a, b in parts})


class PopulationScaler(_Fit):
    """settings: columns.  Mean 0 and population standard deviation 1; constant columns stay 0."""

    def _fit(self, df: DataFrame) -> SqlColumns:
        cols = self._columns()
        row = df.agg(*[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
        return self._affine(row[: len(cols)], row[len(cols) :])


class RangeScaler(_Fit):
    """settings: columns.  Minimum 0, maximum 1."""

    def _fit(self, df: DataFrame) -> SqlColumns:
        cols = self._columns()
        row = df.agg(*[F.min(c).cast("double") for c in cols], *[F.max(c).cast("double") for c in cols]).first()
        low, high = row[: len(cols)], row[len(cols) :]
        return self._affine(low, [(b or 0.0) - (a or 0.0) for a, b in zip(low, high)])


class QuartileScaler(_Fit):
    """settings: columns.  Exact median 0 and interquartile range 1."""

    def _fit(self, df: DataFrame) -> SqlColumns:
        cols = self._columns()
        q = quantiles(unpivot_numeric(df, cols), "value", [0.25, 0.5, 0.75], ["column"])
        found = {r["column"]: r for r in q.collect()}  # one row per column
        return self._affine([found[c]["q1"] for c in cols], [found[c]["q2"] - found[c]["q0"] for c in cols])


class FillMissing(_Fit):
    """settings: columns, strategy ("mean", "most_frequent" or "constant"), value."""

    def _fit(self, df: DataFrame) -> SqlColumns:
        cols, strategy = self._columns(), self.setting("strategy", "mean")
        kinds = dict(df.dtypes)
        if strategy == "mean":
            row = df.agg(*[F.avg(F.when(~is_missing(df, c), F.col(c))) for c in cols]).first()
            fill = {c: f"CAST('{row[i]!r}' AS DOUBLE)" for i, c in enumerate(cols) if row[i] is not None}
        elif strategy == "most_frequent":
            found = {r["column"]: r["mode"] for r in modes(df, cols).collect()}  # one row per column
            fill = {c: f"CAST({_quoted(found[c])} AS {kinds[c]})" for c in cols if c in found}
        else:
            fill = {c: f"CAST({_quoted(self.setting('value'))} AS {kinds[c]})" for c in cols}
        def present(c: str) -> str:
            return f"nanvl(`{c}`, NULL)" if kinds[c] in ("double", "float") else f"`{c}`"

        return SqlColumns(columns={c: f"coalesce({present(c)}, {text})" for c, text in fill.items()})


def _quoted(value) -> str:
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def one_hot(columns: Sequence[str], output: str, drop_first: bool = False) -> Pipeline:
    """Pipeline: alphabetical categories to one vector; unknown values become all zeros.

    The indexer's extra slot for unknown values is the one the encoder drops.
    """
    indexed, encoded = [f"__i_{c}" for c in columns], [f"__v_{c}" for c in columns]
    stages: list = [
        StringIndexer(inputCols=list(columns), outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True, handleInvalid="error"),
    ]
    if drop_first:
        stages.append(_DropFirst(columns=encoded))
    stages.append(VectorAssembler(inputCols=encoded, outputCol=output))
    return Pipeline(stages=stages)


class _DropFirst(_Fit):
    """Slice off the first category of each encoded vector."""

    def _fit(self, df: DataFrame) -> PipelineModel:
        stages = []
        row = df.select(*self._columns()).first()
        for c in self._columns():
            size = row[c].size
            stages += [
                VectorSlicer(inputCol=c, outputCol=f"{c}_rest", indices=list(range(1, size))),
                SqlColumns(columns={c: f"`{c}_rest`"}),
            ]
        return PipelineModel(stages)


def dummies(df: DataFrame, column: str, drop_first: bool = False) -> DataFrame:
    """0/1 column ``<column>_<value>`` per category (sorted); NULL gives all zeros."""
    values = category_values(df, column)[1 if drop_first else 0 :]
    return df.select(
        "*", *[F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in values]
    ).drop(column)


def binarize_labels(df: DataFrame, column: str) -> DataFrame:
    """One 0/1 column per class, the label kept."""
    return df.select("*", *[(F.col(column) == F.lit(v)).cast("int").alias(f"is_{v}") for v in category_values(df, column)])


def recode_by_joint_share(df: DataFrame, column: str, target: str, positive, min_share: float = 0.8) -> DataFrame:
    """Add ``<column>_flag``: 1 for values whose positive rows are at least ``min_share`` of all rows.

    The share is the cell of the crosstab over the whole table (rows with both columns known), not the
    share inside the value."""
    known = df.filter(F.col(column).isNotNull() & F.col(target).isNotNull())
    hits = known.groupBy(column).agg(F.count(F.when(F.col(target) == F.lit(positive), 1)).alias("__hits"))
    total = known.count()
    chosen = hits.filter(F.col("__hits") >= F.lit(min_share) * F.lit(total)).select(column).withColumn("__hit", F.lit(1))
    return df.join(chosen, column, "left").withColumn(f"{column}_flag", F.coalesce("__hit", F.lit(0))).drop("__hit")


def balanced_weights(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Row weight n / (classes · rows of the class)."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().limit(10_001).collect()}
    if len(counts) > 10_000:
        raise ValueError("too many classes")
    total = sum(counts.values())
    weight = F.when(F.lit(False), F.lit(0.0))
    for value, n in counts.items():
        weight = weight.when(F.col(label) == F.lit(value), total / (len(counts) * n))
    return df.withColumn(output, weight)


def inverse_grade_weight(grade: Column) -> Column:
    return 1.0 / (grade + 1)


def hash_unit(key: Column, seed: int) -> Column:
    """Uniform number in [0, 1) fixed by the key and the seed."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double") / float(1 << 53)


def random_split(df: DataFrame, key: str, shares: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Disjoint parts chosen by a hash of the key; the same rows on every run and retry."""
    total, low, parts = float(sum(shares)), 0.0, []
    u = hash_unit(F.col(key), seed)
    for i, share in enumerate(shares):
        high = 1.0 if i == len(shares) - 1 else low + share / total
        parts.append(df.filter((u >= low) & (u < high)))
        low = high
    return parts


def stratified_split(df: DataFrame, key: str, label: str, test_share: float, seed: int = 42) -> DataFrame:
    """Add ``is_test`` with the same share of every class, exact to one row."""
    hashed = df.withColumn("__h", F.xxhash64(F.col(key), F.lit(seed)))
    ranked = row_numbers(hashed, "__h", key, [label], name="__rank")
    test = F.col("__rank") <= F.round(F.col("__rank_total") * F.lit(test_share))
    return ranked.withColumn("is_test", test).drop("__h", "__rank", "__rank_total")


def standardize_expressions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return PopulationScaler(columns=list(columns)).fit(df).transform(df)


def pca(df: DataFrame, columns: Sequence[str], k: int) -> dict:
    """Components, explained and cumulative shares, loadings and the centred scores."""
    columns = list(columns)
    means = df.agg(*[F.avg(F.col(c).cast("double")) for c in columns]).first()
    centred = df.select(
        "*", *[(F.col(c).cast("double") - F.lit(float(m))).alias(f"__c{i}") for i, (c, m) in enumerate(zip(columns, means))]
    )
    names = [f"__c{i}" for i in range(len(columns))]
    assembled = VectorAssembler(inputCols=names, outputCol="__x").transform(centred).drop(*names)
    model = PCA(k=k, inputCol="__x", outputCol="__scores").fit(assembled)
    variances = df.agg(*[F.var_samp(F.col(c).cast("double")) for c in columns]).first()
    total = float(sum(variances))
    shares = model.explainedVariance.toArray()
    components = model.pc.toArray()
    loadings = components * np.sqrt(shares * total)
    spark = df.sparkSession
    rows = [
        (c, j, float(components[i, j]), float(loadings[i, j])) for i, c in enumerate(columns) for j in range(k)
    ]
    ratio = [(j, float(shares[j]), float(shares[: j + 1].sum())) for j in range(k)]
    scored = model.transform(assembled).withColumn("scores", vector_to_array("__scores")).drop("__x", "__scores")
    return {
        "components": spark.createDataFrame(rows, "variable string, component int, weight double, loading double"),
        "explained": spark.createDataFrame(ratio, "component int, ratio double, cumulative double"),
        "scores": scored,
        "model": model,
    }


def as_vector(column: Column) -> Column:
    return array_to_vector(column.cast("array<double>"))


def truncated_svd(
    triples: DataFrame, row: str, column: str, value: str, k: int = 12, extra: int = 8, rounds: int = 4, seed: int = 42
) -> dict:
    """Leading singular values and row factors U·S of a sparse matrix in long form.

    Randomised subspace iteration (a published method).  Entries are stored once, in blocks of whole rows; a task reads
    its block and the column vectors, and only its sums for the columns are shuffled, so a round sends no more than blocks ×
    columns vectors, and (k + extra)² sums reach the driver.  The entries of a row must fit in a task.  Triples with a
    missing part are left out.
    """
    width = k + extra
    names = [f"x{j}" for j in range(width)]
    base = triples.select(F.col(row).alias("r"), F.col(column).alias("c"), F.col(value).cast("double").alias("v")).dropna()
    spark, kind = base.sparkSession, base.schema["r"].dataType.simpleString()
    random = [(F.lit(2.0) * hash_unit(F.col("c"), seed + j) - 1.0).alias(x) for j, x in enumerate(names)]
    base = stored(base, "entries")
    start = base.select("c").distinct().select("c", *random)
    base, row_names = numbered(base, "r", "row")
    base, column_names = numbered(base, "c", "column")
    start = start.join(column_names, "c") if column_names is not None else start.withColumn("column", F.col("c").cast("long"))
    n = base.count()
    blocks = max(1, math.ceil(n / subspace.ENTRIES_PER_BLOCK), min(parallelism(spark), math.ceil(n / subspace.PRODUCTS_AT_ONCE)))
    placed = base.select(F.col("row").alias("r"), F.col("column").alias("c"), "v", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("b"))
    path = kept(placed.repartition(blocks, "b").sortWithinPartitions("b", "c"), "entry-blocks", "b")

    def each_block(task, schema: str) -> DataFrame:
        return spark.range(0, blocks, 1, blocks).mapInArrow(task, schema)

    def whitening(gram: np.ndarray) -> np.ndarray:
        values, vectors = np.linalg.eigh(gram)
        scale = np.where(values > values.max() * 1e-14, 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
        return vectors * scale

    def pushed_back(vectors: str, matrix: np.ndarray) -> tuple[str, np.ndarray]:
        """The columns' vectors after a round, not yet turned, and the sums of products of the rows."""
        parts = each_block(subspace.back_task(path, vectors, names, matrix), f"kind int, c long, {', '.join(f'{x} double' for x in names)}")
        folder = kept(parts.groupBy("kind", "c").agg(*[F.sum(x).alias(x) for x in names]), "vectors", "kind")
        # a row per vector of the subspace
        rows = spark.read.parquet(f"{folder}/kind=1").orderBy("c").collect()
        return f"{folder}/kind=0", np.array([[r[x] for x in names] for r in rows])

    # a round reads the vectors before it and turns them as it goes
    vectors, turn = kept(start.select(F.col("column").alias("c"), *names), "vectors"), np.eye(width)
    for _ in range(rounds - 1):
        vectors, gram = pushed_back(vectors, turn)
        turn = whitening(gram)
    # in the last one the rows are at right angles before they are pushed back
    grams = each_block(subspace.rows_task(path, vectors, names, turn, only_gram=True), "r long, factors array<double>")
    gram = np.zeros((width, width))
    for r in grams.groupBy("r").agg(*[F.sum(F.col("factors")[j]).alias(x) for j, x in enumerate(names)]).collect():
        gram[r["r"]] = [r[x] for x in names]
    turn = turn @ whitening(gram)
    right, _ = pushed_back(vectors, turn)
    right = spark.read.parquet(right.removesuffix("/kind=0")).filter("kind = 0")
    gram = gram_matrix(right, names)[1:, 1:]  # (Q'A)(Q'A)'
    values, basis = np.linalg.eigh(gram)
    order = np.argsort(values)[::-1][:k]
    singular = np.sqrt(np.maximum(values[order], 0))
    factors = each_block(subspace.rows_task(path, vectors, names, turn @ (basis[:, order] * singular)), "r long, factors array<double>")
    if row_names is None:
        factors = factors.select(F.col("r").cast(kind).alias(row), "factors")
    else:
        factors = factors.join(row_names.select(F.col("row").alias("__n"), F.col("r").alias("__r")), F.col("r") == F.col("__n")).select(F.col("__r").alias(row), "factors")
    return {"singular_values": singular, "row_factors": factors}
