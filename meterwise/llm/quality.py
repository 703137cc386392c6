"""Quality classifier: a sparse ensemble of rules over text statistics, compiled to column expressions."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import fresh, stored

#: labelled rows the classifier is fitted on, chosen by a hash of the id
LABELLED_ROWS = 20_000
TREES, DEPTH, PENALTY = 24, 4, 0.0005

STATISTICS = (
    "words", "bytes_per_word", "distinct_words", "top_word", "short_words", "long_words", "upper", "digits", "full_stops", "exclamations",
    "symbols", "brackets", "non_ascii", "lines", "words_per_line", "distinct_lines", "bare_words", "upper_words", "distinct_pairs", "longest_word", "sign_words",
)


def _classes() -> np.ndarray:
    """Class of each byte: upper case, digit, sentence end, exclamation, other symbol, bracket or quote, beyond ASCII."""
    kinds = np.zeros((7, 256))
    members = [range(65, 91), range(48, 58), b".,;:?", b"!", b"#$%&*+/<=>@\\^_`|~", b"()[]{}\"'-", range(128, 256)]
    for i, bytes_of in enumerate(members):
        kinds[i, list(bytes_of)] = 1
    return kinds


def statistics(text: bytes, kinds: np.ndarray) -> list[float]:
    """Language-independent figures of a whole text; all zero for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = kinds @ np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    visible = sum(map(len, words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    seen = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        float(np.log1p(n)),
        visible / n,
        len(seen) / n,
        max(seen.values()) / n,
        float((lengths <= 3).mean()),
        float((lengths >= 16).mean()),
        *(float(c) / visible for c in counts),
        float(np.log1p(len(lines))),
        float(np.log1p(n / max(1, len(lines)))),
        len(set(lines)) / max(1, len(lines)),
        sum(n for w, n in seen.items() if w.isalpha() or w[-1] >= 128) / n,
        sum(n for w, n in seen.items() if w.isupper()) / n,
        (pairs + 1) / n,
        float(np.log1p(lengths.max())),
        sum(n for w, n in seen.items() if len(w) <= 3 and not w.isalnum() and w[0] < 128 and not w[:1].isalnum()) / n,
    ]


def with_statistics(docs: DataFrame, text_col: str = "text", name: str = "__stats") -> DataFrame:
    """The table with a struct of its texts' statistics; only the texts pass through Python."""
    kinds = _classes()

    @F.pandas_udf(", ".join(f"{s} double" for s in STATISTICS))
    def figures(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics((t or "").encode(), kinds) for t in texts], columns=list(STATISTICS), dtype=float)

    return docs.withColumn(name, figures(F.col(text_col)))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is above, threshold)."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self, stats: str) -> Column:
        parts = [F.col(stats)[s] > F.lit(t) if above else F.col(stats)[s] <= F.lit(t) for s, above, t in self.tests]
        return reduce(lambda a, b: a & b, parts)


def tree_rules(debug: str) -> list[Rule]:
    """All paths of an ensemble, from its printed form: every inner and leaf node below the root is a rule."""
    rules, path = [], []
    for line in debug.splitlines():
        m = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) (-?[\d.Ee+-]+)\)", line)
        if line.strip().startswith("Tree "):
            path = []
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, (STATISTICS[int(m[3])], m[4] == ">", float(m[5]))))
        rules.append(Rule(_simplified([test for _, test in path])))
    return list(dict.fromkeys(rules))


def _simplified(tests: list[tuple[str, bool, float]]) -> tuple[tuple[str, bool, float], ...]:
    """Of several tests on one side of a statistic the tightest is kept."""
    kept: dict[tuple[str, bool], float] = {}
    for s, above, t in tests:
        kept[s, above] = t if (s, above) not in kept else max(kept[s, above], t) if above else min(kept[s, above], t)
    return tuple((s, above, t) for (s, above), t in sorted(kept.items()))


@dataclass(frozen=True)
class RuleModel:
    """Intercept and the rules that kept a weight."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, stats: str = "__stats") -> Column:
        """Probability of label 1 as a column expression."""
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def fit(labelled: DataFrame, label: str = "label", stats: str = "__stats", seed: int = 7) -> RuleModel:
    """Rules from the paths of a forest over the statistics, weighted by a lasso logistic regression.

    `labelled` holds a bounded number of rows. Without rows the score is 1/2; with one class only it is near
    that class."""
    # a few files: the rows are few, and every step of the fit reads them
    rows = stored(labelled.coalesce(8).select(F.col(label).cast("double").alias("label"), f"{stats}.*"), "labelled")
    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        return RuleModel(float(np.log((ones + 0.5) / (n - ones + 0.5))), ())
    vector = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(rows).select("x", "label")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="x", numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=max(2, n // 2000), seed=seed
    )
    rules = tree_rules(forest.fit(vector).toDebugString)
    wide = rows.select("label", F.struct(*STATISTICS).alias("s"))
    hits = wide.select("label", array_to_vector(F.array(*[F.when(r.column("s"), 1.0).otherwise(0.0) for r in rules])).alias("x"))
    lasso = LogisticRegression(labelCol="label", featuresCol="x", elasticNetParam=1.0, regParam=PENALTY, standardization=False, maxIter=60)
    model = lasso.fit(hits)
    weights = model.coefficients.toArray()
    return RuleModel(float(model.intercept), tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6))


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = LABELLED_ROWS) -> DataFrame:
    """At most `rows` labelled documents with their statistics: label, __stats.

    Labels 0 and 1 count, others and null ids do not; an id with several labels has the smallest. The choice is
    by hash of the id, so it does not depend on the order of the table. It is small enough to broadcast."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("label"))
    known = known.where(~held_out(F.col("i"))).groupBy("i").agg(F.min("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("i"), "i").limit(rows)
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "i")
    return with_statistics(texts, "t").select("i", "label", "__stats").dropDuplicates(["i"])


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= threshold).

    Inputs of the score are the statistics of the whole text alone. Null texts count as empty and are scored by the
    rules that all-zero statistics meet; repeated rows are scored each; an empty table gives an empty result; other
    columns are not read."""
    model = fit(training_rows(docs, labels, "quality", id_col, text_col))
    slim = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    out = with_statistics(slim, "t").select(F.col("i").alias(id_col), model.score().alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is at least `threshold`; cases as in `scored`."""
    model = fit(training_rows(docs, labels, "quality", id_col, text_col))
    (stats,) = fresh(docs, "__stats")
    return with_statistics(docs, text_col, stats).where(model.score(stats) >= threshold).select(*docs.columns)
