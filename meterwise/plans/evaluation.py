"""Evaluation, folds, resampling and search."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.operators import evaluate, models, resample, search
from meterwise.operators.neighbors import count_nearer
from meterwise.plans.learning import DOC_FEATURES, documents, scaled_documents
from meterwise.plans.registry import Tables, query, r6
from meterwise.session import durable

# a fixed score per labelled document; its ties exercise the ranking curves
SCORED = "s AS (SELECT l.doc_id, l.quality, l.toxic, d.lang, (d.n_chars % 97) / 97.0::DOUBLE AS score, CAST((d.n_chars % 97) / 97.0::DOUBLE >= 0.4 AS INTEGER) AS pred FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


def scored(t: Tables) -> DataFrame:
    score = (F.col("n_chars") % 97) / F.lit(97.0)
    joined = t.labels.join(t.documents.select("doc_id", "n_chars", "lang"), "doc_id")
    return joined.select("doc_id", "quality", "toxic", "lang", score.alias("score"), (score >= 0.4).cast("int").alias("pred"))


@query("confusion", f"WITH {SCORED} SELECT quality, pred, count(*) AS n FROM s GROUP BY 1, 2")
def confusion(t: Tables) -> DataFrame:
    return evaluate.confusion(scored(t), "quality", "pred")


@query("accuracy", f"WITH {SCORED} SELECT round(avg(CASE WHEN quality = pred THEN 1.0 ELSE 0.0 END), 8) AS accuracy FROM s")
def accuracy(t: Tables) -> DataFrame:
    return t.literal([(evaluate.accuracy(scored(t), "quality", "pred"),)], "accuracy double").select(r6("accuracy", 8).alias("accuracy"))


def _report_sql(segment: str = "") -> str:
    seg = f"{segment}, " if segment else ""
    part = f"PARTITION BY {segment}" if segment else ""
    return f"""WITH {SCORED}, c AS (SELECT {seg}y AS class, count(*) FILTER (WHERE quality = y) AS support, count(*) FILTER (WHERE pred = y) AS predicted, count(*) FILTER (WHERE quality = y AND pred = y) AS tp, count(*) AS total
      FROM s, (VALUES (0), (1)) t(y) GROUP BY {seg}y),
    m AS (SELECT *, coalesce(tp / nullif(predicted, 0)::DOUBLE, 0) AS p, coalesce(tp / nullif(support, 0)::DOUBLE, 0) AS r, coalesce((total - support - predicted + tp) / nullif(total - support, 0)::DOUBLE, 0) AS sp FROM c WHERE support + predicted > 0)
    SELECT {seg}CAST(class AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1, round(sp, 6) AS specificity, round(sqrt(r * sp), 6) AS geo,
    round((1 + 0.1 * (r - sp)) * r * sp, 6) AS iba, CAST(support AS BIGINT) AS support FROM m"""


MEASURES = ["precision", "recall", "f1", "specificity", "geo", "iba"]


@query("class_report", _report_sql())
def class_report(t: Tables) -> DataFrame:
    return evaluate.class_report(scored(t), "quality", "pred").withColumns({m: r6(m) for m in MEASURES})


@query("segment_report", _report_sql("lang"))
def segment_report(t: Tables) -> DataFrame:
    return evaluate.class_report(scored(t), "quality", "pred", ["lang"]).withColumns({m: r6(m) for m in MEASURES})


@query(
    "report_averages",
    f"""WITH r AS ({_report_sql().replace('round(', 'round(1.0 * ')}) SELECT 'macro' AS average, round(avg(precision), 4) AS precision, round(avg(recall), 4) AS recall, round(avg(f1), 4) AS f1 FROM r
    UNION ALL SELECT 'weighted', round(sum(precision * support) / sum(support), 4), round(sum(recall * support) / sum(support), 4), round(sum(f1 * support) / sum(support), 4) FROM r""",
)
def report_averages(t: Tables) -> DataFrame:
    found = evaluate.report_averages(evaluate.class_report(scored(t), "quality", "pred"))
    return found.select("average", *[r6(m, 4).alias(m) for m in ("precision", "recall", "f1")])


@query(
    "roc_curve",
    f"""WITH {SCORED}, d AS (SELECT score, sum(quality) AS p, count(*) - sum(quality) AS n FROM s GROUP BY 1)
    SELECT round(score, 6) AS threshold, round(CAST(sum(n) OVER (ORDER BY score DESC) AS DOUBLE) / sum(n) OVER (), 6) AS fpr, round(CAST(sum(p) OVER (ORDER BY score DESC) AS DOUBLE) / sum(p) OVER (), 6) AS tpr FROM d""",
)
def roc_curve(t: Tables) -> DataFrame:
    return evaluate.roc_curve(scored(t), "quality", "score").withColumns({c: r6(c) for c in ("threshold", "fpr", "tpr")})


@query(
    "roc_auc_one_vs_rest",
    f"""WITH {SCORED}, u AS (SELECT '0' AS class, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS y, 1 - score AS sc FROM s UNION ALL SELECT '1', quality, score FROM s),
    p AS (SELECT a.class, sum(CASE WHEN a.sc > b.sc THEN 1.0 WHEN a.sc = b.sc THEN 0.5 ELSE 0 END) / count(*) AS auc FROM u a JOIN u b ON a.class = b.class WHERE a.y = 1 AND b.y = 0 GROUP BY 1) SELECT class, round(auc, 6) AS auc FROM p""",
)
def roc_auc_one_vs_rest(t: Tables) -> DataFrame:
    both = scored(t).withColumn("scores", F.array(1 - F.col("score"), F.col("score")))
    long = evaluate.one_vs_rest(both, "quality", "scores", [0, 1])
    return evaluate.roc_auc(long, "label", "score", ["class"]).withColumn("auc", r6("auc"))


_CURVE = f"""WITH {SCORED}, d AS (SELECT lang, score, CAST(sum(quality) AS DOUBLE) AS p, CAST(count(*) - sum(quality) AS DOUBLE) AS n FROM s GROUP BY 1, 2),
    c AS (SELECT lang, score, p, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER (PARTITION BY lang) AS tot FROM d WINDOW w AS (PARTITION BY lang ORDER BY score DESC)),
    k AS (SELECT lang, score, p, tp / (tp + fp) AS pr, tp / tot AS re, 2 * tp / (tp + fp + tot) AS f1, tot, lag(tp / (tp + fp), 1, 1.0) OVER (PARTITION BY lang ORDER BY score DESC) AS before FROM c)"""


@query("precision_recall_curve", _CURVE + " SELECT lang, round(score, 6) AS threshold, round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1 FROM k")
def precision_recall_curve(t: Tables) -> DataFrame:
    return evaluate.pr_curve(scored(t), "quality", "score", ["lang"]).withColumns({c: r6(c) for c in ("threshold", "precision", "recall", "f1")})


@query("precision_recall_area", _CURVE + " SELECT lang, round(sum(p * (pr + before) / 2) / any_value(tot), 6) AS auc_pr FROM k GROUP BY 1")
def precision_recall_area(t: Tables) -> DataFrame:
    return evaluate.pr_auc(scored(t), "quality", "score", ["lang"]).withColumn("auc_pr", r6("auc_pr"))


@query(
    "segment_thresholds",
    _CURVE + ", b AS (SELECT lang, arg_min(score, struct_pack(a := -round(f1, 12), b := score)) AS th FROM k GROUP BY 1) SELECT s.doc_id, CAST(s.score >= b.th AS INTEGER) AS prediction FROM s JOIN b ON s.lang = b.lang",
)
def segment_thresholds(t: Tables) -> DataFrame:
    """Best-F1 threshold of each language, applied to its documents."""
    table = scored(t)
    best = evaluate.best_thresholds(table, "quality", "score", ["lang"])
    return evaluate.apply_thresholds(table, "score", best, ["lang"]).select("doc_id", "prediction")


@query(
    "regression_metrics",
    """WITH e AS (SELECT l_extendedprice AS y, 2000 * l_quantity + 1000 AS p FROM lineitem) SELECT round(1 - avg(pow(y - p, 2)) / var_pop(y), 6) + 0.0 AS r2, round(avg(pow(y - p, 2)) / 1e6, 6) AS mse, round(sqrt(avg(pow(y - p, 2))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae FROM e""",
)
def regression_metrics(t: Tables) -> DataFrame:
    table = t.lineitem.select(F.col("l_extendedprice").alias("y"), (2000 * F.col("l_quantity") + 1000).alias("p"))
    found = evaluate.regression_metrics(table, "y", "p")
    return found.select(r6("r2").alias("r2"), r6(F.col("mse") / 1e6).alias("mse"), r6("rmse").alias("rmse"), r6("mae").alias("mae"))


@query("side_by_side", f"WITH {SCORED} SELECT doc_id, quality AS truth, pred AS predicted FROM s")
def side_by_side(t: Tables) -> DataFrame:
    return evaluate.side_by_side(scored(t), "doc_id", "quality", "pred")


# ---- folds ----


@query("contiguous_folds", "SELECT event_id, CAST(ntile(7) OVER (ORDER BY ts, event_id) - 1 AS INTEGER) AS fold FROM events")
def contiguous_folds(t: Tables) -> DataFrame:
    return evaluate.contiguous_folds(t.events.select("event_id", "ts"), "ts", "event_id", 7).select("event_id", "fold")


@query("shuffled_folds", "SELECT count(*) AS n, CAST(5 AS BIGINT) AS folds FROM events")
def shuffled_folds(t: Tables) -> DataFrame:
    folded = evaluate.shuffled_folds(t.events.select("event_id"), "event_id", 5)
    return folded.agg(F.count_distinct("event_id").alias("n"), F.count_distinct("fold").alias("folds"))


@query(
    "time_series_folds",
    """WITH r AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM events)
    SELECT event_id, CAST(CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE 1 + (i - (n - 5 * (n // 6))) // (n // 6) END AS INTEGER) AS fold FROM r""",
)
def time_series_folds(t: Tables) -> DataFrame:
    return evaluate.time_series_folds(t.events.select("event_id", "ts"), "ts", "event_id", 5).select("event_id", "fold")


@query(
    "stratified_folds",
    """WITH o AS (SELECT doc_id, quality, row_number() OVER (ORDER BY quality, doc_id) - 1 AS g, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS r FROM labels),
    a AS (SELECT quality, g % 5 AS f, count(*) AS n FROM o GROUP BY 1, 2), e AS (SELECT quality, f, sum(n) OVER (PARTITION BY quality ORDER BY f) AS e FROM a)
    SELECT o.doc_id, CAST(min(e.f) AS INTEGER) AS fold FROM o JOIN e ON o.quality = e.quality AND o.r <= e.e GROUP BY 1""",
)
def stratified_folds(t: Tables) -> DataFrame:
    return evaluate.stratified_folds(t.labels, "quality", "doc_id", 5).select("doc_id", "fold")


# ---- resampling ----


@query("undersample", "SELECT quality, (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY quality)) AS n FROM labels GROUP BY 1")
def undersample(t: Tables) -> DataFrame:
    kept = resample.undersample(t.labels, "quality", "doc_id")
    return kept.groupBy("quality").agg(F.count_distinct("doc_id").alias("n"))


@query(
    "oversample",
    "SELECT quality, (SELECT max(n) FROM (SELECT count(*) AS n FROM labels GROUP BY quality)) AS n, count(*) AS originals FROM labels GROUP BY 1",
)
def oversample(t: Tables) -> DataFrame:
    more = resample.oversample(t.labels, "quality", "doc_id")
    return more.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("originals"))


@query("smote", "SELECT quality, (SELECT max(n) FROM (SELECT count(*) AS n FROM labels GROUP BY quality)) AS n, count(*) AS originals FROM labels GROUP BY 1")
def smote(t: Tables) -> DataFrame:
    made = resample.smote(documents(t), "quality", "doc_id", DOC_FEATURES, 3)
    return made.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("originals"))


@query("smote_rows")
def smote_rows(t: Tables) -> DataFrame:
    return resample.smote(documents(t), "quality", "doc_id", DOC_FEATURES, 3).filter("synthetic")


@query(
    "smote_segments",
    """WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1) SELECT quality, (SELECT max(n) FROM c) - n AS n, CAST(0 AS BIGINT) AS other_class, CAST(0 AS DOUBLE) AS off, CAST(0 AS BIGINT) AS not_near FROM c WHERE n < (SELECT max(n) FROM c)""",
)
def smote_segments(t: Tables) -> DataFrame:
    """New rows by class: how many, how far off the segment between their two rows, and how many of those are of another
    class or not among the three nearest."""
    base = documents(t)
    made = resample.smote(base, "quality", "doc_id", DOC_FEATURES, 3, trace=True).filter("synthetic").select("quality", "from_key", "to_key", "gap", *DOC_FEATURES)
    ends = {n: base.select(F.col("doc_id").alias(f"{n}_key"), F.col("quality").alias(f"{n}_quality"), F.array(*DOC_FEATURES).alias(n)) for n in ("from", "to")}
    placed = made.join(ends["from"], "from_key").join(ends["to"], "to_key")
    point = F.zip_with("from", "to", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    want = F.transform(point, lambda p: p["a"] + F.col("gap") * (p["b"] - p["a"]))
    off = F.array_max(F.zip_with(want, F.array(*DOC_FEATURES), lambda a, b: F.abs(a - b)))
    square = F.aggregate(F.transform(point, lambda p: F.pow(p["a"] - p["b"], 2)), F.lit(0.0), lambda a, b: a + b)
    placed = placed.withColumns({"off": off, "square": square, "strange": (F.col("from_quality") != F.col("quality")) | (F.col("to_quality") != F.col("quality"))})
    # rows of the class that are nearer than the partner
    own = base.select(F.col("doc_id").alias("id"), F.col("quality").alias("group"), F.array(*DOC_FEATURES).alias("vector"))
    pairs = placed.select(F.col("from_key").alias("id"), "to_key", F.col("quality").alias("group"), F.col("from").alias("vector"), (F.col("square") * (1 - 1e-9)).alias("square")).distinct()
    nearer = count_nearer(pairs, own).select(F.col("id").alias("from_key"), "to_key", "nearer")
    found = placed.join(nearer, ["from_key", "to_key"]).groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("strange").alias("other_class"), r6(F.max("off")).alias("off"), F.count_if(F.col("nearer") >= 3).alias("not_near")
    )
    return found


@query("resampling_comparison")
def resampling_comparison(t: Tables) -> DataFrame:
    return resample.cross_validate_resampling(scaled_documents(t), "quality", "doc_id", DOC_FEATURES, LogisticRegression(labelCol="quality", maxIter=10))


@query("threshold_comparison")
def threshold_comparison(t: Tables) -> DataFrame:
    return resample.cross_validate_threshold(scaled_documents(t), "quality", "doc_id", DOC_FEATURES, LogisticRegression(labelCol="quality", maxIter=10))


@query(
    "threshold_scan",
    f"""WITH {SCORED}, t AS (SELECT i / 100.0::DOUBLE AS threshold FROM range(100) r(i)) SELECT threshold, round(2.0 * count(*) FILTER (WHERE score >= threshold AND quality = 1) / nullif(count(*) FILTER (WHERE score >= threshold) + sum(quality), 0), 6) AS f1 FROM s, t GROUP BY 1""",
)
def threshold_scan(t: Tables) -> DataFrame:
    return resample.threshold_scores(scored(t), "quality", "score", [i / 100 for i in range(100)]).withColumn("f1", r6("f1"))


def _searched(t: Tables) -> DataFrame:
    return durable(evaluate.shuffled_folds(models.with_features(scaled_documents(t), DOC_FEATURES), "doc_id", 3))


@query("cross_validation")
def cross_validation(t: Tables) -> DataFrame:
    return search.cross_validate(LogisticRegression(labelCol="quality", maxIter=10), _searched(t), "quality", "fold")


@query("out_of_fold_predictions")
def out_of_fold_predictions(t: Tables) -> DataFrame:
    table = _searched(t)
    predicted = models.out_of_fold(LogisticRegression(labelCol="quality", maxIter=10), table, "doc_id", "fold")
    return evaluate.confusion(table.join(predicted, "doc_id"), "quality", "prediction")


@query("search_comparison")
def search_comparison(t: Tables) -> DataFrame:
    table = _searched(t)
    grid = {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 1.0]}
    return search.compare_searches("logistic", LogisticRegression(labelCol="quality", maxIter=10), grid, table.filter("fold > 0"), table.filter("fold = 0"), "quality", "fold")


@query("grid_ranking")
def grid_ranking(t: Tables) -> DataFrame:
    return search.grid_table(LogisticRegression(labelCol="quality", maxIter=10), {"regParam": [0.0, 0.1]}, _searched(t), "quality", "fold")
