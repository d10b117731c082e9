"""Classifier evaluation as aggregates: confusion table, metrics, ROC, AUC.

* Confusion counts, binary / per-class / weighted metrics come from ONE
  aggregate with ``count_if`` cells (partial + final aggregation), whatever
  the number of rows.
* The ROC curve first aggregates rows per distinct score (a hot score costs
  one row), then needs a running sum in descending score order.  A plain
  ``sum() over (order by score)`` would move every distinct score into one
  task; instead the distinct scores are cut into blocks at approximate
  quantiles, block totals (at most ``blocks`` rows) give each block's offset,
  and the running sum inside a block is a window partitioned by block.
* AUC is the trapezoid area under those points and needs no ``lag``: the
  previous point of a score is its own cumulative count minus its own count.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LABEL, PRED, SCORE = "label", "prediction", "score"


def _safe_div(num, den):
    """num / den, 0.0 when den is 0 (zero-division convention of the metrics)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def confusion_cells(df: DataFrame, label: str = LABEL, prediction: str = PRED) -> DataFrame:
    """One row: tn, fp, fn, tp (binary labels 0/1)."""
    y, p = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def confusion_matrix(df: DataFrame, label: str = LABEL, prediction: str = PRED) -> DataFrame:
    """Dense 2x2 table in long form: actual, predicted, n (zeros included)."""
    return confusion_cells(df, label, prediction).selectExpr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, n)")


def confusion_counts(df: DataFrame, label: str = LABEL, prediction: str = PRED) -> DataFrame:
    """Sparse table: only observed (actual, predicted) pairs, ordered."""
    return (df.groupBy(F.col(label).alias("actual"), F.col(prediction).cast("int").alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy("actual", "predicted"))


def binary_metrics(df: DataFrame, label: str = LABEL, prediction: str = PRED) -> DataFrame:
    """Accuracy, and precision / recall / F1 of the positive class."""
    c = confusion_cells(df, label, prediction)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    return c.select(
        _safe_div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def per_class(df: DataFrame, label: str = LABEL, prediction: str = PRED) -> DataFrame:
    """One row per class: class, precision, recall, f1, support."""
    rows = confusion_cells(df, label, prediction).selectExpr(
        # class, tp, fp, fn of that class
        "stack(2, 0, tn, fn, fp, 1, tp, fp, fn) AS (class, tp, fp, fn)")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    p, r = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    return rows.select(
        F.col("class").cast("int").alias("class"),
        p.alias("precision"), r.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"))


def _weighted_columns() -> list:
    """Support-weighted precision / recall / F1 and accuracy as expressions
    over the confusion cells (class 0: tp=tn, fp=fn, fn=fp)."""
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    n = tp + fp + fn + tn
    s1, s0 = tp + fn, tn + fp
    p1, r1, f1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn), _safe_div(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp), _safe_div(2 * tn, 2 * tn + fn + fp)
    return [
        _safe_div(r0 * s0 + r1 * s1, n).alias("weighted_recall"),
        _safe_div(p0 * s0 + p1 * s1, n).alias("weighted_precision"),
        _safe_div(f0 * s0 + f1 * s1, n).alias("weighted_f1"),
        _safe_div(r0 * s0 + r1 * s1, n).alias("accuracy"),
    ]


def weighted_metrics(df: DataFrame, label: str = LABEL, prediction: str = PRED) -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1 over both classes."""
    return confusion_cells(df, label, prediction).select(*_weighted_columns())


def all_metrics(df: DataFrame, label: str = LABEL, prediction: str = PRED) -> DataFrame:
    """Positive-class and weighted metrics in one row, from one aggregate."""
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    return confusion_cells(df, label, prediction).select(
        _safe_div(tp + tn, tp + tn + fp + fn).alias("accuracy_all"),
        _safe_div(tp, tp + fp).alias("precision"), _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"), *_weighted_columns())


def classification_report(df: DataFrame, label: str = LABEL, prediction: str = PRED,
                          digits: int = 6) -> DataFrame:
    """Per-class rows plus 'accuracy', 'macro avg', 'weighted avg' rows."""
    pc = per_class(df, label, prediction)
    n = F.sum("support")
    classes = pc.select(F.col("class").cast("string").alias("row"), "precision", "recall",
                        "f1", "support")
    summary = pc.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        _safe_div(F.sum(F.col("precision") * F.col("support")), n).alias("wp"),
        _safe_div(F.sum(F.col("recall") * F.col("support")), n).alias("wr"),
        _safe_div(F.sum(F.col("f1") * F.col("support")), n).alias("wf"),
        n.alias("n"),
    ).selectExpr(
        "stack(3, 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), wr, n,"
        " 'macro avg', mp, mr, mf, n, 'weighted avg', wp, wr, wf, n)"
        " AS (row, precision, recall, f1, support)")
    out = classes.unionByName(summary)
    return out.select("row", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("bigint").alias("support"))


# ---------------------------------------------------------------- ROC / AUC

def score_counts(df: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """Positives and negatives per distinct score; NULL and NaN are left out."""
    return (df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
            .groupBy(F.col(score).alias("threshold"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"),
                 F.count_if(F.col(label) != 1).alias("neg")))


def roc_points(df: DataFrame, label: str = LABEL, score: str = SCORE, block_scores: int = 100_000
               ) -> DataFrame:
    """Cumulative tp / fp per distinct threshold (score >= threshold is positive),
    with tpr and fpr; one row per distinct score, none for an empty frame.

    The distinct scores are cut at approximate quantiles into blocks of about
    ``block_scores``, however the scores concentrate, so the number of blocks
    follows the number of distinct scores; their table is checkpointed (shared
    folder) because it is read more than once.
    """
    from pyspark.ml.feature import Bucketizer

    from churnlens.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    sc = score_counts(df, label, score).checkpoint(eager=True)
    blocks = max(1, math.ceil(sc.count() / block_scores))
    cuts: list[float] = []
    if blocks > 1:
        probs = [i / blocks for i in range(1, blocks)]
        cuts = sorted({float(v) for v in sc.approxQuantile("threshold", probs, 1.0 / (4 * blocks))})
    if cuts := [c for c in cuts if math.isfinite(c)]:
        # Bucketizer: ascending block index in score (JVM binary search, no UDF).
        splits = [float("-inf"), *cuts, float("inf")]
        sc = Bucketizer(splits=splits, inputCol="threshold", outputCol="_b").transform(sc)
        sc = sc.withColumn("block", F.col("_b").cast("int")).drop("_b")
    else:
        sc = sc.withColumn("block", F.lit(0))
    totals = sc.groupBy("block").agg(F.sum("pos").alias("bpos"), F.sum("neg").alias("bneg"))
    # One row per block: a single-partition window over scores / block_scores rows.
    # Blocks of HIGHER scores come first in the cumulative order.
    w_all = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "block",
        F.coalesce(F.sum("bpos").over(w_all), F.lit(0)).alias("pos_before"),
        F.coalesce(F.sum("bneg").over(w_all), F.lit(0)).alias("neg_before"),
        F.sum("bpos").over(Window.partitionBy()).alias("P"),
        F.sum("bneg").over(Window.partitionBy()).alias("N"),
    )
    w_in = (Window.partitionBy("block").orderBy(F.col("threshold").desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pts = (sc.join(F.broadcast(offsets), "block")
           .withColumn("tp", F.col("pos_before") + F.sum("pos").over(w_in))
           .withColumn("fp", F.col("neg_before") + F.sum("neg").over(w_in)))
    return pts.select(
        "threshold", "pos", "neg", "tp", "fp",
        F.when(F.col("P") > 0, F.col("tp") / F.col("P")).alias("tpr"),
        F.when(F.col("N") > 0, F.col("fp") / F.col("N")).alias("fpr"),
        "P", "N")


def roc_auc(points: DataFrame) -> DataFrame:
    """Exact area under the ROC curve (trapezoids, ties handled); NULL when a
    class is missing.  One row: auc, positives, negatives."""
    tp, pos, neg = F.col("tp"), F.col("pos"), F.col("neg")
    area = F.sum(neg.cast("double") * (2 * tp - pos).cast("double"))
    return points.agg(
        F.max("P").alias("P"), F.max("N").alias("N"), area.alias("area")
    ).select(
        F.when((F.col("P") > 0) & (F.col("N") > 0),
               F.col("area") / (F.lit(2.0) * F.col("P") * F.col("N"))).alias("auc"),
        F.col("P").alias("positives"), F.col("N").alias("negatives"))


def youden_threshold(points: DataFrame) -> DataFrame:
    """Threshold maximising tpr - fpr; ties go to the highest threshold.
    A global top-1 (each task keeps its best row, then one merge)."""
    return (points.filter(F.col("tpr").isNotNull() & F.col("fpr").isNotNull())
            .withColumn("youden_j", F.col("tpr") - F.col("fpr"))
            .orderBy(F.col("youden_j").desc(), F.col("threshold").desc())
            .limit(1)
            .select("threshold", "tpr", "fpr", "youden_j"))


# ------------------------------------------------- curve over merged histograms

def score_histogram(scored: DataFrame, bins: int = 1024, label: str = "label", score: str = "score") -> DataFrame:
    """(bin, pos, neg): counts of both classes by equal bins of a score between 0 and
    1.  Histograms of parts (micro-batches, days) add up to that of all rows, so a curve
    over a stream needs `bins` rows of state.  Null or NaN scores are left out."""
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("long")
    return (scored.filter(F.col(score).isNotNull() & ~F.isnan(score)).groupBy(at.alias("bin"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))


def merged_histogram(parts: DataFrame) -> DataFrame:
    """The histogram of all rows from those of parts."""
    return parts.groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def roc_from_histogram(histogram: DataFrame) -> DataFrame:
    """(bin, tpr, fpr): the curve's points at the lower edges of the bins, largest first;
    these points are exact."""
    above = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)  # as many rows as bins
    every = Window.partitionBy()
    return histogram.select("bin", (F.sum("pos").over(above) / F.sum("pos").over(every)).alias("tpr"),
                            (F.sum("neg").over(above) / F.sum("neg").over(every)).alias("fpr"))


def auc_from_histogram(histogram: DataFrame) -> DataFrame:
    """(auc, error_bound): the area with half of the pairs within a bin, which is off by at
    most half of their share.  NULL without rows of both classes."""
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as bins
    counted = histogram.select(F.col("pos").cast("double").alias("pos"), F.col("neg").cast("double").alias("neg"),
                               F.coalesce(F.sum(F.col("neg").cast("double")).over(below), F.lit(0.0)).alias("below"))
    pairs, inside = F.sum("pos") * F.sum("neg"), F.sum(F.col("pos") * F.col("neg"))
    return counted.agg(F.when(pairs > 0, (F.sum(F.col("pos") * F.col("below")) + inside / 2.0) / pairs).alias("auc"),
                       F.when(pairs > 0, inside / (2.0 * pairs)).alias("error_bound"))
