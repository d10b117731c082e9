"""Bands, impact, metrics and curves: fixed cases, properties and brute force."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import evaluate as EV
from churnlens.operators import scoring as SC


def test_band_boundaries(spark):
    rows = [(0.0,), (0.40,), (0.4000001,), (0.70,), (0.7000001,), (1.0,), (None,), (float("nan"),)]
    df = SC.with_band(spark.createDataFrame(rows, "prob_churn double"))
    got = [r["nivel_riesgo"] for r in df.collect()]
    assert got == ["BAJO", "BAJO", "MEDIO", "MEDIO", "ALTO", "ALTO", None, None]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=0.0, max_value=1.0), min_size=1, max_size=40))
def test_bands_partition_unit_interval(spark, probs):
    df = SC.with_band(spark.createDataFrame([(p,) for p in probs], "prob_churn double"))
    counts = {r["nivel_riesgo"]: r["n"] for r in SC.band_counts(df).collect()}
    assert sum(counts.values()) == len(probs)
    assert None not in counts
    expected_high = sum(1 for p in probs if p > C.BAND_MEDIUM_MAX)
    assert counts.get("ALTO", 0) == expected_high


@pytest.mark.parametrize("high,retained,preserved,roi", [
    (7, 1, 1_068_000, 0.024), (3, 0, 0, 0.0), (4000, 1000, 1_068_000_000, 24.0)])
def test_impact(spark, high, retained, preserved, roi):
    rows = [("ALTO",)] * high + [("BAJO",)] * 5
    out = SC.retention_impact(spark.createDataFrame(rows, "nivel_riesgo string")).first()
    assert out["total_customers"] == high + 5 and out["high_risk"] == high
    assert out["retained"] == retained and out["preserved_revenue"] == preserved
    assert out["campaign_cost"] == 44_500_000
    assert math.isclose(out["roi"], roi, rel_tol=1e-12, abs_tol=1e-12)


def _pairwise_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y != 1]
    if not pos or not neg:
        return None
    total = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return total / (len(pos) * len(neg))


def _frame(spark, labels, scores):
    return spark.createDataFrame(list(zip(labels, scores)), "label int, score double")


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.5, 0.9, 1.0])),
                min_size=2, max_size=60))
def test_auc_matches_pairwise_brute_force(spark, pairs):
    labels, scores = [p[0] for p in pairs], [p[1] for p in pairs]
    got = EV.roc_auc(EV.roc_points(_frame(spark, labels, scores))).first()["auc"]
    want = _pairwise_auc(labels, scores)
    if want is None:
        assert got is None
    else:
        assert math.isclose(got, want, abs_tol=1e-12)
        flipped = EV.roc_auc(EV.roc_points(_frame(spark, labels, [1 - s for s in scores]))).first()["auc"]
        assert math.isclose(flipped, 1 - want, abs_tol=1e-12)


def test_auc_edge_cases(spark):
    one_class = EV.roc_auc(EV.roc_points(_frame(spark, [1, 1, 1], [0.1, 0.5, 0.9]))).first()
    assert one_class["auc"] is None
    equal = EV.roc_auc(EV.roc_points(_frame(spark, [0, 1, 0, 1], [0.3] * 4))).first()
    assert equal["auc"] == 0.5


def test_auc_matches_spark_evaluator_without_binning(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(7)
    labels = [rng.randint(0, 1) for _ in range(300)]
    scores = [round(rng.random(), 2) for _ in range(300)]
    df = _frame(spark, labels, scores)
    ours = EV.roc_auc(EV.roc_points(df)).first()["auc"]
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    theirs = ev.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert math.isclose(ours, theirs, abs_tol=1e-9)


def test_roc_points_cumulative_and_youden(spark):
    df = _frame(spark, [1, 1, 0, 1, 0, 0], [0.9, 0.8, 0.8, 0.4, 0.3, 0.1])
    pts = {r["threshold"]: r for r in EV.roc_points(df, block_scores=2).collect()}
    assert (pts[0.9]["tp"], pts[0.9]["fp"]) == (1, 0)
    assert (pts[0.8]["tp"], pts[0.8]["fp"]) == (2, 1)
    assert (pts[0.1]["tp"], pts[0.1]["fp"]) == (3, 3)
    best = EV.youden_threshold(EV.roc_points(df)).first()
    assert best["threshold"] == 0.4 and math.isclose(best["youden_j"], 1 - 1 / 3)


def test_confusion_and_metrics(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = random.Random(3)
    rows = [(rng.randint(0, 1), rng.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    cm = EV.confusion_matrix(df).collect()
    assert len(cm) == 4 and sum(r["n"] for r in cm) == 200
    w = EV.weighted_metrics(df).first()
    assert math.isclose(w["weighted_recall"], w["accuracy"])
    ev_df = df.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    for ours, name in (("weighted_precision", "weightedPrecision"),
                       ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1"),
                       ("accuracy", "accuracy")):
        theirs = MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="prediction", metricName=name).evaluate(ev_df)
        assert math.isclose(w[ours], theirs, abs_tol=1e-12), name
    b = EV.binary_metrics(df).first()
    tp = sum(1 for y, p in rows if y == 1 and p == 1)
    fp = sum(1 for y, p in rows if y == 0 and p == 1)
    fn = sum(1 for y, p in rows if y == 1 and p == 0)
    assert math.isclose(b["precision"], tp / (tp + fp)) and math.isclose(b["recall"], tp / (tp + fn))


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    b = EV.binary_metrics(df).first()
    assert (b["accuracy"], b["precision"], b["recall"], b["f1"]) == (1.0, 0.0, 0.0, 0.0)
    rep = {r["row"]: r for r in EV.classification_report(df).collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert rep["accuracy"]["f1"] == 1.0 and rep["accuracy"]["precision"] is None


def test_roc_blocks_with_concentrated_distinct_scores(spark):
    """500 distinct scores packed into [0.50, 0.51) and 8 blocks: the running
    sums must still equal a sorted brute force."""
    rng = random.Random(13)
    scores = [0.5 + rng.random() / 100 for _ in range(500)] + [0.9] * 40
    labels = [rng.randint(0, 1) for _ in scores]
    pts = EV.roc_points(_frame(spark, labels, scores), block_scores=8).collect()
    by_t = {r["threshold"]: (r["tp"], r["fp"]) for r in pts}
    for t, (tp, fp) in by_t.items():
        assert tp == sum(1 for y, s in zip(labels, scores) if s >= t and y == 1)
        assert fp == sum(1 for y, s in zip(labels, scores) if s >= t and y != 1)
    auc = EV.roc_auc(EV.roc_points(_frame(spark, labels, scores), block_scores=8)).first()["auc"]
    assert math.isclose(auc, _pairwise_auc(labels, scores), abs_tol=1e-12)


def test_roc_of_any_input(spark):
    schema = "label int, score double"
    empty = EV.roc_points(spark.createDataFrame([], schema))
    assert empty.collect() == [] and EV.roc_auc(empty).first()["auc"] is None
    assert EV.youden_threshold(empty).collect() == []
    one_class = EV.roc_points(spark.createDataFrame([(1, 0.2), (1, 0.9)], schema))
    assert EV.roc_auc(one_class).first()["auc"] is None
    rows = [(1, 0.9), (0, 0.1), (1, float("nan")), (0, None), (1, float("inf")), (0, float("-inf")), (0, 0.9)]
    for size in (2, 100_000):
        points = EV.roc_points(spark.createDataFrame(rows, schema), block_scores=size)
        assert points.count() == 4
        assert abs(EV.roc_auc(points).first()["auc"] - 5.5 / 6) < 1e-12
