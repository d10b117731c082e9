"""Queries for evaluation, bands and impact.

They score with the deterministic stand-in ``coalesce(risk_score_flags, 0) / 4``
(prediction ``score >= 0.5``) so every post-model operator can be checked
against SQL; the model-backed versions are in ``q_models``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import evaluate as EV
from churnlens.operators import scoring as SC
from churnlens.plans.medallion import split_from
from churnlens.plans.oracle import GOLD_COLS, band_sql, cols, with_base
from churnlens.plans.registry import register


def _test_scored(spark, sf_dir):
    df = SC.standin_score(split_from(spark, sf_dir).filter(F.col("split") == "test"))
    return df.select(F.col(C.TARGET).alias("label"), "score", "prediction")


def _portfolio_scores(spark, sf_dir):
    df = SC.standin_score(split_from(spark, sf_dir))
    return SC.with_band(df.select(*C.ALL_FEATURES, C.TARGET, F.col("score").alias("prob_churn")))


_CELLS = """
cells AS (
  SELECT CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS BIGINT) AS tn,
         CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS BIGINT) AS fn,
         CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS BIGINT) AS tp
  FROM test_scored),
per_class AS (
  SELECT 0 AS class, tn AS tp, fn AS fp, fp AS fn FROM cells
  UNION ALL SELECT 1, tp, fp, fn FROM cells),
pc AS (
  SELECT class,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1,
    tp + fn AS support
  FROM per_class)
"""


@register("confusion_matrix", with_base("""
SELECT 0 AS actual, 0 AS predicted, tn AS n FROM cells
UNION ALL SELECT 0, 1, fp FROM cells
UNION ALL SELECT 1, 0, fn FROM cells
UNION ALL SELECT 1, 1, tp FROM cells""", _CELLS))
def confusion_matrix_q(spark, sf_dir):
    return EV.confusion_matrix(_test_scored(spark, sf_dir))


@register("ordered_counts", with_base("""
SELECT label AS actual, prediction AS predicted, CAST(count(*) AS BIGINT) AS n
FROM test_scored GROUP BY label, prediction ORDER BY 1, 2"""))
def ordered_counts_q(spark, sf_dir):
    return EV.confusion_counts(_test_scored(spark, sf_dir))


@register("binary_metrics", with_base("""
SELECT CASE WHEN tp + tn + fp + fn = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) END AS accuracy,
       CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
       CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
       CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1
FROM cells""", _CELLS))
def binary_metrics_q(spark, sf_dir):
    return EV.binary_metrics(_test_scored(spark, sf_dir))


@register("weighted_metrics", with_base("""
SELECT sum(recall * support) / sum(support) AS weighted_recall,
       sum(precision * support) / sum(support) AS weighted_precision,
       sum(f1 * support) / sum(support) AS weighted_f1,
       sum(recall * support) / sum(support) AS accuracy
FROM pc""", _CELLS))
def weighted_metrics_q(spark, sf_dir):
    return EV.weighted_metrics(_test_scored(spark, sf_dir))


@register("classification_report", with_base("""
SELECT CAST(class AS VARCHAR) AS "row", round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pc
UNION ALL
SELECT 'accuracy', NULL, NULL, round(sum(recall * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM pc
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM pc""", _CELLS))
def classification_report_q(spark, sf_dir):
    return EV.classification_report(_test_scored(spark, sf_dir))


_SCORES = f"""
scores AS (
  SELECT {cols(GOLD_COLS)}, score AS prob_churn, {band_sql('score')} AS nivel_riesgo FROM scored)
"""


@register("risk_band", with_base("SELECT * FROM scores", _SCORES))
def risk_band_q(spark, sf_dir):
    return _portfolio_scores(spark, sf_dir)


@register("scores_layout", with_base(f"SELECT *, '{C.MODEL_TAG_GRID}' AS modelo FROM scores", _SCORES))
def scores_layout_q(spark, sf_dir):
    df = _portfolio_scores(spark, sf_dir).withColumn("modelo", F.lit(C.MODEL_TAG_GRID))
    return SC.scores_layout(df)


@register("risk_band_counts", with_base(
    "SELECT nivel_riesgo, CAST(count(*) AS BIGINT) AS n FROM scores GROUP BY 1 ORDER BY 1", _SCORES))
def risk_band_counts_q(spark, sf_dir):
    return SC.band_counts(_portfolio_scores(spark, sf_dir))


@register("high_risk_count", with_base(
    f"SELECT CAST(count(*) FILTER (WHERE nivel_riesgo = '{C.BAND_HIGH}') AS BIGINT) AS high_risk FROM scores",
    _SCORES))
def high_risk_count_q(spark, sf_dir):
    return SC.high_risk_count(_portfolio_scores(spark, sf_dir))


@register("retention_impact", with_base(f"""
SELECT total_customers, high_risk, retained,
       CAST(retained * {C.CLV_AVERAGE} AS BIGINT) AS preserved_revenue,
       CAST({C.CAMPAIGN_COST} AS BIGINT) AS campaign_cost,
       CAST(retained * {C.CLV_AVERAGE} AS DOUBLE) / {C.CAMPAIGN_COST}.0 AS roi
FROM (SELECT total_customers, high_risk, CAST(floor(high_risk * {C.RETENTION_RATE}) AS BIGINT) AS retained
      FROM (SELECT CAST(count(*) AS BIGINT) AS total_customers,
                   CAST(count(*) FILTER (WHERE nivel_riesgo = '{C.BAND_HIGH}') AS BIGINT) AS high_risk
            FROM scores))""", _SCORES))
def retention_impact_q(spark, sf_dir):
    return SC.retention_impact(_portfolio_scores(spark, sf_dir))


_ROC = """
sc AS (
  SELECT score AS threshold, CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS pos,
         CAST(count(*) FILTER (WHERE label <> 1) AS BIGINT) AS neg
  FROM test_scored WHERE score IS NOT NULL GROUP BY score),
cum AS (
  SELECT threshold, pos, neg,
    CAST(sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
    CAST(sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
    CAST(sum(pos) OVER () AS BIGINT) AS "P", CAST(sum(neg) OVER () AS BIGINT) AS "N"
  FROM sc),
pts AS (
  SELECT threshold, pos, neg, tp, fp,
    CASE WHEN "P" > 0 THEN CAST(tp AS DOUBLE) / "P" END AS tpr,
    CASE WHEN "N" > 0 THEN CAST(fp AS DOUBLE) / "N" END AS fpr, "P", "N"
  FROM cum)
"""


@register("roc_points", with_base("SELECT * FROM pts", _ROC))
def roc_points_q(spark, sf_dir):
    return EV.roc_points(_test_scored(spark, sf_dir))


@register("roc_auc", with_base("""
SELECT round(CASE WHEN max("P") > 0 AND max("N") > 0 THEN
         sum(CAST(neg AS DOUBLE) * CAST(2 * tp - pos AS DOUBLE)) / (2.0 * max("P") * max("N")) END, 6) AS auc,
       max("P") AS positives, max("N") AS negatives
FROM pts""", _ROC))
def roc_auc_q(spark, sf_dir):
    auc = EV.roc_auc(EV.roc_points(_test_scored(spark, sf_dir)))
    return auc.withColumn("auc", F.round("auc", 6))


@register("youden_threshold", with_base("""
SELECT threshold, tpr, fpr, tpr - fpr AS youden_j FROM pts
WHERE tpr IS NOT NULL AND fpr IS NOT NULL
ORDER BY youden_j DESC, threshold DESC LIMIT 1""", _ROC))
def youden_threshold_q(spark, sf_dir):
    return EV.youden_threshold(EV.roc_points(_test_scored(spark, sf_dir)))
