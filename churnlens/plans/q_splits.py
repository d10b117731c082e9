"""Queries for splits, folds, class filters / weights and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import split as SP
from churnlens.plans.medallion import gold_from, split_from
from churnlens.plans.oracle import with_base
from churnlens.plans.registry import register


def _train(spark, sf_dir):
    return split_from(spark, sf_dir).filter(F.col("split") == "train")


@register("stratified_split", with_base("SELECT * EXCLUDE (fold) FROM split"))
def stratified_split_q(spark, sf_dir):
    return SP.stratified_split(gold_from(spark, sf_dir))


@register("stratified_split_exact", with_base("""
SELECT * EXCLUDE (h, h2, cut), CASE WHEN h <= cut THEN 'train' ELSE 'test' END AS split
FROM keyed JOIN cuts USING ("Churn")""", extra_ctes=f"""
cuts AS (SELECT "Churn", quantile_disc(h, {1 - C.TEST_FRACTION}) AS cut FROM keyed GROUP BY "Churn")
"""))
def stratified_split_exact_q(spark, sf_dir):
    return SP.stratified_split_exact(gold_from(spark, sf_dir))


@register("stratified_folds", with_base("SELECT * EXCLUDE (split) FROM train"))
def stratified_folds_q(spark, sf_dir):
    return _train(spark, sf_dir).drop("split")


@register("split_union", with_base("""
SELECT * EXCLUDE (fold) FROM train WHERE "Churn" = 1
UNION ALL
SELECT * EXCLUDE (fold) FROM train WHERE "Churn" = 0"""))
def split_union_q(spark, sf_dir):
    train, _ = SP.split_by_class(gold_from(spark, sf_dir))
    return train


@register("class_filter", with_base('SELECT * FROM gold WHERE "Churn" = 1'))
def class_filter_q(spark, sf_dir):
    return SP.class_filter(gold_from(spark, sf_dir), 1)


@register("class_weight_column", with_base("""
SELECT * EXCLUDE (fold, split),
  CASE WHEN "Churn" = 1 THEN (SELECT CAST(count(*) FILTER (WHERE "Churn" = 0) AS DOUBLE)
                                     / count(*) FILTER (WHERE "Churn" = 1) FROM train)
       ELSE 1.0 END AS "classWeight"
FROM train"""))
def class_weight_column_q(spark, sf_dir):
    return SP.with_own_class_weight(_train(spark, sf_dir).drop("split", "fold"))


@register("row_count", with_base("""
SELECT CAST(count(*) AS BIGINT) AS n_gold,
       CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS n_train,
       CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS n_test
FROM split"""))
def row_count_q(spark, sf_dir):
    return split_from(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_gold"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"))


@register("split_churn_rate", with_base(
    'SELECT split, avg("Churn") AS churn_rate, CAST(count(*) AS BIGINT) AS n FROM split GROUP BY split'))
def split_churn_rate_q(spark, sf_dir):
    return split_from(spark, sf_dir).groupBy("split").agg(
        F.avg(C.TARGET).alias("churn_rate"), F.count(F.lit(1)).alias("n"))


@register("class_balance", with_base("""
SELECT n_negative, n_positive, CAST(n_negative AS DOUBLE) / n_positive AS ratio FROM (
  SELECT CAST(count(*) FILTER (WHERE "Churn" = 0) AS BIGINT) AS n_negative,
         CAST(count(*) FILTER (WHERE "Churn" = 1) AS BIGINT) AS n_positive
  FROM train)"""))
def class_balance_q(spark, sf_dir):
    y = F.col(C.TARGET)
    counts = _train(spark, sf_dir).agg(F.count_if(y == 0).alias("n_negative"),
                                       F.count_if(y == 1).alias("n_positive"))
    return counts.withColumn(
        "ratio", F.when(F.col("n_positive") > 0, F.col("n_negative") / F.col("n_positive")))
