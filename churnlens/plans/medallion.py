"""The medallion flow as plain functions: landing -> bronze -> silver -> gold.

Each layer is a ``DataFrame -> DataFrame`` function; writing a layer as a
table between steps is the caller's choice (``sources.tables``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens import config as C
from churnlens.operators.bronze import rename_headers, stamp_ingestion
from churnlens.operators.gold import gold_features
from churnlens.operators.silver import silver, silver_unfiltered
from churnlens.operators.split import stratified_folds, stratified_split
from churnlens.sources.portfolio import portfolio_tagged


def bronze_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of the portfolio: both landing parts from one scan of the
    source tables, renamed and stamped (same rows as ``bronze(portfolio)``)."""
    return stamp_ingestion(rename_headers(portfolio_tagged(spark, sf_dir)))


def unfiltered_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_unfiltered(bronze_from(spark, sf_dir))


def silver_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(bronze_from(spark, sf_dir))


def gold_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_features(silver_from(spark, sf_dir))


def split_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows with ``split`` and ``fold`` (the fold matters for train rows)."""
    return stratified_folds(stratified_split(gold_from(spark, sf_dir)))


def run_medallion(spark: SparkSession, bronze_df: DataFrame, tables: C.Tables = C.Tables()
                  ) -> dict[str, str]:
    """Materialise bronze, silver and gold as tables (overwrite), each layer
    read back from storage by the next one, as a batch update does.

    The rule metrics of the update (failed rows per rule, kept, dropped) are
    appended to the quality table and the dropped rows, with the rules they
    fail, overwrite the quarantine.  The distinct, derived rows are written
    once to the shared scratch folder; the silver write, the metrics and the
    quarantine are narrow passes over it, and it is deleted at the end."""
    from pyspark.sql import functions as F

    from churnlens.operators.quality import expect_drop, expect_metrics, expect_violations
    from churnlens.session import drop_folder, scratch_path
    from churnlens.sources import tables as T

    T.ensure_database(spark, tables.qualified_database)
    out = {}
    out["bronze"] = T.write_table(bronze_df, tables.qualified(tables.bronze), tables.fmt,
                                  "Raw churn rows (train+test) with standardised column names.")
    scratch = scratch_path(spark, "silver-unfiltered")
    silver_unfiltered(spark.table(out["bronze"])).write.parquet(scratch)
    try:
        unfiltered = spark.read.parquet(scratch)
        out["silver"] = T.write_table(expect_drop(unfiltered), tables.qualified(tables.silver),
                                      tables.fmt,
                                      "Clean, typed, distinct rows with derived business features.")
        metrics = expect_metrics(unfiltered).withColumn("updated_at", F.current_timestamp())
        out["quality"] = T.write_table(metrics, tables.qualified(tables.quality), tables.fmt,
                                       mode="append")
        out["quarantine"] = T.write_table(
            expect_violations(unfiltered), tables.qualified(tables.quarantine), tables.fmt,
            "Rows dropped by the quality rules, with the rules they fail.")
    finally:
        drop_folder(spark, scratch)
    gold_df = gold_features(spark.table(out["silver"]))
    out["gold"] = T.write_table(gold_df, tables.qualified(tables.gold), tables.fmt,
                                "Model-ready feature table.")
    return out
