"""Queries over the landing files and the bronze layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import bronze as B
from churnlens.plans.medallion import bronze_from
from churnlens.plans.oracle import with_base
from churnlens.plans.registry import register
from churnlens.session import scratch_path
from churnlens.sources.landing import landing_inventory, read_landing, typed, write_landing
from churnlens.sources.portfolio import portfolio, portfolio_tagged

RENAMED_UNION = """
SELECT * FROM renamed_train UNION ALL SELECT * FROM renamed_test"""


def _staged_landing(spark, sf_dir):
    """Stage the portfolio parts as CSV landing files in the shared folder."""
    landing = scratch_path(spark, "landing")
    write_landing(portfolio(spark, sf_dir), landing)
    return landing


@register("landing_inventory", "SELECT name, true AS has_bytes, true AS has_files FROM "
          f"(VALUES ('{C.TRAIN_FILE}'), ('{C.TEST_FILE}')) t(name)")
def landing_inventory_q(spark, sf_dir):
    found = landing_inventory(spark, _staged_landing(spark, sf_dir), "*.csv")
    return found.select("name", (F.col("size") > 0).alias("has_bytes"), (F.col("files") > 0).alias("has_files"))


@register("csv_ingest", with_base(RENAMED_UNION))
def csv_ingest_q(spark, sf_dir):
    parts = read_landing(spark, _staged_landing(spark, sf_dir))
    return B.union_parts([B.rename_headers(typed(df)) for df in parts.values()])


@register("bronze_rename", with_base(RENAMED_UNION))
def bronze_rename_q(spark, sf_dir):
    return B.rename_headers(portfolio_tagged(spark, sf_dir)).drop("_source_file")


@register("bronze_provenance", with_base(
    'SELECT "CustomerID", _source_file FROM bronze_rows'))
def bronze_provenance_q(spark, sf_dir):
    parts = [B.tag_source(df, name).select("CustomerID", "_source_file")
             for name, df in portfolio(spark, sf_dir).items()]
    return B.union_parts(parts)


@register("bronze_union", with_base("SELECT * FROM bronze_rows"))
def bronze_union_q(spark, sf_dir):
    """Both parts by name, as one pass over the source tables emits them."""
    return B.rename_headers(portfolio_tagged(spark, sf_dir))


@register("bronze_ingest_time", with_base("""
SELECT CAST(count(DISTINCT _ingestion_time) AS BIGINT) AS n_distinct_times,
       CAST(count(_ingestion_time) AS BIGINT) AS n_stamped,
       CAST(count(*) AS BIGINT) AS n_rows
FROM bronze"""))
def bronze_ingest_time_q(spark, sf_dir):
    return bronze_from(spark, sf_dir).agg(
        F.count_distinct("_ingestion_time").alias("n_distinct_times"),
        F.count("_ingestion_time").alias("n_stamped"),
        F.count(F.lit(1)).alias("n_rows"))


@register("bronze", with_base("""
SELECT * EXCLUDE (_ingestion_time), _ingestion_time IS NOT NULL AS stamped FROM bronze"""))
def bronze_q(spark, sf_dir):
    df = bronze_from(spark, sf_dir)
    return df.withColumn("stamped", F.col("_ingestion_time").isNotNull()).drop("_ingestion_time")


@register("bronze_stream", with_base("""
SELECT * EXCLUDE (_ingestion_time), _ingestion_time IS NOT NULL AS stamped FROM bronze"""))
def bronze_stream_q(spark, sf_dir):
    """Landing files -> streaming ingest (availableNow) -> bronze folder, read back."""
    from churnlens.streaming.ingest import run_bronze_ingest

    landing = _staged_landing(spark, sf_dir)
    out = scratch_path(spark, "bronze-stream")
    run_bronze_ingest(spark, landing, f"{out}/data", f"{out}/checkpoint")
    raw = C.RENAMES
    df = B.rename_headers(typed(spark.read.parquet(f"{out}/data").withColumnsRenamed({v: k for k, v in raw.items()})))
    return df.withColumn("stamped", F.col("_ingestion_time").isNotNull()).drop("_ingestion_time")
