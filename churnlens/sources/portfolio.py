"""Customer portfolio built from the driver's tables.

The application reads two hand-uploaded CSV files of customer profiles.  To
run every operator on the shared test tables, this adapter derives the same
raw profile layout (same headers, same types) from ``customer``, ``orders``
and ``events``.  Orders and events are pre-aggregated per customer before the
joins, so each join sees at most one row per key on its right side and a
customer holding a third of all orders is reduced by the map-side partial
aggregate before any shuffle.

The modulo expressions on the customer key are part of the fixture's
definition, not sampling: they choose the landing file of each customer
(residue 0 -> testing file, 1 -> both files, 2-4 -> training file, so every
customer lands somewhere) and plant the data defects the quality rules must
catch (missing ages, invalid labels, missing last interaction).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens import config as C

#: Fixed reference day for "days since the last order".
AS_OF_DATE = "2001-08-02"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_activity(orders: DataFrame) -> DataFrame:
    """One row per customer: first / last order day, count, urgent count,
    pending count and exact (decimal) spend."""
    return orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.min(F.to_date("o_orderdate")).alias("first_day"),
        F.max(F.to_date("o_orderdate")).alias("last_day"),
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.count_if(F.col("o_orderstatus") == "P").alias("n_pending"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend"),
    )


def event_activity(events: DataFrame) -> DataFrame:
    """One row per user with events: number of click / view events."""
    return events.groupBy(F.col("user_id").alias("custkey")).agg(
        F.count_if(F.col("event_type").isin("click", "view")).alias("n_usage"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw profile rows (CSV layout, typed) for every customer."""
    customer = _read(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    orders = _read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    events = _read(spark, sf_dir, "events").select("user_id", "event_type")

    key = F.col("c_custkey")
    joined = (
        customer
        .join(order_activity(orders), key == F.col("custkey"), "left").drop("custkey")
        .join(event_activity(events), key == F.col("custkey"), "left").drop("custkey")
    )
    u, p, n = F.col("n_urgent"), F.col("n_pending"), F.col("n_orders")
    tenure_days = F.datediff(F.col("last_day"), F.col("first_day"))
    idle_days = F.datediff(F.lit(AS_OF_DATE).cast("date"), F.col("last_day"))
    return joined.select(
        key.alias("CustomerID"),
        F.when(key % 30 == 4, F.lit(None))
         .otherwise(F.floor(F.col("c_acctbal") / 150)).cast("int").alias("Age"),
        F.when(F.col("c_nationkey") == 24, F.lit(None).cast("string"))
         .when(F.col("c_nationkey") % 2 == 0, F.lit("Female"))
         .otherwise(F.lit("Male")).alias("Gender"),
        F.floor(tenure_days / 90).cast("int").alias("Tenure"),
        F.col("n_usage").cast("int").alias("Usage Frequency"),
        u.cast("int").alias("Support Calls"),
        (p * 5).cast("int").alias("Payment Delay"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), F.lit("Basic"))
         .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Premium"))
         .otherwise(F.lit("Standard")).alias("Subscription Type"),
        F.when(n < 8, F.lit("Monthly")).when(n < 12, F.lit("Quarterly"))
         .otherwise(F.lit("Annual")).alias("Contract Length"),
        F.col("spend").cast("double").alias("Total Spend"),
        F.when(key % 40 == 7, F.lit(None))
         .otherwise(F.floor(idle_days / 10)).cast("int").alias("Last Interaction"),
        F.when(key % 50 == 48, F.lit(None))
         .when(key % 50 == 49, F.lit(2))
         .when(u * 7 + p * 5 + key % 40 > 45, F.lit(1))
         .otherwise(F.lit(0)).cast("int").alias("Churn"),
    )


def part_names() -> F.Column:
    """Landing files a profile row belongs to (residue 1 is in both)."""
    r = F.col("CustomerID") % 5
    return (F.when(r == 0, F.array(F.lit(C.TEST_FILE)))
            .when(r == 1, F.array(F.lit(C.TRAIN_FILE), F.lit(C.TEST_FILE)))
            .otherwise(F.array(F.lit(C.TRAIN_FILE))))


def portfolio_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both landing parts in ONE pass, already tagged with ``_source_file``.

    Same rows as ``union(tag(train), tag(test))`` over ``portfolio``, but the
    source tables are scanned, aggregated and joined once; a row of the
    overlapping residue is emitted twice by the generator instead of being
    computed in two copies of the plan."""
    rows = profiles(spark, sf_dir)
    return rows.select("*", F.explode(part_names()).alias("_source_file"))


def portfolio(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The two landing "files": training part and testing part.

    Residue 1 of ``CustomerID % 5`` is in both parts, so the union carries
    cross-file duplicates for the de-duplication to remove.
    """
    rows = profiles(spark, sf_dir)
    cid = F.col("CustomerID")
    return {
        C.TRAIN_FILE: rows.filter(cid % 5 != 0),
        C.TEST_FILE: rows.filter((cid % 5).isin(0, 1)),
    }
