"""Skew: one profile / class holding a third (or more) of all rows."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import quality as Q
from churnlens.operators.bronze import bronze
from churnlens.operators.silver import silver, silver_unfiltered
from churnlens.operators.split import stratified_split_exact
from churnlens.sources.landing import RAW_SCHEMA


def _rows(n_unique: int, n_hot: int, seed: int = 1):
    rng = random.Random(seed)
    hot = (0, 45, "Male", 12, 3, 2, 10, "Basic", "Monthly", 120.5, 9, 1)
    rows = [hot] * n_hot
    for i in range(n_unique):
        rows.append((i + 1, rng.randint(18, 70), rng.choice(["Male", "Female"]), rng.randint(0, 60),
                     rng.randint(0, 30), rng.randint(0, 10), rng.randint(0, 30),
                     rng.choice(["Basic", "Standard", "Premium"]),
                     rng.choice(["Monthly", "Quarterly", "Annual"]),
                     round(rng.uniform(100, 1000), 2), rng.randint(0, 30), rng.randint(0, 1)))
    return rows


def test_hot_duplicate_profile_collapses(spark):
    rows = _rows(2000, 1000)
    df = spark.createDataFrame(rows, RAW_SCHEMA).repartition(16)
    b = bronze({C.TRAIN_FILE: df})
    distinct = {r[1:] for r in rows}
    assert silver_unfiltered(b).count() == len(distinct)
    metrics = Q.expect_metrics(silver_unfiltered(b)).first()
    assert metrics["total"] == len(distinct)
    assert silver(b).count() == metrics["kept"]


def test_exact_split_with_a_dominant_class(spark):
    rows = _rows(6000, 0, seed=3)
    # 90 % of the rows in class 1.
    rows = [r[:-1] + ((1 if i % 10 else 0),) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, RAW_SCHEMA).withColumnsRenamed(C.RENAMES).drop("CustomerID")
    out = stratified_split_exact(df)
    counts = {(r["Churn"], r["split"]): r["n"] for r in
              out.groupBy("Churn", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    for cls in (0, 1):
        n = counts[(cls, "train")] + counts[(cls, "test")]
        assert counts[(cls, "train")] == math.ceil(0.8 * n)
