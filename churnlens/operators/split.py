"""Deterministic splits: hash split, exact per-class split, CV folds, class weights.

A row's split comes from ``md5`` of its own values (plus the seed), so it does
not depend on partition layout, file order or task retries -- a lost executor
recomputes exactly the same rows -- and it needs no shuffle: every class is
split independently by the same uniform hash, which makes the split
stratified in expectation.  ``stratified_split_exact`` additionally makes the
per-class proportions exact with per-class cut-offs found by
``quantiles.percentile_disc`` (bounded memory per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.functions.expressions import fraction_cut, hash60, row_key
from churnlens.operators.quantiles import percentile_disc

#: Input columns of a gold row (the derived ones are functions of these).
KEY_COLUMNS = ["Age", "Tenure", "usage_frequency", "support_calls", "payment_delay",
               "total_spend", "last_interaction", "Gender", "subscription_type",
               "contract_length", "Churn"]


def with_hash(df: DataFrame, seed: int = C.RANDOM_STATE, part: int = 0,
              name: str = "_h", key_columns: list[str] = KEY_COLUMNS) -> DataFrame:
    return df.withColumn(name, hash60(row_key(df, key_columns, seed), part))


def stratified_split(df: DataFrame, test_fraction: float = C.TEST_FRACTION,
                     seed: int = C.RANDOM_STATE, key_columns: list[str] = KEY_COLUMNS) -> DataFrame:
    """Adds ``split`` = 'train' / 'test' (about 80/20 inside every class)."""
    cut = fraction_cut(1 - test_fraction)
    h = hash60(row_key(df, key_columns, seed))
    return df.withColumn("split", F.when(h < F.lit(cut), F.lit("train")).otherwise(F.lit("test")))


def stratified_folds(df: DataFrame, k: int = C.CV_FOLDS, seed: int = C.RANDOM_STATE,
                     key_columns: list[str] = KEY_COLUMNS) -> DataFrame:
    """Adds ``fold`` in [0, k) from hash bits independent of the split bits."""
    h2 = hash60(row_key(df, key_columns, seed), part=1)
    return df.withColumn("fold", F.pmod(h2, F.lit(k)).cast("int"))


def split_by_class(df: DataFrame, label: str = C.TARGET, classes: tuple = (1, 0),
                   test_fraction: float = C.TEST_FRACTION, seed: int = C.RANDOM_STATE
                   ) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the rows of ``classes``.  The hash splits every class
    alike, so the union of the per-class splits is one split of their rows:
    one pass, where a filter and a union per class would each read the input."""
    rows = stratified_split(df.filter(F.col(label).isin(*classes)), test_fraction, seed)
    return rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "test")


def class_filter(df: DataFrame, value, label: str = C.TARGET) -> DataFrame:
    return df.filter(F.col(label) == F.lit(value))


def stratified_split_exact(df: DataFrame, test_fraction: float = C.TEST_FRACTION,
                           seed: int = C.RANDOM_STATE, label: str = C.TARGET,
                           key_columns: list[str] = KEY_COLUMNS) -> DataFrame:
    """Exact per-class proportions: inside each class, the rows whose hash is
    at most the class's PERCENTILE_DISC(1 - test_fraction) go to train.

    The cut-offs (one per class) become literals of a CASE expression, so the
    final pass is a plain projection: no join and no shuffle.  Rows without a
    class are a class of their own and are split alike.
    """
    hashed = with_hash(df, seed, key_columns=key_columns)
    cuts = percentile_disc(hashed, "_h", 1 - test_fraction, [label])
    lab = F.col(label)
    cut_col = F.lit(None).cast("bigint")
    for (cls,), cut in cuts.items():
        cut_col = F.when(lab.eqNullSafe(F.lit(cls)), F.lit(cut)).otherwise(cut_col)
    return (hashed.withColumn("split", F.when(F.col("_h") <= cut_col, F.lit("train"))
                              .otherwise(F.lit("test")))
            .drop("_h"))


def class_counts(df: DataFrame, label: str = C.TARGET) -> dict:
    """Rows per class: one grouped aggregate, at most one row per class."""
    return {r[label]: r["n"] for r in
            df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def class_weight_ratio(df: DataFrame, label: str = C.TARGET) -> float:
    """n_negative / n_positive on the given rows; a clear error without positives."""
    counts = class_counts(df, label)
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    if n_pos == 0:
        raise ValueError("no positive rows: the class-weight ratio is undefined")
    return n_neg / n_pos


def with_class_weight(df: DataFrame, ratio: float, label: str = C.TARGET,
                      name: str = "classWeight") -> DataFrame:
    """Weight ``ratio`` for class 1 rows, 1.0 for the rest."""
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


def with_own_class_weight(df: DataFrame, label: str = C.TARGET, name: str = "classWeight") -> DataFrame:
    """``with_class_weight`` with the ratio of these very rows, in one plan: the
    counts are a scalar subquery, nothing is computed ahead on the driver.
    Without positive rows no row needs the ratio."""
    y = F.col(label)
    ratio = df.agg((F.count_if(y == 0) / F.nullif(F.count_if(y == 1), F.lit(0))).alias("r")).scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))
