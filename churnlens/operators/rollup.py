"""Cubes with distinct counts: exact, and by mergeable sketches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's buckets; its relative standard error is about 0.8 / sqrt(2^LG_K).
LG_K = 12


def sketched_groups(df: DataFrame, dimensions: list[str], distinct: str, lg_k: int = LG_K) -> DataFrame:
    """(dimensions, n, sketch): rows and a distinct sketch of every finest group.  One
    pass over the rows; what follows reads only these groups, and the groups of
    new rows can be appended."""
    return df.groupBy(*dimensions).agg(F.count(F.lit(1)).alias("n"),
                                       F.hll_sketch_agg(F.col(distinct), F.lit(lg_k)).alias("sketch"))


def cube_estimates(groups: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimensions, level, n, estimate) of every combination of dimensions, by merging the
    sketches of ``sketched_groups``.  `level` tells totals from null values: bit i (from the
    right) is set where the last dimension but i is summed over."""
    return groups.cube(*dimensions).agg(
        F.grouping_id(*dimensions).alias("level"), F.sum("n").alias("n"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def cube_counts(df: DataFrame, dimensions: list[str], distinct: str, amount: str, lg_k: int = LG_K) -> DataFrame:
    """(dimensions, level, n, n_distinct, total, estimate_within) of every combination: rows,
    exact distinct values (null is none), the sum of ``amount`` and whether the merged
    sketch is within three standard errors (at least one) of the exact count.  Nulls in a
    dimension are a value; an empty table gives no rows."""
    exact = df.cube(*dimensions).agg(
        F.grouping_id(*dimensions).alias("level"), F.count(F.lit(1)).alias("n"), F.count_distinct(distinct).alias("n_distinct"),
        F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("total"))
    names = [f"_{i}" for i in range(len(dimensions))]
    estimates = cube_estimates(sketched_groups(df, dimensions, distinct, lg_k), dimensions).select(
        *[F.col(c).alias(n) for c, n in zip(dimensions, names)], F.col("level").alias("_level"), "estimate")
    on = reduce(lambda a, b: a & b, [F.col("level") == F.col("_level"),
                                     *[F.col(c).eqNullSafe(F.col(n)) for c, n in zip(dimensions, names)]])
    error = F.greatest(F.lit(1.0), 3 * 0.8 / 2 ** (lg_k / 2) * F.col("n_distinct"))
    return exact.join(estimates, on, "left").select(
        *dimensions, F.col("level").cast("long").alias("level"), "n", "n_distinct", "total",
        (F.abs(F.coalesce("estimate", F.lit(0)) - F.col("n_distinct")) <= error).alias("estimate_within"))
