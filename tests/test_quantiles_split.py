"""Exact order statistics and deterministic splits against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlens.operators import quantiles as QT
from churnlens.operators import split as SP
from churnlens.plans.medallion import gold_from


def _null_safe(columns):
    cond = None
    for c in columns:
        e = F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        cond = e if cond is None else cond & e
    return cond


def _disc(values, q):
    s = sorted(values)
    return s[max(1, math.ceil(q * len(s))) - 1]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=80),
       st.sampled_from([0.1, 0.5, 0.8, 1.0]))
def test_percentile_disc_small_ints(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = QT.percentile_disc(df, "v", q)[()]
    assert got == _disc(values, q)


def test_percentile_disc_grouped_bigint_hashes(spark):
    rng = random.Random(11)
    rows = [(g, rng.randrange(0, 1 << 60)) for g in (0, 1) for _ in range(5000)]
    rows += [(1, rows[0][1])] * 50  # a hot duplicate value
    df = spark.createDataFrame(rows, "g int, h bigint")
    got = QT.percentile_disc(df, "h", 0.8, ["g"])
    for g in (0, 1):
        assert got[(g,)] == _disc([h for gg, h in rows if gg == g], 0.8)


def test_percentile_disc_over_300_powers_of_ten(spark):
    rng = random.Random(3)
    values = [10.0 ** rng.uniform(-150, 150) * rng.choice((-1, 1)) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for q in (0.001, 0.4, 0.5, 0.999):
        assert QT.percentile_disc(df, "v", q)[()] == _disc(values, q)


def test_percentile_disc_of_close_bigints(spark):
    values = [(1 << 59) + i % 3 for i in range(12_000)] + [-(1 << 62), 1 << 62]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    for q in (0.1, 0.34, 0.5, 0.9, 1.0):
        assert QT.percentile_disc(df, "v", q)[()] == _disc(values, q)


def test_ties_at_both_pivots(spark):
    """Two heavy values with thousands of light ones between them."""
    values = [0] * 30_000 + list(range(1, 9_000)) + [9_000] * 30_000
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(4)
    for q in (0.2, 0.44, 0.5, 0.55, 0.9):
        assert QT.percentile_disc(df, "v", q)[()] == _disc(values, q)


def test_nan_and_infinity_count_as_missing(spark):
    df = spark.createDataFrame([(v,) for v in (float("nan"), 1.0, 2.0, 3.0, 4.0, float("inf"), None)], "v double")
    assert QT.percentile_cont_many(df, ["v"]) == {"v": 2.5}
    assert QT.percentile_cont_many(df.filter("isnan(v)"), ["v"]) == {"v": None}


def test_exact_split_of_rows_without_a_class(spark):
    rows = [(i, None if i % 3 == 0 else i % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "Age int, Churn int")
    got = SP.stratified_split_exact(df, key_columns=["Age"])
    n = {(r["Churn"], r["split"]): r["count"] for r in got.groupBy("Churn", "split").count().collect()}
    assert {c: n[(c, "train")] for c in (None, 0, 1)} == {None: 240, 0: 240, 1: 240}


def test_kth_values_refines_continuous_doubles(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.lognormal(3, 2, 20000), np.full(3000, 7.25)]).tolist()
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    found, counts = QT.kth_values(df, "v", lambda n: [1, n // 2, n])
    s = sorted(values)
    n = counts[()]
    assert n == len(values)
    assert found[()][1] == s[0] and found[()][n // 2] == s[n // 2 - 1] and found[()][n] == s[-1]


def test_medians_interpolate_like_numpy(spark):
    rows = [(1, 1.0, None), (3, 2.5, 4.0), (None, 10.0, 4.0), (8, -3.0, None)]
    df = spark.createDataFrame(rows, "a int, b double, c double")
    med = QT.percentile_cont_many(df, ["a", "b", "c"])
    assert med == {"a": 3.0, "b": float(np.median([1.0, 2.5, 10.0, -3.0])), "c": 4.0}


def test_hash_split_is_deterministic_and_stratified(spark):
    gold = gold_from(spark, "/root/testdata/sf0.01")
    a = SP.stratified_split(gold).groupBy("Churn", "split").count().collect()
    b = SP.stratified_split(gold.repartition(5)).groupBy("Churn", "split").count().collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    per_class = {}
    for cls, split, n in map(tuple, a):
        per_class.setdefault(cls, {})[split] = n
    for cls, parts in per_class.items():
        frac = parts["train"] / (parts["train"] + parts["test"])
        assert 0.7 < frac < 0.9, (cls, frac)
    s42 = SP.stratified_split(gold).alias("a")
    s7 = SP.stratified_split(gold, seed=7).alias("b")
    both = s42.join(s7, on=_null_safe(gold.columns), how="inner").select(
        F.col("a.split").alias("s42"), F.col("b.split").alias("s7"))
    assert both.count() == gold.count()
    assert both.filter(F.col("s42") != F.col("s7")).count() > 0


def test_exact_split_counts(spark):
    gold = gold_from(spark, "/root/testdata/sf0.01")
    out = SP.stratified_split_exact(gold)
    counts = {(r["Churn"], r["split"]): r["count"] for r in out.groupBy("Churn", "split").count().collect()}
    for cls in (0, 1):
        n = counts[(cls, "train")] + counts[(cls, "test")]
        assert counts[(cls, "train")] == math.ceil(0.8 * n)


def test_folds_and_union(spark):
    gold = gold_from(spark, "/root/testdata/sf0.001")
    folds = SP.stratified_folds(gold).select("fold").distinct().collect()
    assert {r["fold"] for r in folds} == {0, 1, 2}
    train, test = SP.split_by_class(gold)
    whole = SP.stratified_split(gold)
    assert train.count() == whole.filter(F.col("split") == "train").count()
    assert train.count() + test.count() == gold.count()
    overlap = train.alias("a").join(test.alias("b"), on=_null_safe(gold.columns), how="inner")
    assert overlap.count() == 0


def test_class_weight(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (1,)], "Churn int")
    ratio = SP.class_weight_ratio(df)
    assert ratio == 1.5
    w = {r["Churn"]: r["classWeight"] for r in SP.with_class_weight(df, ratio).distinct().collect()}
    assert w == {0: 1.0, 1: 1.5}
    import pytest

    with pytest.raises(ValueError):
        SP.class_weight_ratio(spark.createDataFrame([(0,)], "Churn int"))
