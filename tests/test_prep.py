"""Feature preparation against numpy / hand computation."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from churnlens.operators import prep as PR


def _frame(spark):
    rows = [(1, 10.0, "b", 0), (3, None, "a", 1), (None, 30.0, "b", 0), (8, 40.0, None, 1),
            (5, 50.0, "a", 0), (5, 60.0, "c", 1)]
    return spark.createDataFrame(rows, "x int, y double, cat string, Churn int")


def test_fit_prep_statistics(spark):
    df = _frame(spark)
    stats = PR.fit_prep(df, ["x", "y"], ["cat"])
    assert stats.medians == {"x": float(np.median([1, 3, 8, 5, 5])),
                             "y": float(np.median([10, 30, 40, 50, 60]))}
    assert stats.modes == {"cat": "a"}  # a and b tie at 2: smallest wins
    x_imp = [1, 3, stats.medians["x"], 8, 5, 5]
    assert math.isclose(stats.means["x"], float(np.mean(x_imp)))
    assert math.isclose(stats.stds["x"], float(np.std(x_imp)))  # population
    assert stats.categories == {"cat": ["a", "b", "c"]}
    assert stats.dummy_columns() == ["cat_b", "cat_c"]


def test_apply_prep_and_unknown_category(spark):
    df = _frame(spark)
    stats = PR.fit_prep(df, ["x", "y"], ["cat"])
    new = spark.createDataFrame([(None, None, "zzz", 0), (3, 10.0, None, 1)],
                                "x int, y double, cat string, Churn int")
    out = PR.apply_prep(new, stats, keep=("Churn",)).orderBy("Churn").collect()
    unknown, null_cat = out
    assert (unknown["cat_b"], unknown["cat_c"]) == (0, 0)
    assert (null_cat["cat_b"], null_cat["cat_c"]) == (0, 0)  # NULL -> mode 'a' -> reference level
    assert math.isclose(unknown["x"], (stats.medians["x"] - stats.means["x"]) / stats.stds["x"])


def test_zero_std_divides_by_one(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    stats = PR.PrepStats({"x": 2.0}, {}, {"x": 2.0}, {"x": 0.0}, {})
    assert PR.standardize(df, stats).agg(F.max("x")).first()[0] == 0.0


def test_with_prepared_matches_apply_prep(spark):
    df = _frame(spark)
    stats = PR.fit_prep(df, ["x", "y"], ["cat"])
    a = PR.apply_prep(df, stats, keep=("Churn",)).collect()
    b = PR.with_prepared(df, stats).select(
        *[F.col(c).alias(c[len(PR.PREPARED_PREFIX):]) for c in PR.prepared_columns(stats)],
        "Churn").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_json_roundtrip():
    stats = PR.PrepStats({"x": 1.5}, {"c": "a"}, {"x": 2.0}, {"x": 3.0}, {"c": ["a", "b"]})
    assert PR.PrepStats.from_json(stats.to_json()) == stats


def test_mode_of_a_column_with_very_many_values(spark):
    df = spark.range(30_000).select(F.concat(F.lit("v"), (F.col("id") % 29_999).cast("string")).alias("c"))
    assert PR.category_modes(df, ["c"]) == {"c": "v0"}


def test_nan_and_infinity_are_imputed(spark):
    df = spark.createDataFrame([(v, "x") for v in (1.0, 2.0, float("nan"), 4.0, None, float("inf"))], "n double, c string")
    stats = PR.fit_prep(df, ["n"], ["c"])
    assert stats.medians == {"n": 2.0} and abs(stats.means["n"] - 13 / 6) < 1e-12
    got = PR.apply_prep(df, stats).collect()
    assert all(r["n"] == r["n"] and abs(r["n"]) < 5 for r in got)


def test_median_fill_stage_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (float("nan"),)], "n double")
    model = PR.MedianFill(numCols=["n"], suffix="_f").fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PR.MedianFillModel.load(str(tmp_path / "m"))
    assert [r["n_f"] for r in again.transform(df).collect()] == [1.0, 2.5, 4.0, 2.5]
