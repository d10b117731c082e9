"""Incremental silver, metrics, repairs and scores against the batch layers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators.quality import expect_metrics, expect_violations
from churnlens.operators.silver import silver, silver_unfiltered
from churnlens.plans.oracle import SILVER_COLS
from churnlens.streaming.scoring import check_input, read_scores, run_scoring_stream, scored, write_batch
from churnlens.streaming.silver import PROFILE, SilverStore, merge_batch, repair, run_silver_stream
from tests.test_fixture_rows import HEADER, TEST_ROWS, TRAIN_ROWS

BRONZE = PROFILE.replace(" int", " string").replace(" double", " string")
#: Nulls, an unparsable number, an unknown label, -0.0, repeats, one hot profile.
ROWS = [("30", "Male", "5", "3", "1", "2", "Basic", "Monthly", "10.5", "4", "0"),
        ("30", "Male", "5", "3", "1", "2", "Basic", "Monthly", "10.50", "4", "0"),
        (None, "Male", "5", "3", "1", "2", "Basic", "Monthly", "10.5", "4", "1"),
        ("x", "Male", "5", "3", "1", "2", "Basic", "Monthly", "10.5", "4", "1"),
        ("41", None, "0", None, "7", "20", None, None, "-0.0", None, "1"),
        ("41", None, "0", None, "7", "20", None, None, "0.0", None, "1"),
        ("50", "F", "12", "3", "4", "15", "Premium", "Annual", "99", "21", "2"),
        *[("60", "F", "7", "1", "0", "0", "Basic", "Annual", "5", "1", "0")] * 40]


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def matches(store, spark, batch_bronze):
    unfiltered = silver_unfiltered(batch_bronze)
    assert rows_of(store.silver(spark).select(*SILVER_COLS)) == rows_of(silver(batch_bronze).select(*SILVER_COLS))
    assert rows_of(store.metrics(spark)) == rows_of(expect_metrics(unfiltered))
    assert rows_of(store.quarantine(spark).select(*SILVER_COLS, "violations")) == rows_of(
        expect_violations(unfiltered).select(*SILVER_COLS, "violations"))
    target = silver(batch_bronze).groupBy(C.TARGET).agg(F.count("*").alias("n"))
    assert rows_of(store.target_distribution(spark)) == rows_of(target)


def test_batches_and_replays_equal_the_batch_layer(spark, tmp_path):
    store = SilverStore(str(tmp_path))
    parts = [ROWS[:4], ROWS[3:], [], ROWS]
    for i, part in enumerate(parts):
        merge_batch(store, bronze(spark, part), i)
        matches(store, spark, bronze(spark, [r for p in parts[:i + 1] for r in p]))
        merge_batch(store, bronze(spark, part), i)  # replayed after its commit
        matches(store, spark, bronze(spark, [r for p in parts[:i + 1] for r in p]))


def test_a_batch_without_commit_is_not_read(spark, tmp_path, monkeypatch):
    from churnlens.streaming import silver as layer

    store = SilverStore(str(tmp_path))
    merge_batch(store, bronze(spark, ROWS[:4]), 0)
    write = layer._write

    def failing(df, place, table, batch):
        if table == "commits":
            raise RuntimeError("lost")
        write(df, place, table, batch)

    monkeypatch.setattr(layer, "_write", failing)
    with pytest.raises(RuntimeError):
        merge_batch(store, bronze(spark, ROWS[4:]), 1)
    monkeypatch.undo()
    matches(store, spark, bronze(spark, ROWS[:4]))
    merge_batch(store, bronze(spark, ROWS[4:]), 1)
    matches(store, spark, bronze(spark, ROWS))


def test_repairs_equal_the_repaired_input(spark, tmp_path):
    store = SilverStore(str(tmp_path))
    merge_batch(store, bronze(spark, ROWS), 0)
    changes = store.quarantine(spark).withColumns({
        "Age": F.coalesce("Age", F.lit(30)), "Churn": F.when(F.col("Churn") == 2, F.lit(None)).otherwise(F.col("Churn"))})
    fixed = [tuple(("30" if i == 0 and v in (None, "x") else None if i == 10 and v == "2" else v) for i, v in enumerate(r))
             for r in ROWS]
    repair(spark, store, changes, 7)
    matches(store, spark, bronze(spark, fixed))
    repair(spark, store, changes, 7)
    matches(store, spark, bronze(spark, fixed))
    merge_batch(store, bronze(spark, ROWS), 1)  # the broken rows again: known
    matches(store, spark, bronze(spark, fixed))
    # Unchanged rows, an unknown key and a second change set.
    again = store.quarantine(spark).withColumn("Churn", F.lit(1))
    unknown = again.withColumn("_key", F.unhex(F.lit("00")))
    repair(spark, store, again.unionByName(unknown).unionByName(again), 8)
    final = [tuple("1" if i == 10 and v is None else v for i, v in enumerate(r)) for r in fixed]
    matches(store, spark, bronze(spark, final))


def test_stream_over_three_increments_with_restarts(spark, tmp_path):
    landing, store = tmp_path / "landing", SilverStore(str(tmp_path / "store"))
    landing.mkdir()
    for name, lines in ((C.TRAIN_FILE, TRAIN_ROWS), (C.TEST_FILE, TEST_ROWS), ("again.csv", TRAIN_ROWS)):
        (landing / name).write_text("\n".join([HEADER, *lines]) + "\n")
        run_silver_stream(spark, str(landing), store, str(tmp_path / "checkpoint"))
    run_silver_stream(spark, str(landing), store, str(tmp_path / "checkpoint"))  # nothing new
    from churnlens.operators.bronze import rename_headers
    from churnlens.sources.landing import read_csv

    matches(store, spark, rename_headers(read_csv(spark, str(landing))))


class Half:
    """A stand-in model: the probability is a column's share."""

    def score(self, df):
        return df.withColumns({"prediction": F.lit(0), "prob_churn": F.col("Age") / 100.0})


def test_streamed_scores_equal_batch_scores(spark, tmp_path):
    rows = spark.range(200).select(
        *[(F.col("id") % 90).cast("double").alias(c) for c in C.NUM_FEATURES],
        *[F.when(F.col("id") % 7 > 0, F.lit("a")).alias(c) for c in C.CAT_FEATURES], (F.col("id") % 2).cast("int").alias(C.TARGET))
    rows.repartition(6).write.parquet(str(tmp_path / "in"))
    stored = spark.read.parquet(str(tmp_path / "in"))
    for _ in range(2):  # a second start has nothing to do
        run_scoring_stream(spark, str(tmp_path / "in"), stored.schema, Half(), "m", str(tmp_path / "out"),
                           str(tmp_path / "checkpoint"), max_files_per_trigger=2)
    want = rows_of(scored(stored, Half(), "m"))
    assert rows_of(read_scores(spark, str(tmp_path / "out"))) == want
    first = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / "batch=1")).collect()]
    write_batch(spark.createDataFrame(first, scored(stored, Half(), "m").schema), str(tmp_path / "out"), 1)  # a replay
    assert rows_of(read_scores(spark, str(tmp_path / "out"))) == want


def test_input_is_checked(spark):
    good = spark.createDataFrame([], ", ".join([f"{c} double" for c in C.NUM_FEATURES] + [f"{c} string" for c in C.CAT_FEATURES]))
    check_input(good)
    with pytest.raises(ValueError, match="Age is missing"):
        check_input(good.drop("Age"))
    with pytest.raises(ValueError, match="Gender is int, not text"):
        check_input(good.withColumn("Gender", F.lit(1)))
