"""Model sanity: fit, evaluate, persist / reload, importances, tables."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import models as M
from churnlens.plans import training as TR
from churnlens.plans.medallion import split_from
from churnlens.sources import tables as TB

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def split_df(spark):
    return split_from(spark, SF).persist()


@pytest.fixture(scope="module")
def native_run(split_df):
    run = TR.fit_single(split_df, C.GBTParams(max_iter=10, max_depth=3))
    TR.evaluate(run, split_df)
    return run


@pytest.fixture(scope="module")
def prepared_run(split_df):
    run = TR.fit_single_prepared(split_df, C.GBTParams(max_iter=10, max_depth=3))
    TR.evaluate(run, split_df)
    return run


def test_models_learn_something(native_run, prepared_run):
    for run in (native_run, prepared_run):
        assert run.metrics["roc_auc"] > 0.7, run.metrics
        assert 0 <= run.metrics["f1_score"] <= 1
        assert math.isclose(run.metrics["weighted_recall"], run.metrics["accuracy"])


def test_exact_auc_close_to_binned_evaluator(native_run, split_df):
    pred = native_run.scorer.model.transform(split_df.filter(F.col("split") == "test"))
    binned = M.auc_evaluator().evaluate(pred)
    assert abs(binned - native_run.metrics["roc_auc"]) < 0.02


def test_importance_by_source_column(native_run, prepared_run, split_df):
    for run in (native_run, prepared_run):
        pairs = M.importance_by_source(run.scorer, split_df)
        assert {f for f, _ in pairs} == set(C.ALL_FEATURES)
        assert math.isclose(sum(v for _, v in pairs), 1.0, abs_tol=1e-9)


def test_source_column_mapping():
    assert M.source_column("support_calls_per_tenure__imp", C.ALL_FEATURES) == "support_calls_per_tenure"
    assert M.source_column("support_calls__imp", C.ALL_FEATURES) == "support_calls"
    assert M.source_column("Gender__ohe_Female", C.ALL_FEATURES) == "Gender"
    assert M.source_column("__p_contract_length_Monthly", C.ALL_FEATURES) == "contract_length"


def test_attribution_one_row_per_feature(native_run, split_df):
    test = split_df.filter(F.col("split") == "test")
    rows = M.mean_abs_attribution(native_run.scorer, test, native_run.reference_values()).collect()
    assert {r["feature"] for r in rows} == set(C.ALL_FEATURES)
    assert all(r["mean_abs_attribution"] >= 0 for r in rows)


def test_save_and_reload_give_identical_scores(spark, native_run, prepared_run, split_df, tmp_path):
    gold = split_df.drop("split", "fold")
    for run in (native_run, prepared_run):
        path = TR.save_run(run, str(tmp_path / run.name))
        assert run.params["model_path"] == f"{path}/model"
        again = TR.load_run_scorer(path)
        a = run.scorer.score(gold).select("prob_churn").collect()
        b = again.score(gold).select("prob_churn").collect()
        assert a == b


def test_scores_table_roundtrip_and_comment(spark, native_run, split_df):
    tables = C.Tables(database="churnlens_test")
    TB.ensure_database(spark, tables.database)
    name = tables.qualified(tables.scores_grid)
    scores = TR.score_portfolio(native_run, split_df.drop("split", "fold"))
    TB.write_table(scores, name, comment="scores")
    back = TB.read_table(spark, name)
    assert back.columns == [c for c in M_SCORE_COLUMNS if c in back.columns]
    assert back.count() == split_df.count()
    assert TB.table_comment(spark, name) == "scores"
    TB.write_table(scores.limit(5), name)   # overwrite
    assert TB.read_table(spark, name).count() == 5


def test_run_log_and_comparison(spark, native_run, prepared_run):
    tables = C.Tables(database="churnlens_test")
    for run in (native_run, prepared_run):
        TR.append_run_log(spark, run, tables, extra_metrics={"roi": 1.0})
    log = TB.read_table(spark, tables.qualified(tables.run_log)).filter(
        F.col("run_id").isin(native_run.run_id, prepared_run.run_id))
    cmp = TR.model_comparison(log).collect()
    assert len(cmp) == 2 and all(r["roi"] == 1.0 for r in cmp)
    n = log.count()
    for run in (native_run, prepared_run):  # a second call changes nothing
        TR.append_run_log(spark, run, tables, extra_metrics={"roi": 2.0})
    again = TB.read_table(spark, tables.qualified(tables.run_log)).filter(
        F.col("run_id").isin(native_run.run_id, prepared_run.run_id))
    assert again.count() == n and TR.model_comparison(again).collect() == cmp


def test_fit_does_not_depend_on_the_input_layout(split_df):
    params = C.GBTParams(max_iter=5, max_depth=3, subsampling_rate=0.8)
    one = TR.fit_single(split_df.repartition(1), params, partitions=4)
    many = TR.fit_single(split_df.repartition(7, "Age"), params, partitions=4)
    assert one.scorer.model.stages[-1].toDebugString == many.scorer.model.stages[-1].toDebugString.replace(
        many.scorer.model.stages[-1].uid, one.scorer.model.stages[-1].uid)


def test_trees_of_a_gamma_draw_still_split(spark):
    import random

    rng = random.Random(1)
    rows = []
    for i in range(600):
        calls = rng.randrange(10)
        rows.append((i, 20 + i % 40, 12, 5, calls, i % 30, 100.0 + i, 7, calls / 12, 8.0 + i, 1, "Male", "Basic", "Annual",
                     int(calls >= 5), "train", i % 3))
    names = ["id", "Age", "Tenure", "usage_frequency", "support_calls", "payment_delay", "total_spend",
             "last_interaction", "support_calls_per_tenure", "spend_per_tenure", "risk_score_flags", "Gender",
             "subscription_type", "contract_length", "Churn", "split", "fold"]
    df = spark.createDataFrame(rows, names).drop("id")
    space = {k: [v[-1]] for k, v in C.RANDOM_SPACE.items()} | {"gamma": [0.5], "n_estimators": [4]}
    run = TR.run_random(df, draws=1, space=space)
    trees = run.scorer.trees
    assert len(trees.feature) == 4 and (trees.feature[:, 0] >= 0).all()
    assert all(run.params[k] == v[0] for k, v in space.items()) and run.search.best["avg_auc"] > 0.95


def test_search_draws_are_seeded_and_distinct():
    a, b = M.random_draws(), M.random_draws()
    assert all(set(d) == set(C.RANDOM_SPACE) and len(d) == 9 for d in a)
    assert a == b and len(a) == C.RANDOM_SEARCH_DRAWS
    assert len({tuple(sorted(d.items())) for d in a}) == len(a)


def test_registered_random_search_has_the_whole_space(spark, monkeypatch):
    from churnlens.plans import q_models as Q
    from churnlens.plans.registry import ORACLES

    seen = {}

    class Stop(Exception):
        pass

    def searched(rows, draws=C.RANDOM_SEARCH_DRAWS, space=C.RANDOM_SPACE, growth=None, tag=""):
        seen.update(draws=draws, space=space)
        raise Stop

    monkeypatch.setattr(TR, "run_random", searched)
    for name in ("cv_random_q", "mean_abs_attribution_q"):
        monkeypatch.setattr(Q, "_RUNS", {})
        seen.clear()
        with pytest.raises(Stop):
            getattr(Q, name)(spark, "/root/testdata/sf0.001")
        assert seen == {"draws": 20, "space": C.RANDOM_SPACE}
    for draw in M.random_draws(C.RANDOM_SPACE, 20):
        assert draw["n_estimators"] >= 200 and Q._params_text(draw) in ORACLES["cv_random"]


from churnlens.operators.scoring import SCORE_COLUMNS as M_SCORE_COLUMNS  # noqa: E402


def test_medallion_tables(spark):
    from churnlens.plans.medallion import bronze_from, run_medallion

    tables = C.Tables(database="churnlens_medallion_test")
    names = run_medallion(spark, bronze_from(spark, "/root/testdata/sf0.001"), tables)
    counts = {k: TB.read_table(spark, v).count() for k, v in names.items() if k != "quality"}
    assert counts == {"bronze": 180, "silver": 130, "gold": 130, "quarantine": 20}
    qt = TB.read_table(spark, names["quality"])
    latest = qt.agg(F.max("updated_at")).first()[0]
    q = qt.filter(F.col("updated_at") == latest).collect()
    assert {(r["total"], r["kept"], r["dropped"]) for r in q} == {(150, 130, 20)} and len(q) == 8
    assert TB.read_table(spark, names["gold"]).columns == C.ALL_FEATURES + [C.TARGET]
    assert TB.table_comment(spark, names["gold"]) == "Model-ready feature table."
    again = run_medallion(spark, bronze_from(spark, "/root/testdata/sf0.001"), tables)  # overwrite
    assert TB.read_table(spark, again["silver"]).count() == 130


def test_whole_job_small_budget(spark):
    from churnlens.plans.job import run_job
    from churnlens.plans.medallion import bronze_from

    tables = C.Tables(database="churnlens_job_test")
    out = run_job(spark, bronze_from(spark, "/root/testdata/sf0.001"), tables,
                  grid={"max_depth": [2], "max_iter": [3]},
                  random={"draws": 2, "space": {**C.RANDOM_SPACE, "n_estimators": [2, 4]}}, concurrent=True)
    assert set(out["models"]) == {"grid", "random"}
    for res in out["models"].values():
        assert TB.read_table(spark, res["scores_table"]).count() == 130
        assert res["impact"]["total_customers"] == 130
        assert res["metrics"]["roc_auc"] is not None
    log = TB.read_table(spark, tables.qualified(tables.run_log))
    ids = [r["run_id"] for r in out["models"].values()]
    gold = TB.read_table(spark, out["tables"]["gold"])
    for res in out["models"].values():
        logged = log.filter((F.col("run_id") == res["run_id"]) & (F.col("name") == "model_path")).first()["value"]
        again = TR.load_run_scorer(logged.rsplit("/", 1)[0]).score(gold).select(*C.ALL_FEATURES, "prob_churn")
        stored = TB.read_table(spark, res["scores_table"]).select(*C.ALL_FEATURES, "prob_churn")
        assert again.exceptAll(stored).isEmpty() and stored.exceptAll(again).isEmpty()
        own = {k: TB.read_table(spark, t).filter(F.col("run_id") == res["run_id"]) for k, t in res["evaluation"].items()}
        assert own["bands"].agg(F.sum("n")).first()[0] == 130
        assert own["importance"].count() == own["attribution"].count() == len(C.ALL_FEATURES)
        assert own["confusion"].agg(F.sum("n")).first()[0] == own["roc"].count() or own["roc"].count() > 1
        assert own["search"].count() == len({r["params"] for r in own["search"].collect()})
    assert log.filter(F.col("run_id").isin(*ids)).select("run_id").distinct().count() == 2


def test_youden_cut_off_as_decision_threshold(native_run, split_df):
    from churnlens.operators import evaluate as EV

    test = split_df.filter(F.col("split") == "test").select(*C.ALL_FEATURES, C.TARGET)
    scored = native_run.scorer.score(test)
    pts = EV.roc_points(scored.select(F.col(C.TARGET).alias("label"), F.col("prob_churn").alias("score")))
    cut = EV.youden_threshold(pts).first()["threshold"]
    at_cut = native_run.scorer.score(test, threshold=cut)
    assert at_cut.filter((F.col("prob_churn") >= cut) != (F.col("prediction") == 1)).count() == 0
    default = scored.filter((F.col("prob_churn") > 0.5) & (F.col("prediction") == 0)).count()
    assert default == 0


def test_table_names_of_one_two_and_three_parts(spark):
    df = spark.range(3)
    TB.ensure_database(spark, "spark_catalog.churnlens_names")
    for name in ("churnlens_names.t2", "spark_catalog.churnlens_names.t3"):
        TB.write_table(df, name, comment="it's here")
        assert TB.read_table(spark, name).count() == 3 and TB.table_comment(spark, name) == "it's here"
    TB.write_table(df, "churnlens_one_part_name")
    assert TB.read_table(spark, "churnlens_one_part_name").count() == 3
    assert C.Tables(catalog="spark_catalog", database="d").qualified("t") == "spark_catalog.d.t"


def test_folds_are_fitted_at_the_same_time(spark, split_df):
    """The fits of a search run ``parallelism`` at a time across folds, not fold after fold."""
    import threading

    together, begun = threading.Barrier(3), []

    class Waiting(GBTClassifier):
        def _fit(self, rows):
            begun.append(1)
            if len(begun) <= 3:
                together.wait(120)
            return super()._fit(rows)

    train, *_ = TR.training_frame(split_df)
    est = Waiting(labelCol=C.TARGET, featuresCol="features", weightCol="classWeight", maxIter=1, maxDepth=1)
    found = M.cross_validate(M.native_stages, est, [{est.maxDepth: 1}], train, [{"maxDepth": 1}], parallelism=3,
                             partitions=1)
    assert len(begun) == 4 and 0 <= found.best["avg_auc"] <= 1


def test_one_task_fits_of_all_rows_run_beside_the_folds(spark, split_df):
    """Where a fit is one task, no parameter set waits for the folds to be fitted on all rows."""
    import threading

    together = threading.Barrier(8)

    class Waiting(GBTClassifier):
        def _fit(self, rows):
            together.wait(120)
            return super()._fit(rows)

    train, _, n, _ = TR.training_frame(split_df)
    est = Waiting(labelCol=C.TARGET, featuresCol="features", weightCol="classWeight", maxIter=1)
    maps = [{est.maxDepth: 1}, {est.maxDepth: 2}]
    labels = [{"maxDepth": 1}, {"maxDepth": 2}]
    found = M.cross_validate(M.native_stages, est, maps, train, labels, parallelism=8, partitions=1)
    assert found.model.stages[-1].getOrDefault("maxDepth") == found.best["maxDepth"]
    assert found.model.transform(train).count() == n


def test_compared_models_are_fitted_at_the_same_time(spark, monkeypatch):
    import threading

    from churnlens.plans import q_models as Q

    together, made = threading.Barrier(2), []

    class Stop(Exception):
        pass

    def logged(*_):
        raise Stop

    def fit(rows, **_):
        together.wait(120)
        assert rows.count() == 130   # both read the same written rows
        made.append(1)
        return TR.ModelRun("tag", str(len(made)), None, None, 1.0, None)

    monkeypatch.setattr(Q, "_RUNS", {})
    monkeypatch.setattr(TR, "run_grid", fit)
    monkeypatch.setattr(TR, "run_random", fit)
    monkeypatch.setattr(TR, "evaluate", lambda run, rows: None)
    monkeypatch.setattr(Q, "_logged", logged)
    with pytest.raises(Stop):
        Q.model_comparison_q(spark, "/root/testdata/sf0.001")
    assert len(made) == 2 and len(Q._RUNS) == 2
    assert Q._runs(spark, "/root/testdata/sf0.001", "random", "grid") == list(Q._RUNS.values())[::-1] and len(made) == 2


def test_compared_models_score_the_same_written_rows(spark, monkeypatch):
    """The plan behind the scored rows runs once, not once a model, and the folder goes with the query."""
    from churnlens.plans import q_models as Q

    seen, want = [], Q._gold(spark, "/root/testdata/sf0.001")

    class Stop(Exception):
        pass

    def logged(spark, sf_dir, kind, gold):
        plan = gold._jdf.queryExecution().toString()
        assert "FileScan" in plan and "Exchange" not in plan
        assert gold.exceptAll(want).isEmpty() and gold.count() == want.count()
        seen.append((kind, gold))
        if len(seen) > 1:
            raise Stop
        return TR.ModelRun("tag", "run", None, None, 1.0, None), None

    monkeypatch.setattr(Q, "_runs", lambda *_: [])
    monkeypatch.setattr(Q, "_logged", logged)
    with pytest.raises(Stop):
        Q.model_comparison_q(spark, "/root/testdata/sf0.001")
    assert [kind for kind, _ in seen] == ["grid", "random"] and seen[0][1] is seen[1][1]
    place = spark._jvm.org.apache.hadoop.fs.Path(seen[0][1].inputFiles()[0])
    assert not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def test_fold_fits_have_their_share_of_tasks(spark, split_df, monkeypatch):
    """A fit without a fold has about two thirds of the rows, and so of the tasks, of one on all rows."""
    seen, features = [], M._features_of
    monkeypatch.setattr(M, "_features_of", lambda prep, rows, keep, n: seen.append((rows.count(), n)) or features(prep, rows, keep, n))
    train, _, rows, _ = TR.training_frame(split_df)
    est = M.gbt(C.GBTParams(max_iter=1, max_depth=1))
    M.cross_validate(M.native_stages, est, [{est.maxDepth: 1}], train, [{"maxDepth": 1}], partitions=6)
    assert sorted(n for _, n in seen)[-1] == 6 and all(n <= 5 for own, n in seen if own < rows) and len(seen) == 4
    assert all(own / n <= rows / 6 for own, n in seen)
    assert M._share(1, {0: 5, 1: 5, 2: 5}, 0) == M._share(3, {0: 9}, 0) == M._share(3, {}, 0) == 1
    assert M._share(73, {0: 10, 1: 10, 2: 9, None: 1}, 2) == 49


def test_tasks_carry_few_trees():
    assert M.gbt().getCheckpointInterval() <= 3


def test_no_task_of_a_fit_takes_most_rows():
    """A fit's rows are dealt to tasks of at most 50,000, whatever their number."""
    for rows in (1, 12_000, 759_060, 4_554_360):
        assert rows / TR._partitions(rows, None) <= 50_000
    assert TR._partitions(12_000, None) == 1 and TR._partitions(12_000, 4) == 4


def test_fits_read_written_rows(spark, split_df):
    """The jobs of a fit neither repeat nor carry the plan of the rows, and the folder goes with the fit."""
    from pyspark.ml import Pipeline

    train, _, n, folder = TR.training_frame(split_df)
    plan = train._jdf.queryExecution().toString()
    assert "FileScan" in plan and "InMemoryTableScan" not in plan and "Exchange" not in plan
    rows = M._features_of(Pipeline(stages=M.native_stages()).fit(train), train, [C.TARGET, "classWeight"], 2)
    plan = rows._jdf.queryExecution().toString()
    assert rows.count() == n and rows.rdd.getNumPartitions() == 2
    assert "FileScan" not in plan and "Exchange" not in plan
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def test_scored_stream_files_follow_the_rows():
    from churnlens.plans.q_streaming import stream_files

    assert stream_files(0) == stream_files(12_000) == 4
    assert 4_554_360 / stream_files(4_554_360) <= 50_000
