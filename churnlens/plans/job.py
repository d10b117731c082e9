"""The whole job: medallion tables, then both model runs.

Stage 1 writes bronze, silver and gold as tables.  Stage 2 reads gold back
from storage, so the model stage starts from a short lineage. Each model then
splits, searches, evaluates on the hold-out rows, scores every gold row into
its scores table, computes the retention impact from the stored scores and
appends its parameters and metrics to the run log.

The two model runs only depend on the gold table; ``concurrent=True`` submits
them from two driver threads so their Spark jobs share the cluster, as the
original job ran the two model tasks in parallel.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from churnlens import config as C
from churnlens.operators import scoring as SC
from churnlens.operators.split import stratified_folds, stratified_split
from churnlens.plans import training as TR
from churnlens.plans.medallion import run_medallion
from churnlens.sources import tables as TB


def model_stage(spark: SparkSession, gold: DataFrame, kind: str, tables: C.Tables,
                search: dict | None = None, log: bool = True) -> dict:
    """One model task: search, evaluate, scores table, impact, stored model,
    evaluation tables, run log.

    With ``log=False`` the run-log entry is returned (``_log``) instead of
    appended, so that concurrent stages log one after the other."""
    split_df = stratified_folds(stratified_split(gold)).persist(StorageLevel.MEMORY_AND_DISK)
    opts = dict(search or {})
    try:
        run = TR.run_grid(split_df, **opts) if kind == "grid" else TR.run_random(split_df, **opts)
        metrics = TR.evaluate(run, split_df)
        table = tables.scores_grid if kind == "grid" else tables.scores_random
        name = TB.write_table(TR.score_portfolio(run, gold), tables.qualified(table), tables.fmt,
                              f"Churn scores ({run.name}).")
        scores = TB.read_table(spark, name)
        impact = SC.retention_impact(scores).first().asDict()
        model_path = TR.save_run(run)
        evaluation = TR.write_evaluation(run, TR.evaluation_frames(run, split_df, scores), tables)
    finally:
        split_df.unpersist()
    extra = {"roi": impact["roi"], "high_risk": impact["high_risk"],
             "best_cv_auc": run.search.best["avg_auc"]}
    result = {"run_id": run.run_id, "model": run.name, "scores_table": name, "metrics": metrics,
              "impact": impact, "best": run.search.best, "model_path": model_path, "evaluation": evaluation}
    if log:
        TR.append_run_log(spark, run, tables, extra_metrics=extra)
    else:
        result["_log"] = (run, extra)
    return result


def run_job(spark: SparkSession, bronze_df: DataFrame, tables: C.Tables = C.Tables(),
            grid: dict | None = None, random: dict | None = None,
            concurrent: bool = False) -> dict:
    """Medallion tables, then the grid-search and random-search model runs.

    ``grid`` / ``random`` are keyword arguments of ``training.run_grid`` /
    ``training.run_random`` (e.g. a smaller grid for a quick run)."""
    layers = run_medallion(spark, bronze_df, tables)
    gold = TB.read_table(spark, layers["gold"])
    tasks = {"grid": grid, "random": random}
    if concurrent:
        with ThreadPoolExecutor(max_workers=2) as pool:
            futures = {k: pool.submit(model_stage, spark, gold, k, tables, v, False)
                       for k, v in tasks.items()}
            models = {k: f.result() for k, f in futures.items()}
        for res in models.values():   # one writer at a time on the shared log
            run, extra = res.pop("_log")
            TR.append_run_log(spark, run, tables, extra_metrics=extra)
    else:
        models = {k: model_stage(spark, gold, k, tables, v) for k, v in tasks.items()}
    return {"tables": layers, "models": models}
