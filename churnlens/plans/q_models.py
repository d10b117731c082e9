"""Model-backed queries.

Fitted trees are no SQL matter, but what must hold of their results is: the
rows and columns that pass through, the enumerated parameter sets, ranges,
sums and orders.  Each query returns those, computed by Spark over all rows of
the real result.  Both searches run in full, the random one with all its draws
of the application's space over all folds, all models grown together.

Fitted runs are kept per (Spark application, data folder and its files, kind): the
keys that only need the winner of a search share it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.functions.expressions import risk_band
from churnlens.operators import attribution as AT
from churnlens.operators import boosting as BT
from churnlens.operators import models as M
from churnlens.operators import scoring as SC
from churnlens.operators.split import with_hash
from churnlens.plans import training as TR
from churnlens.plans.medallion import split_from
from churnlens.plans.oracle import cols, q, with_base
from churnlens.plans.registry import register
from churnlens.session import checkpoint_root, drop_folder, stored
from churnlens.sources import tables as TB

#: The checks write to a database of their own.
CHECK_TABLES = C.Tables(database="churnlens_check")
_RUNS: dict = {}


def _stamp(spark, sf_dir: str) -> tuple:
    """Sizes and times of the files a run reads: rewritten tables are fitted anew."""
    found = []
    for table in ("customer", "orders", "events"):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{table}.parquet")
        files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
        found.append(tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)))
    return tuple(found)


def _check_database(spark) -> None:
    """The database of the checks, in the shared folder."""
    TB.ensure_database(spark, CHECK_TABLES.qualified_database, f"{checkpoint_root(spark)}/{CHECK_TABLES.database}")


def _run(spark, sf_dir, kind: str) -> TR.ModelRun:
    return _runs(spark, sf_dir, kind)[0]


def _runs(spark, sf_dir, *kinds: str) -> list[TR.ModelRun]:
    """The runs of ``kinds``; those not fitted yet are fitted at the same time."""
    stamp = _stamp(spark, sf_dir)
    keys = {kind: (spark.sparkContext.applicationId, sf_dir, kind, stamp) for kind in kinds}
    fits = {"single": TR.fit_single, "grid": lambda d: TR.run_grid(d, parallelism=8), "random": TR.run_random}
    new = [kind for kind in kinds if keys[kind] not in _RUNS]
    if new:
        # Training and hold-out evaluation share the split frame: written
        # for the runs, deleted after them.
        split = split_from(spark, sf_dir)
        df, folder = stored(split, "split")

        @inheritable_thread_target(spark)
        def fitted(kind: str) -> TR.ModelRun:
            run = fits[kind](df)
            TR.evaluate(run, df)
            run.train_rows = split.filter(F.col("split") == "train")
            return run

        try:
            with ThreadPoolExecutor(max_workers=len(new)) as pool:
                _RUNS.update(zip([keys[kind] for kind in new], pool.map(fitted, new)))
        finally:
            drop_folder(spark, folder)
    return [_RUNS[keys[kind]] for kind in kinds]


def _gold(spark, sf_dir):
    return split_from(spark, sf_dir).drop("split", "fold")


def _sets_sql(labels: list[dict]) -> str:
    rows = ", ".join(f"({i}, '{_params_text(r)}')" for i, r in enumerate(labels))
    return ("SELECT CAST(i AS INTEGER) AS param_set, p AS params, true AS auc_valid, true AS best_above_half "
            f"FROM (VALUES {rows}) t(i, p)")


def _params_text(r: dict) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(r.items()) if k != "avg_auc")


def _search_table(spark, run: TR.ModelRun):
    """One row per evaluated parameter set with its mean cross-validated AUC
    (model-sized: the search ran as Spark jobs over the training rows)."""
    rows = [(i, _params_text(r), r["avg_auc"]) for i, r in enumerate(run.search.results)]
    return spark.createDataFrame(rows, "param_set int, params string, avg_auc double")


def _checked_search(spark, run):
    best = _search_table(spark, run).agg((F.max("avg_auc") > 0.5).alias("best_above_half"))
    return _search_table(spark, run).join(F.broadcast(best)).select(
        "param_set", "params", F.col("avg_auc").between(0, 1).alias("auc_valid"), "best_above_half")


_SLOTS = " + ".join(f'(SELECT count(DISTINCT {q(c)}) FROM train)' for c in C.CAT_FEATURES)


@register("train_gbt", with_base(f"""
SELECT CAST({C.GBTParams().max_iter} AS INTEGER) AS num_trees, CAST({C.GBTParams().max_depth} AS INTEGER) AS max_depth,
  CAST({C.GBTParams().step_size} AS DOUBLE) AS step_size,
  CAST({len(C.NUM_FEATURES)} + {_SLOTS} AS INTEGER) AS num_features,
  count(*) FILTER (WHERE "Churn" = 0) / count(*) FILTER (WHERE "Churn" = 1) AS class_weight_ratio,
  count(*) AS train_rows FROM train"""))
def train_gbt_q(spark, sf_dir):
    run = _run(spark, sf_dir, "single")
    gbt = run.scorer.model.stages[-1]
    split = split_from(spark, sf_dir)
    return split.filter(F.col("split") == "train").agg(F.count(F.lit(1)).alias("train_rows")).select(
        F.lit(gbt.getNumTrees).alias("num_trees"), F.lit(gbt.getOrDefault("maxDepth")).alias("max_depth"),
        F.lit(gbt.getOrDefault("stepSize")).alias("step_size"), F.lit(gbt.numFeatures).alias("num_features"),
        F.lit(run.class_weight).alias("class_weight_ratio"), "train_rows")


_GRID_LABELS = [{"maxDepth": d, "maxIter": i, "stepSize": s}
                for d in C.GRID_MAX_DEPTH for i in C.GRID_MAX_ITER for s in C.GRID_STEP_SIZE]


@register("cv_grid", _sets_sql(_GRID_LABELS))
def cv_grid_q(spark, sf_dir):
    return _checked_search(spark, _run(spark, sf_dir, "grid"))


@register("cv_random", _sets_sql(M.random_draws()))
def cv_random_q(spark, sf_dir):
    return _checked_search(spark, _run(spark, sf_dir, "random"))


#: Columns and bin edges of the single split that SQL finds too.
STUMP = {"support_calls": list(range(11)), "payment_delay": list(range(0, 45, 5)), "risk_score_flags": list(range(4))}
_STUMP_EDGES = ", ".join(f"({i}, '{c}', {e})" for i, (c, edges) in enumerate(STUMP.items()) for e in edges)
_STUMP_VALUES = " UNION ALL ".join(
    f"SELECT {i} AS i, coalesce({c}, 0) AS v, 0.5 - \"Churn\" AS g FROM train" for i, c in enumerate(STUMP))


@register("boosted_stump", with_base("""
SELECT feature, edge, round(gain, 6) AS gain, round(-0.1 * tl / (hl + 2), 5) AS left_value,
  round(-0.1 * tr / (hr + 2), 5) AS right_value
FROM (
  SELECT *, tl * tl / (hl + 2) + tr * tr / (hr + 2) - t * t / (hl + hr + 2) AS gain,
    row_number() OVER (ORDER BY tl * tl / (hl + 2) + tr * tr / (hr + 2) - t * t / (hl + hr + 2) DESC, i, edge) AS place
  FROM (
    SELECT *, sign(gl) * greatest(abs(gl) - 0.5, 0) AS tl, sign(gr) * greatest(abs(gr) - 0.5, 0) AS tr,
      sign(gl + gr) * greatest(abs(gl + gr) - 0.5, 0) AS t
    FROM sums WHERE hl >= 3 AND hr >= 3))
WHERE place = 1""", f"""
edges AS (SELECT * FROM (VALUES {_STUMP_EDGES}) e(i, feature, edge)),
rows_of AS ({_STUMP_VALUES}),
sums AS (
  SELECT i, feature, edge, coalesce(sum(g) FILTER (WHERE v <= edge), 0)::DOUBLE AS gl,
    coalesce(sum(g) FILTER (WHERE v > edge), 0)::DOUBLE AS gr,
    0.25::DOUBLE * count(*) FILTER (WHERE v <= edge) AS hl, 0.25::DOUBLE * count(*) FILTER (WHERE v > edge) AS hr
  FROM edges JOIN rows_of USING (i) GROUP BY ALL)"""))
def boosted_stump_q(spark, sf_dir):
    """The first split of a boosted model on given bins: column, edge, loss reduction and leaf
    values, with L1, L2 and least child hessian."""
    train = with_hash(split_from(spark, sf_dir).filter(F.col("split") == "train"), name=M.ROW_HASH).withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)).cast("double") for c in STUMP})
    params = BT.BoostParams(n_estimators=1, max_depth=1, learning_rate=0.1, reg_alpha=0.5, reg_lambda=2.0, min_child_weight=3.0)
    edges = [[float(e) for e in own] for own in STUMP.values()]
    grown = BT.grow(train, [list(STUMP)], [BT.Fit(params)], [1.0], edges=[edges])
    t = grown.trees[0]
    f, at = int(t.feature[0, 0]), int(t.bin[0, 0])
    return spark.createDataFrame([(list(STUMP)[f], int(edges[f][at]), round(float(t.gain[0, 0]), 6),
                                   round(float(t.value[0, 1]), 5), round(float(t.value[0, 2]), 5))],
                                 "feature string, edge int, gain double, left_value double, right_value double")


@register("best_params", f"""
SELECT CAST({len(_GRID_LABELS)} AS BIGINT) AS n_sets, true AS chosen_is_one, true AS chosen_is_best""")
def best_params_q(spark, sf_dir):
    run = _run(spark, sf_dir, "grid")
    table, chosen = _search_table(spark, run), _params_text(run.search.best)
    top = table.orderBy(F.desc("avg_auc"), "param_set").limit(1).select(F.col("params").alias("top"))
    return (table.agg(F.count(F.lit(1)).alias("n_sets"), (F.count_if(F.col("params") == chosen) == 1).alias("chosen_is_one"))
            .join(F.broadcast(top)).select("n_sets", "chosen_is_one", (F.col("top") == chosen).alias("chosen_is_best")))


def _valid(probability: str = "prob_churn"):
    return F.coalesce(F.col(probability).between(0, 1), F.lit(False))


@register("predict", with_base('SELECT "Churn", true AS prob_valid, true AS prediction_valid FROM test'))
def predict_q(spark, sf_dir):
    run = _run(spark, sf_dir, "grid")
    return TR.test_predictions(run, split_from(spark, sf_dir)).select(
        C.TARGET, _valid().alias("prob_valid"),
        (F.col("prediction") == (F.col("prob_churn") > 0.5).cast("int")).alias("prediction_valid"))


@register("score_portfolio", with_base(
    f"SELECT {cols(C.ALL_FEATURES + [C.TARGET])}, true AS prob_valid, true AS band_valid, "
    f"'{C.MODEL_TAG_GRID}' AS modelo FROM split"))
def score_portfolio_q(spark, sf_dir):
    scores = TR.score_portfolio(_run(spark, sf_dir, "grid"), _gold(spark, sf_dir), with_tags=False)
    return scores.select(*C.ALL_FEATURES, C.TARGET, _valid().alias("prob_valid"),
                         (F.col("nivel_riesgo") == risk_band("prob_churn")).alias("band_valid"), "modelo")


@register("score_tags", with_base(
    f"SELECT '{C.MODEL_TAG_GRID}' AS modelo, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_timestamps, "
    "CAST(1 AS BIGINT) AS n_run_ids, count(*) AS n_with_run_id FROM split"))
def score_tags_q(spark, sf_dir):
    scores = TR.score_portfolio(_run(spark, sf_dir, "grid"), _gold(spark, sf_dir))
    return scores.groupBy("modelo").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("scoring_timestamp").alias("n_timestamps"),
        F.count_distinct("mlflow_run_id").alias("n_run_ids"),
        F.count_if(F.length("mlflow_run_id") > 0).alias("n_with_run_id"))


@register("scores_roundtrip", with_base(
    f"SELECT count(*) AS n_rows, '{', '.join(SC.SCORE_COLUMNS)}' AS columns, "
    "CAST(0 AS BIGINT) AS n_without_band FROM split"))
def scores_roundtrip_q(spark, sf_dir):
    run, tables = _run(spark, sf_dir, "grid"), CHECK_TABLES
    _check_database(spark)
    name = TB.write_table(TR.score_portfolio(run, _gold(spark, sf_dir)), tables.qualified(tables.scores_grid),
                          tables.fmt, "Churn scores of the Spark-ML boosted trees.")
    back = TB.read_table(spark, name)
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(", ".join(back.columns)).alias("columns"),
                    F.count_if(F.col("nivel_riesgo").isNull()).alias("n_without_band"))


def _importance_df(spark, sf_dir):
    pairs = M.importance_by_source(_run(spark, sf_dir, "grid").scorer, _gold(spark, sf_dir))
    return spark.createDataFrame(pairs, "feature string, importance double")


def _features_sql(columns: str) -> str:
    values = ", ".join(f"('{c}')" for c in C.ALL_FEATURES)
    return f"SELECT feature, {columns} FROM (VALUES {values}) t(feature)"


@register("feature_importance", _features_sql("true AS valid, true AS sum_is_one"))
def feature_importance_q(spark, sf_dir):
    df = _importance_df(spark, sf_dir)
    total = df.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("sum_is_one"))
    return df.join(F.broadcast(total)).select("feature", F.col("importance").between(0, 1).alias("valid"), "sum_is_one")


@register("importance_topk", "SELECT CAST(i AS INTEGER) AS place, true AS in_order, true AS known FROM range(1, 11) t(i)")
def importance_topk_q(spark, sf_dir):
    from pyspark.sql import Window

    top = _importance_df(spark, sf_dir).orderBy(F.desc("importance"), "feature").limit(10)
    w = Window.orderBy(F.desc("importance"), "feature")  # ten rows
    return top.select(F.row_number().over(w).alias("place"),
                      F.coalesce(F.lag("importance").over(w) >= F.col("importance"), F.lit(True)).alias("in_order"),
                      F.col("feature").isin(C.ALL_FEATURES).alias("known"))


@register("mean_abs_attribution", _features_sql("true AS valid, true AS adds_up"))
def mean_abs_attribution_q(spark, sf_dir):
    """Shapley values of all test rows; for every row they add up to its margin."""
    run = _run(spark, sf_dir, "random")
    test = split_from(spark, sf_dir).filter(F.col("split") == "test")
    return AT.mean_abs_shapley(AT.shapley_values(run.scorer, AT.dealt(test))).select(
        "feature", (F.col("mean_abs_attribution") >= 0).alias("valid"), (F.col("max_error") < 1e-9).alias("adds_up"))


def _impact_metrics(run, gold) -> dict:
    row = SC.retention_impact(TR.score_portfolio(run, gold, with_tags=False)).first()
    return {"roi": row["roi"], "high_risk": row["high_risk"]}


#: Metrics of a run that are shares.
SHARES = ["accuracy", "f1_score", "precision", "recall", "roc_auc", "weighted_f1", "weighted_precision",
          "weighted_recall"]
_LOG_ROWS = ([("param", k) for k in ("class_weight_ratio", "maxDepth", "maxIter", "stepSize")]
             + [("metric", k) for k in sorted([*SHARES, "fit_seconds", "high_risk", "roi"])])


def _logged(spark, sf_dir, kind: str, gold):
    run = _run(spark, sf_dir, kind)
    _check_database(spark)
    name = TR.append_run_log(spark, run, CHECK_TABLES, extra_metrics=_impact_metrics(run, gold))
    return run, TB.read_table(spark, name)


@register("run_log", "SELECT kind, name, true AS value_valid, '" + C.MODEL_TAG_GRID + "' AS model FROM (VALUES "
          + ", ".join(f"('{k}', '{n}')" for k, n in _LOG_ROWS) + ") t(kind, name)")
def run_log_q(spark, sf_dir):
    run, log = _logged(spark, sf_dir, "grid", _gold(spark, sf_dir))
    value = F.col("value").try_cast("double")
    return log.filter(F.col("run_id") == run.run_id).select(
        "kind", "name", F.coalesce(F.when(F.col("name").isin(SHARES), value.between(0, 1)).otherwise(
            value.isNotNull() & ~F.isnan(value)), F.lit(False)).alias("value_valid"), "model")


@register("model_comparison", "SELECT model, true AS roc_auc_valid, true AS f1_valid, true AS roi_valid "
          f"FROM (VALUES ('{C.MODEL_TAG_GRID}'), ('{C.MODEL_TAG_RANDOM}')) t(model)")
def model_comparison_q(spark, sf_dir):
    _runs(spark, sf_dir, "grid", "random")
    gold, folder = stored(_gold(spark, sf_dir), "gold")   # both models score all its rows
    try:
        runs = [_logged(spark, sf_dir, kind, gold) for kind in ("grid", "random")]
    finally:
        drop_folder(spark, folder)
    table = TR.model_comparison(runs[-1][1].filter(F.col("run_id").isin(*[r.run_id for r, _ in runs])))
    return table.select("model", F.col("roc_auc").between(0.5, 1).alias("roc_auc_valid"),
                        F.col("f1_score").between(0, 1).alias("f1_valid"), F.col("roi").isNotNull().alias("roi_valid"))


def flagship(spark, sf_dir: str):
    """Portfolio -> gold -> class-weighted GBT as deep and long as the grid's
    first parameter set -> scores -> band counts."""
    df = split_from(spark, sf_dir)
    run = TR.fit_single(df, C.GBTParams(max_iter=C.GRID_MAX_ITER[0], max_depth=C.GRID_MAX_DEPTH[0]))
    gold = df.drop("split", "fold")
    return SC.band_counts(TR.score_portfolio(run, gold, with_tags=False))
