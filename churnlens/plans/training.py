"""Model runs end to end: split -> weights -> search -> evaluate -> score -> log.

Two runs mirror the two model notebooks of the application:

* ``grid``: Spark-native stages (indexers, one-hot, imputer, assembler) and
  class-weighted GBT, grid search over maxDepth x maxIter x stepSize;
* ``random``: the column transform of ``operators.prep`` (median / mode
  imputation, standardisation, drop-first one-hot), refitted in every fold,
  then second-order boosted trees (``operators.boosting``) with a seeded random
  search over all parameters of the space.

Everything runs as Spark jobs; the driver only sees parameters, one metric
per fit and the few-row statistics of the preparation.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens import config as C
from churnlens.operators import attribution as AT
from churnlens.operators import evaluate as EV
from churnlens.operators import models as M
from churnlens.operators import prep as PR
from churnlens.operators import scoring as SC
from churnlens.operators import split as SP
from churnlens.operators.boosting import BoostedScorer, Growth
from churnlens.session import checkpoint_root, drop_folder, stored


@dataclass
class ModelRun:
    name: str                      # model tag written into the scores
    run_id: str
    scorer: M.Scorer | BoostedScorer
    search: M.SearchResult
    class_weight: float
    prep: PR.PrepStats | None      # training statistics (computed on demand)
    params: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    train_rows: DataFrame | None = None
    fit_seconds: float | None = None

    def reference_values(self) -> dict:
        """Training medians / modes (fitted on first use)."""
        if self.prep is None:
            self.prep = PR.fit_prep(self.train_rows)
        return {**self.prep.medians, **self.prep.modes}


def training_frame(split_df: DataFrame) -> tuple[DataFrame, float, int, str]:
    """Training rows with ``classWeight`` and the row hash that lays them out.

    Returns (weighted rows, n_negative / n_positive, number of rows, the scratch
    folder to drop after the fits).  The rows and their hash are written there
    for the many jobs of the fits, so the upstream plan runs once."""
    spark = split_df.sparkSession
    train = SP.with_hash(split_df.filter(F.col("split") == "train").drop("split"), name=M.ROW_HASH)
    base, folder = stored(train, "train-rows")
    counts = SP.class_counts(base)
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    if n_pos == 0:
        drop_folder(spark, folder)
        raise ValueError("no positive rows: the class-weight ratio is undefined")
    ratio = n_neg / n_pos
    return SP.with_class_weight(base, ratio), ratio, n_pos + n_neg, folder


#: Training rows of a Spark ML fit in one partition.
ROWS_PER_PARTITION = 50_000


def _partitions(rows: int, given: int | None) -> int:
    return given or max(1, -(-rows // ROWS_PER_PARTITION))


def _searched(split_df: DataFrame, tag: str, ratio_name: str, stages, draws, parallelism: int,
              partitions: int | None) -> ModelRun:
    """One search; ``draws(est, rows)`` gives the parameter maps and their labels."""
    checkpoint_root(split_df.sparkSession)   # GBT checkpoints its state there
    began = time.perf_counter()
    train, ratio, rows, folder = training_frame(split_df)
    try:
        est = M.gbt()
        maps, labels = draws(est, rows)
        search = M.cross_validate(stages, est, maps, train, labels, parallelism=parallelism,
                                  partitions=_partitions(rows, partitions))
    finally:
        drop_folder(split_df.sparkSession, folder)
    params = {**search.best, ratio_name: ratio}
    params.pop("avg_auc", None)
    return ModelRun(tag, uuid.uuid4().hex, M.Scorer(search.model), search, ratio, None, params,
                    train_rows=_train_rows(split_df), fit_seconds=time.perf_counter() - began)


def run_grid(split_df: DataFrame, max_depth=C.GRID_MAX_DEPTH, max_iter=C.GRID_MAX_ITER,
             step_size=C.GRID_STEP_SIZE, parallelism: int = 2, partitions: int | None = None,
             tag: str = C.MODEL_TAG_GRID) -> ModelRun:
    def draws(est, rows):
        maps = M.grid_maps(est, max_depth, max_iter, step_size)
        return maps, [{"maxDepth": m[est.maxDepth], "maxIter": m[est.maxIter],
                       "stepSize": m[est.stepSize]} for m in maps]

    return _searched(split_df, tag, "class_weight_ratio", M.native_stages, draws, parallelism, partitions)


def run_random(split_df: DataFrame, draws: int = C.RANDOM_SEARCH_DRAWS, space: dict = C.RANDOM_SPACE,
               growth: Growth = Growth(), tag: str = C.MODEL_TAG_RANDOM) -> ModelRun:
    """Random search over all parameters of the space, all models grown together."""
    began = time.perf_counter()
    train, ratio, _, folder = training_frame(split_df)
    try:
        search = M.boosted_search(train, M.random_draws(space, draws), ratio, growth=growth)
    finally:
        drop_folder(split_df.sparkSession, folder)
    params = {**search.best, "scale_pos_weight": ratio}
    params.pop("avg_auc", None)
    return ModelRun(tag, uuid.uuid4().hex, search.model, search, ratio, search.model.prep, params,
                    train_rows=_train_rows(split_df), fit_seconds=time.perf_counter() - began)


def _single(split_df: DataFrame, params: C.GBTParams, tag: str, ratio_name: str, stages,
            partitions: int | None) -> ModelRun:
    checkpoint_root(split_df.sparkSession)
    began = time.perf_counter()
    train, ratio, rows, folder = training_frame(split_df)
    try:
        model = M.fit_stages(stages, M.gbt(params), train, _partitions(rows, partitions))
    finally:
        drop_folder(split_df.sparkSession, folder)
    labels = {"maxDepth": params.max_depth, "maxIter": params.max_iter, "stepSize": params.step_size}
    search = M.SearchResult(model, [dict(labels, avg_auc=None)], 0)
    return ModelRun(tag, uuid.uuid4().hex, M.Scorer(model), search, ratio, None, {**labels, ratio_name: ratio},
                    train_rows=_train_rows(split_df), fit_seconds=time.perf_counter() - began)


def fit_single(split_df: DataFrame, params: C.GBTParams = C.GBTParams(),
               partitions: int | None = None) -> ModelRun:
    """One class-weighted fit on the native stages (no search)."""
    return _single(split_df, params, C.MODEL_TAG_GRID, "class_weight_ratio", M.native_stages(), partitions)


def fit_single_prepared(split_df: DataFrame, params: C.GBTParams = C.GBTParams(),
                        partitions: int | None = None) -> ModelRun:
    """One class-weighted fit on the prepared columns (no search)."""
    return _single(split_df, params, C.MODEL_TAG_RANDOM, "scale_pos_weight", M.prepared_stages(), partitions)


def _train_rows(split_df: DataFrame) -> DataFrame:
    return split_df.filter(F.col("split") == "train")


def test_predictions(run: ModelRun, split_df: DataFrame) -> DataFrame:
    test = split_df.filter(F.col("split") == "test").select(*C.ALL_FEATURES, C.TARGET)
    return run.scorer.score(test)


def evaluate(run: ModelRun, split_df: DataFrame) -> dict:
    """Hold-out metrics: exact AUC, positive-class and weighted metrics."""
    pred = test_predictions(run, split_df).select(
        F.col(C.TARGET).alias("label"), "prediction", F.col("prob_churn").alias("score"))
    pred = pred.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        auc = EV.roc_auc(EV.roc_points(pred)).first()["auc"]
        m = EV.all_metrics(pred).first().asDict()
    finally:
        pred.unpersist()
    run.metrics = {"roc_auc": auc, "accuracy": m["accuracy_all"], "precision": m["precision"],
                   "recall": m["recall"], "f1_score": m["f1"],
                   "weighted_precision": m["weighted_precision"],
                   "weighted_recall": m["weighted_recall"], "weighted_f1": m["weighted_f1"]}
    return run.metrics


def attribution(run: ModelRun, rows: DataFrame) -> DataFrame:
    """(feature, mean_abs_attribution): Shapley values of the boosted trees, the
    effect of one replaced column for a Spark ML pipeline."""
    if isinstance(run.scorer, BoostedScorer):
        return AT.mean_abs_shapley(AT.shapley_values(run.scorer, AT.dealt(rows))).drop("max_error")
    return M.mean_abs_attribution(run.scorer, rows, run.reference_values())


def evaluation_frames(run: ModelRun, split_df: DataFrame, scores: DataFrame) -> dict[str, DataFrame]:
    """What a run's report shows, by name: confusion counts and ROC points of
    the hold-out rows, importances, attribution, band counts of the stored
    scores, and the search."""
    spark = split_df.sparkSession
    pred = test_predictions(run, split_df)
    held = pred.select(F.col(C.TARGET).alias("label"), "prediction", F.col("prob_churn").alias("score"))
    return {
        "confusion": held.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")),
        "roc": EV.roc_points(held).select("threshold", "tpr", "fpr"),
        "importance": spark.createDataFrame(M.importance_by_source(run.scorer, split_df),
                                            "feature string, importance double"),
        "attribution": attribution(run, split_df.filter(F.col("split") == "test")),
        "bands": SC.band_counts(scores),
        "search": spark.createDataFrame(
            [(i, str(sorted((k, v) for k, v in r.items() if k != "avg_auc")), r["avg_auc"])
             for i, r in enumerate(run.search.results)], "param_set int, params string, avg_auc double"),
    }


def write_evaluation(run: ModelRun, frames: dict[str, DataFrame], tables: C.Tables = C.Tables()) -> dict[str, str]:
    """Append each frame, tagged with the run, to its own table."""
    from churnlens.sources import tables as TB

    return {kind: TB.write_table(
        df.withColumns({"run_id": F.lit(run.run_id), "model": F.lit(run.name)}),
        tables.qualified(f"{tables.evaluation}_{kind}"), tables.fmt, mode="append")
        for kind, df in frames.items()}


def score_portfolio(run: ModelRun, gold: DataFrame, with_tags: bool = True,
                    extra: tuple[str, ...] = ()) -> DataFrame:
    """Every gold row scored, banded, tagged and laid out like the scores table.

    ``extra`` passes columns through after the layout, e.g. ``split`` (to tell
    in-sample rows from hold-out rows) or a customer key kept through silver."""
    scored = SC.with_band(run.scorer.score(gold.select(*C.ALL_FEATURES, C.TARGET, *extra)))
    if with_tags:
        scored = SC.with_tags(scored, run.name, run.run_id)
    else:
        scored = scored.withColumn("modelo", F.lit(run.name))
    return SC.scores_layout(scored, extra)


RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("model", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("logged_at", T.TimestampType()),
])


def run_log_rows(spark: SparkSession, run: ModelRun, extra_metrics: dict | None = None) -> DataFrame:
    """Long-form record of one run: its parameters and metrics (a few dozen
    rows, built from the run's own small dictionaries)."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(run.run_id, run.name, "param", k, str(v), now) for k, v in sorted(run.params.items())]
    metrics = dict(run.metrics, **(extra_metrics or {}))
    if run.fit_seconds is not None:
        metrics["fit_seconds"] = run.fit_seconds
    rows += [(run.run_id, run.name, "metric", k, repr(float(v)) if v is not None else None, now)
             for k, v in sorted(metrics.items())]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def append_run_log(spark: SparkSession, run: ModelRun, tables: C.Tables = C.Tables(),
                   extra_metrics: dict | None = None) -> str:
    """The run's rows in the log, once: a run id that is there already stays as
    it is, so a repeated call changes nothing."""
    from churnlens.sources import tables as TB

    TB.ensure_database(spark, tables.qualified_database)
    name = tables.qualified(tables.run_log)
    if TB.table_exists(spark, name) and not TB.read_table(spark, name).filter(
            F.col("run_id") == run.run_id).isEmpty():
        return name
    return TB.write_table(run_log_rows(spark, run, extra_metrics), name, tables.fmt, mode="append")


def model_comparison(run_log: DataFrame, metrics=("roc_auc", "f1_score", "roi")) -> DataFrame:
    """One row per run: the chosen metrics side by side (pivot over the log)."""
    return (run_log.filter((F.col("kind") == "metric") & F.col("name").isin(*metrics))
            .groupBy("run_id", "model")
            .pivot("name", list(metrics))
            .agg(F.max(F.col("value").cast("double"))))


def save_run(run: ModelRun, path: str | None = None) -> str:
    """Persist the fitted model under the shared checkpoint folder unless a
    path is given; the path becomes a parameter of the run."""
    from churnlens.sources.tables import save_model

    spark = run.train_rows.sparkSession
    path = path or f"{checkpoint_root(spark)}/models/{run.name}-{run.run_id}"
    if isinstance(run.scorer, BoostedScorer):
        run.params["model_path"] = run.scorer.save(spark, f"{path}/{BOOSTED}")
    else:
        run.params["model_path"] = save_model(run.scorer.model, f"{path}/model")
    return path


#: Folder of a saved boosted model within its run's folder.
BOOSTED = "boosted"


def load_run_scorer(path: str) -> M.Scorer | BoostedScorer:
    from churnlens.sources.tables import load_model

    spark = SparkSession.getActiveSession()
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BOOSTED}")
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return BoostedScorer.load(spark, f"{path}/{BOOSTED}")
    return M.Scorer(load_model(f"{path}/model"))
