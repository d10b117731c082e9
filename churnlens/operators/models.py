"""Boosted-tree models with Spark ML: stages, fits, searches, importances.

Training is Spark ML's distributed ``GBTClassifier`` (per-level histogram
aggregation across executors) on a layout fixed by the rows' hash;
hyper-parameter searches go over deterministic hash folds
(``split.stratified_folds``) and fit the feature stages once per fold.  Only model-sized data
(parameters, importances, one metric per fit) reaches the driver.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.functions.expressions import positive_probability
from churnlens.operators.boosting import BoostedScorer, BoostParams, Fit, Growth, grow, prepared_names
from churnlens.operators.prep import PREPARED_PREFIX, ColumnPrep, MedianFill, fit_prep, prepared_columns, with_prepared
from churnlens.session import checkpoint_root

IMP, IDX, OHE = "__imp", "__idx", "__ohe"
#: Column of ``split.with_hash`` that training rows carry.
ROW_HASH = "_h"
#: Trees between checkpoints of a fit's state. Every task of a pass carries the trees since the last one,
#: each a whole model; with Spark's 10 their decoding took about as long as the pass over few rows.
CHECKPOINT_INTERVAL = 3


def gbt(params: C.GBTParams = C.GBTParams(), label: str = C.TARGET,
        weight: str | None = "classWeight") -> GBTClassifier:
    est = GBTClassifier(
        labelCol=label, featuresCol="features", seed=params.seed,
        maxIter=params.max_iter, maxDepth=params.max_depth, stepSize=params.step_size,
        subsamplingRate=params.subsampling_rate,
        featureSubsetStrategy=params.feature_subset_strategy,
        minInstancesPerNode=params.min_instances_per_node, minInfoGain=params.min_info_gain,
        maxBins=params.max_bins, checkpointInterval=CHECKPOINT_INTERVAL)
    if weight:
        est.setWeightCol(weight)
    return est


def native_stages(num: list[str] = C.NUM_FEATURES, cat: list[str] = C.CAT_FEATURES) -> list:
    """Indexer (all categoricals in one pass; unknown / NULL -> extra index),
    one-hot (last slot dropped), exact median imputation of numerics (NaN would
    stop the tree fit), assembler."""
    indexer = StringIndexer(inputCols=cat, outputCols=[c + IDX for c in cat], handleInvalid="keep")
    encoder = OneHotEncoder(inputCols=[c + IDX for c in cat], outputCols=[c + OHE for c in cat])
    imputer = MedianFill(numCols=num, suffix=IMP)
    assembler = VectorAssembler(inputCols=[c + IMP for c in num] + [c + OHE for c in cat],
                                outputCol="features", handleInvalid="keep")
    return [indexer, encoder, imputer, assembler]


def prepared_stages() -> list:
    """The column transform of ``prep`` as one stage: imputation,
    standardisation, drop-first one-hot, assembly."""
    return [ColumnPrep()]


def auc_evaluator(label: str = C.TARGET) -> BinaryClassificationEvaluator:
    """Area under the exact ROC curve (no binning of the scores)."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC", numBins=0)


def grid_maps(est: GBTClassifier, max_depth=C.GRID_MAX_DEPTH, max_iter=C.GRID_MAX_ITER,
              step_size=C.GRID_STEP_SIZE) -> list:
    return (ParamGridBuilder().addGrid(est.maxDepth, list(max_depth))
            .addGrid(est.maxIter, list(max_iter)).addGrid(est.stepSize, list(step_size)).build())


def random_draws(space: dict = C.RANDOM_SPACE, n: int = C.RANDOM_SEARCH_DRAWS,
                 seed: int = C.RANDOM_STATE) -> list[dict]:
    """``n`` distinct seeded draws of all parameters of the space (parameter
    order fixed by the space's keys)."""
    rng = random.Random(seed)
    total = math.prod(len(v) for v in space.values())
    seen, draws = set(), []
    while len(draws) < min(n, total):
        pick = tuple(rng.randrange(len(v)) for v in space.values())
        if pick not in seen:
            seen.add(pick)
            draws.append({k: v[i] for (k, v), i in zip(space.items(), pick)})
    return draws


@dataclass
class SearchResult:
    model: PipelineModel | BoostedScorer
    results: list[dict]      # one dict per parameter set: params + avg_auc
    best_index: int

    @property
    def best(self) -> dict:
        return self.results[self.best_index]


def laid_out(rows: DataFrame, partitions: int | None = None, key: str = ROW_HASH) -> DataFrame:
    """``rows`` dealt to a fixed number of partitions (default: the cluster's
    parallelism) by their hash and ordered by it within.  Trees sample rows by
    partition and place, so a fit depends on the rows and this number alone,
    not on the layout of the input."""
    n = partitions or rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(n, key).sortWithinPartitions(key)


def _features_of(stages: PipelineModel, rows: DataFrame, keep: list[str], partitions: int | None) -> DataFrame:
    """The features a fit reads, laid out and checkpointed: the thousands of small jobs of its trees
    would carry the plan of the features in every task."""
    checkpoint_root(rows.sparkSession)
    return laid_out(stages.transform(rows).select("features", *keep, ROW_HASH), partitions).drop(ROW_HASH).checkpoint()


def fit_stages(stages: list, est: GBTClassifier, train: DataFrame, partitions: int | None = None) -> PipelineModel:
    """The feature stages fitted on ``train``, then the trees on the features
    alone; one model that scores raw rows."""
    return _fit_trees(Pipeline(stages=stages).fit(train), est, train, partitions)


def _fit_trees(prep: PipelineModel, est: GBTClassifier, train: DataFrame, partitions: int | None) -> PipelineModel:
    keep = [est.getLabelCol()] + ([est.getWeightCol()] if est.isSet("weightCol") else [])
    return PipelineModel(prep.stages + [est.fit(_features_of(prep, train, keep, partitions))])


def cross_validate(stages: Callable[[], list], est: GBTClassifier, maps: list, train: DataFrame,
                   labels: list[dict], fold_col: str = "fold", folds: int = C.CV_FOLDS,
                   parallelism: int = 2, partitions: int | None = None) -> SearchResult:
    """k-fold search over ``maps`` using the row's hash fold; refits the best.

    The feature stages are fitted once per fold, on its training part; its
    features are checkpointed once and shared by all parameter sets.  Of all fits
    (folds x parameter sets) ``parallelism`` run at a time.  Without rows of both
    classes in a held-out fold its AUC is left out of the mean.

    ``partitions`` is that of all rows; a fold's training part gets its share of it.
    Where a fit is one task and so leaves cores idle, every parameter set is fitted on all
    rows beside the folds, so the best one's model is there when its AUC is known.
    """
    keep = [est.getLabelCol(), est.getWeightCol()]
    evaluator = auc_evaluator(est.getLabelCol())
    threaded = inheritable_thread_target(train.sparkSession)

    @threaded
    def features(f: int) -> tuple[DataFrame, DataFrame, bool]:
        own, held = train.filter(F.col(fold_col) != f), train.filter(F.col(fold_col) == f)
        prep = Pipeline(stages=stages()).fit(own)
        fit_rows = _features_of(prep, own, keep, partitions and _share(partitions, sizes, f))
        test_rows = prep.transform(held).select("features", *keep).persist(StorageLevel.MEMORY_AND_DISK)
        return fit_rows, test_rows, test_rows.select(keep[0]).distinct().count() >= 2

    @threaded
    def measure(fit_rows: DataFrame, test_rows: DataFrame, i: int) -> float:
        return evaluator.evaluate(est.fit(fit_rows, maps[i]).transform(test_rows))

    @threaded
    def all_rows() -> tuple[PipelineModel, DataFrame | None]:
        prep = Pipeline(stages=stages()).fit(train)
        return prep, _features_of(prep, train, keep, partitions) if partitions == 1 else None

    sizes = {r[fold_col]: r["n"] for r in train.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    scores: list[list[float]] = [[] for _ in maps]
    with ThreadPoolExecutor(max_workers=folds + 1) as pool:  # a few small jobs each
        whole = pool.submit(all_rows)
        by_fold = list(pool.map(features, range(folds)))
    prep, rows = whole.result()
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            found = [[pool.submit(measure, fit_rows, test_rows, i) for i in range(len(maps))] if both else []
                     for fit_rows, test_rows, both in by_fold]
            early = [pool.submit(threaded(est.fit), rows, m) for m in maps] if rows is not None else []
            for (_, test_rows, _), own in zip(by_fold, found):
                for i, auc in enumerate(own):
                    scores[i].append(float(auc.result()))
                test_rows.unpersist()
    finally:
        for _, test_rows, _ in by_fold:
            test_rows.unpersist()
    metrics = [sum(s) / len(s) if s else float("nan") for s in scores]
    best = max(range(len(maps)), key=lambda i: (metrics[i] if metrics[i] == metrics[i] else -1.0, -i))
    results = [dict(lab, avg_auc=m) for lab, m in zip(labels, metrics)]
    model = (PipelineModel(prep.stages + [early[best].result()]) if early
             else _fit_trees(prep, est.copy(maps[best]), train, partitions))
    return SearchResult(model, results, best)


def _share(partitions: int, sizes: dict, fold: int) -> int:
    """Partitions of the rows outside ``fold``, no larger than those of all rows; ``sizes`` has rows by fold."""
    own = sum(n for f, n in sizes.items() if f not in (None, fold))
    return max(1, -(-partitions * own // max(1, sum(sizes.values()))))


def boosted_search(train: DataFrame, draws: list[dict], positive_weight: float, fold_col: str = "fold",
                   folds: int = C.CV_FOLDS, growth: Growth = Growth()) -> SearchResult:
    """k-fold search over ``draws`` (BoostParams by name), all models grown together;
    refits the best on all rows.

    The column transform is fitted per fold, with the categories of all rows.  A fold
    without rows of both classes is left out of a draw's mean."""
    fit = inheritable_thread_target(train.sparkSession)(fit_prep)
    with ThreadPoolExecutor(max_workers=folds + 1) as pool:  # a few small jobs each
        *parts, whole = pool.map(fit, [*[train.filter(F.col(fold_col) != f) for f in range(folds)], train])
    preps = [replace(p, categories=whole.categories) for p in parts] + [whole]
    wide, matrices = train, []
    for i, stats in enumerate(preps[:folds]):
        # A fold without any value of a column takes that of all rows.
        for own, full in ((stats.medians, whole.medians), (stats.modes, whole.modes), (stats.means, whole.means),
                          (stats.stds, whole.stds)):
            own.update({c: v for c, v in full.items() if own.get(c) is None})
        wide = with_prepared(wide, stats, f"__m{i}_")
        matrices.append(prepared_columns(stats, f"__m{i}_"))
    params = [BoostParams(**d) for d in draws]
    fits = [Fit(p, f, f) for p in params for f in range(folds)]
    grown = grow(wide, matrices, fits, [positive_weight] * len(fits), growth, key=ROW_HASH, fold=fold_col,
                 fitted_on=[*range(folds)])
    results = []
    for i, d in enumerate(draws):
        auc = [a for a in grown.auc[i * folds: (i + 1) * folds] if a is not None]
        results.append(dict(d, avg_auc=sum(auc) / len(auc) if auc else float("nan")))
    best = max(range(len(draws)), key=lambda i: (results[i]["avg_auc"] if auc_known(results[i]) else -1.0, -i))
    refit = grow(with_prepared(train, whole), [prepared_columns(whole)], [Fit(params[best])], [positive_weight], growth,
                 key=ROW_HASH, fold=fold_col)
    scorer = BoostedScorer(whole, params[best], refit.trees[0], refit.edges[0], prepared_names(whole))
    return SearchResult(scorer, results, best)


def auc_known(result: dict) -> bool:
    return not math.isnan(result["avg_auc"])


@dataclass
class Scorer:
    """A fitted pipeline.  ``score`` keeps the input columns and adds
    ``prediction`` and ``prob_churn``; everything is a map-only projection."""

    model: PipelineModel

    def score(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        """``threshold`` (e.g. the Youden cut-off of ``evaluate.youden_threshold``)
        replaces the model's own decision: prediction = prob_churn >= threshold."""
        keep = df.columns
        out = self.model.transform(df).withColumn(
            "prob_churn", positive_probability("probability"))
        pred = (F.col("prediction") if threshold is None
                else (F.col("prob_churn") >= F.lit(float(threshold))))
        return out.select(*keep, pred.cast("int").alias("prediction"), "prob_churn")


def slot_names(scorer: Scorer, sample: DataFrame) -> list[str]:
    """Names of the assembled vector's slots, from the column metadata
    (schema only: no job runs)."""
    schema = scorer.model.transform(sample.limit(0)).schema
    attrs = schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [name for _, name in slots]


def source_column(slot: str, sources: list[str]) -> str:
    """Map a slot name back to its input column (longest matching prefix)."""
    slot = slot[len(PREPARED_PREFIX):] if slot.startswith(PREPARED_PREFIX) else slot
    best = ""
    for s in sources:
        if (slot == s or slot.startswith(s + "_")) and len(s) > len(best):
            best = s
    return best or slot


def importance_by_source(scorer: Scorer | BoostedScorer, sample: DataFrame,
                         sources: list[str] = C.ALL_FEATURES) -> list[tuple[str, float]]:
    """GBT gain importance summed per source column: every one-hot slot is
    attributed to its own categorical column (slot names from metadata)."""
    if isinstance(scorer, BoostedScorer):
        return scorer.importance()
    values = scorer.model.stages[-1].featureImportances.toArray()
    totals = {s: 0.0 for s in sources}
    for name, v in zip(slot_names(scorer, sample), values):
        src = source_column(name, sources)
        totals[src] = totals.get(src, 0.0) + float(v)
    return sorted(totals.items(), key=lambda kv: (-kv[1], kv[0]))


def mean_abs_attribution(scorer: Scorer, rows: DataFrame, reference: dict,
                         features: list[str] = C.ALL_FEATURES) -> DataFrame:
    """Mean |p - p0| per feature, where p re-scores each row with that one
    feature set to its reference value (training median / mode).

    Every row is expanded into one copy per feature with ``inline`` (one
    scan, no union of plans) and the copies go through the model in one job.
    """
    types = dict(rows.dtypes)
    base = scorer.score(rows.select(*features)).withColumnRenamed("prob_churn", "_p0")
    copies = F.array(*[
        F.struct(F.lit(f).alias("_feature"),
                 *[(F.lit(reference[g]).cast(types[g]) if g == f else F.col(g)).alias(g)
                   for g in features],
                 F.col("_p0"))
        for f in features])
    rescored = scorer.score(base.select(F.inline(copies)))
    return (rescored.groupBy(F.col("_feature").alias("feature"))
            .agg(F.avg(F.abs(F.col("prob_churn") - F.col("_p0"))).alias("mean_abs_attribution")))
