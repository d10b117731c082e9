"""Queries over the incremental layers: silver, metrics, quarantine repairs and scores
by micro-batches, each equal to its batch query."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import scoring as SC
from churnlens.plans import training as TR
from churnlens.plans.medallion import split_from
from churnlens.plans.oracle import BASE, SILVER_COLS, cols, with_base
from churnlens.plans.q_silver import _METRICS_SQL
from churnlens.plans.registry import register
from churnlens.session import drop_folder, scratch_path, stored
from churnlens.sources.landing import write_landing
from churnlens.sources.portfolio import portfolio
from churnlens.streaming.scoring import read_scores, run_scoring_stream
from churnlens.streaming.silver import SilverStore, repair, run_silver_stream


def _three_increments(spark, sf_dir) -> SilverStore:
    """The portfolio's files one after the other, the first again under another
    name; every increment is a new start of the stream from its checkpoint."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "silver-stream")
    parts, store = portfolio(spark, sf_dir), SilverStore(f"{root}/store")
    for name, df in [*parts.items(), ("again-" + C.TRAIN_FILE, parts[C.TRAIN_FILE])]:
        write_landing({name: df}, landing)
        run_silver_stream(spark, landing, store, f"{root}/checkpoint", pattern="*.csv")
    return store


@register("silver_stream", with_base("SELECT * FROM silver"))
def silver_stream_q(spark, sf_dir):
    return _three_increments(spark, sf_dir).silver(spark).select(*SILVER_COLS)


@register("metrics_stream", with_base(_METRICS_SQL))
def metrics_stream_q(spark, sf_dir):
    return _three_increments(spark, sf_dir).metrics(spark)


@register("target_stream", with_base('SELECT "Churn", count(*) AS n FROM silver GROUP BY "Churn"'))
def target_stream_q(spark, sf_dir):
    return _three_increments(spark, sf_dir).target_distribution(spark)


#: How the replay query repairs: a missing age becomes 33, an unknown label 1.
_REPAIRED = BASE.replace(
    "SELECT DISTINCT * FROM casted",
    'SELECT DISTINCT * REPLACE (coalesce("Age", 33) AS "Age", CASE WHEN "Churn" = 2 THEN 1 ELSE "Churn" END AS "Churn") '
    "FROM casted")


def _repaired(spark, sf_dir) -> SilverStore:
    store = _three_increments(spark, sf_dir)
    changes = store.quarantine(spark).withColumns({
        "Age": F.coalesce("Age", F.lit(33)), "Churn": F.when(F.col("Churn") == 2, 1).otherwise(F.col("Churn"))})
    for _ in range(2):  # a replay changes nothing
        repair(spark, store, changes, 1)
    return store


@register("quarantine_replay", f"WITH {_REPAIRED.strip()} SELECT {cols(SILVER_COLS)} FROM silver")
def quarantine_replay_q(spark, sf_dir):
    return _repaired(spark, sf_dir).silver(spark).select(*SILVER_COLS)


@register("quarantine_replay_metrics", f"WITH {_REPAIRED.strip()} {_METRICS_SQL}")
def quarantine_replay_metrics_q(spark, sf_dir):
    return _repaired(spark, sf_dir).metrics(spark)


def stream_files(rows: int) -> int:
    """Files of the scored stream, half of them a micro-batch: four, more where one would get over 50,000 rows."""
    return max(4, -(-rows // TR.ROWS_PER_PARTITION))


@register("score_stream", with_base(
    f"SELECT {cols(C.ALL_FEATURES + [C.TARGET])}, true AS as_batch, '{C.MODEL_TAG_GRID}' AS modelo FROM split"))
def score_stream_q(spark, sf_dir):
    """Gold rows scored in micro-batches by a stored and reloaded model; every row has the batch score."""
    gold, folder = stored(split_from(spark, sf_dir), "split")
    root = scratch_path(spark, "score-stream")
    files = stream_files(gold.count())
    gold.drop("split", "fold").repartition(files).write.parquet(f"{root}/gold")
    run = TR.fit_single(gold, C.GBTParams(max_iter=C.GRID_MAX_ITER[0], max_depth=C.GRID_MAX_DEPTH[0]))
    scorer = TR.load_run_scorer(TR.save_run(run, f"{root}/model"))
    drop_folder(spark, folder)
    rows = spark.read.parquet(f"{root}/gold")
    run_scoring_stream(spark, f"{root}/gold", rows.schema, scorer, run.name, f"{root}/scores", f"{root}/checkpoint",
                       max_files_per_trigger=-(-files // 2))
    batch = SC.with_band(run.scorer.score(rows)).select(*[F.col(c).alias(f"b_{c}") for c in (
        *C.ALL_FEATURES, C.TARGET, "prob_churn", "nivel_riesgo")])
    got = read_scores(spark, f"{root}/scores")
    same = F.lit(True)
    for c in (*C.ALL_FEATURES, C.TARGET):
        same = same & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    return got.join(batch, same, "left").select(
        *C.ALL_FEATURES, C.TARGET, F.coalesce((F.col("prob_churn") == F.col("b_prob_churn"))
                                             & (F.col("nivel_riesgo") == F.col("b_nivel_riesgo")), F.lit(False)).alias("as_batch"),
        "modelo")
