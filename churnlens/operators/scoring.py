"""Scores table: probability, risk band, tags, layout, band counts, impact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.functions.expressions import risk_band

SCORE_COLUMNS = C.ALL_FEATURES + [C.TARGET, "prob_churn", "nivel_riesgo", "modelo",
                                  "scoring_timestamp", "mlflow_run_id"]


def with_band(df: DataFrame, probability: str = "prob_churn", name: str = "nivel_riesgo") -> DataFrame:
    return df.withColumn(name, risk_band(probability))


def with_tags(df: DataFrame, model_tag: str, run_id: str) -> DataFrame:
    """Model name, scoring time (one per query) and run id as columns."""
    return df.withColumns({
        "modelo": F.lit(model_tag),
        "scoring_timestamp": F.current_timestamp(),
        "mlflow_run_id": F.lit(run_id),
    })


def scores_layout(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Final column order of a scores table (missing tag columns skipped)."""
    return df.select(*[c for c in SCORE_COLUMNS if c in df.columns], *extra)


def band_counts(scores: DataFrame, band: str = "nivel_riesgo") -> DataFrame:
    return (scores.groupBy(band).agg(F.count(F.lit(1)).alias("n")).orderBy(band))


def high_risk_count(scores: DataFrame, band: str = "nivel_riesgo") -> DataFrame:
    return scores.agg(F.count_if(F.col(band) == C.BAND_HIGH).alias("high_risk"))


def retention_impact(scores: DataFrame, band: str = "nivel_riesgo") -> DataFrame:
    """Customers scored, high-risk customers, customers retained by the
    campaign, revenue preserved, campaign cost and return on investment."""
    agg = scores.agg(F.count(F.lit(1)).alias("total_customers"),
                     F.count_if(F.col(band) == C.BAND_HIGH).alias("high_risk"))
    retained = F.floor(F.col("high_risk") * F.lit(C.RETENTION_RATE)).cast("bigint")
    return agg.select(
        "total_customers", "high_risk",
        retained.alias("retained"),
        (retained * F.lit(C.CLV_AVERAGE)).cast("bigint").alias("preserved_revenue"),
        F.lit(C.CAMPAIGN_COST).cast("bigint").alias("campaign_cost"),
        ((retained * F.lit(C.CLV_AVERAGE)).cast("double") / F.lit(float(C.CAMPAIGN_COST))).alias("roi"),
    )


def standin_score(df: DataFrame) -> DataFrame:
    """Deterministic score ``coalesce(risk_score_flags, 0) / 4`` and prediction
    ``score >= 0.5``: a test device that lets the post-model operators be
    checked against SQL without a model."""
    score = F.coalesce(F.col("risk_score_flags"), F.lit(0)).cast("double") / F.lit(4.0)
    return df.withColumns({"score": score, "prediction": (score >= 0.5).cast("int")})
