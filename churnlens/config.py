"""Fixed values, feature lists and table names.

Everything another module needs to agree on lives here, so the Spark code and
the SQL oracle texts read the same numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values that must equal the application we re-express (names, rules,
# thresholds, bands, business constants).  Kept verbatim, in natural order.
# ---------------------------------------------------------------------------

TRAIN_FILE = "customer_churn_dataset-training-master.csv"
TEST_FILE = "customer_churn_dataset-testing-master.csv"

# Raw CSV header -> bronze column name (the seven spaced headers).
RENAMES = {
    "Usage Frequency": "usage_frequency",
    "Support Calls": "support_calls",
    "Payment Delay": "payment_delay",
    "Subscription Type": "subscription_type",
    "Contract Length": "contract_length",
    "Total Spend": "total_spend",
    "Last Interaction": "last_interaction",
}

RAW_COLUMNS = [
    "CustomerID", "Age", "Gender", "Tenure", "Usage Frequency", "Support Calls",
    "Payment Delay", "Subscription Type", "Contract Length", "Total Spend",
    "Last Interaction", "Churn",
]

META_COLUMNS = ["CustomerID", "_source_file", "_ingestion_time"]

# Silver casts: column -> Spark SQL type name.
CASTS = {
    "Age": "int",
    "Tenure": "int",
    "usage_frequency": "int",
    "support_calls": "int",
    "payment_delay": "int",
    "last_interaction": "int",
    "total_spend": "double",
    "Churn": "int",
}

# Data-quality rules of the silver layer: name -> boolean SQL expression.
EXPECTATIONS = {
    "churn_valido": "Churn IN (0, 1)",
    "age_no_nulo": "Age IS NOT NULL",
    "tenure_no_nulo": "Tenure IS NOT NULL",
    "support_calls_no_nulo": "support_calls IS NOT NULL",
    "payment_delay_no_nulo": "payment_delay IS NOT NULL",
    "total_spend_no_nulo": "total_spend IS NOT NULL",
    "age_no_negativa": "Age >= 0",
    "tenure_no_negativa": "Tenure >= 0",
}

# Flag thresholds.
NEW_CLIENT_MAX_TENURE = 6        # is_new_client: Tenure <= 6
HIGH_FRICTION_MIN_CALLS = 4      # high_friction: support_calls >= 4
HIGH_DELAY_MIN_DAYS = 15         # high_payment_delay: payment_delay >= 15
INACTIVE_MIN_DAYS = 20           # is_inactive: last_interaction > 20

TARGET = "Churn"
NUM_FEATURES = [
    "Age",
    "Tenure",
    "usage_frequency",
    "support_calls",
    "payment_delay",
    "total_spend",
    "last_interaction",
    "support_calls_per_tenure",
    "spend_per_tenure",
    "risk_score_flags",
]
CAT_FEATURES = [
    "Gender",
    "subscription_type",
    "contract_length",
]
ALL_FEATURES = NUM_FEATURES + CAT_FEATURES

# Risk bands on the churn probability: <= 0.40 BAJO, <= 0.70 MEDIO, else ALTO.
BAND_LOW_MAX = 0.40
BAND_MEDIUM_MAX = 0.70
BAND_LOW, BAND_MEDIUM, BAND_HIGH = "BAJO", "MEDIO", "ALTO"

# Business-impact constants.
EXCHANGE_RATE = 890
CLV_AVERAGE = 1_200 * EXCHANGE_RATE          # value of one retained customer
RETENTION_RATE = 0.25
CAMPAIGN_COST = 50_000 * EXCHANGE_RATE

RANDOM_STATE = 42
TEST_FRACTION = 0.20
CV_FOLDS = 3

# Grid of the Spark-ML model: maxDepth x maxIter x stepSize.
GRID_MAX_DEPTH = [3, 5]
GRID_MAX_ITER = [100]
GRID_STEP_SIZE = [0.1]

# Random-search space of the boosted-tree model, by the original parameter
# name; see plans/training.py for how each maps onto GBTClassifier.
RANDOM_SPACE = {
    "n_estimators": [200, 300, 400],
    "max_depth": [3, 4, 5],
    "learning_rate": [0.03, 0.05, 0.08],
    "subsample": [0.7, 0.8, 0.9],
    "colsample_bytree": [0.7, 0.8, 0.9],
    "reg_alpha": [0.1, 0.5, 1.0],
    "reg_lambda": [1.0, 2.0, 5.0],
    "min_child_weight": [3, 5, 7],
    "gamma": [0.1, 0.2, 0.5],
}
RANDOM_SEARCH_DRAWS = 20

MODEL_TAG_GRID = "spark_mllib_gbt"
MODEL_TAG_RANDOM = "spark_gbt_random_search"

# ---------------------------------------------------------------------------
# Our own settings.
# ---------------------------------------------------------------------------

#: Stored table format.  The transactional format of the original is not on
#: the classpath here; Parquet is the default and any installed format works.
DEFAULT_FORMAT = "parquet"


@dataclass(frozen=True)
class Tables:
    """Names of the stored layers, inside one database (of ``catalog`` if given)."""

    database: str = "churnlens"
    catalog: str | None = None
    bronze: str = "bronze_churn"
    silver: str = "silver_churn"
    gold: str = "gold_churn_features"
    scores_grid: str = "gold_churn_scores_mllib"
    scores_random: str = "gold_churn_scores_xgboost"
    run_log: str = "run_log"
    quality: str = "quality_metrics"
    quarantine: str = "silver_quarantine"
    evaluation: str = "run_evaluation"
    fmt: str = DEFAULT_FORMAT

    @property
    def qualified_database(self) -> str:
        return f"{self.catalog}.{self.database}" if self.catalog else self.database

    def qualified(self, name: str) -> str:
        return f"{self.qualified_database}.{name}"


@dataclass(frozen=True)
class GBTParams:
    """Boosted-tree settings used by one fit (defaults: Spark's own)."""

    max_iter: int = 20
    max_depth: int = 5
    step_size: float = 0.1
    subsampling_rate: float = 1.0
    feature_subset_strategy: str = "all"
    min_instances_per_node: int = 1
    min_info_gain: float = 0.0
    max_bins: int = 32
    seed: int = RANDOM_STATE
