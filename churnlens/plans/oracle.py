"""DuckDB SQL texts that define each registered query independently.

Every text starts with the same chain of common table expressions
(portfolio -> bronze -> silver -> gold -> splits) over the views
``customer``, ``orders`` and ``events``, and ends with one query-specific
SELECT.  The texts are written from the operator definitions, not generated
from Spark plans.
"""

from __future__ import annotations

from churnlens import config as C
from churnlens.functions.expressions import HASH_SPACE, fraction_cut


def q(name: str) -> str:
    """Quote an identifier (the raw headers contain spaces)."""
    return '"' + name + '"'


PROFILE_COLS = ["Age", "Gender", "Tenure", "usage_frequency", "support_calls", "payment_delay",
                "subscription_type", "contract_length", "total_spend", "last_interaction", "Churn"]
#: Gold columns that are inputs (the rest is derived from them) and their types.
KEY_COLS = [("Age", "int"), ("Tenure", "int"), ("usage_frequency", "int"),
            ("support_calls", "int"), ("payment_delay", "int"), ("total_spend", "double"),
            ("last_interaction", "int"), ("Gender", "string"), ("subscription_type", "string"),
            ("contract_length", "string"), ("Churn", "int")]

SILVER_COLS = PROFILE_COLS + ["support_calls_per_tenure", "spend_per_tenure", "is_new_client",
                              "high_friction", "high_payment_delay", "is_inactive",
                              "risk_score_flags"]
GOLD_COLS = C.ALL_FEATURES + [C.TARGET]


def cols(names: list[str]) -> str:
    return ", ".join(q(n) for n in names)


def rules_sql(rules: dict[str, str] = C.EXPECTATIONS) -> dict[str, str]:
    return {n: f"coalesce(({e}), false)" for n, e in rules.items()}


def all_rules_sql() -> str:
    return " AND ".join(rules_sql().values())


def key_sql(seed: int = C.RANDOM_STATE) -> str:
    parts = [f"'{seed}'"]
    for c, t in KEY_COLS:
        v = f"TRY_CAST({q(c)} AS DECIMAL(38,2))" if t == "double" else q(c)
        parts.append(f"coalesce(CAST({v} AS VARCHAR), '\\N')")
    return "concat_ws('|', " + ", ".join(parts) + ")"


def hash_sql(key: str, part: int = 0) -> str:
    return f"CAST('0x' || substr(md5({key}), {1 + 15 * part}, 15) AS BIGINT)"


BASE = f"""
ord AS (
  SELECT o_custkey AS custkey,
         min(CAST(o_orderdate AS DATE)) AS first_day,
         max(CAST(o_orderdate AS DATE)) AS last_day,
         count(*) AS n_orders,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
         count(*) FILTER (WHERE o_orderstatus = 'P') AS n_pending,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend
  FROM orders GROUP BY o_custkey),
ev AS (
  SELECT user_id AS custkey,
         count(*) FILTER (WHERE event_type IN ('click', 'view')) AS n_usage
  FROM events GROUP BY user_id),
profile AS (
  SELECT c.c_custkey AS "CustomerID",
    CAST(CASE WHEN c.c_custkey % 30 = 4 THEN NULL ELSE floor(c.c_acctbal / 150) END AS INTEGER) AS "Age",
    CASE WHEN c.c_nationkey = 24 THEN NULL WHEN c.c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS "Gender",
    CAST(floor(datediff('day', o.first_day, o.last_day) / 90) AS INTEGER) AS "Tenure",
    CAST(e.n_usage AS INTEGER) AS "Usage Frequency",
    CAST(o.n_urgent AS INTEGER) AS "Support Calls",
    CAST(o.n_pending * 5 AS INTEGER) AS "Payment Delay",
    CASE WHEN c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'Basic'
         WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Premium' ELSE 'Standard' END AS "Subscription Type",
    CASE WHEN o.n_orders < 8 THEN 'Monthly' WHEN o.n_orders < 12 THEN 'Quarterly'
         ELSE 'Annual' END AS "Contract Length",
    CAST(o.spend AS DOUBLE) AS "Total Spend",
    CAST(CASE WHEN c.c_custkey % 40 = 7 THEN NULL
         ELSE floor(datediff('day', o.last_day, DATE '2001-08-02') / 10) END AS INTEGER) AS "Last Interaction",
    CAST(CASE WHEN c.c_custkey % 50 = 48 THEN NULL WHEN c.c_custkey % 50 = 49 THEN 2
         WHEN o.n_urgent * 7 + o.n_pending * 5 + c.c_custkey % 40 > 45 THEN 1 ELSE 0 END AS INTEGER) AS "Churn"
  FROM customer c
  LEFT JOIN ord o ON c.c_custkey = o.custkey
  LEFT JOIN ev e ON c.c_custkey = e.custkey),
raw_train AS (SELECT * FROM profile WHERE "CustomerID" % 5 <> 0),
raw_test AS (SELECT * FROM profile WHERE "CustomerID" % 5 IN (0, 1)),
renamed_train AS (
  SELECT "CustomerID", "Age", "Gender", "Tenure", "Usage Frequency" AS usage_frequency,
    "Support Calls" AS support_calls, "Payment Delay" AS payment_delay,
    "Subscription Type" AS subscription_type, "Contract Length" AS contract_length,
    "Total Spend" AS total_spend, "Last Interaction" AS last_interaction, "Churn"
  FROM raw_train),
renamed_test AS (
  SELECT "CustomerID", "Age", "Gender", "Tenure", "Usage Frequency" AS usage_frequency,
    "Support Calls" AS support_calls, "Payment Delay" AS payment_delay,
    "Subscription Type" AS subscription_type, "Contract Length" AS contract_length,
    "Total Spend" AS total_spend, "Last Interaction" AS last_interaction, "Churn"
  FROM raw_test),
bronze_rows AS (
  SELECT *, '{C.TRAIN_FILE}' AS _source_file FROM renamed_train
  UNION ALL
  SELECT *, '{C.TEST_FILE}' AS _source_file FROM renamed_test),
bronze AS (SELECT *, current_timestamp AS _ingestion_time FROM bronze_rows),
casted AS (
  SELECT TRY_CAST("Age" AS INTEGER) AS "Age", "Gender", TRY_CAST("Tenure" AS INTEGER) AS "Tenure",
    TRY_CAST(usage_frequency AS INTEGER) AS usage_frequency,
    TRY_CAST(support_calls AS INTEGER) AS support_calls,
    TRY_CAST(payment_delay AS INTEGER) AS payment_delay,
    subscription_type, contract_length,
    TRY_CAST(total_spend AS DOUBLE) AS total_spend,
    TRY_CAST(last_interaction AS INTEGER) AS last_interaction,
    TRY_CAST("Churn" AS INTEGER) AS "Churn"
  FROM bronze_rows),
distinct_rows AS (SELECT DISTINCT * FROM casted),
flagged AS (
  SELECT *,
    CASE WHEN "Tenure" > 0 THEN support_calls / "Tenure" ELSE CAST(support_calls AS DOUBLE) END
      AS support_calls_per_tenure,
    CASE WHEN "Tenure" > 0 THEN total_spend / "Tenure" ELSE CAST(total_spend AS DOUBLE) END
      AS spend_per_tenure,
    CAST("Tenure" <= {C.NEW_CLIENT_MAX_TENURE} AS INTEGER) AS is_new_client,
    CAST(support_calls >= {C.HIGH_FRICTION_MIN_CALLS} AS INTEGER) AS high_friction,
    CAST(payment_delay >= {C.HIGH_DELAY_MIN_DAYS} AS INTEGER) AS high_payment_delay,
    CAST(last_interaction > {C.INACTIVE_MIN_DAYS} AS INTEGER) AS is_inactive
  FROM distinct_rows),
unfiltered AS (
  SELECT *, is_new_client + high_friction + high_payment_delay + is_inactive AS risk_score_flags
  FROM flagged),
silver AS (SELECT * FROM unfiltered WHERE {all_rules_sql()}),
gold AS (SELECT {cols(GOLD_COLS)} FROM silver),
keyed AS (
  SELECT *, {hash_sql(key_sql())} AS h, {hash_sql(key_sql(), 1)} AS h2 FROM gold),
split AS (
  SELECT * EXCLUDE (h, h2),
    CASE WHEN h < {fraction_cut(1 - C.TEST_FRACTION)} THEN 'train' ELSE 'test' END AS split,
    CAST(h2 % {C.CV_FOLDS} AS INTEGER) AS fold
  FROM keyed),
train AS (SELECT * FROM split WHERE split = 'train'),
test AS (SELECT * FROM split WHERE split = 'test'),
scored AS (
  SELECT *, CAST(coalesce(risk_score_flags, 0) AS DOUBLE) / 4.0 AS score FROM split),
test_scored AS (
  SELECT "Churn" AS label, score, CAST(score >= 0.5 AS INTEGER) AS prediction
  FROM scored WHERE split = 'test')
"""

assert HASH_SPACE == 1 << 60


def with_base(select: str, extra_ctes: str = "") -> str:
    """The shared chain followed by optional CTEs and the final SELECT."""
    more = f",\n{extra_ctes.strip()}" if extra_ctes.strip() else ""
    return f"WITH {BASE.strip()}{more}\n{select.strip()}"


def band_sql(p: str) -> str:
    return (f"CASE WHEN {p} IS NULL OR isnan({p}) THEN NULL "
            f"WHEN {p} <= {C.BAND_LOW_MAX} THEN '{C.BAND_LOW}' "
            f"WHEN {p} <= {C.BAND_MEDIUM_MAX} THEN '{C.BAND_MEDIUM}' ELSE '{C.BAND_HIGH}' END")
