"""Queries over the silver and gold layers and the quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import quality as Q
from churnlens.operators import silver as S
from churnlens.operators.gold import gold_features
from churnlens.plans.medallion import bronze_from, gold_from, silver_from, unfiltered_from
from churnlens.plans.oracle import PROFILE_COLS, cols, rules_sql, with_base
from churnlens.plans.registry import register

_PROFILE = cols(PROFILE_COLS)


def _distinct(spark, sf_dir):
    return S.dedup(S.cast_columns(S.drop_meta(bronze_from(spark, sf_dir))))


@register("silver_drop_meta", with_base("SELECT * EXCLUDE (\"CustomerID\", _source_file) FROM bronze_rows"))
def silver_drop_meta_q(spark, sf_dir):
    return S.drop_meta(bronze_from(spark, sf_dir))


@register("silver_cast", with_base("SELECT * FROM casted"))
def silver_cast_q(spark, sf_dir):
    return S.cast_columns(S.drop_meta(bronze_from(spark, sf_dir)))


@register("silver_dedup", with_base("SELECT * FROM distinct_rows"))
def silver_dedup_q(spark, sf_dir):
    return _distinct(spark, sf_dir)


def _single(name, column_fn, sql_expr):
    @register(name, with_base(f"SELECT {_PROFILE}, {sql_expr} AS {name} FROM distinct_rows"))
    def q(spark, sf_dir):
        return _distinct(spark, sf_dir).withColumn(name, column_fn())
    q.__name__ = f"{name}_q"
    return q


_single("support_calls_per_tenure", S.support_calls_per_tenure,
        'CASE WHEN "Tenure" > 0 THEN support_calls / "Tenure" ELSE CAST(support_calls AS DOUBLE) END')
_single("spend_per_tenure", S.spend_per_tenure,
        'CASE WHEN "Tenure" > 0 THEN total_spend / "Tenure" ELSE CAST(total_spend AS DOUBLE) END')
_single("is_new_client", S.is_new_client, f'CAST("Tenure" <= {C.NEW_CLIENT_MAX_TENURE} AS INTEGER)')
_single("high_friction", S.high_friction, f"CAST(support_calls >= {C.HIGH_FRICTION_MIN_CALLS} AS INTEGER)")
_single("high_payment_delay", S.high_payment_delay,
        f"CAST(payment_delay >= {C.HIGH_DELAY_MIN_DAYS} AS INTEGER)")
_single("is_inactive", S.is_inactive, f"CAST(last_interaction > {C.INACTIVE_MIN_DAYS} AS INTEGER)")
_single("risk_score_flags", S.risk_score_flags,
        f'CAST("Tenure" <= {C.NEW_CLIENT_MAX_TENURE} AS INTEGER)'
        f" + CAST(support_calls >= {C.HIGH_FRICTION_MIN_CALLS} AS INTEGER)"
        f" + CAST(payment_delay >= {C.HIGH_DELAY_MIN_DAYS} AS INTEGER)"
        f" + CAST(last_interaction > {C.INACTIVE_MIN_DAYS} AS INTEGER)")


@register("expect_drop", with_base("SELECT * FROM silver"))
def expect_drop_q(spark, sf_dir):
    return Q.expect_drop(unfiltered_from(spark, sf_dir))


@register("silver", with_base("SELECT * FROM silver"))
def silver_q(spark, sf_dir):
    return silver_from(spark, sf_dir)


_METRICS_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS rule, CAST(count(*) FILTER (WHERE NOT {e}) AS BIGINT) AS failed, "
    f"CAST(count(*) AS BIGINT) AS total, "
    f"CAST(count(*) FILTER (WHERE {' AND '.join(rules_sql().values())}) AS BIGINT) AS kept, "
    f"CAST(count(*) FILTER (WHERE NOT ({' AND '.join(rules_sql().values())})) AS BIGINT) AS dropped "
    f"FROM unfiltered"
    for n, e in rules_sql().items())


@register("expect_metrics", with_base(_METRICS_SQL))
def expect_metrics_q(spark, sf_dir):
    return Q.expect_metrics(unfiltered_from(spark, sf_dir))


_VIOLATIONS_SQL = ("concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT {e} THEN '{n}' END" for n, e in rules_sql().items()) + ")")


@register("expect_violations", with_base(f"""
SELECT * FROM (SELECT *, {_VIOLATIONS_SQL} AS violations FROM unfiltered) WHERE violations <> ''"""))
def expect_violations_q(spark, sf_dir):
    return Q.expect_violations(unfiltered_from(spark, sf_dir))


@register("gold_features", with_base("SELECT * FROM gold"))
def gold_features_q(spark, sf_dir):
    return gold_features(silver_from(spark, sf_dir))


@register("target_distribution", with_base(
    'SELECT "Churn", CAST(count(*) AS BIGINT) AS n FROM gold GROUP BY "Churn"'))
def target_distribution_q(spark, sf_dir):
    return gold_from(spark, sf_dir).groupBy(C.TARGET).agg(F.count(F.lit(1)).alias("n"))
