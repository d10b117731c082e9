"""Silver layer: drop lineage columns, cast, de-duplicate, derive, apply rules.

Plan shape: Project(casts) -> HashAggregate(partial) -> Exchange ->
HashAggregate(final) -> Project(derived) -> Filter(rules).  Catalyst moves the
rule filter below the aggregate (all rule columns are grouping keys), so rows
failing a rule are discarded on the map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.functions.expressions import tolerant_cast
from churnlens.functions.expressions import flag, guarded_ratio
from churnlens.operators.quality import expect_drop

DERIVED_COLUMNS = [
    "support_calls_per_tenure", "spend_per_tenure", "is_new_client",
    "high_friction", "high_payment_delay", "is_inactive", "risk_score_flags",
]


def drop_meta(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop the customer id and the lineage columns (``keep`` retains some)."""
    return df.drop(*[c for c in C.META_COLUMNS if c not in keep])


def cast_columns(df: DataFrame, casts: dict[str, str] = C.CASTS) -> DataFrame:
    """Typed columns; text that does not parse, NaN and infinities become NULL,
    `30.0` is the whole number 30."""
    types = dict(df.dtypes)
    return df.withColumns({c: tolerant_cast(F.col(c), types[c], t) for c, t in casts.items() if c in types})


def dedup(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct rows (NULL equals NULL).  Partial aggregation collapses a hot
    duplicate group on the map side, so one profile repeated a billion times
    ships one row per map task."""
    return df.dropDuplicates(keys) if keys else df.dropDuplicates()


def support_calls_per_tenure() -> F.Column:
    return guarded_ratio("support_calls", "Tenure")


def spend_per_tenure() -> F.Column:
    return guarded_ratio("total_spend", "Tenure")


def is_new_client() -> F.Column:
    return flag(F.col("Tenure") <= C.NEW_CLIENT_MAX_TENURE)


def high_friction() -> F.Column:
    return flag(F.col("support_calls") >= C.HIGH_FRICTION_MIN_CALLS)


def high_payment_delay() -> F.Column:
    return flag(F.col("payment_delay") >= C.HIGH_DELAY_MIN_DAYS)


def is_inactive() -> F.Column:
    return flag(F.col("last_interaction") > C.INACTIVE_MIN_DAYS)


def risk_score_flags() -> F.Column:
    """Sum of the four flags; NULL when any flag is NULL."""
    return is_new_client() + high_friction() + high_payment_delay() + is_inactive()


def derive(df: DataFrame) -> DataFrame:
    """The seven business columns, in one projection."""
    return df.withColumns({
        "support_calls_per_tenure": support_calls_per_tenure(),
        "spend_per_tenure": spend_per_tenure(),
        "is_new_client": is_new_client(),
        "high_friction": high_friction(),
        "high_payment_delay": high_payment_delay(),
        "is_inactive": is_inactive(),
        "risk_score_flags": risk_score_flags(),
    })


def silver_unfiltered(bronze: DataFrame, keep: tuple[str, ...] = (),
                      dedup_keys: list[str] | None = None) -> DataFrame:
    """Silver before the quality rules (the frame the rule metrics read)."""
    return derive(dedup(cast_columns(drop_meta(bronze, keep)), dedup_keys))


def silver(bronze: DataFrame, rules: dict[str, str] = C.EXPECTATIONS,
           keep: tuple[str, ...] = (), dedup_keys: list[str] | None = None) -> DataFrame:
    """Clean, typed, distinct profiles with derived columns; rule failures dropped."""
    return expect_drop(silver_unfiltered(bronze, keep, dedup_keys), rules)
