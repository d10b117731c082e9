"""Named data-quality rules: drop, metrics and quarantine.

A rule holds only when its predicate is TRUE; a NULL predicate counts as a
failure.  Metrics are one aggregate over the frame (a single scan with a
partial/final aggregate), never a separate count per rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.functions.expressions import all_rules_hold, rule_holds


def expect_drop(df: DataFrame, rules: dict[str, str] = C.EXPECTATIONS) -> DataFrame:
    """Keep the rows for which every rule holds."""
    return df.filter(all_rules_hold(rules))


def expect_metrics(df: DataFrame, rules: dict[str, str] = C.EXPECTATIONS) -> DataFrame:
    """One row per rule: failed rows, and the frame's total / kept / dropped.

    ``kept + dropped == total``; a row failing several rules is counted once
    in ``dropped`` and once per failed rule in ``failed``.
    """
    names = list(rules)
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(all_rules_hold(rules)).alias("kept")]
    aggs += [F.count_if(~rule_holds(rules[n])).alias(f"f{i}") for i, n in enumerate(names)]
    stacked = ", ".join(f"'{n}', f{i}" for i, n in enumerate(names))
    return df.agg(*aggs).selectExpr(
        f"stack({len(names)}, {stacked}) AS (rule, failed)",
        "total", "kept", "total - kept AS dropped",
    )


def violated_rules(rules: dict[str, str] = C.EXPECTATIONS):
    """Array of the names of the rules a row fails (empty when it passes)."""
    return F.array_compact(F.array(*[
        F.when(~rule_holds(expr), F.lit(name)) for name, expr in rules.items()
    ]))


def expect_violations(df: DataFrame, rules: dict[str, str] = C.EXPECTATIONS) -> DataFrame:
    """The dropped rows with the comma-joined names of the rules they fail."""
    return (
        df.withColumn("_violated", violated_rules(rules))
        .filter(F.size("_violated") > 0)
        .withColumn("violations", F.concat_ws(",", "_violated"))
        .drop("_violated")
    )
