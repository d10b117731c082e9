"""Gold layer: the model-ready projection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from churnlens import config as C


def gold_features(silver: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """10 numeric + 3 categorical features and the target, in that order.

    ``extra`` passes further columns through (e.g. a customer key kept by
    ``silver(keep=...)`` so scores can be joined back)."""
    return silver.select(*C.ALL_FEATURES, C.TARGET, *extra)
