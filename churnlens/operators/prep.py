"""Feature preparation fitted on training rows: impute, standardise, one-hot.

``fit_prep`` computes small statistics (one number per column, or the list of
categories of a categorical column) with distributed aggregates; only those
reach the driver.  ``apply_prep`` is then a single projection of literals,
so transforming any number of rows is a map-only stage.

* numeric NULL -> training median (exact, interpolated; ``quantiles``);
* categorical NULL -> most frequent training value (ties -> smallest);
* numeric -> (x - mean) / population std (std 0 -> divide by 1);
* categorical -> one 0/1 column per category except the alphabetically
  first; an unseen category gives all zeros.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators.quantiles import finite, percentile_cont_many


@dataclass
class PrepStats:
    medians: dict[str, float]
    modes: dict[str, str]
    means: dict[str, float]
    stds: dict[str, float]
    categories: dict[str, list[str]]

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> PrepStats:
        return PrepStats(**json.loads(text))

    def dummy_columns(self) -> list[str]:
        return [f"{c}_{v}" for c, values in self.categories.items() for v in values[1:]]


def numeric_medians(df: DataFrame, columns: list[str] = C.NUM_FEATURES) -> dict[str, float]:
    return percentile_cont_many(df, columns, 0.5)


def _category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, n) of every non-NULL value of the columns."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("kv")).select("kv.*").filter(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def category_mode_rows(df: DataFrame, columns: list[str] = C.CAT_FEATURES) -> DataFrame:
    """(feature, mode), one row per column with a value: the most frequent
    value, the smallest on ties.  No list of categories is gathered."""
    return (_category_counts(df, columns).groupBy("feature")
            .agg(F.min(F.struct((-F.col("n")).alias("minus"), "value"))["value"].alias("mode")))


def category_modes(df: DataFrame, columns: list[str] = C.CAT_FEATURES) -> dict[str, str]:
    """Most frequent non-NULL value per column, smallest value on ties."""
    found = {r["feature"]: r["mode"] for r in category_mode_rows(df, columns).collect()}
    return {c: found.get(c) for c in columns}


def category_values(df: DataFrame, columns: list[str] = C.CAT_FEATURES) -> dict[str, list[str]]:
    """Sorted distinct values per column: as many as the one-hot columns that
    are made of them."""
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in _category_counts(df, columns).select("feature", "value").collect():
        out[r["feature"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


def modes_and_values(df: DataFrame, columns: list[str] = C.CAT_FEATURES) -> tuple[dict[str, str], dict[str, list[str]]]:
    """``category_modes`` and ``category_values`` from one count."""
    found: dict[str, list[tuple[int, str]]] = {c: [] for c in columns}
    for r in _category_counts(df, columns).collect():
        found[r["feature"]].append((-r["n"], r["value"]))
    return ({c: min(v)[1] if v else None for c, v in found.items()},
            {c: sorted(x for _, x in v) for c, v in found.items()})


def number(c: str) -> Column:
    """The column as a finite double, else NULL."""
    return finite(F.col(c).cast("double"), "double")


def impute(df: DataFrame, medians: dict[str, float], modes: dict[str, str]) -> DataFrame:
    """NULL, NaN or infinite numerics -> median (as double); NULL categories -> mode."""
    cols = {c: F.coalesce(number(c), F.lit(m)) for c, m in medians.items() if m is not None}
    cols.update({c: F.coalesce(F.col(c), F.lit(m)) for c, m in modes.items() if m is not None})
    return df.withColumns(cols)


def numeric_moments(df: DataFrame, columns: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Mean and population standard deviation of each column's finite values
    (one aggregate)."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(number(c)).alias(f"m{i}"), F.stddev_pop(number(c)).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return ({c: row[f"m{i}"] for i, c in enumerate(columns)},
            {c: row[f"s{i}"] for i, c in enumerate(columns)})


def fit_prep(train: DataFrame, num: list[str] = C.NUM_FEATURES,
             cat: list[str] = C.CAT_FEATURES) -> PrepStats:
    """Fit every statistic on ``train``.  The 13 feature columns are persisted
    for the few bounded passes of the fit (lost blocks are recomputed from
    lineage) and released afterwards."""
    cols = train.select(*num, *cat).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        medians = numeric_medians(cols, num)
        # Imputing with the mode adds no new value, so the categories of the
        # imputed column are the distinct non-NULL values counted here.
        modes, categories = modes_and_values(cols, cat)
        means, stds = numeric_moments(impute(cols, medians, modes), num)
        return PrepStats(medians, modes, means, stds, categories)
    finally:
        cols.unpersist()


def standardize(df: DataFrame, stats: PrepStats, digits: int | None = None) -> DataFrame:
    cols = {}
    for c, m in stats.means.items():
        s = stats.stds[c]
        scale = 1.0 if (s is None or s == 0.0) else s
        v = (F.col(c).cast("double") - F.lit(m)) / F.lit(scale)
        cols[c] = F.round(v, digits) if digits is not None else v
    return df.withColumns(cols)


def onehot_drop_first(df: DataFrame, stats: PrepStats, drop_source: bool = False) -> DataFrame:
    cols = {f"{c}_{v}": (F.col(c) == F.lit(v)).cast("int")
            for c, values in stats.categories.items() for v in values[1:]}
    for name in cols:  # unseen categories and NULL give 0
        cols[name] = F.coalesce(cols[name], F.lit(0))
    out = df.withColumns(cols)
    return out.drop(*stats.categories) if drop_source else out


def apply_prep(df: DataFrame, stats: PrepStats, digits: int | None = None,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """The full column transform: imputed + standardised numerics and the
    drop-first dummies; other columns are dropped unless listed in ``keep``."""
    out = with_prepared(df, stats)
    names = {PREPARED_PREFIX + c: c for c in [*stats.means, *stats.dummy_columns()]}
    rounded = {p: F.round(p, digits) if digits is not None and c in stats.means else F.col(p)
               for p, c in names.items()}
    return out.select(*[rounded[p].alias(c) for p, c in names.items()], *keep)


PREPARED_PREFIX = "__p_"


def prepared_columns(stats: PrepStats, prefix: str = PREPARED_PREFIX) -> list[str]:
    return [prefix + c for c in stats.means] + [prefix + d for d in stats.dummy_columns()]


def with_prepared(df: DataFrame, stats: PrepStats, prefix: str = PREPARED_PREFIX) -> DataFrame:
    """``apply_prep`` into new ``prefix``-named columns, keeping the raw ones
    (so scores can carry the original feature values)."""
    cols = {}
    for c, m in stats.means.items():
        s = stats.stds[c]
        scale = 1.0 if (s is None or s == 0.0) else s
        filled = F.coalesce(number(c), F.lit(stats.medians[c]))
        cols[prefix + c] = (filled - F.lit(m)) / F.lit(scale)
    for c, values in stats.categories.items():
        filled = F.coalesce(F.col(c), F.lit(stats.modes[c]))
        for v in values[1:]:
            cols[prefix + f"{c}_{v}"] = F.coalesce((filled == F.lit(v)).cast("int"), F.lit(0))
    return df.withColumns(cols)


# --------------------------------------------- as a Spark ML pipeline stage

from pyspark import keyword_only  # noqa: E402
from pyspark.ml import Estimator, Model  # noqa: E402
from pyspark.ml.feature import VectorAssembler  # noqa: E402
from pyspark.ml.param import Param, Params, TypeConverters  # noqa: E402
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable  # noqa: E402


class _PrepParams(Params):
    numCols = Param(Params._dummy(), "numCols", "numeric feature columns",
                    typeConverter=TypeConverters.toListString)
    catCols = Param(Params._dummy(), "catCols", "categorical feature columns",
                    typeConverter=TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector column",
                      typeConverter=TypeConverters.toString)


class ColumnPrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """The column transform as a pipeline stage, so a ``CrossValidator``
    refits it inside every fold (fit = ``fit_prep``: distributed aggregates
    with small results; the model is a projection plus assembly)."""

    @keyword_only
    def __init__(self, *, numCols=None, catCols=None, outputCol="features"):
        super().__init__()
        self._setDefault(numCols=list(C.NUM_FEATURES), catCols=list(C.CAT_FEATURES),
                         outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ColumnPrepModel:
        stats = fit_prep(dataset, self.getOrDefault(self.numCols), self.getOrDefault(self.catCols))
        return ColumnPrepModel(statsJson=stats.to_json(), outputCol=self.getOrDefault(self.outputCol))


class ColumnPrepModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    statsJson = Param(Params._dummy(), "statsJson", "fitted statistics (JSON)",
                      typeConverter=TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector column",
                      typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, statsJson=None, outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**self._input_kwargs)

    def stats(self) -> PrepStats:
        return PrepStats.from_json(self.getOrDefault(self.statsJson))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stats = self.stats()
        prepared = with_prepared(dataset, stats)
        asm = VectorAssembler(inputCols=prepared_columns(stats),
                              outputCol=self.getOrDefault(self.outputCol), handleInvalid="keep")
        return asm.transform(prepared).drop(*prepared_columns(stats))


class MedianFill(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Exact medians of numeric columns as a pipeline stage (``ml.feature.Imputer``
    takes approximate ones that depend on the partitions)."""

    suffix = Param(Params._dummy(), "suffix", "suffix of the filled columns",
                   typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numCols=None, suffix="__imp"):
        super().__init__()
        self._setDefault(numCols=list(C.NUM_FEATURES), suffix="__imp")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MedianFillModel:
        medians = numeric_medians(dataset, self.getOrDefault(self.numCols))
        return MedianFillModel(statsJson=json.dumps(medians), suffix=self.getOrDefault(self.suffix))


class MedianFillModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    statsJson = Param(Params._dummy(), "statsJson", "medians (JSON)",
                      typeConverter=TypeConverters.toString)
    suffix = Param(Params._dummy(), "suffix", "suffix of the filled columns",
                   typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, statsJson=None, suffix="__imp"):
        super().__init__()
        self._setDefault(suffix="__imp")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        suffix = self.getOrDefault(self.suffix)
        return dataset.withColumns({
            c + suffix: F.coalesce(number(c), F.lit(m).cast("double"))
            for c, m in json.loads(self.getOrDefault(self.statsJson)).items()})
