"""Queries for feature preparation (G12-G14, F1-F4, F8): statistics are fitted
on the training split and applied to every gold row."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import prep as PR
from churnlens.plans.medallion import split_from
from churnlens.plans.oracle import q, with_base
from churnlens.plans.registry import register

NUM, CAT = C.NUM_FEATURES, C.CAT_FEATURES
GOLD_ALL = C.ALL_FEATURES + [C.TARGET]
#: Categories of the portfolio's categorical columns, by definition of the
#: adapter (sorted; the first one is the dropped reference level).
ORACLE_CATEGORIES = {
    "Gender": ["Female", "Male"],
    "subscription_type": ["Basic", "Premium", "Standard"],
    "contract_length": ["Annual", "Monthly", "Quarterly"],
}


def _split(spark, sf_dir):
    return split_from(spark, sf_dir)


def _train(spark, sf_dir):
    return _split(spark, sf_dir).filter(F.col("split") == "train")


def _fitted(spark, sf_dir):
    df = _split(spark, sf_dir)
    stats = PR.fit_prep(df.filter(F.col("split") == "train"))
    return df.drop("split", "fold"), stats


_MED = "med AS (SELECT " + ", ".join(
    f"CAST(median({q(c)}) AS DOUBLE) AS {q('med_' + c)}" for c in NUM) + " FROM train)"
_MODE = ",\n".join(
    f"mode_{i} AS (SELECT {q(c)} AS v FROM train WHERE {q(c)} IS NOT NULL "
    f"GROUP BY {q(c)} ORDER BY count(*) DESC, {q(c)} LIMIT 1)" for i, c in enumerate(CAT))


def _imputed_select(src: str) -> str:
    nums = ", ".join(f"coalesce(CAST({src}.{q(c)} AS DOUBLE), med.{q('med_' + c)}) AS {q(c)}" for c in NUM)
    cats = ", ".join(f"coalesce({src}.{q(c)}, (SELECT v FROM mode_{i})) AS {q(c)}"
                     for i, c in enumerate(CAT))
    return f"SELECT {nums}, {cats}, {src}.\"Churn\" FROM {src}, med"


_MOM = "mom AS (SELECT " + ", ".join(
    f"avg({q(c)}) AS {q('m_' + c)}, stddev_pop({q(c)}) AS {q('s_' + c)}" for c in NUM) + " FROM imp_train)"
_PREP_CTES = f"""
{_MED},
{_MODE},
imp_train AS ({_imputed_select('train')}),
imp_all AS ({_imputed_select('split')}),
{_MOM}
"""


def _std_expr(c: str) -> str:
    s = q("s_" + c)
    return (f"round(({q(c)} - {q('m_' + c)}) / CASE WHEN {s} IS NULL OR {s} = 0 THEN 1.0 ELSE {s} END, 6)"
            f" AS {q(c)}")


def _dummies_sql() -> str:
    return ", ".join(f"CAST(coalesce({q(c)} = '{v}', false) AS INTEGER) AS {q(c + '_' + v)}"
                     for c, vals in ORACLE_CATEGORIES.items() for v in vals[1:])


@register("numeric_median", with_base(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {q('med_' + c)} AS median FROM med" for c in NUM), _MED))
def numeric_median_q(spark, sf_dir):
    med = PR.numeric_medians(_train(spark, sf_dir), NUM)
    return spark.createDataFrame(list(med.items()), "feature string, median double")


@register("category_mode", with_base(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, v AS mode FROM mode_{i}" for i, c in enumerate(CAT)), _MODE))
def category_mode_q(spark, sf_dir):
    return PR.category_mode_rows(_train(spark, sf_dir), CAT)


@register("numeric_moments", with_base(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {q('med_' + c)} AS median, round({q('m_' + c)}, 6) AS mean, "
    f"round({q('s_' + c)}, 6) AS std FROM med, mom" for c in NUM), _PREP_CTES))
def numeric_moments_q(spark, sf_dir):
    train = _train(spark, sf_dir)
    med = PR.numeric_medians(train, NUM)
    imputed = PR.impute(train.select(*NUM), med, {})
    aggs = []
    for c in NUM:
        aggs += [F.lit(med[c]).cast("double").alias(f"md_{c}"),
                 F.round(F.avg(c), 6).alias(f"m_{c}"), F.round(F.stddev_pop(c), 6).alias(f"s_{c}")]
    return imputed.agg(*aggs).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"md_{c}").alias("median"),
                 F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std")) for c in NUM
    ])).alias("kv")).select("kv.*")


_NUM_RAW = ", ".join(f"split.{q(c)}" for c in NUM)
_CAT_RAW = ", ".join(f"split.{q(c)}" for c in CAT)
_NUM_IMP = ", ".join(f"coalesce(CAST(split.{q(c)} AS DOUBLE), med.{q('med_' + c)}) AS {q(c)}" for c in NUM)
_CAT_IMP = ", ".join(f"coalesce(split.{q(c)}, (SELECT v FROM mode_{i})) AS {q(c)}"
                     for i, c in enumerate(CAT))


@register("impute_numeric", with_base(
    f'SELECT {_NUM_IMP}, {_CAT_RAW}, split."Churn" FROM split, med', _PREP_CTES))
def impute_numeric_q(spark, sf_dir):
    return PR.impute(_split(spark, sf_dir).drop("split", "fold"),
                     PR.numeric_medians(_train(spark, sf_dir), NUM), {})


@register("impute_category", with_base(
    f'SELECT {_NUM_RAW}, {_CAT_IMP}, split."Churn" FROM split', _PREP_CTES))
def impute_category_q(spark, sf_dir):
    return PR.impute(_split(spark, sf_dir).drop("split", "fold"), {},
                     PR.category_modes(_train(spark, sf_dir), CAT))


@register("standardize", with_base(
    "SELECT " + ", ".join(_std_expr(c) for c in NUM) + ", " + ", ".join(q(c) for c in CAT)
    + ', "Churn" FROM imp_all, mom', _PREP_CTES))
def standardize_q(spark, sf_dir):
    df, stats = _fitted(spark, sf_dir)
    out = PR.standardize(PR.impute(df, stats.medians, stats.modes), stats, digits=6)
    return out.select(*NUM, *CAT, C.TARGET)


@register("onehot_drop_first", with_base(
    "SELECT " + ", ".join(q(c) for c in CAT) + ", " + _dummies_sql() + ', "Churn" FROM imp_all',
    _PREP_CTES))
def onehot_drop_first_q(spark, sf_dir):
    train = _train(spark, sf_dir)
    stats = PR.PrepStats({}, PR.category_modes(train, CAT), {}, {}, PR.category_values(train, CAT))
    out = PR.onehot_drop_first(PR.impute(_split(spark, sf_dir).drop("split", "fold"), {}, stats.modes), stats)
    return out.select(*CAT, *stats.dummy_columns(), C.TARGET)


@register("column_transform", with_base(
    "SELECT " + ", ".join(_std_expr(c) for c in NUM) + ", " + _dummies_sql() + " FROM imp_all, mom",
    _PREP_CTES))
def column_transform_q(spark, sf_dir):
    df, stats = _fitted(spark, sf_dir)
    return PR.apply_prep(df, stats, digits=6)


# ------------------------------------------------- Spark-ML indexing

def _indexed(spark, sf_dir):
    """Indexers and encoder fitted on the training split, applied to all rows."""
    from pyspark.ml import Pipeline

    from churnlens.operators.models import native_stages

    df = _split(spark, sf_dir)
    stages = native_stages()
    model = Pipeline(stages=stages).fit(df.filter(F.col("split") == "train"))
    return model.transform(df.drop("split", "fold"))


_RANKS = ",\n".join(
    f"rank_{i} AS (SELECT {q(c)} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {q(c)}) - 1 AS DOUBLE)"
    f" AS idx FROM train WHERE {q(c)} IS NOT NULL GROUP BY {q(c)})" for i, c in enumerate(CAT))
_IDX = ", ".join(
    f"coalesce(r{i}.idx, (SELECT CAST(count(*) AS DOUBLE) FROM rank_{i})) AS {q(c + '__idx')}"
    for i, c in enumerate(CAT))
_JOINS = " ".join(f"LEFT JOIN rank_{i} r{i} ON split.{q(c)} = r{i}.v" for i, c in enumerate(CAT))


@register("string_index", with_base(
    f"SELECT {', '.join('split.' + q(c) for c in GOLD_ALL)}, {_IDX} FROM split {_JOINS}", _RANKS))
def string_index_q(spark, sf_dir):
    out = _indexed(spark, sf_dir)
    return out.select(*GOLD_ALL, *[c + "__idx" for c in CAT])


_OHE = ", ".join(
    f"array_to_string([CASE WHEN coalesce(r{i}.idx, -1) = k THEN 1 ELSE 0 END "
    f"FOR k IN range((SELECT count(*) FROM rank_{i}))], ',') AS {q(c + '__ohe')}"
    for i, c in enumerate(CAT))


@register("onehot_keep", with_base(
    f"SELECT {', '.join('split.' + q(c) for c in GOLD_ALL)}, {_OHE} FROM split {_JOINS}", _RANKS))
def onehot_keep_q(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    out = _indexed(spark, sf_dir)
    flat = {c + "__ohe": F.array_join(F.transform(vector_to_array(c + "__ohe"),
                                                  lambda x: x.cast("int")), ",") for c in CAT}
    return out.select(*GOLD_ALL, *[flat[c + "__ohe"].alias(c + "__ohe") for c in CAT])


_SLOTS = " || ',' || ".join(
    f"array_to_string([CASE WHEN coalesce(r{i}.idx, -1) = k THEN 1 ELSE 0 END "
    f"FOR k IN range((SELECT count(*) FROM rank_{i}))], ',')" for i in range(len(CAT)))
_FILLED = ", ".join(
    f"coalesce(CAST(split.{q(c)} AS DOUBLE), med.{q('med_' + c)}) AS {q('f_' + c)}" for c in NUM)


@register("assemble", with_base(
    f"SELECT {', '.join('split.' + q(c) for c in GOLD_ALL)}, {_FILLED}, {_SLOTS} AS onehot "
    f"FROM split {_JOINS}, med", f"{_MED},\n{_RANKS}"))
def assemble_q(spark, sf_dir):
    """The assembled vector, its numeric slots as columns and the rest as text."""
    from pyspark.ml.functions import vector_to_array

    out = _indexed(spark, sf_dir).withColumn("_v", vector_to_array("features"))
    n = len(NUM)
    return out.select(
        *GOLD_ALL, *[F.get("_v", F.lit(i)).alias(f"f_{c}") for i, c in enumerate(NUM)],
        F.array_join(F.transform(F.slice("_v", F.lit(n + 1), F.size("_v") - n), lambda x: x.cast("int")),
                     ",").alias("onehot"))
