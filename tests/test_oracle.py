"""Every SQL-checked query against its DuckDB text on sf0.001 (the driver's
correctness gate runs the same comparison at sf0.01: tools/oracle_check.py)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
#: Keys behind a whole hyper-parameter search: minutes of tree fits at any size.
#: tools/oracle_check.py runs them; test_models.py tests their parts on small searches.
SEARCHES = {"cv_grid", "cv_random", "best_params", "predict", "score_portfolio", "score_tags", "scores_roundtrip",
            "feature_importance", "importance_topk", "mean_abs_attribution", "run_log", "model_comparison"}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k not in SEARCHES}


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    rel = duck.sql(ORACLES[name])
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    got = sdf.toPandas()
    want = rel.df()
    gn, gr = rows_of(got)
    wn, wr = rows_of(want)
    assert gn == wn
    assert len(got) == len(want)
    assert gr == wr


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["nivel_riesgo", "n"]
    assert sum(r["n"] for r in rows) == 130
