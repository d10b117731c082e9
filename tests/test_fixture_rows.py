"""Hand-made landing rows (FIXTURES.md section 2) through bronze -> silver -> gold."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import quality as Q
from churnlens.operators.bronze import bronze
from churnlens.operators.gold import gold_features
from churnlens.operators.silver import silver, silver_unfiltered
from churnlens.sources.landing import landing_inventory, read_csv, read_landing, typed

HEADER = ("CustomerID,Age,Gender,Tenure,Usage Frequency,Support Calls,Payment Delay,"
          "Subscription Type,Contract Length,Total Spend,Last Interaction,Churn")
TRAIN_ROWS = [
    "1,30,Female,39,14,5,18,Standard,Annual,932,17,1",
    "2,65,Female,0,1,10,8,Basic,Monthly,557.5,6,1",
    "3,65,Female,0,1,10,8,Basic,Monthly,557.5,6,1",
    "4,40,Male,5,,2,15,Premium,Quarterly,100,,0",
    ",,,,,,,,,,,",
]
TEST_ROWS = [
    "9,-1,Male,6,3,4,15,Premium,Quarterly,100,20,0",
    "10,22,Male,7,3,3,14,Premium,Annual,200,21,2",
    "11,x,Male,7,3,3,14,Premium,Annual,200,21,0",
    "1,30,Female,39,14,5,18,Standard,Annual,932,17,1",
]
EXPECTED_FAILED = {"churn_valido": 2, "age_no_nulo": 2, "tenure_no_nulo": 1,
                   "support_calls_no_nulo": 1, "payment_delay_no_nulo": 1,
                   "total_spend_no_nulo": 1, "age_no_negativa": 3, "tenure_no_negativa": 1}


def _write_landing(folder: str) -> str:
    for name, rows in ((C.TRAIN_FILE, TRAIN_ROWS), (C.TEST_FILE, TEST_ROWS)):
        with open(os.path.join(folder, name), "w") as fh:
            fh.write("\n".join([HEADER, *rows]) + "\n")
    return folder


@pytest.fixture(params=["typed", "text"])
def landed(request, spark, tmp_landing):
    folder = _write_landing(tmp_landing)
    parts = read_landing(spark, folder)
    return bronze({n: typed(df) if request.param == "typed" else df for n, df in parts.items()})


def test_bronze_rows_and_provenance(landed):
    assert landed.count() == 9
    per_file = {r["_source_file"]: r["n"] for r in
                landed.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_file == {C.TRAIN_FILE: 5, C.TEST_FILE: 4}
    assert landed.select(F.count_distinct("_ingestion_time")).first()[0] == 1
    assert "usage_frequency" in landed.columns and "Usage Frequency" not in landed.columns


def test_silver_keeps_three_profiles(landed):
    unfiltered = silver_unfiltered(landed)
    assert unfiltered.count() == 7
    kept = silver(landed).orderBy("Age").collect()
    assert len(kept) == 3
    by_tenure = {r["Tenure"]: r for r in kept}
    zero = by_tenure[0]
    assert zero["support_calls_per_tenure"] == 10.0 and zero["spend_per_tenure"] == 557.5
    row4 = by_tenure[5]
    assert row4["risk_score_flags"] is None and row4["is_inactive"] is None
    assert row4["high_payment_delay"] == 1 and row4["is_new_client"] == 1
    row1 = by_tenure[39]
    assert (row1["high_friction"], row1["high_payment_delay"], row1["risk_score_flags"]) == (1, 1, 2)


def test_rule_metrics(landed):
    rows = Q.expect_metrics(silver_unfiltered(landed)).collect()
    failed = {r["rule"]: r["failed"] for r in rows}
    assert failed == EXPECTED_FAILED
    assert {(r["total"], r["kept"], r["dropped"]) for r in rows} == {(7, 3, 4)}


def test_violations_are_the_dropped_rows(landed):
    v = Q.expect_violations(silver_unfiltered(landed)).collect()
    assert len(v) == 4
    all_null = [r for r in v if r["Churn"] is None and r["Tenure"] is None]
    assert len(all_null) == 1 and len(all_null[0]["violations"].split(",")) == 8


def test_gold_layout(landed):
    g = gold_features(silver(landed))
    assert g.columns == C.ALL_FEATURES + [C.TARGET]


def test_boundaries_other_side(spark):
    """Tenure 6 / calls 4 / delay 15 / last 20 flag; 7 / 3 / 14 / 21 flip."""
    from churnlens.operators.silver import derive

    df = spark.createDataFrame(
        [(6, 4, 15, 20, 10.0), (7, 3, 14, 21, 10.0)],
        "Tenure int, support_calls int, payment_delay int, last_interaction int, total_spend double")
    rows = derive(df).orderBy("Tenure").collect()
    a, b = rows
    assert (a["is_new_client"], a["high_friction"], a["high_payment_delay"], a["is_inactive"]) == (1, 1, 1, 0)
    assert (b["is_new_client"], b["high_friction"], b["high_payment_delay"], b["is_inactive"]) == (0, 0, 0, 1)


def test_landing_inventory(spark, tmp_landing):
    folder = _write_landing(tmp_landing)
    inv = {r["name"]: r["size"] for r in landing_inventory(spark, folder).collect()}
    assert set(inv) == {C.TRAIN_FILE, C.TEST_FILE}
    assert all(v > 0 for v in inv.values())


def test_landing_inventory_empty_folder(spark, tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    assert landing_inventory(spark, str(empty)).count() == 0


def test_single_pass_portfolio_equals_union_of_parts(spark):
    from churnlens.plans.medallion import bronze_from
    from churnlens.sources.portfolio import portfolio

    sf = "/root/testdata/sf0.001"
    a = bronze_from(spark, sf).drop("_ingestion_time")
    b = bronze(portfolio(spark, sf)).drop("_ingestion_time").select(*a.columns)
    assert a.count() == b.count() == 180
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_inferred_schemas_widen_in_the_union(spark, tmp_landing):
    """With inference the testing file's Age is text ('x'), the training
    file's is numeric; the union widens and silver's try_cast drops 'x'."""
    folder = _write_landing(tmp_landing)
    parts = read_landing(spark, folder, infer_schema=True)
    types = {name: dict(df.dtypes)["Age"] for name, df in parts.items()}
    assert types[C.TEST_FILE] == "string" and types[C.TRAIN_FILE] != "string"
    b = bronze(parts)
    assert b.count() == 9
    assert silver(b).count() == 3
    failed = {r["rule"]: r["failed"] for r in Q.expect_metrics(silver_unfiltered(b)).collect()}
    assert failed == EXPECTED_FAILED


def test_keep_customer_id_through_dedup(spark, tmp_landing):
    """Keeping the id makes customers 2 and 3 (same profile) two rows; the
    cross-file copy of customer 1 still collapses."""
    folder = _write_landing(tmp_landing)
    b = bronze(read_landing(spark, folder))
    assert silver(b).count() == 3
    with_ids = silver(b, keep=("CustomerID",))
    assert sorted(int(r["CustomerID"]) for r in with_ids.collect()) == [1, 2, 3, 4]
    g = gold_features(with_ids, extra=("CustomerID",))
    assert g.columns[-1] == "CustomerID" and g.count() == 4
    by_id = silver(b, keep=("CustomerID",), dedup_keys=["CustomerID"])
    assert sorted(int(r["CustomerID"]) for r in by_id.collect()) == [1, 2, 3, 4]


def test_check_landing_warns_on_empty(spark, tmp_path):
    from churnlens.sources.landing import check_landing

    empty = tmp_path / "nothing"
    empty.mkdir()
    with pytest.warns(UserWarning):
        assert check_landing(spark, str(empty)) == []
    folder = _write_landing(str(tmp_path))
    assert {n for n, _ in check_landing(spark, folder, "*.csv")} == {C.TRAIN_FILE, C.TEST_FILE}


PERMUTED = ("Churn,Age,CustomerID,Gender,Tenure,Usage Frequency,Support Calls,Payment Delay,"
            "Subscription Type,Contract Length,Last Interaction,Total Spend,Note")
AWKWARD = {
    "a.csv": [HEADER, "1,30.0,Female,39.0,14,5,18.0,Standard,Annual,932,17,1.0", "2,NaN,Female,1,1,1,1,Basic,Annual,5,1,0"],
    "b.csv": [PERMUTED, "0,41,7,Male,6,2,3,4,Basic,Monthly,9,55.5,x", "1,x,8,Male,6,2,3,4,Basic,Monthly,9,55.5,y",
              "1,42,9,Male,6,2,3,4,Basic,Monthly,9,NaN,z", "0,43,10,Male,6,2,3,4,Basic,Monthly,9,Infinity,z"],
    "C.CSV": [HEADER, "11,50,Male,12,1,1,1,Premium,Annual,77,3,0"],
    "d.csv.gz": [PERMUTED, '0,51,12,Male,13,1,1,1,"Pre,mium",Annual,4,88,w'],
    "e.csv": [],
}


def _awkward(folder) -> str:
    import gzip

    for name, lines in AWKWARD.items():
        data = "".join(x + "\n" for x in lines).encode()
        (folder / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    return str(folder)


def test_columns_go_by_header_and_whole_numbers_may_have_decimals(spark, tmp_path):
    from churnlens.streaming.ingest import run_bronze_ingest

    landing = tmp_path / "landing"
    landing.mkdir()
    folder = _awkward(landing)
    batch = read_csv(spark, folder)
    by = {r["CustomerID"]: r for r in batch.collect()}
    assert sorted(map(int, by)) == [1, 2, 7, 8, 9, 10, 11, 12]
    assert by["7"]["Age"] == "41" and by["8"]["Age"] == "x"  # raw text stays
    assert by["12"]["Subscription Type"] == "Pre,mium"
    kept = silver(bronze({"f": batch}), keep=("CustomerID",))
    assert sorted(int(r["CustomerID"]) for r in kept.collect()) == [1, 7, 11, 12]
    assert kept.filter("CustomerID = '1'").select("Age", "Tenure", "Churn").first() == (30, 39, 1)

    out = tmp_path / "bronze"
    assert run_bronze_ingest(spark, folder, str(out / "data"), str(out / "ckpt")) == 1
    stream = spark.read.parquet(str(out / "data"))
    want = bronze({"f": batch}).drop("_source_file", "_ingestion_time")
    got = stream.drop("_source_file", "_ingestion_time").select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert {r[0] for r in stream.select("_source_file").distinct().collect()} == set(AWKWARD) - {"e.csv"}


def test_missing_column_is_named(spark, tmp_path):
    (tmp_path / "x.csv").write_text("CustomerID,Age\n1,2\n")
    with pytest.raises(ValueError, match="Tenure"):
        read_csv(spark, str(tmp_path))


def test_inferred_types_that_disagree_lose_no_row(spark, tmp_path):
    for name, age in (("a.csv", "30.0"), ("b.csv", "x")):
        (tmp_path / name).write_text("\n".join([HEADER, f"1,{age},Male,39.0,14,5,18,Standard,Annual,932,17,1",
                                                f"2,31.0,Male,39.0,14,5,18,Standard,Annual,{len(name) if age == 'x' else 8},17,1"]) + "\n")
    parts = {n: read_csv(spark, str(tmp_path / n), infer_schema=True) for n in ("a.csv", "b.csv")}
    assert silver(bronze(parts)).count() == 3
