"""Incremental bronze ingest: same rows as batch, each file exactly once."""

from __future__ import annotations

import os

from churnlens import config as C
from churnlens.streaming.ingest import run_bronze_ingest
from tests.test_fixture_rows import HEADER, TEST_ROWS, TRAIN_ROWS


def test_stream_ingest_is_incremental(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "bronze"
    landing.mkdir()
    (landing / C.TRAIN_FILE).write_text("\n".join([HEADER, *TRAIN_ROWS]) + "\n")
    run_bronze_ingest(spark, str(landing), str(out / "data"), str(out / "ckpt"))
    first = spark.read.parquet(str(out / "data"))
    assert first.count() == len(TRAIN_ROWS)
    assert {r["_source_file"] for r in first.select("_source_file").distinct().collect()} == {C.TRAIN_FILE}

    (landing / C.TEST_FILE).write_text("\n".join([HEADER, *TEST_ROWS]) + "\n")
    run_bronze_ingest(spark, str(landing), str(out / "data"), str(out / "ckpt"))
    both = spark.read.parquet(str(out / "data"))
    assert both.count() == len(TRAIN_ROWS) + len(TEST_ROWS)
    assert "usage_frequency" in both.columns and both.filter("_ingestion_time IS NULL").count() == 0
    assert os.path.isdir(out / "ckpt")
