"""The pipeline against a brute-force version of every stage."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline as P
from churnlens.llm import queries as Q
from churnlens.llm.pii import Pseudonyms
from tests.llm.frames import awkward, none, words
from tests.llm.test_decontaminate import shingle_set as item_set
from tests.llm.test_near_dup import brute

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    good = con.execute("WITH " + Q.OP5_CTES.format(documents="documents")
                       + " SELECT doc_id, text FROM verdicts JOIN docs USING (r) WHERE kept").fetchall()
    component = brute(good, 80)
    items = [s for (t,) in con.execute("SELECT text FROM benchmark").fetchall() if (s := item_set(t))]
    kept = [(i, t) for i, t in good if component[i] == i]
    clean = [(i, t) for i, t in kept if all(100 * len(s & item_set(t)) < 80 * len(s) for s in items)]
    assert len(good) > len(kept) > len(clean) > 50
    pseudonyms = Pseudonyms(Q.PII_KEY)
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, t in clean:
        ids = tokenizer.encode(pseudonyms.replace(t)[0], add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            own = np.array(ids[at:at + 4096], "<u4")
            want.add((i, k, at, len(own), zlib.crc32(own.tobytes())))
    got = P.run(spark, SF).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    assert len(got) == len(want)
    ends: dict = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096


@pytest.mark.parametrize("name, stage", P.STAGES[:-1])
def test_stages_keep_columns_and_take_awkward_rows(spark, name, stage):
    docs = awkward(spark)
    got = stage(spark, docs, SF)
    assert got.columns == docs.columns
    assert [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    assert got.count() <= docs.count()
    empty = stage(spark, none(spark), SF)
    assert empty.columns == docs.columns and empty.collect() == []


def test_one_of_each_group_stays(spark):
    docs = awkward(spark)
    ids = sorted(r["doc_id"] or -1 for r in P.minhash_near_dup(spark, docs, SF).collect())
    assert ids == [-1, 1, 2, 3, 4, 5, 7, 8, 11]  # the copy without an id goes, the null text stays


def test_rows_without_an_id_are_deduplicated_too(spark):
    other = " ".join(words(77, 150))
    rows = [(None, other), (None, other), (None, other + " tail"), (5, " ".join(words(78, 150))),
            (None, " ".join(words(78, 150)) + " end"), (1, "a b"), (1, "c d")]
    made = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in P.minhash_near_dup(spark, made, SF).collect())
    assert [i for i, _ in got] == [0, 1, 1, 5]
    assert got[0][1] in (other, other + " tail")


def test_last_stage_packs_awkward_rows(spark):
    docs = awkward(spark)
    got = P.best_fit_packing(spark, docs, SF).collect()
    assert sum(r["piece"] == 0 for r in got) == docs.count()
    assert P.best_fit_packing(spark, none(spark), SF).collect() == []
