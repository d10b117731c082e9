from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from churnlens.llm import shingles as S
from churnlens.llm.components import connected_components
from churnlens.llm.near_dup import NearDup, estimate, near_duplicates, pack
from tests.llm.frames import awkward, none, words


def shingle_set(text, lower=True):
    w = (text or "").encode()
    w = (w.lower() if lower else w).split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent):
    """Component of every (id, text) with an id, by comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_shingles_match_python():
    rng = random.Random(4)
    texts = [None, "", "a", "A  b\tc", "\x00 x", *[" ".join(rng.choice("abc") * rng.randint(1, 3)
             for _ in range(rng.randint(0, 25))) for _ in range(200)]]
    seen = {}
    for row, hashes in S.text_shingles(pa.array(texts), S.SPACE_WORDS, 5):
        w = (texts[row] or "").encode().lower().split()
        want = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])
        assert len(hashes) == len(want)
        for one, h in zip(want, hashes.tolist()):
            assert seen.setdefault(one, h) == h
    assert len(set(seen.values())) == len(seen)


def test_sliced_and_null_columns():
    column = pa.array(["x y", None, "a b c d e f", "z"]).slice(1, 2)
    assert [len(h) for _, h in S.text_shingles(column, S.SPACE_WORDS, 5)] == [0, 2]


def test_estimate_is_corrected_for_collisions():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 1 << 32, 4096, dtype=np.uint32) for _ in range(2))
    same = rng.random(4096) < 0.7
    c = np.where(same, a, b)
    of = lambda x: np.frombuffer(pack(x, 2), dtype=np.uint8)
    near, far, equal = estimate(of(a), np.array([of(c), of(b), of(a)]), 2, 4096)
    assert abs(near - same.mean()) < 0.05 and abs(far) < 0.05 and equal == 1


@pytest.mark.parametrize("block_docs", [256, 3])
def test_components_equal_brute_force(spark, block_docs):
    """A cloud of edited copies, in one block and in many."""
    rng = random.Random(9)
    base = words(5, 150)
    rows = []
    for i in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(1000)}"
        rows.append((i * 3, " ".join(copy)))
    rows += [(1000 + i, " ".join(words(100 + i, 60))) for i in range(10)] + [(2000, rows[4][1])]
    rng.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"),
                          NearDup(percent=85, block_docs=block_docs)).collect()
    want = brute(rows, 85)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert len({*want.values()}) not in (1, len(want))
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingle_set(t)) for i, t in rows}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_one_id_with_several_texts(spark):
    """Every text is linked by itself, whatever other texts its id has."""
    b, c = " ".join(words(21, 120)), " ".join(words(22, 120))
    rows = [(1, b), (1, c), (2, c + " more"), (3, b + " more"), (4, " ".join(words(23, 80)))] + [
        (9, " ".join(words(200 + i, 40))) for i in range(60)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), NearDup(percent=85)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert (by[1], by[2], by[3], by[4], by[9]) == (1, 1, 1, 4, 9)


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = near_duplicates(docs, NearDup(percent=85)).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[5]["component_id"] == by[6]["component_id"] == 5  # A-Z are lower-cased
    assert [by[i]["component_id"] for i in (8, 9, 10)] == [8, 8, 8] and by[8]["kept"] and not by[9]["kept"]
    assert all(by[i]["n_shingles"] == 0 and by[i]["kept"] for i in (1, 2, 3))
    assert Counter(r["component_id"] for r in got if r["doc_id"] is None) == {None: 2}
    assert all(r["kept"] for r in got if r["doc_id"] is None)
    assert near_duplicates(none(spark)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(40)] + [(7, 7)]
    got = connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert {r["vertex"]: r["component"] for r in got.collect()} == {
        **{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(40)}}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []
