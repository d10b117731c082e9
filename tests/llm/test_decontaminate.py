from __future__ import annotations

import re

import pytest

from churnlens.llm.decontaminate import Decontam, ItemIndex, contained_items, least_hits, size_class, without_items
from tests.llm.frames import awkward, none, words


def shingle_set(text):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def cases():
    items = [(i, " ".join(words(500 + i, 8 + 12 * i))) for i in range(8)] + [(100, None), (101, ""), (102, "just four words here")]
    docs = []
    for i, text in items[:8]:
        w = text.split()
        prose = words(900 + i, 700)
        docs.append((i, " ".join(prose[:300] + w + prose[300:])))  # whole
        docs.append((100 + i, " ".join(prose[:300]) + "\n" + text.upper().replace(" ", "!! ") + ", " + prose[0]))
        docs.append((200 + i, " ".join(prose + w[: len(w) * 6 // 10])))  # too little
        cut = len(w) * 17 // 20
        docs.append((300 + i, " ".join(w[:cut] + prose)))  # around the threshold
    docs += [(400, "Just four words, here!"), (401, "so just four words here too"), (402, None), (403, "")]
    return docs, items


@pytest.mark.parametrize("params", [Decontam(), Decontam(sketch=6, longer=3, miss=1e-6), Decontam(block_bytes=200)])
def test_equals_brute_force(spark, params):
    docs, items = cases()
    got = contained_items(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items + items[:1], "item_id long, text string"), params).collect()
    want = set()
    for i, t in docs:
        for j, u in items:
            s, d = shingle_set(u), shingle_set(t)
            if s and 100 * len(s & d) >= 80 * len(s):
                want.add((i, j, len(s), len(s & d)))
    assert {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in got} == want
    assert len(got) == len(want) > 16
    if params.sketch == 32:
        assert (400, 102, 1, 1) in want and not any(i == 401 for i, *_ in want)


def test_least_hits():
    assert least_hits(10, 32, 80, 1e-9) == 8
    assert 1 <= least_hits(1000, 32, 80, 1e-9) < 26
    assert least_hits(1, 32, 80, 1e-9) == 1


def test_size_classes():
    p = Decontam()
    assert [size_class(n, p) for n in (1, 32, 33, 64, 65, 128, 129, 32 << 9)] == [0, 0, 1, 1, 2, 2, 3, 9]


def test_recall_and_false_candidates_of_every_class():
    """Items of all classes, each in documents at 80 to 100 %: every one is found, and documents
    that hold 45 % seldom become candidates where sketches are samples."""
    import pyarrow as pa

    p = Decontam()
    sizes = (20, 60, 120, 250, 500, 1000, 2000)
    items = [words(7000 + i, n, 100_000) for i, n in enumerate(sizes)]
    index = ItemIndex(list(range(len(items))), pa.array([" ".join(w) for w in items]), p)
    assert len(index.classes) == len({size_class(len(s), p) for s in index.sets}) == len(sizes)
    for i, w in enumerate(items):
        docs, far = [], []
        for k in range(20):
            n = -(-len(w) * (82 + k % 19) // 100) + 4
            docs.append(" ".join(words(8000 + k, 300, 100_000) + w[:n]))
            far.append(" ".join(words(9000 + k, 300, 100_000) + w[: len(w) * 45 // 100]))
        found = {(d, j) for d, j, _ in index.search(pa.array(docs))}
        assert {(d, i) for d in range(20)} <= found  # recall 1 in this class
        assert not {(d, j) for d, j, _ in index.search(pa.array(far))}


def test_awkward_rows(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(1, " ".join(words(2, 120))), (None, "one"), (3, None)], "item_id long, text string")
    found = contained_items(docs, items).collect()
    assert sorted((r["doc_id"] or -1, r["item_id"] or -1) for r in found) == [
        (-1, 1), (4, -1), (8, 1), (8, 1), (9, 1), (10, 1)]
    rest = without_items(docs, items)
    assert rest.columns == docs.columns and rest.schema == docs.schema
    assert sorted(r["doc_id"] or -1 for r in rest.collect()) == [-1, 1, 2, 3, 5, 6, 7, 11]
    assert contained_items(none(spark), items).collect() == []
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert contained_items(docs, nothing).collect() == []
    assert without_items(docs, nothing).count() == docs.count()
