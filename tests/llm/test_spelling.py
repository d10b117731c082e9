from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from churnlens.llm.spelling import Spelling, _search, near_words, paths, roots, spelling_variants
from tests.conftest import SF_SMALL
from tests.llm.frames import awkward, none

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, misprint):
    total = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if misprint and h % misprint == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    near = {w: [] for w in n}
    ordered = sorted(n, key=len)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if len(b) > len(a) + 1:
                break
            if one_edit(a, b):
                near[a].append(b), near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def variants(seed, count):
    rng = random.Random(seed)
    letters = "abeorstnéÉ"
    known = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(count // 3)}
    while len(known) < count:
        w = rng.choice(sorted(known)) if rng.random() < .2 else rng.choice(list(known))
        at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
        w = w[:at] + (rng.choice(letters) if kind else "") + w[at + (kind != 1):]
        if len(w) >= 5:
            known.add(w)
    return {w: rng.choice([3, 4, 6, 7, 14, 30, 200]) for w in sorted(known)}


@pytest.mark.parametrize("params", [Spelling(), Spelling(shard_words=20), Spelling(shard_words=1),
                                    Spelling(groups=2, shard_words=7), Spelling(groups=30, shard_words=50)])
def test_near_words_equal_all_pairs(spark, params):
    """One shard, many shards, shards of one word and paths with more words than a shard."""
    n = variants(3, 900)
    rows = got(near_words(spark.createDataFrame(list(n.items()), "word string, n long"), params))
    near = {w: (k, f, fn) for w, k, f, fn in rows}
    for w in n:
        own = [x for x in n if one_edit(w, x)]
        best = min(own, key=lambda x: (-n[x], x), default=None)
        assert near.get(w) == ((len(own), best, n[best]) if own else None)


def test_search_reaches_exactly_the_budget():
    words = sorted(variants(5, 400))
    every = paths(words, 6)
    order = np.lexsort(every.T[::-1])
    tree = every[order]
    found = set()
    for lo, hi, q, _ in _search(tree, every):
        found |= {(int(i), int(order[k])) for i in q for k in range(lo, hi)}
    for i, a in enumerate(every):
        for k, b in enumerate(every):
            d = b[1:] - a[1:]
            fits = (np.maximum(d, 0).sum() <= 1 and np.maximum(-d, 0).sum() <= 1 and tuple(b) >= tuple(a)
                    and b[0] - a[0] in (0, 1))
            assert ((i, k) in found) == bool(fits)


def test_documents_equal_definition(spark):
    rng = random.Random(9)
    n = variants(7, 120)
    words = [w for w, k in n.items() for _ in range(k)]
    rng.shuffle(words)
    rows = [(i, " ".join(w.upper() if rng.random() < .1 else w for w in words[i * 25:(i + 1) * 25]) + "’x1Ÿ")
            for i in range(len(words) // 25 + 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for p in (Spelling(), Spelling(misprint=3, held_words=50), Spelling(misprint=97)):
        assert got(spelling_variants(docs, p)) == brute(counted(rows, p.misprint))


def test_chains(spark):
    forms = [(f"w{i:03}", f"w{i + 1:03}") for i in range(37)] + [("a", "b")]
    ends = dict(got(roots(spark.createDataFrame(forms, "word string, form string"))))
    assert ends == {**{f"w{i:03}": "w037" for i in range(37)}, "a": "b"}


def test_awkward_long_and_empty(spark):
    long = "word" * 100_000
    docs = awkward(spark, [(30, f"{long} {long} {long}", "en", "a"), (31, f"{long}x " * 3 + "ÀÀÀÀÀ " * 3, "en", "a")])
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(spelling_variants(docs, Spelling(misprint=97))) == brute(counted(rows, 97))
    assert spelling_variants(none(spark)).count() == 0


def test_small_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(spelling_variants(docs, Spelling(misprint=97, shard_words=200))) == brute(counted(rows, 97))
