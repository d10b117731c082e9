from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from churnlens.llm import divergence
from churnlens.llm.divergence import Divergence, collapsed, source_divergence
from tests.conftest import SF_SMALL
from tests.llm.frames import awkward, none, words

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=3, top=200):
    """The definition, term by term over every kept term."""
    docs = [(la or "", s or "", Counter(TERM.findall((t or "").translate(LOWER)))) for la, s, t in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = sorted(t for t in df if df[t] >= min_docs)
        counts = defaultdict(Counter)
        for _, s, c in own:
            counts[s].update({t: n for t, n in c.items() if df[t] >= min_docs})
        whole = sum((counts[s] for s in counts), Counter())

        def share(c, t):
            return 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for a in counts:
            pairs = [(-sum((share(counts[a], t) - share(counts[b], t)) ** 2 // share(counts[b], t) for t in kept), b)
                     for b in counts if b != a]
            terms = []
            for t in kept:
                p, q = share(counts[a], t), share(whole, t)
                if counts[a][t] and p > q:
                    terms.append((-((p - q) ** 2 // q), t.encode(), t))
            out |= {(lang, a, "pair", b, -v, k + 1) for k, (v, b) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())))}
            out |= {(lang, a, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(terms)[:top])}
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def rows():
    text = [" ".join(words(i, 60, 90)) for i in range(40)]
    made = [("en" if i % 3 else "fr", f"s{i % 7}", text[i]) for i in range(40)]
    made += [("en", "s1", text[3])] * 30 + [("en", "s2", text[3])] * 5 + [("en", "s3", text[3]), (None, None, text[3])]
    made += [("de", "x", "un deux"), ("de", "y", ""), ("de", "y", None), ("en", "empty", "123 +-"), ("zh", "one", "漢字 漢字 É é E")] * 3
    return made


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string")


def test_equals_definition(spark, rows):
    assert got(source_divergence(frame(spark, rows))) == brute(rows)


def test_small_limits_and_flushes(spark, rows):
    """A task that passes its counts on early, other parameters, one row a partition."""
    p = Divergence(min_docs=1, top_terms=3, held_terms=10)
    assert got(source_divergence(frame(spark, rows).repartition(20), p)) == brute(rows, 1, 3)


def test_copies_are_one_text(spark, rows):
    found = collapsed(frame(spark, rows).fillna("")).collect()
    assert len(found) == len({(la or "", t or "") for la, _, t in rows})
    assert sum(c["n"] for r in found for c in r["copies"]) == len(rows)


def test_awkward_and_long(spark):
    docs = awkward(spark, [(20, "été " * 400_000 + "Z" * 2_000_000, "fr", "a")] * 3)
    rows = [tuple(r) for r in docs.select("lang", "source", "text").collect()]
    assert got(source_divergence(docs)) == brute(rows)
    assert source_divergence(none(spark)).count() == 0


def test_small_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("lang", "source", "text").collect()]
    assert got(source_divergence(docs)) == brute(rows)


def test_shares_are_exact_beyond_long(spark):
    p = Divergence()
    row = spark.range(1).select(divergence._share(F.lit(10 ** 12), F.lit(3 * 10 ** 12), F.lit(7), p).alias("p")).first()
    assert row["p"] == 1 + 10 ** 9 * (10 ** 12 + 1) // (3 * 10 ** 12 + 7)
