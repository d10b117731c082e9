"""As-of and interval joins with hot keys, streaming windows with late rows, cubes, histograms."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from churnlens.operators.evaluate import auc_from_histogram, merged_histogram, roc_from_histogram, score_histogram
from churnlens.operators.rollup import cube_counts, cube_estimates, sketched_groups
from churnlens.operators.temporal import asof_join, interval_join, sessions, sliding
from churnlens.streaming.windows import read_windows, run_windows

DAY = datetime(2024, 3, 1)


def at(minutes):
    return None if minutes is None else DAY + timedelta(minutes=minutes)


def hot_rows(seed, n):
    """Key 1 has more than a third of all rows, many of them at one time; nulls in key and time."""
    rng = random.Random(seed)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice([None, *range(0, 600, 3), *[300] * 60])) for i in range(n)]
    return [(i, k, m) for i, k, m in rows]


@pytest.mark.parametrize("blocks, within", [(1, None), (13, None), (13, "45 minutes")])
def test_asof_equals_brute_force(spark, blocks, within):
    left, right = hot_rows(1, 400), hot_rows(2, 150)
    left += left[:5]  # repeated rows
    a = spark.createDataFrame([(i, k, at(m)) for i, k, m in left], "id long, k int, t timestamp")
    b = spark.createDataFrame([(i, k, at(m)) for i, k, m in right], "rid long, rk int, rt timestamp")
    got = Counter(tuple(r) for r in asof_join(a, b, {"k": "rk"}, ("t", "rt"), ["rid", "rt"], ["rid"], within, blocks)
                  .select("id", "rid").collect())
    want = Counter()
    for i, k, m in left:
        fit = [(rm, rid) for rid, rk, rm in right if None not in (k, m, rm) and rk == k and rm <= m
               and (within is None or True)]
        best = max(fit, default=None)
        if best and within and m - best[0] > 45:
            best = None
        want[i, best[1] if best else None] += 1
    assert got == want


def test_asof_splits_a_hot_key(spark):
    """A key of all rows lands in many blocks, each of a share of them."""
    a = spark.range(3000).select("id", F.lit(1).alias("k"), F.col("id").alias("t"))
    b = spark.range(0, 3000, 50).select(F.lit(1).alias("rk"), F.col("id").alias("rt"), F.col("id").alias("rid"))
    out = asof_join(a, b, {"k": "rk"}, ("t", "rt"), ["rid"], blocks=10)
    assert all(r["rid"] == r["t"] // 50 * 50 for r in out.collect())
    with pytest.raises(ValueError, match="both sides: id"):
        asof_join(a, b.withColumn("id", F.lit(1)), {"k": "rk"}, ("t", "rt"), ["id"])
    empty = asof_join(a.limit(0), b, {"k": "rk"}, ("t", "rt"), ["rid"])
    assert empty.collect() == [] and empty.columns == ["id", "k", "t", "rid"]
    assert asof_join(a, b.limit(0), {"k": "rk"}, ("t", "rt"), ["rid"]).filter("rid is null").count() == 3000


@pytest.mark.parametrize("spread", [1, 400])
def test_intervals_equal_brute_force(spark, spread):
    """Lengths from a minute to the whole range; empty and inverted ones, nulls, a hot key."""
    rng = random.Random(spread)
    points = hot_rows(3, 300)
    spans = [(i, k, m, None if m is None else m + rng.choice([0, 1, -5, 7, spread, 3 * spread])) for i, k, m in hot_rows(4, 80)]
    a = spark.createDataFrame([(i, k, at(m)) for i, k, m in points], "id long, k int, t timestamp")
    b = spark.createDataFrame([(i, k, at(s), at(e)) for i, k, s, e in spans], "rid long, rk int, s timestamp, e timestamp")
    out = interval_join(a, b, {"k": "rk"}, "t", "s", "e")
    want = Counter((i, r) for i, k, m in points for r, rk, s, e in spans
                   if None not in (k, m, s, e) and k == rk and s <= m < e)
    assert Counter((r["id"], r["rid"]) for r in out.collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert interval_join(a, b.limit(0), {"k": "rk"}, "t", "s", "e").collect() == []
    assert interval_join(a.limit(0), b, {"k": "rk"}, "t", "s", "e").collect() == []


def plain_sessions(rows, gap):
    by = defaultdict(list)
    for k, m, v in rows:
        by[k].append((m, v))
    out = []
    for k, own in by.items():
        own.sort()
        start, last, n = own[0][0], own[0][0], 0
        for m, _ in own:
            if m - last > gap:
                out.append((k, at(start), at(last + gap), n))
                start, n = m, 0
            last, n = m, n + 1
        out.append((k, at(start), at(last + gap), n))
    return sorted(out)


def test_streamed_windows_and_late_rows(spark, tmp_path):
    """Three files in order, one late row among them, a closing row: the batch result
    without the late row, which is counted; a restart in between changes nothing."""
    rng = random.Random(6)
    files = [[(rng.randrange(4), m, 1.0) for m in sorted(rng.sample(range(lo, lo + 400), 60))] for lo in (0, 500, 1000)]
    late = (2, 30, 9.0)
    schema = "user_id int, ts timestamp, value double"
    source = str(tmp_path / "in")
    frame = lambda rows: spark.createDataFrame([(k, at(m), v) for k, m, v in rows], schema)
    for name, shape in (("s", lambda e: sessions(e, "user_id", "ts", "20 minutes", {"n": F.count(F.lit(1))})),
                        ("w", lambda e: sliding(e, "user_id", "ts", "60 minutes", "20 minutes", {"n": F.count(F.lit(1))}))):
        dropped = 0
        # The watermark moves at the end of a batch, so a late row comes after the batch that moves it.
        for rows in (*files, [late], [(None, 90_000, 0.0)], [(None, 90_001, 0.0)]):
            frame(rows).coalesce(1).write.mode("append").parquet(f"{source}-{name}")
            dropped += run_windows(spark, f"{source}-{name}", frame([]).schema, "ts", "30 minutes", shape,
                                   str(tmp_path / f"out-{name}"), str(tmp_path / f"ckpt-{name}"), 1)
        got = sorted(tuple(r) for r in read_windows(spark, str(tmp_path / f"out-{name}")).collect())
        good = [r for f in files for r in f]
        if name == "s":
            assert got == plain_sessions(good, 20)
            assert dropped == 1
        else:
            want = Counter((k, at(s), at(s + 60)) for k, m, _ in good for s in range(m // 20 * 20 - 40, m + 1, 20))
            assert got == sorted((*w, n) for w, n in want.items())
            assert dropped >= 1  # one late row is in three late windows


def test_cube_and_merged_sketches(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.choice(["x", None]), rng.choice([None, *range(2000)]), 1.5) for _ in range(4000)]
    df = spark.createDataFrame(rows, "a string, b string, v int, m double")
    got = {(r["a"], r["b"], r["level"]): r for r in cube_counts(df, ["a", "b"], "v", "m").collect()}
    for level, keep in ((0, (0, 1)), (1, (0,)), (2, (1,)), (3, ())):
        groups = defaultdict(list)
        for r in rows:
            groups[tuple(r[i] if i in keep else None for i in (0, 1))].append(r)
        for key, own in groups.items():
            r = got.pop((*key, level))
            assert (r["n"], r["n_distinct"], r["total"]) == (len(own), len({x[2] for x in own} - {None}), 1.5 * len(own))
            assert r["estimate_within"]
    assert not got
    halves = [df.filter(F.col("a") == x) for x in "ab"]
    parts = [sketched_groups(h, ["a", "b"], "v") for h in halves]
    whole = cube_estimates(sketched_groups(df, ["a", "b"], "v"), ["a", "b"])
    assert sorted(map(str, cube_estimates(parts[0].unionByName(parts[1]), ["a", "b"]).collect())) == sorted(map(str, whole.collect()))
    assert cube_counts(df.limit(0), ["a", "b"], "v", "m").collect() == []


def test_histogram_bound(spark):
    rng = random.Random(9)
    rows = [(int(rng.random() < s), s) for s in [rng.random() ** 2 for _ in range(800)] + [0.0, 1.0, 0.5, 0.5]]
    rows += [(1, None), (0, float("nan"))]
    df = spark.createDataFrame(rows, "label int, score double")
    pos, neg = [s for y, s in rows[:-2] if y], [s for y, s in rows[:-2] if not y]
    exact = sum((a > b) + .5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    bounds = []
    for bins in (2, 16, 1024):
        parts = [score_histogram(df.filter(c), bins) for c in ("score < 0.3", "score >= 0.3 or score is null")]
        merged = merged_histogram(parts[0].unionByName(parts[1]))
        r = auc_from_histogram(merged).first()
        assert abs(r["auc"] - exact) <= r["error_bound"] + 1e-12
        bounds.append(r["error_bound"])
        for p in roc_from_histogram(merged).collect():
            edge = p["bin"] / bins
            assert p["tpr"] == pytest.approx(sum(s >= edge for s in pos) / len(pos))
            assert p["fpr"] == pytest.approx(sum(s >= edge for s in neg) / len(neg))
    assert bounds[0] > bounds[1] > bounds[2] < 0.01
    assert auc_from_histogram(score_histogram(df.filter("label = 1"))).first()["auc"] is None
