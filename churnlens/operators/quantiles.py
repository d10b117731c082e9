"""Exact order statistics with bounded memory per task.

``percentile`` / ``percentile_disc`` keep every distinct value of a group in
one aggregation buffer, which for a near-unique column is the whole group in
one task.  Here the same exact values come from narrowing by pivots:

* a mergeable quantile sketch of the values still possible (bounded memory
  whatever their distribution) gives two pivots around each wanted rank;
* one aggregate counts what lies below, at, between and above the pivots, so
  the rank's zone is known exactly, however far the sketch was off;
* a pivot that is the answer ends the search; otherwise the zone, without its
  pivots, is the next range, or is fetched once it is a few thousand rows.

Every round leaves out at least the pivots, so the search ends, and it goes on
until every rank is found.  All series (columns, or one column per class)
share every scan, and each is tested against its own pivots only.  NaN and
infinite values count as missing, like NULL.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relative error of the sketch is 1 / ACCURACY.
ACCURACY = 10_000
#: A zone of at most so many rows is fetched (it saves rounds, nothing else).
FETCH_ROWS = 4096
#: Groups become columns of one aggregate; more are refused.
MAX_GROUPS = 1_000


@dataclass
class _Target:
    series: int
    rank: int            # 1-based rank inside the series
    lo: object           # inclusive range still possible
    hi: object
    below: int           # rows of the series below lo
    rows: int            # rows in the range
    value: object = None
    done: bool = False


def finite(c: Column, dtype: str) -> Column:
    """``c`` with NaN and infinities as NULL."""
    if dtype not in ("double", "float"):
        return c
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def _select(df: DataFrame, series: list[Column], ranks_for: Callable[[int], list[int]]
            ) -> tuple[list[dict[int, object]], list[int]]:
    """For every series its {rank: value} and its number of values."""
    # Ranges are literals of the column's own type, so comparisons are exact.
    frame = df.select(*[c.alias(f"s{i}") for i, c in enumerate(series)])
    types = [t for _, t in frame.dtypes]

    def lit(x, i):
        return F.lit(x).cast(types[i])

    first = frame.agg(*[f(F.col(f"s{i}")).alias(f"{n}{i}") for i in range(len(series))
                        for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    counts = [first[f"n{i}"] for i in range(len(series))]
    targets, after = [], []  # a rank right behind a searched one is read off it at the end
    for i, n in enumerate(counts):
        searched = 0
        for k in sorted(set(ranks_for(n))) if n else ():
            if k == searched + 1 and searched:
                after.append((i, k))
            else:
                targets.append(_Target(i, k, first[f"lo{i}"], first[f"hi{i}"], 0, n))
                searched = k
    for t in targets:
        if not 1 <= t.rank <= t.rows:
            raise ValueError(f"rank {t.rank} of {t.rows} values")
        if t.lo == t.hi:
            t.value, t.done = t.lo, True

    while live := [t for t in targets if not t.done]:
        fetch = [t for t in live if t.rows <= FETCH_ROWS]
        if fetch:
            _fetch(frame, fetch, lit)
        live = [t for t in live if not t.done]
        if not live:
            break
        sketched = frame.agg(*[
            F.percentile_approx(F.when(F.col(f"s{t.series}").between(lit(t.lo, t.series), lit(t.hi, t.series)),
                                       F.col(f"s{t.series}")),
                                [max(0.0, min(1.0, (t.rank - t.below - 0.5) / t.rows + d)) for d in (-2 / ACCURACY, 2 / ACCURACY)],
                                ACCURACY).alias(f"p{j}") for j, t in enumerate(live)]).first()
        pivots, aggs = [], []
        for j, t in enumerate(live):
            v = F.col(f"s{t.series}")
            # A sketch of wide integers rounds: keep its pivots inside the range.
            a, b = (min(max(x, t.lo), t.hi) for x in sketched[f"p{j}"])
            pivots.append((a, b))
            la, lb = lit(a, t.series), lit(b, t.series)
            inside = v.between(lit(t.lo, t.series), lit(t.hi, t.series))
            zones = {"l": inside & (v < la), "a": inside & (v == la), "m": inside & (v > la) & (v < lb),
                     "b": inside & (v == lb) & (v > la), "h": inside & (v > lb)}
            for z, c in zones.items():
                aggs.append(F.count_if(c).alias(f"n{z}{j}"))
                if z in "lmh":  # the others are the pivots themselves
                    aggs += [F.min(F.when(c, v)).alias(f"lo{z}{j}"), F.max(F.when(c, v)).alias(f"hi{z}{j}")]
        row = frame.agg(*aggs).first()
        for j, t in enumerate(live):
            ends = {"a": pivots[j][:1] * 2, "b": pivots[j][1:] * 2,
                    **{z: (row[f"lo{z}{j}"], row[f"hi{z}{j}"]) for z in "lmh"}}
            for z in "lambh":
                n = row[f"n{z}{j}"]
                if t.rank <= t.below + n:
                    (t.lo, t.hi), t.rows = ends[z], n
                    if t.lo == t.hi:
                        t.value, t.done = t.lo, True
                    break
                t.below += n
            else:
                raise RuntimeError("the rows changed between two passes of a quantile search")

    found: list[dict[int, object]] = [{} for _ in series]
    for t in targets:
        found[t.series][t.rank] = t.value
    if after:
        aggs = []
        for j, (i, k) in enumerate(after):
            v, before = F.col(f"s{i}"), lit(found[i][k - 1], i)
            aggs += [F.count_if(v <= before).alias(f"n{j}"), F.min(F.when(v > before, v)).alias(f"v{j}")]
        row = frame.agg(*aggs).first()
        for j, (i, k) in enumerate(after):
            found[i][k] = found[i][k - 1] if row[f"n{j}"] >= k else row[f"v{j}"]
    return found, counts


def _fetch(frame: DataFrame, targets: list[_Target], lit) -> None:
    """The values of small ranges, counted in Spark, for several targets in one job."""
    tags = [F.when(F.col(f"s{t.series}").between(lit(t.lo, t.series), lit(t.hi, t.series)),
                   F.struct(F.lit(i).alias("t"), F.col(f"s{t.series}").cast("string").alias("v")))
            for i, t in enumerate(targets)]
    rows = (frame.select(F.explode(F.array_compact(F.array(*tags))).alias("x"))
            .groupBy("x.t", "x.v").agg(F.count(F.lit(1)).alias("n")).collect())
    per: dict[int, list] = {}
    for r in rows:
        kind = type(targets[r["t"]].lo)
        per.setdefault(r["t"], []).append((kind(r["v"]), r["n"]))
    for i, t in enumerate(targets):
        at = t.below
        for v, n in sorted(per.get(i, [])):
            at += n
            if at >= t.rank:
                t.value = v
                break
        t.done = True


def kth_values(df: DataFrame, value_col: str, ranks_for: Callable[[int], list[int]],
               group_cols: list[str] = (), persist: bool = True
               ) -> tuple[dict[tuple, dict[int, object]], dict[tuple, int]]:
    """Exact k-th smallest value per group.

    ``ranks_for(n)`` gives the 1-based ranks wanted in a group of ``n``
    values.  Returns ``({group: {rank: value}}, {group: n})`` for the groups
    that have values; a NULL group is a group.  With ``persist`` the narrow
    projection is kept for the few passes and released at the end.
    """
    group_cols = list(group_cols)
    dtype = dict(df.dtypes)[value_col]
    vals = df.select(*group_cols, finite(F.col(value_col), dtype).alias("_v"))
    if persist:
        vals = vals.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        groups = [()]
        if group_cols:
            rows = vals.filter("_v is not null").select(*group_cols).distinct().limit(MAX_GROUPS + 1).collect()
            if len(rows) > MAX_GROUPS:
                raise ValueError(f"more than {MAX_GROUPS} groups")
            groups = [tuple(r) for r in rows]
        series = []
        for g in groups:
            own = F.lit(True)
            for c, x in zip(group_cols, g):
                own = own & F.col(c).eqNullSafe(F.lit(x))
            series.append(F.when(own, F.col("_v")))
        if not series:
            return {}, {}
        found, counts = _select(vals, series, ranks_for)
    finally:
        if persist:
            vals.unpersist()
    return ({g: f for g, f, n in zip(groups, found, counts) if n},
            {g: n for g, n in zip(groups, counts) if n})


def percentile_disc(df: DataFrame, value_col: str, q: float,
                    group_cols: list[str] = ()) -> dict[tuple, object]:
    """Smallest value whose cumulative share reaches ``q`` (SQL PERCENTILE_DISC)."""
    def rank(n: int) -> list[int]:
        return [max(1, math.ceil(q * n))]

    found, counts = kth_values(df, value_col, rank, group_cols)
    return {g: found[g][rank(n)[0]] for g, n in counts.items()}


def percentile_cont_many(df: DataFrame, columns: list[str], q: float = 0.5) -> dict[str, float]:
    """Interpolated percentile (SQL PERCENTILE_CONT, numpy's median for 0.5)
    of several columns, all sharing the same scans; None for a column without
    values."""
    def ranks(n: int) -> list[int]:
        p = (n - 1) * q
        return [math.floor(p) + 1, math.ceil(p) + 1]

    found, counts = _select(df, [finite(F.col(c).cast("double"), "double") for c in columns], ranks)
    out: dict[str, float] = {}
    for c, f, n in zip(columns, found, counts):
        p = (n - 1) * q
        out[c] = None if not n else (
            f[math.floor(p) + 1] + (p - math.floor(p)) * (f[math.ceil(p) + 1] - f[math.floor(p) + 1]))
    return out
