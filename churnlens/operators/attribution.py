"""Shapley values of boosted trees, by row, along the trees' own paths.

The value of a set of known columns is the tree's expectation where unknown
columns go both ways in proportion to the training weight of the branches.  A
leaf depends only on the columns of its path, at most as many as the tree is
deep: for each of the 2^d ways a row can meet the path's d conditions, the
leaf's share of every column is computed once.  A row then costs one look-up a
leaf, in Arrow batches; the tables are sized by the model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.boosting import BoostedScorer, Trees, _pandas, binned, leaves


#: Upper bound of a column without a condition: above every bin.
UNBOUND = 1 << 16


@dataclass
class Leaf:
    """A row meets condition i if low[i] < bin <= high[i]; bit i of its case says so."""
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray
    shares: np.ndarray   # (2^d cases, d columns)


def _paths(trees: Trees, k: int) -> Iterator[tuple[float, dict[int, tuple[int, int, float]]]]:
    """(value, column -> (low, high, share of the training weight)) of every leaf of tree k."""
    stack: list[tuple[int, dict]] = [(0, {})]
    while stack:
        node, path = stack.pop()
        f = int(trees.feature[k, node])
        if f < 0:
            yield float(trees.value[k, node]), path
            continue
        at, whole = int(trees.bin[k, node]), trees.cover[k, node]
        low, high, share = path.get(f, (-1, UNBOUND, 1.0))
        for child, bounds in ((2 * node + 1, (low, min(high, at))), (2 * node + 2, (max(low, at), high))):
            stack.append((child, {**path, f: (*bounds, share * trees.cover[k, child] / whole)}))


def _shares(value: float, z: np.ndarray) -> np.ndarray:
    """Shapley values of one leaf's columns for all cases of met conditions."""
    d = len(z)
    met = (np.arange(1 << d)[:, None] >> np.arange(d) & 1).astype(float)
    weight = np.array([math.factorial(s) * math.factorial(d - s - 1) / math.factorial(d) for s in range(d)])
    out = np.zeros((1 << d, d))
    for i in range(d):
        # Coefficients by size of the set of other known columns.
        sizes = np.zeros((1 << d, d))
        sizes[:, 0] = 1
        for j in range(d):
            if j != i:
                sizes[:, 1:] = sizes[:, 1:] * z[j] + sizes[:, :-1] * met[:, j: j + 1]
                sizes[:, 0] *= z[j]
        out[:, i] = value * (met[:, i] - z[i]) * (sizes @ weight)
    return out


def leaf_tables(trees: Trees) -> tuple[float, list[Leaf]]:
    """(expected sum of the trees, the tables of all leaves)."""
    base, out = 0.0, []
    for k in range(len(trees.feature)):
        for value, path in _paths(trees, k):
            z = np.array([p[2] for p in path.values()])
            base += value * float(np.prod(z))
            if path and value:
                out.append(Leaf(np.array(list(path)), np.array([p[0] for p in path.values()]),
                                np.array([p[1] for p in path.values()]), _shares(value, z)))
    return base, out


def row_values(tables: list[Leaf], bins: np.ndarray) -> np.ndarray:
    """Shapley values (rows, columns) of rows of bins."""
    out = np.zeros(bins.shape[::-1])
    columns = np.ascontiguousarray(bins.T)
    for leaf in tables:
        case = np.zeros(len(bins), dtype=np.intp)
        for i, (f, low, high) in enumerate(zip(leaf.columns.tolist(), leaf.low.tolist(), leaf.high.tolist())):
            # A bound that no condition set holds for every row.
            met = columns[f] <= high if high < UNBOUND else np.ones(len(bins), bool)
            if low >= 0:
                met &= columns[f] > low
            case += met.astype(np.intp) << i
        for i, f in enumerate(leaf.columns.tolist()):
            out[f] += leaf.shares[:, i].take(case)
    return out.T


def shapley_values(scorer: BoostedScorer, rows: DataFrame, by_source: bool = True) -> DataFrame:
    """``rows`` with `base` (the model's expected log-odds), `margin` (the row's) and
    `contributions`, a map from column to Shapley value: base + contributions =
    margin.  ``by_source`` adds the dummies of a categorical column up; else the
    prepared columns keep their own.  Nulls are imputed as the model does; rows
    repeat as they are; an empty table gives no rows."""
    base, tables = leaf_tables(scorer.trees)
    shared = rows.sparkSession.sparkContext.broadcast(tables)
    edges = scorer.edges
    trees = Trees(scorer.trees.feature, scorer.trees.bin, scorer.trees.value, scorer.trees.cover[:0], scorer.trees.gain[:0])
    names = scorer.sources() if by_source else list(scorer.names)
    kept = list(dict.fromkeys(names))
    sums = np.zeros((len(names), len(kept)))
    sums[np.arange(len(names)), [kept.index(n) for n in names]] = 1

    def run(column):
        bins = binned(np.array(column.tolist(), dtype=np.float64).reshape(len(column), len(edges)), edges)
        depth = (trees.feature.shape[1] + 1).bit_length() - 2
        margin = np.zeros(len(bins))
        for k in range(len(trees.feature)):
            margin += trees.value[k][leaves(trees.feature[k], trees.bin[k], bins, depth)]
        return pd.Series(list(np.column_stack([margin, row_values(shared.value, bins) @ sums])))

    keep = rows.columns
    wide, x = scorer._features(rows)
    found = wide.select(*keep, _pandas(run, "array<double>")(x).alias("_found"))
    contributions = F.map_from_arrays(F.array(*[F.lit(c) for c in kept]), F.slice("_found", 2, len(kept)))
    return found.select(*keep, F.lit(base).alias("base"), F.get("_found", F.lit(0)).alias("margin"),
                        contributions.alias("contributions"))


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` dealt evenly to two tasks a core, in no order.  A row costs a look-up a leaf,
    so rows few in bytes, which would share one task, are work for all cores."""
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism)


def mean_abs_shapley(values: DataFrame) -> DataFrame:
    """(feature, mean_abs_attribution, max_error) from ``shapley_values``: the mean absolute
    value of each column, and by how much base + values misses a row's margin at most."""
    total = F.aggregate(F.map_values("contributions"), F.lit(0.0).cast("double"), lambda s, v: s + v)
    error = F.abs(F.col("base") + total - F.col("margin"))
    return (values.select(error.alias("error"), F.explode("contributions").alias("feature", "value"))
            .groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs_attribution"),
                                    F.max("error").alias("max_error")))
