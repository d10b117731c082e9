"""Second-order boosted trees, many models grown together.

Up to `rows_per_partition` rows, the models of a search (parameter sets x folds)
are dealt to the tasks of one Spark job; a task grows its models to the end.  Beyond that all models add their next level in one job: a pass
over blocks of binned rows sums gradients and hessians by (model, node, feature,
bin), the sums merge, and one row per (model, node) with its best split comes back.
Both ways give the same trees.

* Gradients and hessians are whole multiples of 2^-20, so their sums are exact
  and a fit does not depend on the layout of the rows or the order of merges.
* Rows are sampled per tree by their hash, columns by a seeded draw.
* Scores of the trees so far are written with the blocks every `window` trees;
  a task adds the trees since then.  A worker remembers its last scores, but any
  other one can compute them again from the written ones.

Driver and tasks hold trees and histograms, whose size the models bound, never rows.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators.prep import PREPARED_PREFIX, PrepStats, prepared_columns, with_prepared
from churnlens.session import drop_folder, scratch_path

#: Gradients are whole numbers of this.
UNIT = 2.0 ** -20


@dataclass(frozen=True)
class BoostParams:
    """The parameters of one model, by the names of the original search space.
    ``gamma`` is the least loss reduction of a split, summed over its rows."""
    n_estimators: int = 100
    max_depth: int = 4
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    seed: int = C.RANDOM_STATE


@dataclass(frozen=True)
class Fit:
    """One model to grow: its parameters, the fold it leaves out (None: none)
    and the number of the feature matrix it reads."""
    params: BoostParams
    fold: int | None = None
    matrix: int = 0


@dataclass(frozen=True)
class Growth:
    """How models grow: bins a feature, most rows of a task and, where it grows whole models, most
    cells of its matrix (that many bytes four times, and 70 bytes a row), rows of a block, trees
    between written scores, partial sums that one task merges."""
    max_bins: int = 64
    rows_per_partition: int = 5_000_000
    cells_per_partition: int = 80_000_000
    rows_per_block: int = 50_000
    window: int = 16
    merged: int = 32


@dataclass
class Trees:
    """One model's trees by heap position (children of i: 2i+1 and 2i+2); a row
    goes left if its bin is at most `bin`.  `feature` is -1 at leaves; `cover`
    and `gain` are a node's hessian sum and its split's loss reduction."""
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, trees: int, depth: int) -> Trees:
        size = (trees, (1 << depth + 1) - 1)
        return cls(np.full(size, -1, np.int16), np.zeros(size, np.int16), np.zeros(size, np.float32),
                   np.zeros(size), np.zeros(size))

    def part(self, first: int, end: int) -> Trees:
        """Some of the trees, as far as scoring needs them."""
        return Trees(self.feature[first:end], self.bin[first:end], self.value[first:end], self.cover[:0], self.gain[:0])


def leaves(feature: np.ndarray, at: np.ndarray, bins: np.ndarray, levels: int) -> np.ndarray:
    """The node each row of ``bins`` reaches after at most ``levels`` steps down one tree."""
    cells = bins.reshape(-1)
    first = np.arange(len(bins)) * bins.shape[1]
    column, splits = np.maximum(feature, 0).astype(np.int64), feature >= 0
    at = at.astype(np.uint8) if bins.dtype == np.uint8 else at
    node = np.zeros(len(bins), dtype=np.int64)
    for _ in range(levels):
        inner = splits.take(node)
        if not inner.any():
            break
        step = 2 * node + 1
        step += cells.take(first + column.take(node)) > at.take(node)
        node = step if inner.all() else np.where(inner, step, node)
    return node


def add_scores(scores: np.ndarray, trees: Trees, bins: np.ndarray) -> None:
    """``scores`` (float32) plus the trees' values, tree by tree."""
    depth = (trees.feature.shape[1] + 1).bit_length() - 2
    for k in range(len(trees.feature)):
        scores += trees.value[k][leaves(trees.feature[k], trees.bin[k], bins, depth)]


def gradients(scores: np.ndarray, label: np.ndarray, positive_weight: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the log loss, in whole UNITs."""
    p = np.negative(scores, dtype=np.float64)
    np.exp(p, out=p)
    p += 1
    np.divide(1, p, out=p)
    weight = np.where(label == 1, positive_weight / UNIT, 1 / UNIT)
    h = 1 - p
    h *= p
    np.maximum(h, 1e-6, out=h)
    p -= label
    for x in (p, h):
        x *= weight
        np.rint(x, out=x)
    return p, h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sampled(keys: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees, by their hash."""
    if share >= 1:
        return np.ones(len(keys), dtype=bool)
    salt = _mixed(np.array([seed * 1_000_003 + tree], dtype=np.uint64))
    return (_mixed(keys ^ salt) >> np.uint64(11)) * 2.0 ** -53 < share


def columns_of(params: BoostParams, tree: int, features: int) -> np.ndarray:
    """The columns of a tree: a seeded draw without repetition."""
    n = max(1, int(round(params.colsample_bytree * features)))
    return np.sort(np.random.default_rng([params.seed, tree]).permutation(features)[:n])


def soft(g: np.ndarray, alpha) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def best_splits(sums: np.ndarray, alpha: np.ndarray, lam: np.ndarray, least: np.ndarray) -> dict[str, np.ndarray]:
    """The best split of every node from ``sums`` (2, nodes, features, bins; in UNITs) with
    the nodes' own regularisation.  Ties go to the first feature, then the lowest bin."""
    # All in UNITs; a loss reduction is worth UNIT of what comes out.
    a, lam, least = (x[:, None, None] / UNIT for x in (alpha, lam, least))
    # A column that the tree did not draw has no sums; the first drawn one has all rows.
    drawn = sums[1].any(axis=2)
    at, first = np.arange(len(drawn)), drawn.argmax(axis=1)
    total_g, total_h = (x[at, first].sum(axis=1)[:, None, None] for x in sums)
    left_g, left_h = np.cumsum(sums, axis=3)[..., :-1]
    right_h = total_h - left_h

    def reduction(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        x = np.abs(g)
        x -= a
        np.maximum(x, 0, out=x)
        x *= x
        x /= h + lam
        return x

    with np.errstate(divide="ignore", invalid="ignore"):
        gain = reduction(left_g, left_h)
        gain += reduction(total_g - left_g, right_h)
        gain -= reduction(total_g, total_h)
    gain[(left_h < least) | (right_h < least) | ~drawn[:, :, None]] = -np.inf
    flat = gain.reshape(len(gain), -1).argmax(axis=1)
    f, b = flat // gain.shape[2], flat % gain.shape[2]
    return {"feature": f, "bin": b, **{k: v * UNIT for k, v in (
        ("gain", gain[at, f, b]), ("g", total_g[:, 0, 0]), ("h", total_h[:, 0, 0]), ("left_g", left_g[at, f, b]),
        ("left_h", left_h[at, f, b]))}}


@dataclass
class _Step:
    """What a task needs for one level: the models that split, their trees since
    the written scores, the open tree of each and its open nodes."""
    run: str
    done: int                      # trees in the written scores
    trees: dict[int, Trees]        # per model, since then
    grown: int                     # trees before the open one
    level: int
    open: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # feature, bin, nodes to split
    columns: dict[int, np.ndarray]


#: Scores a worker has computed: (run, block) -> (trees, matrix of scores).
_KNOWN: OrderedDict = OrderedDict()


def _scores(block: dict, step_run: str, done: int, grown: int, trees: dict[int, Trees], fits: list[Fit]) -> np.ndarray:
    """Scores (models, rows) of a block with ``grown`` trees."""
    key = (step_run, block["block"])
    known = _KNOWN.pop(key, None)
    if known is None or not done <= known[0] <= grown:
        known = done, np.frombuffer(block["scores"], np.float32).reshape(len(fits), -1).copy()
    first, scores = known
    if first < grown:
        for m, own in trees.items():
            add_scores(scores[m], own.part(first - done, grown - done), block["bins"][fits[m].matrix])
    _KNOWN[key] = grown, scores
    while len(_KNOWN) > 8:
        _KNOWN.popitem(last=False)
    return scores


def _blocks(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[dict]:
    for batch in batches:
        for row in batch.to_pylist():
            n = row["n"]
            yield {"block": row["block"], "scores": row["scores"], "label": np.frombuffer(row["label"], np.int8),
                   "fold": np.frombuffer(row["fold"], np.int8), "key": np.frombuffer(row["key"], np.uint64),
                   "bins": [np.frombuffer(b, np.uint8).reshape(n, features) for b in row["bins"]]}


def _level(step: _Step, fits: list[Fit], weight: list[float], features: int, bins: int):
    """The sums of one partition."""
    slots = {m: (first, len(o[2])) for (m, o), first in zip(step.open.items(), np.cumsum(
        [0, *[len(o[2]) for o in step.open.values()]]).tolist())}
    nodes = sum(n for _, n in slots.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, nodes, features * bins))
        for block in _blocks(batches, features):
            scores = _scores(block, step.run, step.done, step.grown, step.trees, fits)
            base = [b + np.arange(features) * bins for b in block["bins"]]
            for m, (feature, at, own) in step.open.items():
                fit = fits[m]
                use = sampled(block["key"], fit.params.seed, step.grown, fit.params.subsample)
                if fit.fold is not None:
                    use &= block["fold"] != fit.fold
                rows = np.flatnonzero(use)
                node = leaves(feature, at, block["bins"][fit.matrix][rows], step.level)
                slot = np.full(len(feature), -1)
                slot[own] = np.arange(len(own))
                place = slot[node]
                rows, place = rows[place >= 0], place[place >= 0]
                g, h = gradients(scores[m, rows], block["label"][rows], weight[m])
                columns = step.columns[m]
                cell = (place[:, None] * (features * bins) + base[fit.matrix][rows][:, columns]).ravel()
                size = len(own) * features * bins
                first = slots[m][0]
                for k, x in enumerate((g, h)):
                    sums[k, first: first + len(own)] += np.bincount(
                        cell, np.repeat(x, len(columns)), size).reshape(len(own), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(slots), pa.int32()), pa.array(
                [np.ascontiguousarray(sums[:, a: a + n]).tobytes() for a, n in slots.values()], pa.binary())],
            names=["model", "sums"])

    return run


SPLITS = "model int, node int, feature int, bin int, gain double, g double, h double, left_g double, left_h double"


def _splits(sums: np.ndarray, step: _Step, fits: list[Fit], features: int, bins: int,
            models: list[int]) -> pa.RecordBatch:
    own = [(m, int(n)) for m in models for n in step.open[m][2]]
    of = {k: np.array([getattr(fits[m].params, k) for m, _ in own], float)
          for k in ("reg_alpha", "reg_lambda", "min_child_weight")}
    found = best_splits(sums.reshape(2, len(own), features, bins), of["reg_alpha"], of["reg_lambda"],
                        of["min_child_weight"])
    ints = [pa.array([m for m, _ in own], pa.int32()), pa.array([n for _, n in own], pa.int32()),
            pa.array(found["feature"], pa.int32()), pa.array(found["bin"], pa.int32())]
    names = ["gain", "g", "h", "left_g", "left_h"]
    return pa.RecordBatch.from_arrays([*ints, *[pa.array(found[k], pa.float64()) for k in names]],
                                      names=["model", "node", "feature", "bin", *names])


def _merged(table: pa.Table) -> pa.Table:
    """Equal models' sums added up; their order does not matter, as they are whole numbers."""
    total: dict[int, np.ndarray] = {}
    for m, data in zip(table["model"].to_pylist(), table["sums"]):
        values = np.frombuffer(data.as_buffer(), np.float64)
        total[m] = total[m] + values if m in total else values
    keep = table.select([c for c in table.column_names if c not in ("model", "sums")]).slice(0, 1)
    out = {c: pa.array(keep[c].to_pylist() * len(total), keep.schema.field(c).type) for c in keep.column_names}
    return pa.table({**out, "model": pa.array(total, pa.int32()),
                     "sums": pa.array([v.tobytes() for v in total.values()], pa.binary())})


def _merged_splits(step: _Step, fits: list[Fit], features: int, bins: int):
    def run(table: pa.Table) -> pa.Table:
        table = _merged(table.select(["model", "sums"]))
        models = table["model"].to_pylist()
        sums = np.concatenate([np.frombuffer(x.as_buffer(), np.float64).reshape(2, -1, features * bins)
                               for x in table["sums"]], axis=1)
        return pa.Table.from_batches([_splits(sums, step, fits, features, bins, models)])

    return run


# ------------------------------------------------- whole models in one task

#: Rows of one pass over a task's rows, so that what a pass makes stays in the core's cache.
PASS = 65_536
#: Most cells of a joint histogram.
CELLS = 4096
#: Above so many nodes that split, a level's rows look their split up instead of being compared node by node.
COMPARED = 32


def _passes(first: int, end: int) -> Iterator[slice]:
    return (slice(a, min(a + PASS, end)) for a in range(first, end, PASS))


def _packs(sizes: list[int], most: int) -> list[list[int]]:
    """Columns by the joint histogram they share: as few as have ``most`` cells each or one column."""
    packs: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for own in packs:
            if math.prod(sizes[j] for j in own) * sizes[i] <= most:
                own.append(i)
                break
        else:
            packs.append([i])
    return packs


@dataclass
class _Rows:
    """The rows of one model, those it leaves out at the end: bins (a line a column), bins of a column,
    and by row: score, whether the open tree sees it, derivatives (gradient + i * hessian, so that both
    are summed at once), node of the open tree and cells of the joint histograms."""
    seen: int
    bins: np.ndarray
    sizes: list[int]
    label: np.ndarray
    key: np.ndarray
    scores: np.ndarray
    use: np.ndarray
    slopes: np.ndarray
    node: np.ndarray
    cells: np.ndarray

    @classmethod
    def of(cls, block: dict, fit: Fit) -> _Rows:
        bins, label, key = block["bins"], block["label"], block["key"]
        if fit.fold is None:
            n = len(label)
        else:
            out = block["fold"] == fit.fold
            order = np.concatenate([np.flatnonzero(~out), np.flatnonzero(out)])
            bins, label, key = np.stack([c[order] for c in bins]), label[order], key[order]
            n = len(label) - int(out.sum())
        return cls(n, bins, [int(c.max(initial=0)) + 1 for c in bins], label, key[:n], np.zeros(len(label), np.float32),
                   np.empty(n, bool), np.empty(n, complex), np.empty(len(label), np.uint8 if fit.params.max_depth < 8 else np.int32),
                   np.empty((len(bins), n), np.uint16))


class _Histograms:
    """Sums of a tree's columns by node from few joint histograms of several columns each."""

    def __init__(self, rows: _Rows, columns: np.ndarray, bins: int):
        self.rows, self.bins, self.n = rows, bins, len(columns)
        sizes = [rows.sizes[c] for c in columns]
        self.packs = _packs(sizes, min(CELLS, rows.seen // 128))
        self.shapes = [[sizes[i] for i in own] for own in self.packs]
        for at in _passes(0, rows.seen):
            for own, cell in zip(self.packs, rows.cells):
                cell = cell[at]
                cell[:] = rows.bins[columns[own[0]], at]
                for i in own[1:]:
                    cell *= np.uint16(sizes[i])
                    cell += rows.bins[columns[i], at]

    def of(self, children: np.ndarray | None = None, first: int = 0) -> np.ndarray:
        """Sums (2, nodes, columns, bins) of all rows, or of the rows in each of ``children``, which
        are numbered from ``first`` on by heap position."""
        rows, nodes = self.rows, 1 if children is None else len(children)
        joint = [np.zeros(nodes * math.prod(shape), complex) for shape in self.shapes]
        if children is not None:
            slot = np.full(2 * first + 1, -1)
            slot[children] = np.arange(nodes)
        for at in _passes(0, rows.seen):
            slopes, some = rows.slopes[at], None
            if children is not None:
                place = slot.take(rows.node[at])
                some = np.flatnonzero((place >= 0) & rows.use[at])
                place, slopes = place.take(some), slopes.take(some)
            for total, shape, cell in zip(joint, self.shapes, rows.cells):
                if some is None:
                    where = cell[at].astype(np.int64)
                else:
                    where = place * math.prod(shape)
                    where += cell[at].take(some)
                np.add.at(total, where, slopes)
        sums = np.zeros((2, nodes, self.n, self.bins))
        for own, shape, total in zip(self.packs, self.shapes, joint):
            total = total.reshape(nodes, *shape)
            for k, i in enumerate(own):
                one = total.sum(axis=tuple(1 + j for j in range(len(own)) if j != k))
                sums[0, :, i, :shape[k]], sums[1, :, i, :shape[k]] = one.real, one.imag
        return sums


def _descend(rows: _Rows, parents: np.ndarray, f: np.ndarray, b: np.ndarray, last: bool) -> np.ndarray:
    """Takes the rows of ``parents`` a level down, left up to bin ``b`` of column ``f``; of the rows
    that the model sees the number in either child (parents, 2), unless it is the ``last`` level."""
    counts = np.zeros((len(parents), 2), np.int64)
    kind = rows.node.dtype.type
    if len(parents) > COMPARED:
        rank = np.full(2 * int(parents.max()) + 3, -1)
        rank[parents] = np.arange(len(parents))
    for seen, at in [*((True, x) for x in _passes(0, rows.seen)), *((False, x) for x in _passes(rows.seen, len(rows.node)))]:
        node, bins = rows.node[at], rows.bins[:, at]
        if len(parents) > COMPARED:
            own = rank.take(node)
            some = np.flatnonzero(own >= 0)
            own = own.take(some)
            right = bins[f[own], some] > b[own]
            node[some] = 2 * parents[own] + 1 + right
            if seen and not last:
                counts += np.bincount(2 * own + right, minlength=2 * len(parents)).reshape(-1, 2)
            continue
        here, right, step = np.empty(len(node), bool), np.empty(len(node), bool), np.empty_like(node)
        for i, (parent, column, bound) in enumerate(zip(parents.tolist(), f.tolist(), b.tolist())):
            np.equal(node, kind(parent), out=here)
            np.greater(bins[column], np.uint8(bound), out=right)
            np.logical_and(right, here, out=right)
            if seen and not last:
                both, more = np.count_nonzero(here), np.count_nonzero(right)
                counts[i] += both - more, more
            # Children lie beyond all nodes of this level, so no later parent meets them.
            np.multiply(here.view(np.uint8), kind(parent + 1), out=step)
            step += right.view(np.uint8)
            node += step
    return counts


def _grow_tree(trees: Trees, tree: int, p: BoostParams, columns: np.ndarray, rows: _Rows, bins: int) -> None:
    """Tree number ``tree`` from the derivatives of ``rows``, which end at their leaves.
    Of two children the smaller one is summed, the other has the rest of its parent."""
    feature, at, gain = trees.feature[tree], trees.bin[tree], trees.gain[tree]
    totals, there = np.zeros((2, len(feature))), np.zeros(len(feature), bool)
    there[0] = True
    nodes = np.array([0])
    rows.node[:] = 0
    histograms = _Histograms(rows, columns, bins)
    sums = histograms.of()
    for level in range(p.max_depth):
        of = [np.full(len(nodes), float(x)) for x in (p.reg_alpha, p.reg_lambda, p.min_child_weight)]
        found = best_splits(sums, *of)
        totals[:, nodes] = found["g"], found["h"]
        which = np.flatnonzero(found["gain"] > max(p.gamma, 1e-6))
        if not len(which):
            break
        parents, f, b = nodes[which], found["feature"][which], found["bin"][which]
        feature[parents], at[parents], gain[parents] = columns[f], b, found["gain"][which]
        left = np.array([found["left_g"][which], found["left_h"][which]])
        totals[:, 2 * parents + 1], totals[:, 2 * parents + 2] = left, totals[:, parents] - left
        there[2 * parents + 1] = there[2 * parents + 2] = True
        last = level + 1 == p.max_depth
        small = _descend(rows, parents, columns[f], b, last).argmin(axis=1)
        if last:
            break
        part, whole = histograms.of(2 * parents + 1 + small, (2 << level + 1) - 1), sums[:, which]
        sums = np.empty((2, 2 * len(which), len(columns), bins))
        children = 2 * np.arange(len(which))
        sums[:, children + small], sums[:, children + 1 - small] = part, whole - part
        nodes = np.column_stack([2 * parents + 1, 2 * parents + 2]).ravel()
    _finish(trees, tree, p, totals, there)


def _finish(trees: Trees, tree: int, p: BoostParams, totals: np.ndarray, there: np.ndarray) -> None:
    """Covers of all nodes and values of the leaves, from the sums of the nodes that are ``there``."""
    g, h = totals
    trees.cover[tree] = np.where(there, h, 0)
    trees.value[tree] = np.where(there & (trees.feature[tree] < 0),
                                 -p.learning_rate * soft(g, p.reg_alpha) / (h + p.reg_lambda), 0)


def _exact_auc(scores: np.ndarray, positive: np.ndarray) -> float | None:
    """As ``auc_by_model``."""
    _, place = np.unique(scores + np.float32(0), return_inverse=True)
    p = np.bincount(place, positive).astype(np.int64)
    n = np.bincount(place) - p
    if not p.any() or not n.any():
        return None
    return float(((2 * (np.cumsum(n) - n) + n) * p).sum()) / (2.0 * p.sum() * n.sum())


def _grow_model(fit: Fit, weight: float, block: dict, max_bins: int) -> tuple[Trees, float | None]:
    """One model from all rows, and its AUC on the fold it left out."""
    p, rows = fit.params, _Rows.of(block, fit)
    trees = Trees.empty(p.n_estimators, p.max_depth)
    for tree in range(p.n_estimators):
        for at in _passes(0, rows.seen):
            use = rows.use[at] = sampled(rows.key[at], p.seed, tree, p.subsample)
            g, h = gradients(rows.scores[at], rows.label[at], weight)
            np.multiply(g, use, out=rows.slopes.real[at])
            np.multiply(h, use, out=rows.slopes.imag[at])
        _grow_tree(trees, tree, p, columns_of(p, tree, len(rows.bins)), rows, max_bins)
        value = trees.value[tree]
        for at in _passes(0, len(rows.node)):
            rows.scores[at] += value.take(rows.node[at])
    out = slice(rows.seen, None)
    return trees, None if fit.fold is None else _exact_auc(rows.scores[out], rows.label[out] == 1)


TREES = ["feature", "bin", "value", "cover", "gain"]


def _grow_group(groups: list[list[int]], fits: list[Fit], weight: list[float], features: int, max_bins: int):
    def run(table: pa.Table) -> pa.Table:
        def joined(name: str, kind) -> np.ndarray:
            return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table[name]])

        block = {"label": joined("label", np.int8), "fold": joined("fold", np.int8), "key": joined("key", np.uint64),
                 "bins": np.ascontiguousarray(joined("bins", np.uint8).reshape(-1, features).T)}
        own = groups[table["grp"][0].as_py()]
        grown = [_grow_model(fits[m], weight[m], block, max_bins) for m in own]
        return pa.table({"model": pa.array(own, pa.int32()),
                         **{k: pa.array([getattr(t, k).tobytes() for t, _ in grown], pa.binary()) for k in TREES},
                         "auc": pa.array([a for _, a in grown], pa.float64())})

    return run


def _dealt(fits: list[Fit], tasks: int) -> list[list[int]]:
    """Models in about ``tasks`` groups of like work, each of models that read one matrix, the most work first."""
    cost = [f.params.n_estimators * (f.params.max_depth + 2) for f in fits]
    matrices = sorted({f.matrix for f in fits})
    groups: list[list[int]] = []
    for matrix in matrices:
        own = sorted((m for m, f in enumerate(fits) if f.matrix == matrix), key=lambda m: -cost[m])
        share: list[list[int]] = [[] for _ in range(min(-(-tasks // len(matrices)), len(own)))]
        for m in own:
            min(share, key=lambda g: sum(cost[i] for i in g)).append(m)
        groups += share
    return sorted(groups, key=lambda g: -sum(cost[i] for i in g))


def _whole_models(blocks: DataFrame, fits: list[Fit], weight: list[float], features: int,
                  max_bins: int) -> tuple[list[Trees], list[float | None]]:
    """All models, dealt to tasks by ``_dealt``."""
    groups = _dealt(fits, 2 * blocks.sparkSession.sparkContext.defaultParallelism)
    of = F.explode(F.array(*[F.struct(F.lit(i).alias("grp"), F.lit(fits[g[0]].matrix + 1).alias("at"))
                             for i, g in enumerate(groups)]))
    rows = (blocks.select("label", "fold", "key", "bins", of.alias("of"))
            .select("of.grp", "label", "fold", "key", F.element_at("bins", F.col("of.at")).alias("bins")))
    found = (rows.repartitionByRange(len(groups), "grp").groupBy("grp")
             .applyInArrow(_grow_group(groups, fits, weight, features, max_bins),
                           f"model int, {', '.join(f'{k} binary' for k in TREES)}, auc double").toArrow().to_pylist())
    trees = [Trees.empty(f.params.n_estimators, f.params.max_depth) for f in fits]
    auc: list[float | None] = [None] * len(fits)
    for r in found:
        t, auc[r["model"]] = trees[r["model"]], r["auc"]
        for k in TREES:
            own = getattr(t, k)
            own[:] = np.frombuffer(r[k], own.dtype).reshape(own.shape)
    return trees, auc


# ------------------------------------------------------------- binned rows

def bin_edges(rows: DataFrame, columns: list[str], max_bins: int) -> list[list[float]]:
    """Upper bounds of the bins of every column: its distinct quantiles, from one mergeable sketch a column."""
    at = [i / max_bins for i in range(1, max_bins)]
    row = rows.agg(*[F.percentile_approx(c, at, 10_000).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(row[f"c{i}"] or [])) for i in range(len(columns))]


def binned(values: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bin numbers (uint8) of a matrix of features: a value up to the first edge is in bin 0."""
    return np.column_stack([np.searchsorted(np.array(e), values[:, i], side="left") for i, e in enumerate(edges)]
                           ).astype(np.uint8)


def _as_blocks(edges: list[list[list[float]]], models: int, size: int):
    schema = pa.schema([("block", pa.string()), ("n", pa.int32()), ("label", pa.binary()), ("fold", pa.binary()),
                        ("key", pa.binary()), ("bins", pa.list_(pa.binary())), ("scores", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                own = batch.slice(first, size)
                n = own.num_rows
                label = own.column("label").to_numpy().astype(np.int8)
                fold = own.column("fold").to_numpy().astype(np.int8)
                key = own.column("key").to_numpy().astype(np.int64).view(np.uint64)
                matrices = []
                for k, e in enumerate(edges):
                    values = own.column(f"x{k}").flatten().to_numpy(zero_copy_only=False).reshape(n, len(e))
                    matrices.append(binned(values, e).tobytes())
                yield pa.RecordBatch.from_pylist([{
                    "block": f"{part}-{number}", "n": n, "label": label.tobytes(), "fold": fold.tobytes(),
                    "key": key.tobytes(), "bins": matrices,
                    "scores": np.zeros((models, n), np.float32).tobytes()}], schema=schema)
                number += 1

    return run


BLOCK = "block string, n int, label binary, fold binary, key binary, bins array<binary>, scores binary"


def _with_scores(step: _Step, fits: list[Fit], features: int):
    """Blocks with the scores of all grown trees written in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [_scores(b, step.run, step.done, step.grown, step.trees, fits).tobytes()
                      for b in _blocks([batch], features)]
            yield batch.set_column(batch.schema.get_field_index("scores"), "scores", pa.array(scores, pa.binary()))

    return run


@dataclass
class Grown:
    """All models of a search, and their exact AUC on the fold they left out (None without one)."""
    trees: list[Trees]
    edges: list[list[list[float]]]
    auc: list[float | None]


def grow(rows: DataFrame, matrices: list[list[str]], fits: list[Fit], positive_weight: list[float],
         growth: Growth = Growth(), label: str = C.TARGET, key: str = "_h", fold: str = "fold",
         fitted_on: list[int | None] | None = None, edges: list[list[list[float]]] | None = None) -> Grown:
    """Grow all ``fits`` on ``rows``.

    ``matrices`` are lists of columns of ``rows`` (doubles without nulls); bins
    are quantiles of the rows that matrix i is fitted on (all but fold
    ``fitted_on[i]``), or the given ``edges`` of every matrix and column (fewer than
    `max_bins`).  ``positive_weight`` is each model's weight of label 1.
    No rows: models of empty trees.
    """
    spark = rows.sparkSession
    features, run = len(matrices[0]), uuid.uuid4().hex
    fitted_on = fitted_on or [None] * len(matrices)
    edges = edges or [bin_edges(rows if f is None else rows.filter(F.col(fold) != f), m, growth.max_bins)
                      for m, f in zip(matrices, fitted_on)]
    n = rows.count()
    whole = n <= growth.rows_per_partition and n * features <= growth.cells_per_partition
    partitions = max(-(-n // growth.rows_per_partition),
                     min(spark.sparkContext.defaultParallelism, -(-n // growth.rows_per_block)))
    narrow = rows.select(F.col(label).cast("int").alias("label"), F.col(fold).cast("int").alias("fold"),
                         F.col(key).cast("long").alias("key"),
                         *[F.array(*[F.col(c).cast("double") for c in m]).alias(f"x{i}") for i, m in enumerate(matrices)])
    paths = []

    def written(df: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "boosting"))
        df.write.parquet(paths[-1])
        if len(paths) > 1:
            drop_folder(spark, paths[-2])
        return spark.read.schema(df.schema).parquet(paths[-1])

    if whole:
        if not n:
            return Grown([Trees.empty(f.params.n_estimators, f.params.max_depth) for f in fits], edges, [None] * len(fits))
        blocks = written(narrow.mapInArrow(_as_blocks(edges, 0, growth.rows_per_block), BLOCK))
        grown = _whole_models(blocks, fits, positive_weight, features, growth.max_bins)
        drop_folder(spark, paths[-1])
        return Grown(grown[0], edges, grown[1])
    blocks = written(narrow.repartition(partitions).mapInArrow(_as_blocks(edges, len(fits), growth.rows_per_block), BLOCK))
    trees = [Trees.empty(f.params.n_estimators, f.params.max_depth) for f in fits]
    sums = [np.zeros((2, t.feature.shape[1])) for t in trees]
    done = 0

    def step(grown: int, level: int, open_: dict, columns: dict) -> _Step:
        return _Step(run, done, {m: t.part(done, grown) for m, t in enumerate(trees) if len(t.feature) > done},
                     grown, level, open_, columns)

    def split(s: _Step) -> list:
        partial = blocks.mapInArrow(_level(s, fits, positive_weight, features, growth.max_bins), "model int, sums binary")
        if partitions > growth.merged:  # first by groups of tasks, so that no task merges more than `merged`
            many = -(-partitions // growth.merged)
            partial = (partial.withColumn("some", F.pmod(F.spark_partition_id(), F.lit(many)))
                       .groupBy("some", "model").applyInArrow(_merged, "some int, model int, sums binary"))
        return (partial.groupBy("model").applyInArrow(_merged_splits(s, fits, features, growth.max_bins), SPLITS)
                .toArrow().to_pylist())

    most = max((f.params.n_estimators for f in fits), default=0)
    for tree in range(most):
        active = [m for m, f in enumerate(fits) if f.params.n_estimators > tree]
        columns = {m: columns_of(fits[m].params, tree, features) for m in active}
        nodes = {m: np.array([0]) for m in active}
        for level in range(max(fits[m].params.max_depth for m in active)):
            open_ = {m: (trees[m].feature[tree], trees[m].bin[tree], nodes[m]) for m in active
                     if len(nodes[m]) and fits[m].params.max_depth > level}
            if not open_:
                break
            following: dict[int, list[int]] = {m: [] for m in active}
            for r in split(step(tree, level, open_, {m: columns[m] for m in open_})):
                m, at, p = r["model"], r["node"], fits[r["model"]].params
                sums[m][:, at] = r["g"], r["h"]
                if r["gain"] > max(p.gamma, 1e-6):
                    t = trees[m]
                    t.feature[tree, at], t.bin[tree, at], t.gain[tree, at] = r["feature"], r["bin"], r["gain"]
                    sums[m][:, 2 * at + 1] = r["left_g"], r["left_h"]
                    sums[m][:, 2 * at + 2] = r["g"] - r["left_g"], r["h"] - r["left_h"]
                    following[m] += [2 * at + 1, 2 * at + 2]
            nodes = {m: np.array(sorted(x), dtype=np.int64) for m, x in following.items()}
        for m in active:
            t = trees[m]
            # A child exists where its parent splits; the root always does.
            there = np.concatenate([[True], np.repeat(t.feature[tree][:t.feature.shape[1] // 2] >= 0, 2)])
            _finish(t, tree, fits[m].params, sums[m], there)
        if (tree + 1) % growth.window == 0:
            blocks = written(blocks.mapInArrow(_with_scores(step(tree + 1, 0, {}, {}), fits, features), BLOCK))
            done = tree + 1
            spark.sparkContext._jvm.System.gc()  # lets Spark delete the shuffles of past levels
    auc = _held_out(blocks, step(most, 0, {}, {}), fits, features)
    drop_folder(spark, paths[-1])
    return Grown(trees, edges, auc)


# ---------------------------------------------------------- held-out AUC

def _distinct_scores(step: _Step, fits: list[Fit], features: int):
    """(model, order, n_pos, n_neg) of the rows each model left out; `order` sorts like the score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, features):
            scores = _scores(block, step.run, step.done, step.grown, step.trees, fits)
            for m, fit in enumerate(fits):
                if fit.fold is None:
                    continue
                own = block["fold"] == fit.fold
                bits = (scores[m, own] + np.float32(0)).view(np.int32).astype(np.int64)
                order, place = np.unique(np.where(bits < 0, -(bits & 0x7FFFFFFF), bits), return_inverse=True)
                positive = np.bincount(place, block["label"][own] == 1, len(order)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(order), m), pa.int32()), pa.array(order), pa.array(positive),
                     pa.array(np.bincount(place, minlength=len(order)) - positive)],
                    names=["model", "order", "n_pos", "n_neg"])

    return run


def auc_by_model(counts: DataFrame) -> DataFrame:
    """(model, auc) from (model, order: long, n_pos, n_neg): the exact area, ties
    counted half.  Ranks are found in two steps, between buckets of scores and
    within them, so that no window holds all scores of a model."""
    scores = (counts.groupBy("model", "order").agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"))
              .withColumn("bucket", F.shiftright("order", 16)))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    buckets = (scores.groupBy("model", "bucket").agg(F.sum("n_neg").alias("n"))
               .withColumn("below", F.coalesce(F.sum("n").over(upto(Window.partitionBy("model").orderBy("bucket"))),
                                               F.lit(0))).drop("n"))
    within = F.coalesce(F.sum("n_neg").over(upto(Window.partitionBy("model", "bucket").orderBy("order"))), F.lit(0))
    ranked = scores.withColumn("within", within).join(buckets, ["model", "bucket"])
    half = (2 * (F.col("below") + F.col("within")) + F.col("n_neg")).cast("decimal(20,0)") * F.col("n_pos")
    totals = ranked.groupBy("model").agg(F.sum(half).alias("half"), F.sum("n_pos").alias("p"), F.sum("n_neg").alias("n"))
    return totals.select("model", F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("half").cast("double") / (
        2.0 * F.col("p") * F.col("n"))).alias("auc"))


def _held_out(blocks: DataFrame, step: _Step, fits: list[Fit], features: int) -> list[float | None]:
    counts = blocks.mapInArrow(_distinct_scores(step, fits, features), "model int, order long, n_pos long, n_neg long")
    found = {r["model"]: r["auc"] for r in auc_by_model(counts).collect()}
    return [found.get(m) for m in range(len(fits))]


# --------------------------------------------------------------- the model

@dataclass
class BoostedScorer:
    """One model with its column transform.  Same use as ``models.Scorer``."""
    prep: PrepStats
    params: BoostParams
    trees: Trees
    edges: list[list[float]]
    names: list[str] = field(default_factory=list)   # prepared columns, in the order of the bins

    def _features(self, df: DataFrame) -> tuple[DataFrame, Column]:
        wide = with_prepared(df, self.prep)
        return wide, F.array(*[F.col(PREPARED_PREFIX + c).cast("double") for c in self.names])

    def _udf(self, returns: str, of_bins):
        edges = self.edges

        def run(column):
            values = np.array(column.tolist(), dtype=np.float64).reshape(len(column), len(edges))
            return of_bins(binned(values, edges))

        return _pandas(run, returns)

    def margins(self, df: DataFrame, name: str = "margin") -> DataFrame:
        """``df`` with the sum of the trees (log-odds)."""
        trees = self.trees

        def of(bins):
            scores = np.zeros(len(bins), np.float32)
            add_scores(scores, trees, bins)
            return pd.Series(scores.astype(np.float64))

        keep = df.columns
        wide, x = self._features(df)
        return wide.select(*keep, self._udf("double", of)(x).alias(name))

    def score(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        """Input columns, ``prediction`` and ``prob_churn``, as ``models.Scorer.score``."""
        keep = [c for c in df.columns if c != "__margin"]
        out = self.margins(df, "__margin").withColumn("prob_churn", 1 / (1 + F.exp(-F.col("__margin"))))
        cut = 0.5 if threshold is None else float(threshold)
        at_least = F.col("prob_churn") > cut if threshold is None else F.col("prob_churn") >= cut
        return out.select(*keep, at_least.cast("int").alias("prediction"), "prob_churn")

    def sources(self) -> list[str]:
        """The input column behind every prepared column."""
        dummies = {f"{c}_{v}": c for c, values in self.prep.categories.items() for v in values}
        return [n if n in self.prep.means else dummies[n] for n in self.names]

    def importance(self) -> list[tuple[str, float]]:
        """Loss reduction of all splits by input column, as shares, largest first."""
        totals = dict.fromkeys([*self.prep.means, *self.prep.categories], 0.0)
        inner = self.trees.feature >= 0
        for f, gain in zip(self.trees.feature[inner].tolist(), self.trees.gain[inner].tolist()):
            totals[self.sources()[f]] += gain
        whole = sum(totals.values()) or 1.0
        return sorted(((k, v / whole) for k, v in totals.items()), key=lambda kv: (-kv[1], kv[0]))

    def to_json(self) -> str:
        t = self.trees
        return json.dumps({"prep": self.prep.to_json(), "params": asdict(self.params), "edges": self.edges,
                           "names": self.names, "trees": {k: getattr(t, k).tolist() for k in (
                               "feature", "bin", "value", "cover", "gain")}})

    @classmethod
    def from_json(cls, text: str) -> BoostedScorer:
        d = json.loads(text)
        kinds = {"feature": np.int16, "bin": np.int16, "value": np.float32, "cover": float, "gain": float}
        return cls(PrepStats.from_json(d["prep"]), BoostParams(**d["params"]),
                   Trees(**{k: np.array(d["trees"][k], dtype) for k, dtype in kinds.items()}), d["edges"], d["names"])

    def save(self, spark: SparkSession, path: str) -> str:
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedScorer:
        return cls.from_json(spark.read.parquet(path).first()["model"])


def _pandas(run, returns: str):
    def series(x: pd.Series) -> pd.Series:
        return run(x)

    return F.pandas_udf(series, returns)


def prepared_names(stats: PrepStats) -> list[str]:
    return [c[len(PREPARED_PREFIX):] for c in prepared_columns(stats)]
