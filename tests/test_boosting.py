"""Many-model boosting against a plain single-model version, and Shapley values against subset enumeration."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.operators import boosting as B
from churnlens.operators import models as M
from churnlens.operators.attribution import leaf_tables, mean_abs_shapley, row_values, shapley_values
from churnlens.operators.prep import PrepStats
from churnlens.plans import training as TR


def table(n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.randint(0, 20), rng.random(), rng.randint(0, 1)
        rows.append((a * 1.0, b, float(c), int(rng.random() < (0.8 if a > 9 and b > .4 else 0.2 + 0.2 * c)),
                     rng.getrandbits(60), rng.randrange(3)))
    return rows


SCHEMA = "a double, b double, c double, y int, _h long, fold int"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(table(), SCHEMA)


def plain(rows, fit, edges, weight):
    """One model, node by node, every split tried by a plain loop over floats."""
    p = fit.params
    x = B.binned(np.array([r[:3] for r in rows]), edges)
    y, key = np.array([r[3] for r in rows]), np.array([r[4] for r in rows], dtype=np.int64).view(np.uint64)
    fold = np.array([r[5] for r in rows])
    scores = np.zeros(len(rows), np.float32)
    trees = []
    for t in range(p.n_estimators):
        use = B.sampled(key, p.seed, t, p.subsample) & ((fold != fit.fold) if fit.fold is not None else True)
        prob = 1 / (1 + np.exp(-scores.astype(float)))
        w = np.where(y == 1, weight, 1.0)
        g = np.round((prob - y) * w / B.UNIT) * B.UNIT
        h = np.round(np.maximum(prob * (1 - prob), 1e-6) * w / B.UNIT) * B.UNIT
        columns = B.columns_of(p, t, 3)
        values = np.zeros(len(rows), np.float32)
        tree = {}

        def gain(G, H):
            return max(abs(G) - p.reg_alpha, 0) ** 2 / (H + p.reg_lambda)

        def visit(node, mine, level):
            G, H = g[mine & use].sum(), h[mine & use].sum()
            best = None
            if level < p.max_depth:
                for f in columns:
                    for b in range(63):
                        left = mine & use & (x[:, f] <= b)
                        GL, HL = g[left].sum(), h[left].sum()
                        if HL < p.min_child_weight or H - HL < p.min_child_weight:
                            continue
                        value = gain(GL, HL) + gain(G - GL, H - HL) - gain(G, H)
                        if best is None or value > best[0] + 1e-12:
                            best = value, f, b
            if best is not None and best[0] > max(p.gamma, 1e-6):
                _, f, b = best
                tree[node] = (f, b)
                visit(2 * node + 1, mine & (x[:, f] <= b), level + 1)
                visit(2 * node + 2, mine & (x[:, f] > b), level + 1)
            else:
                values[mine] = np.float32(-p.learning_rate * math.copysign(max(abs(G) - p.reg_alpha, 0), G)
                                          / (H + p.reg_lambda))

        visit(0, np.ones(len(rows), bool), 0)
        scores += values
        trees.append(tree)
    return trees, scores


PARAMS = [B.BoostParams(3, 3, .3, 1.0, 1.0, 0.0, 1.0, 1.0, 0.0),
          B.BoostParams(5, 2, .1, .7, .67, .5, 2.0, 3.0, .2),
          B.BoostParams(4, 4, .08, .9, .9, 1.0, 5.0, 5.0, .5)]


@pytest.mark.parametrize("growth", [B.Growth(), B.Growth(rows_per_partition=60, rows_per_block=25, window=2, merged=2)])
def test_equals_plain_models(spark, rows, growth):
    """All models together, in one partition or in many with partial sums merged in two
    steps, scores written after every second tree: the same trees as one at a time."""
    fits = [B.Fit(p, fold) for p in PARAMS for fold in (None, 1)]
    grown = B.grow(rows, [["a", "b", "c"]], fits, [1.7] * len(fits), growth, label="y")
    for fit, trees, auc in zip(fits, grown.trees, grown.auc):
        expected, scores = plain(table(), fit, grown.edges[0], 1.7)
        for k, tree in enumerate(expected):
            got = {i: (int(trees.feature[k, i]), int(trees.bin[k, i])) for i in np.flatnonzero(trees.feature[k] >= 0)}
            assert got == tree
        x = B.binned(np.array([r[:3] for r in table()]), grown.edges[0])
        mine = np.zeros(len(x), np.float32)
        B.add_scores(mine, trees, x)
        assert np.allclose(mine, scores, atol=1e-6)
        if fit.fold is None:
            assert auc is None
        else:
            held = [(s, r[3]) for s, r in zip(mine, table()) if r[5] == 1]
            pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
            wins = sum((a > b) + .5 * (a == b) for a in pos for b in neg)
            assert auc == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)


def test_matrices_and_layout(spark, rows):
    """A model reads its own matrix; another layout of the rows changes nothing."""
    wide = rows.withColumns({"a2": -F.col("a"), "b2": F.col("b") * 0, "c2": F.col("c")})
    matrices = [["a", "b", "c"], ["a2", "b2", "c2"]]
    fits = [B.Fit(PARAMS[1], 0, 0), B.Fit(PARAMS[1], 0, 1)]
    one = B.grow(wide, matrices, fits, [1.0] * 2, label="y", fitted_on=[0, 0])
    two = B.grow(wide.repartition(7, "b"), matrices, fits, [1.0] * 2, B.Growth(rows_per_partition=40), label="y",
                 fitted_on=[0, 0])
    for a, b in zip(one.trees, two.trees):
        assert (a.feature == b.feature).all() and (a.bin == b.bin).all() and (a.value == b.value).all()
    assert one.auc == two.auc
    assert not (one.trees[1].feature == 1).any()  # a constant column never splits


def jobs_of(spark, group, run):
    """Spark jobs of ``run()``."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_trees(spark, rows):
    """Rows that fit a task: models are dealt to tasks, no job a level."""
    def grow(trees):
        return B.grow(rows, [["a", "b", "c"]], [B.Fit(B.BoostParams(trees, 3), f) for f in (None, 0, 1)], [1.0] * 3, label="y")

    few, many = (jobs_of(spark, f"trees-{n}", lambda n=n: grow(n)) for n in (2, 12))
    assert few == many < 12


def test_whole_models_equal_levels(spark, rows):
    """A task that grows whole models gives what the jobs by level give, covers and gains too."""
    fits = [B.Fit(B.BoostParams(6, d, .2, s, .67, .1, 1.0, 2.0, .1), f) for d, s in ((1, 1.0), (5, .6)) for f in (None, 2)]
    one, two = (B.grow(rows, [["a", "b", "c"]], fits, [2.5] * len(fits), g, label="y")
                for g in (B.Growth(), B.Growth(rows_per_partition=100, rows_per_block=50, window=4)))
    assert one.auc == two.auc
    for a, b in zip(one.trees, two.trees):
        for k in B.TREES:
            assert (getattr(a, k) == getattr(b, k)).all(), k


def test_deep_and_wide_models_equal_levels(spark):
    """More nodes that split than are compared one by one, node numbers beyond a byte and
    columns that share a histogram; a matrix of too many cells is not one task's."""
    wide = spark.createDataFrame(table(6000, 3), SCHEMA).withColumn("d", F.col("_h") % 7)
    fits = [B.Fit(B.BoostParams(2, 9, .3, s, c, .0, .1, .5, .0), f) for s, c in ((1.0, 1.0), (.8, .75)) for f in (None, 1)]
    one, two = (B.grow(wide, [["a", "b", "c", "d"]], fits, [1.3] * 4, g, label="y")
                for g in (B.Growth(), B.Growth(cells_per_partition=20_000, rows_per_block=1500)))
    assert max((t.feature[0, 63:127] >= 0).sum() for t in one.trees) > B.COMPARED
    assert one.auc == two.auc
    for a, b in zip(one.trees, two.trees):
        for k in B.TREES:
            assert (getattr(a, k) == getattr(b, k)).all(), k


def test_columns_share_histograms():
    """Fewer passes than columns, and the sums of every column by node all the same."""
    rng, n = np.random.default_rng(5), 150_000
    sizes = [64, 3, 2, 2, 40, 2, 11]
    block = {"bins": np.stack([rng.integers(0, k, n) for k in sizes]).astype(np.uint8), "fold": rng.integers(0, 3, n),
             "label": rng.integers(0, 2, n), "key": rng.integers(0, 1 << 60, n).astype(np.uint64)}
    rows = B._Rows.of(block, B.Fit(B.BoostParams(1, 3), 2))
    assert rows.seen == (block["fold"] != 2).sum()
    g, h = rng.integers(-2 ** 20, 2 ** 20, rows.seen), rng.integers(0, 2 ** 18, rows.seen)
    rows.slopes.real, rows.slopes.imag, rows.use[:] = g, h, True
    rows.node[:] = rng.integers(0, 7, n)
    columns = np.array([0, 1, 2, 4, 5, 6])
    own = B._Histograms(rows, columns, 64)
    assert len(own.packs) <= 3 and sorted(i for p in own.packs for i in p) == list(range(len(columns)))
    for got, nodes in ((own.of(), [range(7)]), (own.of(np.array([3, 6]), 7), [[3], [6]])):
        for i, some in enumerate(nodes):
            mine = np.isin(rows.node[:rows.seen], list(some))
            for j, c in enumerate(columns):
                for k, x in enumerate((g, h)):
                    assert (got[k, i, j] == np.bincount(rows.bins[c, :rows.seen][mine], x[mine], 64)).all()


def test_tasks_have_like_work():
    fits = [B.Fit(B.BoostParams(**d), f, f) for d in M.random_draws() for f in range(3)]
    work = lambda m: fits[m].params.n_estimators * (fits[m].params.max_depth + 2)
    groups = B._dealt(fits, 24)
    assert sorted(m for g in groups for m in g) == list(range(len(fits)))
    assert all(len({fits[m].matrix for m in g}) == 1 for g in groups) and len(groups) == 24
    loads = [sum(map(work, g)) for g in groups]
    assert loads == sorted(loads, reverse=True) and max(loads) < 1.25 * sum(loads) / len(loads)


def test_search_fits_only_the_best_draw_on_all_rows(monkeypatch):
    """A model without a held-out fold is one whose result may be read."""
    class Stop(Exception):
        pass

    grown = []
    stats = PrepStats({"a": 9.0}, {}, {"a": 0.0}, {"a": 1.0}, {})

    def grow(rows, matrices, fits, *args, **kwargs):
        grown.append(fits)
        if len(grown) > 1:
            raise Stop
        return B.Grown([], [], [[.6, .9, None][f.params.n_estimators // 2] for f in fits])

    class Rows:
        sparkSession = None

        def filter(self, condition):
            return self

    monkeypatch.setattr(M, "grow", grow)
    monkeypatch.setattr(M, "fit_prep", lambda df: stats)
    monkeypatch.setattr(M, "with_prepared", lambda df, *args: df)
    monkeypatch.setattr(M, "inheritable_thread_target", lambda spark: lambda f: f)
    with pytest.raises(Stop):
        M.boosted_search(Rows(), [{"n_estimators": n} for n in (1, 2, 4)], 1.0)
    search, refit = grown
    assert sorted((f.params.n_estimators, f.fold) for f in search) == [(n, f) for n in (1, 2, 4) for f in range(3)]
    assert [(f.params.n_estimators, f.fold) for f in refit] == [(2, None)]


def test_no_rows_one_class_and_ties(spark, rows):
    grown = B.grow(rows.limit(0), [["a", "b", "c"]], [B.Fit(PARAMS[0], 1)], [1.0], label="y")
    assert (grown.trees[0].feature == -1).all() and grown.auc == [None]
    grown = B.grow(rows.filter("y = 1"), [["a", "b", "c"]], [B.Fit(PARAMS[0], 1)], [1.0], label="y")
    assert grown.auc == [None]
    same = spark.createDataFrame([(1.0, 1.0, 1.0, i % 2, i, i % 3) for i in range(60)], SCHEMA)
    grown = B.grow(same, [["a", "b", "c"]], [B.Fit(PARAMS[0], 1)], [1.0], label="y")
    assert (grown.trees[0].feature == -1).all() and grown.auc == [0.5]


def test_auc_in_two_steps(spark):
    rng = random.Random(2)
    counts = [(m, rng.choice([-1, 1]) * rng.randrange(1 << 20), rng.randrange(3), rng.randrange(3))
              for m in (0, 1) for _ in range(300)] + [(2, 5, 1, 0)]
    got = {r["model"]: r["auc"] for r in B.auc_by_model(
        spark.createDataFrame(counts, "model int, order long, n_pos long, n_neg long")).collect()}
    for m in (0, 1):
        own = [c for c in counts if c[0] == m]
        wins = sum(a[2] * b[3] * ((a[1] > b[1]) + .5 * (a[1] == b[1])) for a in own for b in own)
        assert got[m] == pytest.approx(wins / sum(c[2] for c in own) / sum(c[3] for c in own), abs=1e-12)
    assert got[2] is None


# --------------------------------------------------------------- attribution

def expectation(trees, k, x, known):
    """The tree's value where only the columns ``known`` are known."""
    def visit(node):
        f = trees.feature[k, node]
        if f < 0:
            return float(trees.value[k, node])
        left, right = 2 * node + 1, 2 * node + 2
        if f in known:
            return visit(left if x[f] <= trees.bin[k, node] else right)
        whole = trees.cover[k, node]
        return (trees.cover[k, left] * visit(left) + trees.cover[k, right] * visit(right)) / whole
    return visit(0)


def grown_trees(seed, features=5, depth=4):
    rng = np.random.default_rng(seed)
    trees = B.Trees.empty(3, depth)
    for k in range(3):
        trees.cover[k, 0] = 100
        for node in range((1 << depth) - 1):
            if trees.cover[k, node] and rng.random() < .85:
                trees.feature[k, node], trees.bin[k, node] = rng.integers(features), rng.integers(6)
                share = rng.uniform(.1, .9)
                trees.cover[k, 2 * node + 1] = share * trees.cover[k, node]
                trees.cover[k, 2 * node + 2] = (1 - share) * trees.cover[k, node]
        trees.value[k] = np.where(trees.feature[k] < 0, rng.normal(size=trees.value.shape[1]), 0)
    return trees


@pytest.mark.parametrize("seed", range(4))
def test_shapley_equals_subset_enumeration(seed):
    """Columns repeat on paths; every subset of the five columns is tried."""
    trees, n = grown_trees(seed), 5
    bins = np.random.default_rng(seed + 50).integers(0, 7, (12, n)).astype(np.uint8)
    base, tables = leaf_tables(trees)
    got = row_values(tables, bins)
    assert base == pytest.approx(sum(expectation(trees, k, bins[0], ()) for k in range(3)))
    for x, values in zip(bins, got):
        for i in range(n):
            others = [j for j in range(n) if j != i]
            want = sum(math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n)
                       * sum(expectation(trees, k, x, {*s, i}) - expectation(trees, k, x, set(s)) for k in range(3))
                       for size in range(n) for s in itertools.combinations(others, size))
            assert values[i] == pytest.approx(want, abs=1e-9)


def scorer(spark):
    rows = spark.createDataFrame(table(), SCHEMA).withColumn("kind", F.when(F.col("c") == 1, "x").otherwise("y"))
    stats = PrepStats({"a": 9.0, "b": 0.5}, {"kind": "x"}, {"a": 0.0, "b": 0.0}, {"a": 1.0, "b": 1.0}, {"kind": ["x", "y"]})
    wide = B.with_prepared(rows, stats)
    params = B.BoostParams(6, 3, .3)
    grown = B.grow(wide, [["__p_a", "__p_b", "__p_kind_y"]], [B.Fit(params)], [1.0], label="y")
    return rows, B.BoostedScorer(stats, params, grown.trees[0], grown.edges[0], B.prepared_names(stats))


def test_values_add_up_and_awkward_rows(spark, tmp_path):
    rows, model = scorer(spark)
    extra = rows.unionByName(spark.createDataFrame([(None, float("nan"), None, None, 1, 0, None), (1e300, -1.0, 0.0, 1, 2, 0, "new")],
                                                   SCHEMA + ", kind string")).withColumn("margin_", F.lit("kept"))
    values = shapley_values(model, extra).collect()
    assert len(values) == 302
    margins = [r["margin"] for r in model.margins(extra).collect()]
    for r, m in zip(values, margins):
        assert set(r["contributions"]) == {"a", "b", "kind"} and r["margin_"] == "kept"
        assert r["base"] + sum(r["contributions"].values()) == pytest.approx(r["margin"], abs=1e-12)
        assert r["margin"] == pytest.approx(m, abs=1e-5)
    mean = {r["feature"]: r for r in mean_abs_shapley(shapley_values(model, rows)).collect()}
    own = shapley_values(model, rows).collect()
    assert mean["a"]["mean_abs_attribution"] == pytest.approx(np.mean([abs(r["contributions"]["a"]) for r in own]))
    assert mean["a"]["max_error"] < 1e-12
    assert set(shapley_values(model, rows, by_source=False).first()["contributions"]) == {"a", "b", "kind_y"}
    assert shapley_values(model, rows.limit(0)).count() == 0
    scored = model.score(rows).collect()
    again = B.BoostedScorer.load(spark, model.save(spark, str(tmp_path / "m"))).score(rows).collect()
    assert scored == again and all(0 < r["prob_churn"] < 1 for r in scored)
    assert sum(v for _, v in model.importance()) == pytest.approx(1)


def test_attribution_of_few_rows_is_dealt_to_all_cores(spark, monkeypatch):
    """Rows of one small file would be one task, whatever a row's look-ups cost."""
    rows, model = scorer(spark)
    seen = []
    monkeypatch.setattr(TR.AT, "shapley_values", lambda of, df: seen.append(df) or shapley_values(of, df))
    got = TR.attribution(TR.ModelRun("tag", "run", model, None, 1.0, None), rows.coalesce(1)).collect()
    assert seen[0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    want = {r["feature"]: r for r in mean_abs_shapley(shapley_values(model, rows)).collect()}
    assert {r["feature"] for r in got} == set(want)
    for r in got:
        assert r["mean_abs_attribution"] == pytest.approx(want[r["feature"]]["mean_abs_attribution"], abs=1e-12)
