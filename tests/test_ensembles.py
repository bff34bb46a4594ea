"""Histogram forests and boosting against plain recursive versions on small tables."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from claimspark.operators import boosting as B
from claimspark.operators import forest as RF
from claimspark.operators import histograms as H

WEIGHTS = (1.0, 2.5)


def table(n, seed, width=5):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 3, n), rng.exponential(size=n).round(1), rng.integers(0, 2, n), np.full(n, 7.0)])[:, :width]
    y = (x[:, 0] + 0.8 * (x[:, 1] == 1) - 0.5 * x[:, 2] + rng.normal(size=n) > 0.2).astype(int)
    return x, y


def landed(spark, x, y, bins, partitions=3):
    rows = [(f"c{i}", Vectors.dense(v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    prepared = spark.createDataFrame(rows, _schema()).repartition(partitions).cache()
    edges = H.bin_edges(prepared, "f", "claim_id", bins)
    return H.land_blocks(prepared, "f", "y", "claim_id", edges), edges, prepared


def _schema():
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    return T.StructType([T.StructField("claim_id", T.StringType()), T.StructField("f", VectorUDT()), T.StructField("y", T.IntegerType())])


def whole(blocks):
    parts = [H.unpack(r["bins"], r["keys"], r["labels"]) for r in blocks.collect()]
    return tuple(np.concatenate(c) for c in zip(*parts))


def plain_booster(block, spec, edges):
    """Node by node over the rows themselves: no histograms, levels, merges or guesses."""
    bins, keys, y = block
    base = float(np.log((y == 1).sum() * WEIGHTS[1] / ((y == 0).sum() * WEIGHTS[0])))
    margin, trees, unit = np.full(len(y), base), [], float(1 << B.BITS)
    for tree in range(spec.trees):
        chosen = spec.chosen(len(edges), tree)
        g, h = B.gradients(y, margin, WEIGHTS)
        rows = np.flatnonzero(H.uniform(keys, spec.seed, tree) < spec.subsample)
        step = np.zeros(len(y))
        splits = {}

        def grow(node, rows, every, depth):
            all_g, all_h = g[rows].sum() / unit, h[rows].sum() / unit
            step[every] = -spec.rate * all_g / (all_h + spec.penalty)
            best = (1e-6, None, None)
            if depth < spec.depth and all_h >= 2 * spec.least_hessian:
                for f in chosen:
                    for c in range(len(edges[f])):
                        left = bins[rows, f] <= c
                        lg, lh = g[rows[left]].sum() / unit, h[rows[left]].sum() / unit
                        rg, rh = all_g - lg, all_h - lh
                        gain = lg**2 / (lh + spec.penalty) + rg**2 / (rh + spec.penalty) - all_g**2 / (all_h + spec.penalty)
                        if min(lh, rh) >= spec.least_hessian and gain > best[0] + 1e-9:
                            best = (gain, f, c)
            if best[1] is not None:
                _, f, c = best
                splits[node] = (int(f), c)
                left, all_left = bins[rows, f] <= c, bins[every, f] <= c
                grow(2 * node + 1, rows[left], every[all_left], depth + 1)
                grow(2 * node + 2, rows[~left], every[~all_left], depth + 1)

        grow(0, rows, np.arange(len(y)), 0)
        trees.append(splits)
        margin = margin + step
    return trees, margin


def loss(y, margin):
    w = np.where(y == 1, WEIGHTS[1], WEIGHTS[0])
    return float(np.sum(w * (np.logaddexp(0, margin) - y * margin)) / w.sum())


@pytest.fixture(params=["one pass", "poor guesses", "merged by shuffle"])
def way(request, monkeypatch):
    if request.param == "poor guesses":
        monkeypatch.setattr(B, "GUESS_ROWS", 12)
    if request.param == "merged by shuffle":
        monkeypatch.setattr(B, "DIRECT_BYTES", 0)
        monkeypatch.setattr(B, "PART_BYTES", 1)


def test_boosting_equals_the_plain_booster(spark, way):
    x, y = table(300, 5)
    blocks, edges, _ = landed(spark, x, y, 8)
    spec = B.Boosting(trees=6, depth=4, rate=0.3, bins=8)
    model = B.fit(blocks, list("abcde"), edges, WEIGHTS, spec)
    block = whole(blocks)
    trees, margin = plain_booster(block, spec, edges)
    got = [{int(i): (int(f[i]), int(c[i])) for i in np.flatnonzero(f >= 0)} for f, c in zip(model.feature, model.cut)]
    assert got == trees
    np.testing.assert_allclose(model.outputs(block[0]), margin, atol=1e-9)
    assert loss(block[2], model.outputs(block[0])) == pytest.approx(loss(block[2], margin), abs=1e-10)
    assert loss(block[2], margin) < loss(block[2], np.full(len(margin), model.base)) - 0.1


def test_boosting_is_the_same_for_any_dealing(spark):
    x, y = table(400, 6)
    models = [B.fit(landed(spark, x, y, 16, n)[0].repartition(n), list("abcde"), landed(spark, x, y, 16, n)[1], WEIGHTS,
                    B.Boosting(trees=4, depth=3, bins=16)) for n in (2, 8)]
    assert all(np.array_equal(getattr(models[0], k), getattr(models[1], k)) for k in ("feature", "cut", "value", "cover", "gain"))


@pytest.mark.parametrize("moved", [1 << 20, -1])
def test_boosting_finishes_small_nodes_in_tasks(spark, monkeypatch, moved):
    """Poor guesses cost a pass a level; the rows of nodes that are small enough meet in a task instead."""
    x, y = table(600, 7)
    blocks, edges, _ = landed(spark, x, y, 8)
    spec, passes, finished = B.Boosting(trees=3, depth=5, rate=0.3, bins=8), [], []
    monkeypatch.setattr(B, "GUESS_ROWS", 12)
    monkeypatch.setattr(B, "MOVED_ROWS", moved)
    monkeypatch.setattr(B, "SUBTREE_ROWS", (300, 300))
    for name, calls in (("_whole_splits", passes), ("_subtrees", finished)):
        monkeypatch.setattr(B, name, lambda *a, f=getattr(B, name), calls=calls: calls.append(1) or f(*a))
    model = B.fit(blocks, list("abcde"), edges, WEIGHTS, spec)
    trees, margin = plain_booster(whole(blocks), spec, edges)
    assert [{int(i): (int(f[i]), int(c[i])) for i in np.flatnonzero(f >= 0)} for f, c in zip(model.feature, model.cut)] == trees
    np.testing.assert_allclose(model.outputs(whole(blocks)[0]), margin, atol=1e-9)
    assert (len(finished) > 0 and len(passes) <= 3 * 3) if moved > 0 else (not finished and len(passes) > 3 * 3)


def test_features_counted_together_have_their_own_histograms():
    rng = np.random.default_rng(3)
    sizes = np.array([8, 2, 1, 3, 2, 8, 5])
    bins = np.column_stack([rng.integers(0, n, 500) for n in sizes]).astype(np.uint8)
    at, g, h = rng.integers(-1, 4, 500), rng.integers(-99, 99, 500).astype(float), rng.integers(0, 99, 500).astype(float)
    chosen = np.array([0, 1, 3, 4, 6])
    got = B.histogram(at, 4, bins, chosen, g, h, B.Boosting(bins=8), sizes[chosen])
    for n, j, b in np.ndindex(4, len(chosen), 8):
        rows = (at == n) & (bins[:, chosen[j]] == b)
        assert got[n, j, b].tolist() == [g[rows].sum(), h[rows].sum()]
    assert sorted(j for group in B.joined(tuple(sizes)) for j in group) == list(range(7)) and len(B.joined(tuple(sizes))) < 7


def plain_tree(block, plan, tree, model):
    """{node: (feature, cut)} and {node: share of class 1} by recursion over drawn rows."""
    bins, keys, y = block
    count = RF.drawn(keys, plan, tree) * (RF.fold_of(keys, plan.folds, plan.seed) != model)
    w = np.array(plan.weights)
    splits, shares = {}, {}

    def impure(n):
        a, b = n * w
        return 2 * a * b / (a + b) if a + b > 0 else 0.0

    def grow(node, rows, depth):
        n = np.array([count[rows][y[rows] == k].sum() for k in (0, 1)])
        if n.sum():
            shares[node] = n[1] * w[1] / (n * w).sum()
        if depth == plan.depth or n.min() == 0:
            return
        best = (1e-9 * (n * w).sum(), None, None)
        for f in RF.tried_features(plan, tree, np.array([node]))[0]:
            for c in range(plan.bins):
                left = bins[rows, f] <= c
                a = np.array([count[rows[left]][y[rows[left]] == k].sum() for k in (0, 1)])
                gain = impure(n) - impure(a) - impure(n - a)
                if a.sum() and (n - a).sum() and gain > best[0] + 1e-12:
                    best = (gain, f, c)
        if best[1] is not None:
            splits[node] = (int(best[1]), best[2])
            left = bins[rows, best[1]] <= best[2]
            grow(2 * node + 1, rows[left], depth + 1)
            grow(2 * node + 2, rows[~left], depth + 1)

    grow(0, np.flatnonzero(count), 0)
    return splits, shares


def test_forests_equal_plain_trees(spark):
    x, y = table(250, 7)
    blocks, edges, _ = landed(spark, x, y, 6)
    plan = RF.Plan(2, 5, 4, 6, len(edges), WEIGHTS)
    forests = RF.grow(H.block_rdd(blocks), plan, list("abcde"), edges)
    block = whole(blocks)
    for model, own in enumerate(forests):
        for t in range(plan.trees):
            splits, shares = plain_tree(block, plan, t, model)
            assert {int(i): (int(own.feature[t, i]), int(own.cut[t, i])) for i in np.flatnonzero(own.feature[t] >= 0)} == splits
            for node, share in shares.items():
                assert own.value[t, node] == pytest.approx(share, abs=1e-12)


def test_a_smaller_forest_is_part_of_a_larger_one(spark):
    x, y = table(300, 8)
    blocks, edges, _ = landed(spark, x, y, 6)
    grown = [RF.grow(H.block_rdd(blocks), RF.Plan(0, trees, depth, 6, len(edges), WEIGHTS), list("abcde"), edges)[-1] for trees, depth in ((6, 5), (4, 3))]
    cut = grown[0].truncated(4, 3)
    assert all(np.array_equal(getattr(cut, k), getattr(grown[1], k)) for k in ("feature", "gain", "value", "cover"))


def test_grid_search_equals_brute_force(spark):
    x, y = table(300, 9)
    blocks, edges, _ = landed(spark, x, y, 6)
    grid = {"numTrees": [2, 4], "maxDepth": [2, 3], "maxBins": [6]}
    tuned = RF.tune(blocks, list("abcde"), edges, grid, 3, WEIGHTS)
    plan = RF.Plan(3, 4, 3, 6, len(edges), WEIGHTS)
    bins, keys, labels = whole(blocks)
    forests, fold, want = RF.grow(H.block_rdd(blocks), plan, list("abcde"), edges), RF.fold_of(keys, 3, plan.seed), []
    for g in tuned.grid:
        aucs = []
        for k in range(3):
            s, t = forests[k].truncated(g["numTrees"], g["maxDepth"]).outputs(bins[fold == k]), labels[fold == k]
            pairs = s[t == 1][:, None] - s[t == 0][None, :]
            aucs.append(((pairs > 0).sum() + 0.5 * (pairs == 0).sum()) / pairs.size)
        want.append(np.mean(aucs))
    assert tuned.avgMetrics == pytest.approx(want, abs=1e-12)
    assert tuned.best == tuned.grid[int(np.argmax(want))] and tuned.bestModel.n_trees == tuned.best["numTrees"]


def test_bins_and_edges(spark):
    x, y = table(500, 10)
    _, edges, prepared = landed(spark, x, y, 8)
    assert edges[1].tolist() == [0.0, 1.0] and edges[3].tolist() == [0.0] and len(edges[4]) == 0 and len(edges[0]) == 7
    got = H.binned(x, edges)
    assert got.max() <= 7 and np.array_equal(got[:, 1], x[:, 1].astype(int))
    counts = np.bincount(got[:, 0])
    assert counts.min() > 40 and counts.max() < 90


def test_one_class_and_no_rows(spark):
    x, _ = table(60, 11)
    for y, n in ((np.ones(60), 60), (np.zeros(60), 60), (np.ones(60), 0)):
        blocks, edges, _ = landed(spark, x[:n] if n else x, y[:n] if n else y, 4)
        blocks = blocks if n else blocks.limit(0)
        model = B.fit(blocks, list("abcde"), edges, WEIGHTS, B.Boosting(trees=2, depth=2, bins=4))
        assert (model.feature >= 0).sum() == 0 and model.base == 0.0
        forest = RF.tune(blocks, list("abcde"), edges, {"numTrees": [2], "maxDepth": [2], "maxBins": [4]}, 0, WEIGHTS).bestModel
        assert set(forest.outputs(H.binned(x, edges)).tolist()) == {float(y[0]) if n else 0.0}


def test_a_grid_walks_each_tree_once_and_a_pass_sends_narrow_histograms(monkeypatch):
    rng = np.random.default_rng(11)
    bins, y = rng.integers(0, 6, (500, 5)).astype(np.uint8), rng.integers(0, 2, 500).astype(np.int8)
    keys, size = rng.integers(0, 1 << 62, 500).astype(np.uint64), 31
    feature, cut = rng.integers(-1, 5, (4, size)).astype(np.int16), rng.integers(0, 5, (4, size)).astype(np.uint8)
    feature[:, 15:] = -1
    zeros = np.zeros((4, size))
    forest = H.Ensemble("forest", list("abcde"), [np.arange(5.0)] * 5, feature, cut, zeros, zeros, rng.random((4, size)))
    grid = [{"numTrees": t, "maxDepth": d} for t in (2, 4) for d in (2, 4)]
    plain = [forest.truncated(g["numTrees"], g["maxDepth"]).outputs(bins) for g in grid]
    walks, steps = [], RF.steps
    monkeypatch.setattr(RF, "steps", lambda *a: walks.append(1) or steps(*a))
    for got, own in zip(RF.grid_outputs(forest, grid, bins), plain, strict=True):
        np.testing.assert_array_equal(got, own)
    assert len(walks) == 4  # not one for each combination
    plan = RF.Plan(2, 4, 4, 6, 5, WEIGHTS)
    count = RF.drawn(keys, plan, 1)
    rows, nodes = np.flatnonzero(count), np.array([0])
    h = RF.tree_histogram(RF.classed((bins, keys, y)), rows * 5, count[rows].astype(float), plan, 1, feature[0], cut[0], nodes, 0)
    at, n = RF.packed(h)
    assert at is None and n.nbytes <= 2 * h.size
    for k, f in enumerate(RF.tried_features(plan, 1, nodes)[0]):
        for b in range(6):
            for c in (0, 1):
                assert n.reshape(plan.tried, 6, 2)[k, b, c] == count[(bins[:, f] == b) & (y == c)].sum()
