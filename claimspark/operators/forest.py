"""Random forests for a whole grid and all its folds, grown together from histograms.

A tree's randomness (which rows it draws, which features a node tries) hangs on
(seed, tree, node) alone. So the forests of a grid of tree counts and depths
are parts of one: its first trees, cut at a depth. One forest of the largest size
is grown for each fold's training rows and one for all rows; all of them grow level
by level in the same passes over one binned copy, with (model, tree, node,
feature, bin) as the key of the histograms.

Rows are drawn with replacement (Poisson counts from a hash), nodes try a square
root of the features, splits are by weighted Gini impurity, and a row's
probability is the mean of its leaves' weighted shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.operators.evaluate import grouped_auc_roc
from claimspark.operators.histograms import SEED, Block, Ensemble, block_rdd, mix, steps, uniform, unpack, walk

#: Bytes of histograms that one merging task may hold.
MERGE_BYTES = 256_000_000
#: Cumulative probabilities of a Poisson(1) count.
_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(16)])


@dataclass(frozen=True)
class Plan:
    """What is grown: ``folds`` models without a fold each, then one of all rows."""

    folds: int
    trees: int
    depth: int
    bins: int
    width: int
    weights: tuple[float, float]
    seed: int = SEED

    @property
    def models(self) -> int:
        return self.folds + 1

    @property
    def tried(self) -> int:
        return max(1, int(np.ceil(np.sqrt(self.width))))


def fold_of(keys: np.ndarray, folds: int, seed: int) -> np.ndarray:
    """Each row's fold; -1 without folds."""
    return (uniform(keys, seed, 1 << 32) * folds).astype(np.int64) if folds else np.full(len(keys), -1)


def drawn(keys: np.ndarray, plan: Plan, tree: int) -> np.ndarray:
    """How often each row is in the tree's sample."""
    u, count = uniform(keys, plan.seed, tree), np.zeros(len(keys), np.int8)
    for p in _POISSON:
        count += u >= p
    return count


def tried_features(plan: Plan, tree: int, nodes: np.ndarray) -> np.ndarray:
    """The features that each node may split on, in order (nodes x tried)."""
    salt = mix(np.array([plan.seed + 1, tree], np.uint64))
    place = nodes.astype(np.uint64)[:, None] * np.uint64(plan.width) + np.arange(plan.width, dtype=np.uint64)
    order = np.argsort(mix(place ^ salt[0] ^ (salt[1] << np.uint64(1))), axis=1, kind="stable")[:, :plan.tried]
    return np.sort(order, axis=1)


def classed(block: Block) -> np.ndarray:
    """2 * bin + class of all values of a block, row by row."""
    bins, _, y = block
    wide = bins if not bins.size or bins.max() < 128 else bins.astype(np.uint16)
    return (2 * wide + y.astype(wide.dtype)[:, None]).ravel()


def tree_histogram(flat: np.ndarray, begins: np.ndarray, weight: np.ndarray, plan: Plan, tree: int, feature: np.ndarray, cut: np.ndarray,
                   nodes: np.ndarray, level: int) -> np.ndarray:
    """Rows by (place of a tried feature, node, bin, class) of one tree's open ``nodes`` at ``level``, each
    ``weight`` times: the rows that begin at ``begins`` in the ``classed`` values ``flat``."""
    size = len(nodes) * plan.bins * 2
    out = np.zeros((plan.tried, size), np.int64)
    place = np.full((1 << level + 1) - 1, -1, np.int64)
    place[nodes] = np.arange(len(nodes))
    at = place.take(walk(feature, 2 * cut.astype(flat.dtype) + 1, flat, begins, level))
    if len(at) and at.min() < 0:
        open_ = np.flatnonzero(at >= 0)
        begins, weight, at = begins[open_], weight[open_], at[open_]
    if len(at):
        first = at * (plan.bins * 2)
        for k, f in enumerate(tried_features(plan, tree, nodes).T):
            value = np.ascontiguousarray(f).take(at, mode="clip")
            value += begins
            # whole numbers, exact in sums below 2^53
            out[k] = np.bincount(first + flat.take(value, mode="clip"), weights=weight, minlength=size)
    return out


def packed(h: np.ndarray) -> tuple:
    """A histogram as it travels: in the narrowest type, and only what is not zero if that is less."""
    h = h.ravel().astype(np.min_scalar_type(int(h.max(initial=0))))
    if np.count_nonzero(h) * (4 + h.itemsize) >= h.nbytes:
        return None, h
    at = np.flatnonzero(h)
    return at.astype(np.int32), h[at]


def best_splits(counts: np.ndarray, plan: Plan, tree: int, nodes: np.ndarray) -> np.ndarray:
    """For each node (feature or -1, cut, gain, left n0, left n1, n0, n1) of its
    histogram; equal gains: the first feature, then the lowest cut."""
    h = counts.reshape(plan.tried, len(nodes), plan.bins, 2).transpose(1, 0, 2, 3).cumsum(axis=2)
    total = h[:, 0, -1, :]
    w = np.array(plan.weights)

    def impure(n):
        """Weight times Gini impurity."""
        a, b = n[..., 0] * w[0], n[..., 1] * w[1]
        return 2 * a * b / np.maximum(a + b, 1e-300)

    right = total[:, None, None, :] - h
    gain = impure(total)[:, None, None] - impure(h) - impure(right)
    gain[(h.sum(-1) == 0) | (right.sum(-1) == 0)] = -1.0
    flat = gain.reshape(len(nodes), -1)
    best = flat.argmax(axis=1)
    rows = np.arange(len(nodes))
    f, c = best // plan.bins, best % plan.bins
    feature = tried_features(plan, tree, nodes)[rows, f].astype(float)
    found = flat[rows, best]
    weight = np.maximum((total * w).sum(-1), 1e-300)
    ok = found > 1e-9 * weight
    return np.column_stack([np.where(ok, feature, -1), c, np.where(ok, found, 0.0), h[rows, f, c], total])


def _level(blocks: RDD, plan: Plan, trees: list[tuple[int, int]], feature: np.ndarray, cut: np.ndarray, open_nodes: dict, level: int) -> dict:
    """The best splits of all open nodes of all trees: one pass and one merge by tree. A
    histogram costs its size in every task, so few tasks hold many rows each, and where
    there are fewer of them than cores each is run once for every group of trees."""
    sc = blocks.context
    n = blocks.getNumPartitions()
    groups = max(1, min(plan.trees, -(-2 * sc.defaultParallelism // max(n, 1))))
    sent = sc.broadcast((feature, cut, open_nodes))
    held = max(len(n) for n in open_nodes.values()) * plan.tried * plan.bins * 2 * 8
    parts = max(1, min(len(open_nodes), max(2 * sc.defaultParallelism, -(-held * len(open_nodes) // MERGE_BYTES))))

    def sums(part: int, own: Iterator[Block]):
        features, cuts, open_ = sent.value
        own = [(b, classed(b), fold_of(b[1], plan.folds, plan.seed)) for b in own]
        last, samples = None, []
        some = [i for i in open_ if trees[i][1] % groups == part // n]
        for i in sorted(some, key=lambda i: trees[i][1]):  # the models' trees of one number draw alike
            (model, tree), nodes = trees[i], open_[i]
            if tree != last:
                last, samples = tree, []
                for b, flat, fold in own:
                    count = drawn(b[1], plan, tree)
                    rows = np.flatnonzero(count)
                    samples.append((flat, rows * b[0].shape[1], count[rows].astype(float), fold[rows]))
            h = None
            for flat, begins, weight, fold in samples:
                rows = np.flatnonzero(fold != model)
                part = tree_histogram(flat, begins[rows], weight[rows], plan, tree, features[i], cuts[i], nodes, level)
                h = part if h is None else np.add(h, part, out=h)
            if h is not None:
                yield i, packed(h)

    def merge(own):
        _, _, open_ = sent.value
        total: dict[int, np.ndarray] = {}
        for i, (at, n) in own:
            if i not in total:
                total[i] = np.zeros(len(open_[i]) * plan.tried * plan.bins * 2, np.int64)
            total[i][slice(None) if at is None else at] += n
        for i, h in total.items():
            yield i, best_splits(h, plan, trees[i][1], open_[i])

    try:
        return dict(sc.union([blocks] * groups).mapPartitionsWithIndex(sums).partitionBy(parts, partial(_part, parts)).mapPartitions(merge).collect())
    finally:
        sent.destroy()


def _part(parts: int, tree: int) -> int:
    return tree % parts


def grow(blocks: RDD, plan: Plan, names: list[str], edges: list[np.ndarray]) -> list[Ensemble]:
    """A forest for each fold left out, then the one of all rows."""
    trees = [(m, t) for m in range(plan.models) for t in range(plan.trees)]
    size = (1 << plan.depth + 1) - 1
    feature, cut = np.full((len(trees), size), -1, np.int16), np.zeros((len(trees), size), np.uint8)
    gain, n = np.zeros((len(trees), size)), np.zeros((len(trees), size, 2))
    open_nodes = {i: np.zeros(1, np.int64) for i in range(len(trees))}
    for level in range(plan.depth):
        found = _level(blocks, plan, trees, feature, cut, open_nodes, level) if open_nodes else {}
        after = {}
        for i, splits in found.items():
            nodes = open_nodes[i]
            n[i, nodes] = splits[:, 5:7]
            split = splits[:, 0] >= 0
            at, s = nodes[split], splits[split]
            feature[i, at], cut[i, at], gain[i, at] = s[:, 0], s[:, 1], s[:, 2]
            n[i, 2 * at + 1], n[i, 2 * at + 2] = s[:, 3:5], s[:, 5:7] - s[:, 3:5]
            if children := [c for x in at.tolist() for c in (2 * x + 1, 2 * x + 2) if n[i, c].min() > 0]:
                after[i] = np.array(children, np.int64)
        open_nodes = after
    weighted = n * np.array(plan.weights)
    cover = weighted.sum(-1)
    value = np.divide(weighted[..., 1], cover, out=np.zeros_like(cover), where=cover > 0)
    own = lambda a, m: a[m * plan.trees:(m + 1) * plan.trees]
    return [Ensemble("forest", names, edges, *(own(a, m) for a in (feature, cut, gain, cover, value))) for m in range(plan.models)]


def grid_outputs(forest: Ensemble, grid: list[dict], bins: np.ndarray) -> list[np.ndarray]:
    """``truncated(...).outputs(bins)`` of each combination; a row walks each tree once for all of them."""
    depths, counts = {g["maxDepth"] for g in grid}, {g["numTrees"] for g in grid}
    flat, begins, found = bins.ravel(), np.arange(len(bins)) * bins.shape[1], {}
    total = {d: np.zeros(len(bins)) for d in depths}
    for t, (feature, cut, value) in enumerate(zip(forest.feature, forest.cut, forest.value, strict=True), 1):
        for d, node in enumerate(steps(feature, cut, flat, begins, max(depths)), 1):
            if d in depths:
                total[d] += value.take(node)
        if t in counts:
            found |= {(t, d): total[d] / t for d in depths}
    return [found[g["numTrees"], g["maxDepth"]] for g in grid]


def cross_validate(blocks: DataFrame, forests: list[Ensemble], plan: Plan, grid: list[dict]) -> DataFrame:
    """combo, fold, auc_roc: each combination's forest of a fold on the rows left out of it."""
    sent = blocks.sparkSession.sparkContext.broadcast(forests[:plan.folds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                bins, keys, y = unpack(r["bins"], r["keys"], r["labels"])
                fold = fold_of(keys, plan.folds, plan.seed)
                for k in range(plan.folds):
                    rows = np.flatnonzero(fold == k)
                    for combo, scores in enumerate(grid_outputs(sent.value[k], grid, bins[rows])):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), combo, np.int32)), pa.array(np.full(len(rows), k, np.int32)),
                             pa.array(y[rows].astype(np.int32)), pa.array(scores)], names=["combo", "fold", "label", "score"])

    scored = blocks.mapInArrow(run, "combo int, fold int, label int, score double")
    return grouped_auc_roc(scored, ["combo", "fold"])


@dataclass
class Tuned:
    """The best combination's forest of all rows, and every combination's mean AUC."""

    bestModel: Ensemble
    avgMetrics: list[float]
    grid: list[dict]
    best: dict


def tune(blocks: DataFrame, names: list[str], edges: list[np.ndarray], grid: dict[str, list], folds: int, weights: tuple[float, float],
         seed: int = SEED) -> Tuned:
    """Grid search by cross-validated AUC-ROC (ties: the first combination) over
    ``numTrees`` and ``maxDepth``; ``maxBins`` has one value, that of the blocks."""
    combos = [{"numTrees": t, "maxDepth": d, "maxBins": b} for t in grid["numTrees"] for d in grid["maxDepth"] for b in grid["maxBins"]]
    if len(grid["maxBins"]) != 1:
        raise ValueError("blocks are binned once: give one value of maxBins")
    plan = Plan(folds, max(grid["numTrees"]), max(grid["maxDepth"]), grid["maxBins"][0], len(edges), weights, seed)
    rdd = block_rdd(blocks)
    try:
        forests = grow(rdd, plan, names, edges)
    finally:
        rdd.unpersist()
    if folds:
        found = {(r["combo"], r["fold"]): r["auc_roc"] for r in cross_validate(blocks, forests, plan, combos).collect()}
        means = [float(np.mean([found.get((i, k)) or 0.0 for k in range(folds)])) for i in range(len(combos))]
    else:
        means = [0.0] * len(combos)
    best = combos[int(np.argmax(means))]
    return Tuned(forests[-1].truncated(best["numTrees"], best["maxDepth"]), means, combos, best)
