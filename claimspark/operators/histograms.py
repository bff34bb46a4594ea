"""Binned training rows and tree ensembles grown from their histograms.

Features are cut into at most ``bins`` ranges at quantiles, so a row is one byte a
feature and a split is "bin <= b". Rows lie in blocks (matrices of bytes) that
are landed once; every level of every tree is then one pass in which a task sums
the histograms of its blocks by (tree, node, feature, bin) and Spark merges them by
key. All sums are whole numbers (counts, or gradients in fixed point), and samples are
hashes of a row's key, so a model does not depend on how the rows are dealt.

Level passes run on the RDD of blocks: there are thousands of them for a boosted
model, each of a few milliseconds, and planning a query for each would cost more
than the pass; and merging by key as the parts arrive holds one histogram a key,
however many tasks sent one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.session import materialize

#: Rows whose quantiles are the bin edges: those with the smallest hashes, about so many.
EDGE_ROWS = 20_000
#: Rows of a block, and of a task while there are fewer tasks than twice the cores.
BLOCK_ROWS, TASK_ROWS = 65_536, 16_384
#: Rows of a task at most, where there are many.
MOST_TASK_ROWS = 1_048_576
SEED = 42


def mix(x: np.ndarray) -> np.ndarray:
    """A hash of each 64-bit number (the SplitMix64 finaliser)."""
    with np.errstate(over="ignore"):
        z = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def uniform(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """A number in [0, 1) for each row key and tree."""
    salt = mix(np.uint64(seed) + mix(np.array([tree], np.uint64)))
    return (mix(keys ^ salt) >> np.uint64(11)) / float(1 << 53)


def bin_edges(prepared: DataFrame, features: str, key: str, bins: int, rows: int = EDGE_ROWS, seed: int = SEED) -> list[np.ndarray]:
    """Upper edges of each feature's bins: its distinct values if they are few, else
    quantiles, over a sample of about ``rows`` rows chosen by the hash of their key.
    A value is in the first bin whose edge is not below it, else in the last."""
    n = prepared.count()
    share = min(1.0, rows / max(n, 1))
    sample = prepared.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    slots = sample.select(F.posexplode(vector_to_array(features)).alias("slot", "value"))
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = slots.groupBy("slot").agg(
        F.percentile("value", shares).alias("cuts"), F.max("value").alias("most"),
        F.when(F.count_distinct("value") <= bins, F.sort_array(F.collect_set("value"))).alias("few")).collect()
    edges = [np.zeros(0)] * len(found)
    for r in found:
        cuts = np.unique(np.array(r["few"] if r["few"] is not None else r["cuts"], float))
        edges[r["slot"]] = cuts[cuts < r["most"]]
    return edges


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins (rows x features, bytes) of feature values (rows x features)."""
    out = np.empty(values.shape, np.uint8)
    for j, cuts in enumerate(edges):
        out[:, j] = np.searchsorted(cuts, values[:, j], side="left")
    return out


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _packed(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    columns = [np.concatenate(c).tobytes() for c in zip(*parts, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["bins", "keys", "labels"])


def land_blocks(prepared: DataFrame, features: str, label: str, key: str, edges: list[np.ndarray],
                task_rows: int = TASK_ROWS) -> DataFrame:
    """The binned rows, landed: one row a block with ``bins`` (row by row), ``keys``
    (64-bit hashes of the key) and ``labels`` as bytes."""
    width, n = len(edges), prepared.count()
    cores = prepared.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(-(-n // task_rows), 2 * cores), -(-n // MOST_TASK_ROWS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                if n + part.num_rows > BLOCK_ROWS:
                    yield _packed(held)
                    held, n = [], 0
                held.append([binned(_matrix(part.column("x"), width), edges), part.column("k").to_numpy(), part.column("y").to_numpy().astype(np.int8)])
                n += part.num_rows
        if n:
            yield _packed(held)

    rows = prepared.select(vector_to_array(features).alias("x"), F.xxhash64(key).alias("k"), F.col(label).cast("int").alias("y"))
    return materialize(rows.repartition(tasks, "k").mapInArrow(cut, "bins binary, keys binary, labels binary"), "binned-blocks")


Block = tuple[np.ndarray, np.ndarray, np.ndarray]


def unpack(bins: bytes, keys: bytes, labels: bytes) -> Block:
    y = np.frombuffer(labels, np.int8)
    return np.frombuffer(bins, np.uint8).reshape(len(y), -1), np.frombuffer(keys, np.uint64), y


def block_rdd(blocks: DataFrame) -> RDD:
    """The blocks as arrays, kept for many passes (a lost copy is read again from the landing)."""
    return blocks.rdd.map(lambda r: unpack(r["bins"], r["keys"], r["labels"])).persist(StorageLevel.MEMORY_AND_DISK)


def leaves(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node of one tree that each row ends in. Nodes are numbered as in a heap:
    the children of i are 2i+1 (bin <= cut) and 2i+2; ``feature`` is -1 where a path ends."""
    return walk(feature, cut, bins.ravel(), np.arange(len(bins)) * bins.shape[1], depth)


def steps(feature: np.ndarray, cut: np.ndarray, flat: np.ndarray, begins: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """The rows' nodes (``leaves``) after each of ``depth`` levels. Rows begin at ``begins`` in
    the bins ``flat``; where a path ends, a node's children are the node itself."""
    inner = (1 << depth) - 1
    on, own = feature[:inner] >= 0, np.arange(inner)
    f, c, child = np.where(on, feature[:inner], 0).astype(np.int64), cut[:inner], np.repeat(own, 2)
    child[0::2][on], child[1::2][on] = 2 * own[on] + 1, 2 * own[on] + 2
    node = np.zeros(len(begins), np.int64)
    for _ in range(depth):
        at = f.take(node, mode="clip")  # all places are valid; this mode only leaves out the check
        at += begins
        right = flat.take(at, mode="clip") > c.take(node, mode="clip")
        at = node + node
        at += right
        node = child.take(at, mode="clip")
        yield node


def walk(feature: np.ndarray, cut: np.ndarray, flat: np.ndarray, begins: np.ndarray, depth: int) -> np.ndarray:
    """``leaves`` of the rows that begin at ``begins`` in ``flat``."""
    node = np.zeros(len(begins), np.int64)
    for node in steps(feature, cut, flat, begins, depth):  # noqa: B007
        pass
    return node


@dataclass
class Ensemble:
    """Trees over binned features as heaps of nodes, one row a tree.

    ``feature`` (-1 at the end of a path), ``cut``, ``gain``, ``cover`` (training weight),
    ``value``: share of class 1 (forest, at every node) or step of the margin
    (boosted, at leaves). ``base`` is the boosted margin before the first tree."""

    kind: str
    names: list[str]
    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    value: np.ndarray
    base: float = 0.0

    @property
    def n_trees(self) -> int:
        return len(self.feature)

    @property
    def depth(self) -> int:
        return int(self.feature.shape[1] + 1).bit_length() - 2

    def truncated(self, trees: int, depth: int) -> Ensemble:
        """The first ``trees`` trees, cut at ``depth``: what growing only these would
        have given, since no tree and no node depends on later ones."""
        size, inner = (1 << depth + 1) - 1, (1 << depth) - 1
        keep = lambda a: a[:trees, :size].copy()
        out = replace(self, feature=keep(self.feature), cut=keep(self.cut), gain=keep(self.gain), cover=keep(self.cover), value=keep(self.value))
        out.feature[:, inner:], out.gain[:, inner:] = -1, 0.0
        return out

    def outputs(self, bins: np.ndarray) -> np.ndarray:
        """Share of class 1 (forest) or margin (boosted) of binned rows."""
        total = np.zeros(len(bins))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            total += value[leaves(feature, cut, bins, self.depth)]
        return total / max(self.n_trees, 1) if self.kind == "forest" else self.base + total

    def importances(self) -> np.ndarray:
        """Gain of each feature's splits, each tree's in proportion, normed to 1."""
        total = np.zeros(len(self.edges))
        for feature, gain in zip(self.feature, self.gain, strict=True):
            own = np.bincount(feature[feature >= 0], weights=gain[feature >= 0], minlength=len(total))
            total += own / own.sum() if own.sum() > 0 else own
        return total / total.sum() if total.sum() > 0 else total

    def node_table(self, spark) -> DataFrame:
        """tree, node, feature, threshold, value, cover, gain of every node on a path, and
        one row (tree -1) with the kind and base: the model as a table."""
        rows = [(-1, 0, self.kind, None, self.base, None, None)]
        for t in range(self.n_trees):
            there, feature = [0], self.feature[t]
            for node in there:
                f = int(feature[node])
                if f >= 0:
                    there += [2 * node + 1, 2 * node + 2]
                threshold = float(self.edges[f][self.cut[t, node]]) if f >= 0 else None
                rows.append((t, node, self.names[f] if f >= 0 else None, threshold, float(self.value[t, node]),
                             float(self.cover[t, node]), float(self.gain[t, node])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, value double, cover double, gain double")


    @classmethod
    def from_nodes(cls, rows, names: list[str]) -> Ensemble:
        """The model of a collected ``node_table``."""
        slot = {n: i for i, n in enumerate(names)}
        edges = [np.array(sorted({r["threshold"] for r in rows if r["feature"] == n and r["tree"] >= 0})) for n in names]
        size = 1 << int(max((r["node"] for r in rows), default=0) + 1).bit_length()
        shape = (max((r["tree"] for r in rows), default=-1) + 1, size - 1)
        head = next(r for r in rows if r["tree"] < 0)
        out = cls(head["feature"], names, edges, np.full(shape, -1, np.int16), np.zeros(shape, np.uint8), *(np.zeros(shape) for _ in range(3)),
                  base=head["value"])
        for r in rows:
            if r["tree"] >= 0:
                at = r["tree"], r["node"]
                out.value[at], out.cover[at], out.gain[at] = r["value"], r["cover"], r["gain"]
                if r["feature"] is not None:
                    f = slot[r["feature"]]
                    out.feature[at], out.cut[at] = f, np.searchsorted(edges[f], r["threshold"])
        return out


def score_rows(prepared: DataFrame, model: Ensemble, features: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``output``, the model's share or margin, for each row. The model
    goes to the tasks as one broadcast, which trees and depth bound."""
    sent = prepared.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in prepared.select(*keep).schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", output double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = sent.value
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                out = m.outputs(binned(_matrix(part.column(len(keep)), len(m.edges)), m.edges))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], pa.array(out)], names=[*keep, "output"])

    return prepared.select(*keep, vector_to_array(features).alias("_x")).mapInArrow(run, schema)
