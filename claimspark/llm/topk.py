"""Operator 9: exact inner-product top-k by ball-tree branch and bound.

Vectors are dealt by hash into shards of about ``SHARD_VECTORS``. A task sorts
a shard's vectors before its queries, builds a ball tree of the ones and
streams the others past it in blocks. The inner product of a query q with
anything in a ball is at most q.centre + |q| * radius: a block goes down the
tree level by level, drops balls that cannot reach their query's current k-th
score, and visits the leaves left in descending order of bound.

The current k-th score is shared: each query is first searched in one shard,
and what it found there is the bar that it brings to all other shards. The
candidates above the bar (at most k a shard) are merged at the end.

Defined results
  a null vector, or one holding a null or a component that is not finite, takes no part
  vectors of different lengths do not meet: each length is searched by itself
  null ids take no part; an empty vector scores 0 with any other empty vector
  repeated rows of one id: each is a candidate (but not for its own id); equal
  ones are searched once and counted; different vectors of one query id are
  one query, with the best of either
  fewer candidates than k: all; empty table: no rows; extra columns are ignored
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.session import materialize

SHARD_VECTORS = 8192
BLOCK_QUERIES = 2048
LEAF = 128
_EXACT = 2**52


@dataclass
class Level:
    centres: np.ndarray
    radii: np.ndarray
    first: np.ndarray  # the vectors of a ball, as a range of ``order``
    last: np.ndarray


class BallTree:
    """A binary ball tree, stored by levels; a ball's children are 2i and 2i + 1."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(vectors))
        first, last = [0], [len(vectors)]
        self.levels = [self._level(vectors, first, last)]
        while max(b - a for a, b in zip(first, last, strict=True)) > leaf:
            cut = []
            for a, b in zip(first, last, strict=True):
                cut += [a, self._split(vectors, a, b)] if b - a > 1 else [a, b]
            first, last = cut, [*cut[1:], len(vectors)]
            self.levels.append(self._level(vectors, first, last))

    def _split(self, vectors: np.ndarray, a: int, b: int) -> int:
        """Order a ball's vectors along the line between two far ones, halves first."""
        own = self.order[a:b]
        x = vectors[own]
        one = x[np.argmax(((x - x[0]) ** 2).sum(axis=1))]
        two = x[np.argmax(((x - one) ** 2).sum(axis=1))]
        self.order[a:b] = own[np.argsort(x @ (two - one), kind="stable")]
        return (a + b) // 2

    def _level(self, vectors: np.ndarray, first: list[int], last: list[int]) -> Level:
        centres = np.zeros((len(first), vectors.shape[1]))
        radii = np.full(len(first), -np.inf)
        for i, (a, b) in enumerate(zip(first, last, strict=True)):
            if b > a:
                x = vectors[self.order[a:b]]
                centres[i] = x.mean(axis=0)
                radii[i] = np.sqrt(((x - centres[i]) ** 2).sum(axis=1).max())
        return Level(centres, radii, np.array(first), np.array(last))


class Shard:
    """Vectors of one length with whole-number components."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray, leaf: int = LEAF):
        self.tree = BallTree(vectors, leaf)
        order = self.tree.order
        self.ids, self.vectors, self.copies = ids[order], vectors[order], copies[order]
        self.largest = np.abs(vectors).max(initial=0)

    def scores(self, queries: np.ndarray, a: int, b: int) -> np.ndarray:
        if self.largest * np.abs(queries).max(initial=0) * max(1, queries.shape[1]) < _EXACT:
            return (queries @ self.vectors[a:b].T).astype(np.int64)  # doubles hold each sum exactly
        return queries.astype(np.int64) @ self.vectors[a:b].astype(np.int64).T

    def search(self, query_ids: np.ndarray, queries: np.ndarray, bar: np.ndarray, k: int):
        """(query position, place in the shard, score) of each query's k best here
        with at least ``bar``; only they can be among its k best overall. bar:
        nan for none."""
        norms = np.sqrt((queries**2).sum(axis=1))
        best = np.where(np.isnan(bar), -np.inf, bar)
        q = np.arange(len(queries))
        ball = np.zeros(len(queries), np.int64)
        for depth, level in enumerate(self.tree.levels):
            if depth:
                q, ball = np.repeat(q, 2), np.repeat(2 * ball, 2) + np.tile([0, 1], len(q))
            bound = np.empty(len(q))
            for at in range(0, len(q), 1 << 16):  # the products of a bounded number of pairs
                s = slice(at, at + (1 << 16))
                bound[s] = np.einsum("ij,ij->i", queries[q[s]], level.centres[ball[s]])
            bound += norms[q] * level.radii[ball]
            bound += 1 + 1e-9 * np.abs(bound)  # above any rounding
            go = bound >= best[q]
            q, ball, bound = q[go], ball[go], bound[go]
        found_q, found_at, found_score = (np.zeros(0, np.int64) for _ in range(3))
        order = np.lexsort((-bound, q))
        q, ball, bound = q[order], ball[order], bound[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        leaves, begin, width = self.tree.levels[-1], 0, 2
        while True:  # each query's next best leaves, more in each round
            now = (rank >= begin) & (rank < begin + width) & (bound >= best[q])
            if not now.any():
                if not (rank >= begin + width).any():
                    break
                begin, width = begin + width, 2 * width
                continue
            parts = [(found_q, found_at, found_score)]
            by = np.flatnonzero(now)
            by = by[np.argsort(ball[by], kind="stable")]
            for group in np.split(by, np.flatnonzero(np.diff(ball[by])) + 1):
                a, b = leaves.first[ball[group[0]]], leaves.last[ball[group[0]]]
                own = q[group]
                score = self.scores(queries[own], a, b)
                ids = self.ids[a:b]
                i, j = np.nonzero((score >= best[own][:, None]) & (ids[None, :] != query_ids[own][:, None]))
                parts.append((own[i], a + j, score[i, j]))
            found_q, found_at, found_score = (np.concatenate(x) for x in zip(*parts, strict=True))
            keep = np.lexsort((self.ids[found_at], -found_score, found_q))
            found_q, found_at, found_score = found_q[keep], found_at[keep], found_score[keep]
            place = np.arange(len(found_q)) - np.searchsorted(found_q, found_q)
            kth = place == k - 1
            best[found_q[kth]] = np.maximum(best[found_q[kth]], found_score[kth])
            top = place < k
            found_q, found_at, found_score = found_q[top], found_at[top], found_score[top]
            begin, width = begin + width, 2 * width
        return found_q, found_at, found_score


def whole_vectors(table: DataFrame, is_query: Column, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """id, vector (doubles, each a whole number), is_query of the rows that take part."""
    x = F.transform(F.col(vector_column), lambda v: F.floor(v.cast("double") * scale).cast("double"))
    return table.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & F.forall(
        F.col(vector_column), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))) \
        .select(F.col(id_column).cast("long").alias("id"), x.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query"))


def _search(vectors: DataFrame, queries: DataFrame, k: int, block: int, leaf: int) -> DataFrame:
    """query_id, vec_id, score, copies; vectors: dim, shard, id, vector, copies;
    queries: dim, shard (the one to search), id, vector, bar."""
    rows = vectors.select("dim", "shard", F.lit(0).alias("role"), "id", "vector", "copies", F.lit(None).cast("double").alias("bar")) \
        .unionByName(queries.select("dim", "shard", F.lit(1).alias("role"), "id", "vector", F.lit(0).cast("long").alias("copies"), "bar"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, shard = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "role")], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *edges], [*edges, len(keys)], strict=True):
                part, (dim, number, role) = batch.slice(a, b - a), keys[a]
                if (dim, number) != at:
                    at, held, shard = (dim, number), [], None
                ids, copies = part.column("id").to_numpy(), part.column("copies").to_numpy()
                vectors = part.column("vector").flatten().to_numpy().reshape(b - a, dim)
                if role == 0:
                    held.append((ids, vectors, copies))
                    continue
                if shard is None:
                    if not held:  # no vectors fell into this shard
                        continue
                    shard, held = Shard(*(np.concatenate(x) for x in zip(*held, strict=True)), leaf), []
                bars = part.column("bar").to_numpy(zero_copy_only=False)
                for i in range(0, b - a, block):
                    own = slice(i, i + block)
                    q, j, score = shard.search(ids[own], vectors[own], bars[own], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (ids[own][q], shard.ids[j], score, shard.copies[j])],
                        names=["query_id", "vec_id", "score", "copies"])

    return rows.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "role", "id") \
        .mapInArrow(run, "query_id long, vec_id long, score long, copies long")


def top_k(table: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
          scale: int = 256, shard_vectors: int = SHARD_VECTORS, block_queries: int = BLOCK_QUERIES, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows with the highest inner
    product (components floor(scale * x)) for each row where ``is_query``."""
    rows = whole_vectors(table, is_query, id_column, vector_column, scale) \
        .groupBy("id", "vector").agg(F.count("*").alias("copies"), F.max("is_query").alias("is_query")) \
        .withColumn("dim", F.size("vector"))
    rows = materialize(rows, "vectors")
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / shard_vectors).cast("int").alias("shards"))
    rows = rows.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.col("shards")).cast("int"))
    asked = rows.where("is_query").select("dim", "shards", "id", "vector", F.col("shard").alias("home"))
    first = materialize(_search(rows, asked.withColumns({"shard": F.col("home"), "bar": F.lit(None).cast("double")}),
                                k, block_queries, leaf), "first")
    bars = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("bar")) \
        .where(F.col("n") >= k).select(F.col("query_id").alias("id"), "bar")
    others = F.filter(F.sequence(F.lit(0), F.col("shards") - 1), lambda s: s != F.col("home"))
    rest = _search(rows, asked.join(bars, "id", "left").withColumn("shard", F.explode(others)), k, block_queries, leaf)
    each = first.unionByName(rest).withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
