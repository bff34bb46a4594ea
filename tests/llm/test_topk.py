import math

import numpy as np
from pyspark.sql import functions as F

from claimspark.llm import topk as K


def brute(rows, k):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in ok if i % 5 == 0}):
        found = []
        for q in {tuple(v) for j, v in ok if j == i}:
            found += [(-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in ok if j != i and len(v) == len(q)]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(found)[:k])]
    return out


def rows():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 7))
    out = [(i, [float(np.float32(x)) for x in centres[i % 6] + 0.3 * rng.normal(size=7)]) for i in range(700)]
    out += [(1000 + i, [0.5] * 7) for i in range(60)]  # ties
    out += [(2000, None), (2005, [1.0, None] + [0.0] * 5), (2010, [math.nan] * 7), (2015, [math.inf] * 7), (None, [9.0] * 7)]
    out += [(3000 + i, [1.0 * i, -2.0]) for i in range(11)] + [(4000, [1.0, 2.0, 3.0]), (4005, []), (4006, [])]
    out += [out[3], out[3], out[10], (20, [3.0] * 7), (5000, [1e7] * 7), (5005, [-1e7] * 7)]
    return out


def test_matches_brute_force(spark):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows()], "vec_id long, embedding array<double>, shard string, id int")
    for k, size in ((5, 64), (9, 10_000)):
        got = K.top_k(table, F.col("vec_id") % 5 == 0, k, shard_vectors=size, block_queries=50, leaf=8).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(brute(rows(), k))
    assert K.top_k(table.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_tree_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    vectors = np.round(100 * (rng.normal(size=(20, 8))[rng.integers(0, 20, 4000)] * 4 + rng.normal(size=(4000, 8)) * 0.2))
    tree = K.BallTree(vectors, 32)
    q = np.round(100 * rng.normal(size=(5, 8)))
    for level in tree.levels:
        assert level.first[0] == 0 and level.last[-1] == 4000 and (level.first[1:] == level.last[:-1]).all()
        for c, r, a, b in zip(level.centres, level.radii, level.first, level.last, strict=True):
            if b > a:
                assert ((q @ vectors[tree.order[a:b]].T).max(axis=1) <= q @ c + np.sqrt((q**2).sum(axis=1)) * r + 1).all()
    shard = K.Shard(np.arange(4000), vectors, np.ones(4000, np.int64), 32)
    seen = []
    scores = shard.scores
    shard.scores = lambda x, a, b: seen.append(len(x) * (b - a)) or scores(x, a, b)
    found = shard.search(np.full(5, -1), q, np.full(5, np.nan), 3)
    assert sum(seen) < 5 * 4000 / 4  # most balls were never opened
    assert sorted(found[2][found[0] == 0])[::-1] == sorted((q[0] @ vectors.T).astype(int))[-3:][::-1]
