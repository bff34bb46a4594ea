import random
import re

import numpy as np
from pyspark.sql import functions as F

from claimspark.llm import near_dedup as N
from claimspark.session import materialize


def shingles(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def brute(rows, size, percent):
    """(doc_id, n_shingles, component_id) by all pairs and a union-find."""
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def got(frame):
    rows = frame.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def corpus(seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(3))
    rows = [(900, None), (901, ""), (902, " \n "), (903, "One"), (904, "one"), (905, "one two"), (906, "ONE  two"), (None, "one"),
            (None, "lonely null id"), (907, "x " * 5000), (908, "x x x")]
    for base in range(8):
        text = [word() for _ in range(rng.choice([12, 40, 90]))]
        for copy in range(rng.choice([2, 9, 25])):
            t = list(text)
            for _ in range(rng.randrange(0, max(2, len(t) // 8))):
                t[rng.randrange(len(t))] = word()
            rows.append((base * 100 + 99 - copy, " ".join(t)))
    chain = [word() for _ in range(100)]
    for k in range(12):  # a chain: only neighbours are near
        rows.append((5000 - k, " ".join(chain)))
        for i in range(k * 8, k * 8 + 8):
            chain[i % 100] = word()
    rows += [rows[20], rows[21]]  # repeated rows
    rng.shuffle(rows)
    return rows


def test_components_match_brute_force(docs_of):
    for size in (2, 5):
        rows = corpus(size)
        assert got(N.near_duplicates(docs_of(rows), size, 80)) == brute(rows, size, 80)
    assert N.near_duplicates(docs_of([]), 2, 80).count() == 0


def test_star_around_an_original_that_is_not_the_smallest_id(docs_of):
    """Copies are near the original only, not each other."""
    rng = random.Random(9)
    text = [f"w{i}" for i in range(300)]
    rows = [(1000, " ".join(text))]
    for k in range(60):
        t = list(text)
        for i in rng.sample(range(1, 299, 3), 14):
            t[i] = f"n{k}x{i}"
        rows.append((k, " ".join(t)))
    assert got(N.near_duplicates(docs_of(rows), 2, 80)) == brute(rows, 2, 80)


def test_super_minhash_estimates_jaccard_and_stops_early():
    rng = np.random.default_rng(1)
    for n, share in ((60, 0.5), (2000, 0.8)):
        errors = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
            both = int(round(2 * n * share / (1 + share)))
            only = n - both
            a, b = pool[:n], np.concatenate([pool[:both], pool[n:n + only]])
            low = N.super_minhash([a, b])
            errors.append((low[0] == low[1]).mean() - both / (n + only))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 1.1 * (share * (1 - share) / N.REGISTERS) ** 0.5
    # registers are filled by rank: a permutation of one element has each rank once
    one = N.super_minhash([np.array([7], np.uint64)])[0]
    assert sorted(one >> np.uint64(48)) == list(range(N.REGISTERS))


def test_signature_does_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 3, 50, 700, 4000)]
    whole = N.super_minhash([*sets, np.zeros(0, np.uint64)])
    assert all((N.super_minhash([s])[0] == row).all() for s, row in zip(sets, whole, strict=False))


def test_components_of_long_paths_and_hubs(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5, 5), (1000, 1001)]
    rng.shuffle(edges)
    frame = spark.createDataFrame(edges, "u long, v long")
    got_ = {r.node: r.label for r in N.components(frame).collect()}
    assert got_ == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}
    assert N.components(frame.limit(0)).count() == 0


def test_better_head_that_already_heads_another_group(spark, docs_of):
    """B heads the group of L's buckets and takes over the group of H; member m is in both.
    m and y share nothing with B, so only their shingles outside B can link them."""
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    texts = {"H": words("h", 50), "B": words("c", 100), "L": words("l", 60), **{k: words(k, 40) for k in ("z1", "z2", "w1", "w2")},
             **{f"p{i}": words("c", 100) + words(f"p{i}x", 5) for i in range(6)},
             "m": words("both", 160) + words("m", 20), "y": words("both", 160) + words("y", 20)}
    buckets = [["H", "B", "m", *[f"p{i}" for i in range(6)]], ["B", "L"], ["L", "m", "y"],
               *[["H", "z1", "z2"]] * 4, *[["B", "p0", "p1"]] * 3, *[["L", "w1", "w2"]] * 4]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts.values())]
    docs = docs_of(rows)
    of = {i: [b for b, names in enumerate(buckets) if name in names] for i, name in enumerate(texts)}
    bands = spark.createDataFrame(list(of.items()), "i long, bands array<long>")
    nodes = docs.join(bands, docs.doc_id == bands.i).select(
        F.encode(F.col("doc_id").cast("string"), "utf-8").alias("digest"), "doc_id", N.text_key(F.col("text")).alias("key"), "bands")
    labels = {int(bytes(r.node)): bytes(r.label) for r in N.components(N.links(docs, nodes, 1, 80)).collect()}
    want = {d: c for d, _, c in brute(rows, 1, 80)}
    assert {(a, b) for a in want for b in want if want[a] == want[b]} == \
        {(a, b) for a in want for b in want if labels.get(a, a) == labels.get(b, b)}


def test_all_of_the_small_tables_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = got(N.near_duplicates(docs, 2, 80))
    assert found == brute(rows, 2, 80) and sum(d != c for d, _, c in found) > 50


def test_pairs_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    """One large component and one member apart: every pair asked for has that member in it, in any number of deals."""
    rows = [("h", f"m{i:03}", 95, 100, 100, "a") for i in range(400)] + [("h", "odd", 80, 80, 100, "odd")]
    group = spark.createDataFrame(rows, "head string, member string, same long, n long, n_head long, label string")
    nothing = spark.createDataFrame([], "head string, member string, shingle long")
    monkeypatch.setattr(N, "outside", lambda pairs, sets: nothing)
    for size in (4096, 30):
        monkeypatch.setattr(N, "GROUP_ROWS", size)
        pairs = [(r["head"], r["member"]) for r in N.rest_pairs(group, None, 80).collect()]
        assert sorted(pairs) == [(f"m{i:03}", "odd") for i in range(400)]


def test_stars_need_no_round_and_a_path_does(spark, monkeypatch):
    """The driver starts no round of joins only to see that nothing changes."""
    landed = []
    monkeypatch.setattr(N, "materialize", lambda df, name: (landed.append(name), materialize(df, name))[1])
    stars = spark.createDataFrame([(1, i) for i in range(2, 50)] + [(60, 70), (70, 60), (8, 8)], "u long, v long")
    assert {r.node: r.label for r in N.components(stars).collect()} == {**{i: 1 for i in range(1, 50)}, 60: 60, 70: 60}
    assert landed == ["edges"]
    path = spark.createDataFrame([(1, 2), (2, 3), (4, 3)], "u long, v long")
    assert {r.node: r.label for r in N.components(path).collect()} == {1: 1, 2: 1, 3: 1, 4: 1}
    assert len(landed) > 2


def test_no_plan_starts_many_exchanges_at_once(spark, docs_of, monkeypatch):
    """Each exchange of a plan is a thread, a state and a text in the driver; one plan had some eighty."""
    exchanges = {}

    def land(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges[name] = max(exchanges.get(name, 0), len(re.findall(r"[ -]Exchange ", plan)))
        return materialize(df, name)

    monkeypatch.setattr(N, "materialize", land)
    N.near_duplicates(docs_of(corpus()), 2, 80).collect()
    assert max(exchanges.values()) <= 30, exchanges
    assert {"edges", "stars", "outside"} <= set(exchanges)
