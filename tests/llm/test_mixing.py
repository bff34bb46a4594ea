import collections
import hashlib

import pytest

from claimspark.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, topic string"


def corpus(n=3000):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        text = ["word " * (5 + i % 40), "see me@x.org now " * 3, "All rights reserved " * 4][0 if i % 5 else 1 + i % 2]
        rows.append((i, text, ["en", "de", None][i % 11 % 3], source, len(text), "clash"))
    return rows


def brute_rake(cells, targets, budget, sweeps=500):
    total = sum(cells.values())
    w = {c: t * budget for c, t in cells.items()}
    for _ in range(sweeps):
        for at, target in enumerate(targets):
            sums = collections.Counter()
            for c, x in w.items():
                sums[c[at]] += x
            w = {c: min(cells[c], x * (target[c[at]] * budget * total / sums[c[at]] if sums[c[at]] > 0 else 1)) for c, x in w.items()}
    return w


def test_raked_probabilities_match_numpy_free_loops(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    got = M.calibrated(docs).select("row.doc_id", "source", "lang", "topic", "tokens", "probability", "sampled").collect()
    cells = collections.Counter()
    for r in got:
        cells[r.source, r.lang, r.topic] += r.tokens
    targets = []
    for at, name in enumerate(("source", "lang", "topic")):
        sums = collections.Counter()
        for c, t in cells.items():
            sums[c[at]] += t
        powers = {k: v ** M.SMOOTHING[name] for k, v in sums.items()}
        targets.append({k: v / sum(powers.values()) for k, v in powers.items()})
    want = brute_rake(cells, targets, M.BUDGET)
    for r in got:
        c = (r.source, r.lang, r.topic)
        assert r.probability == pytest.approx(want[c] / cells[c], abs=5e-3)
        draw = int(hashlib.md5(f"{M.SEED}:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        assert r.sampled == (draw < r.probability)
    total = sum(cells.values())
    for at, target in enumerate(targets):
        reached, drawn = collections.Counter(), collections.Counter()
        for r in got:
            key = (r.source, r.lang, r.topic)[at]
            reached[key] += r.probability * r.tokens / (M.BUDGET * total)
            drawn[key] += r.sampled * r.tokens / (M.BUDGET * total)
        assert all(reached[k] == pytest.approx(target[k], abs=1e-3) and drawn[k] == pytest.approx(target[k], abs=0.05) for k in target)


def test_given_targets_that_cannot_be_met_go_in_whole(spark):
    docs = spark.createDataFrame([(i, "a b c d", "en", "rare" if i < 5 else "big", 7, "") for i in range(100)], SCHEMA)
    want = spark.createDataFrame([("rare", 0.5), ("big", 0.5)], "value string, share double")
    got = {r.source: r.probability for r in M.calibrated(docs, {"source": want}).select("source", "probability").distinct().collect()}
    assert got["rare"] == 1.0 and got["big"] == pytest.approx(25 / 95, abs=1e-3)


def test_edge_rows(spark):
    rows = [(None, None, None, None, None, None), (1, "", "en", None, 0, ""), (2, "x " * 50_000, "en", "a", 9, ""), (2, "x " * 50_000, "en", "a", 9, ""),
            (3, "| a | b | c | d |", "en", "a", 9, "")]
    got = M.calibrated(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 5 and all(0 <= r.probability <= 1 for r in got) and {r.tokens for r in got} == {0, 50_000, 9}
    assert len({r.sampled for r in got if r.row.doc_id == 2}) == 1
    assert M.calibrated(spark.createDataFrame([], SCHEMA)).count() == 0
