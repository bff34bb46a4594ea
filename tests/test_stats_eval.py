"""Statistics and evaluation operators against brute force in Python."""

import random

import numpy as np
import pytest

from claimspark.operators import evaluate as ev
from claimspark.operators import stats


def _scored(spark, n=2000, seed=3):
    rnd = random.Random(seed)
    rows = [(f"c{i}", int(rnd.random() < 0.3), round(rnd.random(), 2)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "claim_id string, label int, score double")


def _brute_auc(rows):
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


def test_auc_matches_pairwise(spark):
    rows, df = _scored(spark)
    got = ev.auc_roc(df).first()["auc_roc"]
    assert got == pytest.approx(_brute_auc(rows), abs=1e-12)


def test_curve_monotone_and_ap(spark):
    rows, df = _scored(spark)
    pts = sorted(ev.curve(df).collect(), key=lambda r: -r["threshold"])
    assert all(a["tp"] <= b["tp"] and a["fp"] <= b["fp"] for a, b in zip(pts, pts[1:]))
    P = sum(y for _, y, _ in rows)
    ap = 0.0
    prev = 0
    for r in pts:
        ap += (r["tp"] - prev) / P * (r["tp"] / (r["tp"] + r["fp"]))
        prev = r["tp"]
    assert ev.average_precision(df).first()["average_precision"] == pytest.approx(ap, abs=1e-9)


def test_threshold_table(spark):
    rows, df = _scored(spark)
    t = {r["threshold"]: r for r in ev.threshold_table(df, thresholds=[0.5]).collect()}[0.5]
    flagged = [y for _, y, s in rows if s >= 0.5]
    assert t["patients_flagged"] == len(flagged)
    assert t["precision"] == round(sum(flagged) / len(flagged), 3)


def test_classification_metrics(spark):
    rows, df = _scored(spark)
    df = df.selectExpr("label", "CAST(score >= 0.5 AS INT) AS prediction")
    m = ev.classification_metrics(df).first()
    acc = sum((s >= 0.5) == (y == 1) for _, y, s in rows) / len(rows)
    assert m["accuracy"] == pytest.approx(acc)


@pytest.mark.parametrize("parts", [1, 5])
def test_exact_percentiles(spark, parts):
    rnd = random.Random(7)
    vals = [float(rnd.randint(0, 500)) for _ in range(3001)] + [None]
    grp = ["a" if i % 3 else "b" for i in range(len(vals))]
    df = spark.createDataFrame(list(zip(grp, vals)), "g string, v double").repartition(parts)
    got = {r["g"]: (r["p25"], r["p50"], r["p90"]) for r in
           stats.exact_percentiles(df, "v", [0.25, 0.5, 0.9], ["g"]).collect()}
    for g in ("a", "b"):
        xs = [v for gg, v in zip(grp, vals) if gg == g and v is not None]
        exp = tuple(float(np.percentile(xs, q)) for q in (25, 50, 90))
        assert got[g] == pytest.approx(exp)


def test_histogram_and_trend(spark):
    df = spark.createDataFrame([(float(x), float(2 * x + 1)) for x in range(100)], "x double, y double")
    h = stats.histogram(df, "x", 10).collect()
    assert sum(r["n"] for r in h) == 100 and len(h) == 10
    t = stats.linear_trend(df, "x", "y").first()
    assert (t["slope"], t["intercept"]) == (2.0, 1.0)


def test_base_rate_and_sample_n(spark):
    from claimspark.operators import sampling

    rows, df = _scored(spark)
    assert ev.base_rate(df).first()["base_rate"] == pytest.approx(sum(y for _, y, _ in rows) / len(rows))
    a = sampling.hash_sample_n(df, 100).collect()
    b = sampling.hash_sample_n(df.repartition(7), 100).collect()
    assert len(a) == 100 and sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_correlation_pairwise_complete(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(500):
        a = rnd.gauss(0, 1)
        b = a * 0.5 + rnd.gauss(0, 1)
        c = None if rnd.random() < 0.2 else b - a + rnd.gauss(0, 0.3)
        rows.append((a, b, c))
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["x"], r["y"]): r["r"] for r in stats.correlation_matrix(df, ["a", "b", "c"], 9).collect()}
    for x, y in [("b", "a"), ("c", "a"), ("c", "b")]:
        pairs = [(r["abc".index(x)], r["abc".index(y)]) for r in rows
                 if r["abc".index(x)] is not None and r["abc".index(y)] is not None]
        exp = float(np.corrcoef(np.array(pairs).T)[0, 1])
        assert got[(x, y)] == pytest.approx(exp, abs=1e-8)


def test_box_stats_global_and_grouped(spark):
    vals = [float(v) for v in range(1, 101)] + [1000.0]
    df = spark.createDataFrame([("a", v) for v in vals], "g string, v double")
    glob = stats.box_stats(df, "v", []).first()
    q1, q3 = np.percentile(vals, 25), np.percentile(vals, 75)
    assert (glob["q1"], glob["q3"]) == (pytest.approx(q1), pytest.approx(q3))
    assert glob["whisker_high"] == 100.0 and glob["whisker_low"] == 1.0
    grp = stats.box_stats(df, "v", ["g"]).first()
    assert grp["whisker_high"] == glob["whisker_high"] and grp["median"] == glob["median"]
