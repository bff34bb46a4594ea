import collections
import random
import re

import numpy as np
import pandas as pd

from claimspark.llm import quality_rules as Q

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORDS.findall(text)
    where = collections.defaultdict(list)
    for i in range(len(ws) - 7):
        where[tuple(ws[i:i + 8])].append(i)
    hit = {j for places in where.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dups += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(hit)


def texts():
    rng = random.Random(1)
    out = [None, "", " \n\t", "a", "é\x0bb ñ", "x " * 40, "one two\none two\n\n one two", "a\x1fb\u00a0c d", "#|<>" * 3,
           " ".join("abcdefgh") + " z " + " ".join("abcdefgh"), "w\n" * 9000]
    for _ in range(60):
        out.append("".join(rng.choice(["a ", "b ", "c\n", "Dé ", "!! ", "| ", "\t"]) for _ in range(rng.randrange(120))))
    return out


def test_statistics_match_brute_force():
    got = Q.text_statistics(texts())
    assert list(zip(*(got[c] for c in Q.COUNTS), strict=True)) == [brute(t) for t in texts()]
    assert all(np.isfinite(got[c]).all() for c in Q.SHARES)


def test_learner_finds_planted_conjunctions_and_spares_the_rest():
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({c: rng.random(3000) for c in Q.SHARES})
    bad = ((frame.pipe_share > 0.7) & (frame.mean_word < 0.5) | (frame.upper_share > 0.9)).to_numpy()
    rules = Q.learn(frame, bad)
    hit = rules.covers(frame)
    assert (hit & bad).sum() / bad.sum() > 0.95 and (hit & ~bad).sum() / (~bad).sum() < 0.01
    assert Q.learn(frame, np.zeros(3000, bool)).rules == [] == Q.learn(frame, np.ones(3000, bool)).rules


def test_judge_edge_rows_and_expression(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "a b"), (3, "a"), (3, "a")]
    rules = Q.DecisionList([[("pipe_share", ">=", 0.3), ("bang_share", "<", 0.1)], [("upper_share", ">=", 0.4)]])
    got = Q.judge(docs_of(rows), rules).select("row.*", "stats", "base_failed", "rejected", "kept").toPandas()
    assert len(got) == len(rows) and "text_" in got
    frame = pd.DataFrame(Q.text_statistics(list(got.text)))
    assert list(got.rejected) == list(rules.covers(frame))
    assert list(got.base_failed) == list((frame.n_words < 20) | (100 * frame.n_repeat_words > 30 * frame.n_words))
    assert list(got.kept) == list(~got.base_failed & ~got.rejected)
    assert Q.judge(docs_of([]), Q.DecisionList()).count() == 0


def test_rules_from_tables(spark, docs_of):
    clean, noisy = "the cat sat on a mat and saw it all ", "x | yy | z | q | "
    docs = docs_of([(i, (noisy if i % 3 == 0 else clean) * (3 + i % 7)) for i in range(120)] + [(None, clean)])
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(120)] + [(None, 0, 0), (5, None, 0), (999, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    rules = Q.learn_rules(docs, labels)
    got = Q.judge(docs, rules).select("row.doc_id", "rejected").toPandas().dropna()
    assert (got.rejected == (got.doc_id % 3 == 0)).all()
    assert Q.learn_rules(docs, labels.limit(0)).rules == []


def test_a_task_holds_a_small_slice_of_text():
    import tracemalloc

    import pyarrow as pa

    from claimspark.llm import packing, quality_rules
    from claimspark.llm.common import slices

    text = " ".join(f"w{i % 5000}" for i in range(20_000))
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 40)], names=["text"])
    assert packing.SLICE_BYTES <= 1_000_000
    tracemalloc.start()
    for part in slices(iter([batch]), "text", quality_rules.SLICE_BYTES):
        quality_rules.text_statistics(part.column("text").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000
