import random
import zlib

import numpy as np
import pytest

from claimspark.llm import toxicity as X

BAD = ["vilemonster", "vilely", "rotten", "scoundrel"]


def corpus(n=900, seed=0):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows, toxic = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(plain) for _ in range(rng.randint(3, 12))) for _ in range(rng.choice([1, 4, 30, 120]))]
        bad = i % 5 == 0
        if bad:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(BAD) + " and " + ("vile" + "".join(rng.choice("xyz") for _ in range(4)))
        rows.append((i, ". ".join(s.capitalize() for s in sentences) + "."))
        toxic.append(int(bad))
    return rows, toxic


def brute(model, text):
    gone, spans = 1.0, []
    for m in X._SENTENCE.finditer(text or ""):
        words = set(X._WORD.findall(m.group().lower()))
        if words:
            z = min(30, max(-30, model.bias + sum(model.word_weight(w) for w in words)))
            p = 1 / (1 + np.exp(-z))
            gone *= 1 - p
            if p >= 0.5:
                spans.append((m.start(), m.end()))
    return 1 - gone, spans


def test_learns_bags_and_locates_sentences(spark, docs_of):
    rows, toxic = corpus()
    labels = spark.createDataFrame([(i, t) for (i, _), t in zip(rows, toxic, strict=True) if i % 3] + [(None, 1), (7, None), (10**6, 1)],
                                   "doc_id long, toxic int")
    model = X.learn(docs_of(rows), labels)
    extra = [(None, None), (-1, ""), (-2, " .!? \n"), (-3, "plain words " * 30_000), (-4, "Rotten scoundrel! fine."), (-4, "Rotten scoundrel! fine.")]
    got = X.score_texts(docs_of(rows + extra), model).select("row.*", "score", "sentences").collect()
    assert len(got) == len(rows) + len(extra)
    for r in got:
        score, spans = brute(model, r.text)
        assert r.score == pytest.approx(score, abs=1e-9) and [(s.start, s.end) for s in r.sentences] == spans
    held = [r for r in got if r.doc_id is not None and 0 <= r.doc_id < len(rows) and r.doc_id % 3 == 0]
    truth = np.array([toxic[r.doc_id] for r in held], bool)
    said = np.array([r.score >= X.THRESHOLD for r in held])
    assert said[truth].mean() > 0.95 and said[~truth].mean() < 0.02
    for r in held:
        if toxic[r.doc_id] and r.sentences:
            assert all("vile" in r.text[s.start:s.end].lower() for s in r.sentences)
    assert {r.score for r in got if r.doc_id in (None, -1, -2)} == {0.0}
    assert next(r for r in got if r.doc_id == -3).score < X.THRESHOLD
    assert next(r for r in got if r.doc_id == -4).sentences[0].end == 17


def test_without_labels_nothing_is_predicted(spark, docs_of):
    rows, _ = corpus(12)
    for labels in ([], [(1, 0), (2, 0)], [(1, 1)]):
        model = X.learn(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert model is None
    assert {r.score for r in X.score_texts(docs_of(rows), None).collect()} == {0.0}
    assert X.score_texts(docs_of([]), None).count() == 0


def test_held_out_rows_of_the_query_are_never_labels(spark):
    from claimspark.llm.queries import QUERIES

    got = QUERIES["op8_mil_toxicity"](spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
