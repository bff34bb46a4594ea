import re

import pytest

from claimspark.llm import licenses as L

TEMPLATES = {"five": "Alpha beta, gamma delta epsilon!", "long": " ".join(f"w{i}" for i in range(40)), "mit": L.TEMPLATES["mit"]}
LONG = TEMPLATES["long"].split()
ROWS = [
    (1, None), (2, ""), (3, "too few words here"), (4, "alpha BETA gamma; delta epsilon"), (5, "x y " + TEMPLATES["long"] + " z " * 300),
    (6, " ".join(LONG[:20] + ["new"] + LONG[20:])),  # 32 of 36 shingles are left
    (7, " ".join(LONG[:12] + ["a", "b"] + LONG[14:26] + ["c", "d"] + LONG[28:])),  # too few are left
    (8, "ñ 🙂 " * 4000 + "Released under the MIT License."), (9, TEMPLATES["mit"] + " " + TEMPLATES["five"] + " q " + TEMPLATES["five"]),
    (None, TEMPLATES["mit"]), (4, "alpha BETA gamma; delta epsilon"), (10, "released under the mit"), (11, " ".join(LONG[4:])),
]


def shingles(text):
    w = re.findall(L.WORD, (text or "").lower())
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(rows, templates):
    out = set()
    for d, t in rows:
        have = shingles(t)
        for name, body in templates.items():
            own = set(shingles(body))
            length, step, _ = L.class_of(len(own))
            best = max(((len(own & set(have[a:a + length])) / len(own), -a) for a in range(0, len(have), step)), default=(0, 0))
            if 100 * best[0] >= L.CONTAINMENT:
                out.add((d, name, best[0], -best[1]))
    return out


def test_matches_brute_force(spark, docs_of):
    got = L.scan(docs_of(ROWS), TEMPLATES).collect()
    assert {tuple(r) for r in got} == brute(ROWS, TEMPLATES) and len(got) == len(brute(ROWS, TEMPLATES))
    assert {r.doc_id for r in got if r.license == "long"} == {5, 6, 11}
    assert L.scan(docs_of([]), TEMPLATES).count() == 0


def test_band_settings_reach_the_probability():
    for size in (1, 2, 3, 5, 8, 30, 200, 900):
        length, step, bands = L.class_of(size)
        top = 1 << (size - 1).bit_length()
        # any run of ``size`` shingles lies whole in some window
        assert all(any(a <= p and p + size <= a + length for a in range(0, p + 1, step)) for p in range(3 * step))
        least = top // 2 + 1 if top > 1 else 1
        inside = -(-L.CONTAINMENT * least // 100)
        jaccard = inside / (length + least - inside)
        assert 1 - (1 - jaccard) ** bands >= L.PROBABILITY


def test_short_templates_are_refused(spark, docs_of):
    with pytest.raises(ValueError):
        L.scan(docs_of(ROWS), {"short": "only four words here"})


def test_no_python_on_the_main_path(docs_of):
    plan = L.scan(docs_of(ROWS), TEMPLATES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
