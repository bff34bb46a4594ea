import collections
import hashlib
import re

import corpus_pipeline as C
import pandas as pd
import pytest

from claimspark.llm import mixing, packing, quality_rules
from claimspark.llm.common import DOCUMENT_COLUMNS

from .test_line_templates import brute as brute_lines
from .test_mixing import brute_rake
from .test_near_dedup import brute as brute_near
from .test_packing import check as check_packing
from .test_packing import ids_of
from .test_quality_rules import brute as brute_counts

SF = "/root/testdata/sf0.001"
LONG = [f"w{i}" for i in range(40)]


def test_stages_are_the_five_in_order():
    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mixing", "packing"]


def test_each_stage_takes_effect_and_keeps_the_columns(spark):
    docs, sizes = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF).cache()
        sizes.append(out.count())
        if name != "packing":
            assert out.columns == DOCUMENT_COLUMNS and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            assert out.select("doc_id").distinct().count() == sizes[-1]
            assert out.join(docs.select("doc_id"), "doc_id", "left_anti").count() == 0
        else:
            assert out.select("doc_id").distinct().count() == docs.count()
        docs = out
    assert sizes[0] > sizes[2] > sizes[3]


def brute_topic(text):
    for name, literals, pattern in mixing.TOPICS:
        if any(x in text for x in literals) and (pattern is None or re.search(pattern, text)):
            return name
    return "prose"


def brute_mixture(rows):
    """{doc_id: (draw, probability)} by plain loops."""
    tokens = {r.doc_id: len(re.findall(mixing.WORD, r.text or "")) for r in rows}
    cell = {r.doc_id: (r.source, r.lang, brute_topic(r.text or "")) for r in rows}
    cells, targets = collections.Counter(), []
    for d, c in cell.items():
        cells[c] += tokens[d]
    for at, power in enumerate(mixing.SMOOTHING.values()):
        sums = collections.Counter()
        for c, t in cells.items():
            sums[c[at]] += t
        total = sum(v ** power for v in sums.values())
        targets.append({k: v ** power / total for k, v in sums.items()})
    weights = brute_rake(cells, targets, mixing.BUDGET)
    return {d: (int(hashlib.md5(f"{mixing.SEED}:{d}".encode()).hexdigest()[:13], 16) / 2**52, weights[c] / cells[c]) for d, c in cell.items()}


def test_each_stage_equals_a_plain_version_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = lambda rows: sorted((r.doc_id, r.text) for r in rows)
    rows, outs = docs.collect(), {}
    for name, stage in C.STAGES:
        docs = stage(spark, docs, SF).cache()
        outs[name] = docs.collect()
        if name == "quality_rules":
            rules = quality_rules.learn_rules(spark.read.parquet(f"{SF}/documents.parquet"), labels)
            bad = rules.covers(pd.DataFrame(quality_rules.text_statistics([r.text for r in rows])))
            want = []
            for r, rejected in zip(rows, bad):
                n, _, _, _, repeated = brute_counts(r.text)
                if n >= 20 and 100 * repeated <= 30 * n and not rejected:
                    want.append((r.doc_id, r.text))
            assert texts(outs[name]) == sorted(want)
        elif name == "line_dedup":
            found = [(d, t, dropped) for d, t, _, dropped in brute_lines([(r.doc_id, r.text) for r in rows])]
            assert texts(outs[name]) == sorted((d, t) for d, t, dropped in found if not dropped or re.search(mixing.WORD, t))
            length = {r.doc_id: r.n_chars for r in rows}
            assert {r.doc_id: r.n_chars for r in outs[name]} == {
                d: len(t) if dropped else length[d] for d, t, dropped in found if not dropped or re.search(mixing.WORD, t)}
        elif name == "near_dedup":
            kept = {d for d, _, c in brute_near([(r.doc_id, r.text) for r in rows], 5, 80) if d == c}
            assert texts(outs[name]) == sorted((r.doc_id, r.text) for r in rows if r.doc_id in kept)
        elif name == "mixing":
            got = {r.doc_id for r in outs[name]}
            near = {d for d, (draw, p) in brute_mixture(rows).items() if abs(draw - p) < 0.01}
            assert len(near) < 10 and got - near == {d for d, (draw, p) in brute_mixture(rows).items() if draw < p} - near
        else:
            check_packing(outs[name], packing.CAPACITY, {r.doc_id: ids_of(r.text) for r in rows})
        rows = outs[name]


def test_edge_rows_pass_through_every_stage(spark, docs_of):
    text = " ".join(LONG) + " plain words that go on for a while so that it is long enough to be kept by the rules"
    docs = docs_of([(1, text), (2, text), (None, None), (3, ""), (None, text), (1, text), (4, "unlike " + " ".join(reversed(LONG)))])
    quality = C.quality(spark, docs, SF)
    assert sorted(r.doc_id or 0 for r in quality.collect()) == [0, 1, 1, 2, 4]
    near = C.near_duplicates(spark, quality, SF).collect()
    assert {r.doc_id for r in near} == {1, 4}
    for _, stage in C.STAGES:
        assert stage(spark, docs_of([]), SF).count() == 0


def test_run_is_the_stages_in_a_row(spark):
    got = C.run(spark, SF)
    assert set(got.columns) >= {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert got.agg({"length": "max"}).first()[0] <= packing.CAPACITY
    assert got.groupBy("sequence_id").sum("length").where(f"`sum(length)` > {packing.CAPACITY}").count() == 0


@pytest.mark.parametrize("name", ["claimspark.llm", "corpus_pipeline"])
def test_the_library_does_not_import_it(name):
    import pathlib

    root = pathlib.Path(C.__file__).parent
    files = [p for p in (root / "claimspark").rglob("*.py") if "llm" not in p.parts] + list((root / "tests").glob("*.py")) + [root / "bench.py"]
    assert not [p for p in files if re.search(rf"^\s*(from|import) {re.escape(name)}\b", p.read_text(), re.M)]
