import collections
import math
import re

from claimspark.llm import line_templates as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def levels(line):
    tokens = [L.FIELD if re.search("[0-9]", t) else t for t in WORD.findall(line)]
    n = len(tokens)
    if n < L.MIN_TOKENS:
        return []
    width = math.ceil((n - L.DEPTH) / L.SEGMENTS)
    parts = [tuple(tokens[L.DEPTH + i * width:L.DEPTH + (i + 1) * width]) for i in range(L.SEGMENTS)]
    top = L.SEGMENTS if n >= L.SEGMENT_TOKENS else 0
    return [(lv, n, tuple(tokens[:L.DEPTH]), *[p for i, p in enumerate(parts) if i != lv - 1]) for lv in range(top + 1)]


def brute(rows):
    """Texts without the lines that recur, by plain loops."""
    texts, first = collections.defaultdict(set), {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for d, t in order:
        for i, line in enumerate((t or "").split("\n")):
            for key in levels(line):
                texts[key].add(t)
                place = (d is not None, d or 0, i)
                if key not in first or place < first[key][0]:
                    first[key] = (place, t, i)
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        lines, kept = t.split("\n"), []
        for i, line in enumerate(lines):
            found = [(k[0] > 0, -len(texts[k]), k[0], k) for k in levels(line) if len(texts[k]) >= L.MIN_DOCS]
            if not found or first[min(found)[3]][1:] == (t, i):
                kept.append(line)
        out.append((d, "\n".join(kept), len(lines) if t else 0, len(lines) - len(kept)))
    return out


ROWS = [
    (5, "Job 17 ended at noon today\nown line of the fifth text here\nshort one"),
    (3, "Job 18 ended at noon today\nan own line of the third\nshort one"),
    (9, "Job x9 ended at noon today\n\n  \nshort one\nJob 44 ended at noon today"),
    (1, "nothing recurs in this text"), (2, None), (4, ""), (None, "Job 1 ended at noon today\nwithout an id"),
    # one segment of four differs
    (20, "alpha beta gamma one two three four five six seven eight"), (21, "alpha beta gamma one two three four nine nine seven eight"),
    (22, "alpha beta gamma one two three four ten ten seven eight"), (23, "alpha beta gamma x two x four ten x seven x"),
    # whole copies count as one text
    (30, "copied text that has a line\nand another one of it too"), (31, "copied text that has a line\nand another one of it too"),
    (32, "copied text that has a line\nand another one of it too"),
    (40, "é ü twice in texts of three"), (41, "é ü twice in texts of three\nplus"), (42, "é\x0bü  twice in texts of three\nmore"),
    (50, "word " * 20_000 + "\n" + "w x y z\n" * 3000), (3, "an own line of the third again"), (1, "nothing recurs in this text"),
]


def test_matches_loops(spark, docs_of):
    got = L.drop_templates(docs_of(ROWS)).select("row.doc_id", "text", "n_lines", "n_dropped", "row.text_").collect()
    key = lambda r: (str(r[0]), r[1] or "", r[2])
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(brute(ROWS), key=key)
    by_id = {r.doc_id: r.text for r in got}
    assert by_id[31] == ROWS[12][1] and "noon" not in by_id[9] and by_id[21] == by_id[22] == "" and by_id[23] == ROWS[10][1]
    assert L.drop_templates(docs_of([])).count() == 0


def test_no_python_on_the_main_path(docs_of):
    plan = L.drop_templates(docs_of(ROWS[:3]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
