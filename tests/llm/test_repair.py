import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from claimspark.llm import repair as R

ROWS = "conv_id long, turn long, role string, text string, code string, block long, n long"
LEGAL = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], ROWS)


def brute_edits(rows, found):
    """(cost, audit, repaired) by trying every edit of every row, with up to two inserts
    before it and at the end; only ways that no longer can become legal are left."""
    name, begun = {"u": "user", "a": "assistant"}, re.compile(r"(s?(ua)*u?)?")
    inserts = ["", "u", "a", "uu", "ua", "au", "aa"]

    def ways(i, initials, cost, audit, out):
        for before in inserts:
            now = initials + before
            if not begun.fullmatch(now):
                continue
            price, letters, kept = cost + 2 * len(before), audit + "I" * len(before), out + [(name[x], "") for x in before]
            if i == len(rows):
                if LEGAL.fullmatch(now):
                    yield price, letters, kept
                continue
            role, text = rows[i]
            yield from ways(i + 1, now, price + 3, letters + "D", kept)
            if found[i] not in ("blank", "duplicate"):
                more = price + (found[i] == "truncated")
                for letter, extra, new in [("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")]:
                    if begun.fullmatch(now + (new or "?")[0]):
                        yield from ways(i + 1, now + new[0], more + extra, letters + letter, kept + [(new, text)])

    return min(ways(0, "", 0, "", []))


def plain(rows):
    """The contract in plain Python: damage, faults, figures and brute-force edits of one conversation's rows."""
    kept = []
    for conv_id, turn, role, text in rows:
        spaced = lambda v: " " if v is None else str(v)
        code = zlib.crc32(f"{spaced(conv_id)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        kept += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    found, seen = [], set()
    for _, role, text in kept:
        bare = text.rstrip(SPACE)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = {t for t, _, _ in kept if t is not None}
    initials = [r[:1] for _, r, _ in kept]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    figures = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal)
    return figures, [(r, t) for _, r, t in kept], found


def random_rows(rng, conv_id, n):
    turn = lambda i: rng.choice([i, i, i, i + 1, None])
    texts = ["Yes.", "No!", "cut", " ", "", None, "Ends here.\n ", "é?"]
    return [(conv_id, turn(i), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]), rng.choice(texts)) for i in range(n)]


def check(got, rows, by_brute):
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r)
    assert {r.conv_id for r in got} == set(by_conv) and len(got) == len(by_conv)
    for r in got:
        figures, kept, found = plain(by_conv[r.conv_id])
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == figures
        if by_brute:
            cost, audit, repaired = brute_edits(kept, found)
            assert (r.cost, r.audit) == (cost, audit), (kept, found)
            text = "\n".join(f"{a}:{b}" for a, b in repaired)
            assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_short_conversations_equal_brute_force(spark):
    rng = random.Random(7)
    rows = [r for i in range(150) for r in random_rows(rng, i if i else None, rng.randrange(1, 4))]
    got = R.repair(R.damage(frame(spark, rows).repartition(5))).collect()
    check(got, rows, True)
    assert {len(r.repaired) for r in got} >= {0, 2, 4}


def test_blocks_equal_one_pass(spark):
    """Long conversations, by blocks of three rows over several partitions, give what one pass over all rows gives."""
    rng = random.Random(8)
    rows = [r for i, n in enumerate([40, 2, 90, 1, 17, 60]) for r in random_rows(rng, i if i else None, n)]
    damaged = R.damage(frame(spark, rows).repartition(4))
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    one = sorted(map(tuple, R.repair(damaged).select(columns).collect()), key=str)
    many = R.repair(damaged, most_rows=4, block_rows=3)
    assert sorted(map(tuple, many.select(columns).collect()), key=str) == one
    check(many.collect(), rows, False)


def test_weights_over_many_rows_equal_blocks():
    """The choice between blocks in plain Python, against one integer for all rows."""
    rng = random.Random(9)
    kinds = [k for k in R._STEPS if k is not None]
    for _ in range(200):
        own = [rng.choice(kinds) for _ in range(rng.randrange(1, 30))]
        weight = min(R.least_weights([*own, None], R.NONE).values())
        cost, places = R.read_weight(weight, len(own) + 1)
        blocks, audits, begin = [], [], 0
        while begin < len(own):
            part = own[begin:begin + rng.randrange(1, 6)]
            begin += len(part)
            told, names = [None] * 16, [None] * 16
            for entry in R.STATES:
                for leave, w in R.least_weights(part, entry).items():
                    told[4 * entry + leave], letters = R.read_weight(w, len(part))
                    names[4 * entry + leave] = "".join(letters)
            rank = {a: i for i, a in enumerate(sorted({n for n in names if n is not None}))}
            blocks.append({"costs": told, "ranks": [rank.get(n) for n in names]})
            audits.append(names)
        price, path, ending = R.choose_states(blocks)
        assert (price, "".join(a[4 * i + j] for a, (i, j) in zip(audits, path)) + ending) == (cost, "".join(places))


def test_edge_conversations(spark):
    rows = [(1, None, None, None), (1, None, "user", ""), (2, 5, "user", "A long one. " * 20_000), (3, 1, "user", "Hi."), (3, 1, "user", "Hi."),
            (4, 0, "system", "Be nice."), (None, 0, "user", "Hi."), (None, 1, "assistant", "Ho.")]
    f = frame(spark, rows)
    check(R.repair(R.damage(f)).collect(), rows, True)
    gone = R.repair(f.withColumn("gone", F.lit(True))).collect()
    assert {(r.conv_id, r.cost, r.audit, r.gaps) for r in gone} == {(i, 0, "", 0) for i in (1, 2, 3, 4, None)}
    assert {r.repaired_sha256 for r in gone} == {hashlib.sha256(b"").hexdigest()}
    assert R.repair(f.limit(0)).count() == 0


@pytest.mark.parametrize("rows,want", [
    ([("user", ""), ("assistant", "")], (0, "KK")),
    ([("assistant", "")], (2, "IK")),
    ([("user", "")], (2, "KI")),
    ([("system", "")], (3, "D")),
    ([("user", ""), ("user", "")], (4, "KIKI")),
])
def test_named_repairs(rows, want):
    kinds = [R.kind(role, "") for role, _ in rows] + [None]
    cost, places = R.read_weight(min(R.least_weights(kinds, R.NONE).values()), len(kinds))
    assert (cost, "".join(places)) == min(want, brute_edits(rows, [""] * len(rows))[:2])
