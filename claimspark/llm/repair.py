"""Operator 11: repair of conversation structure by scalar big-integer weights.

Every row is kept (K), given another role (R) or deleted (D), and empty rows may
be inserted (I) before it or at the end, so that the role initials read
``(s?(ua)+)?``. A path's weight is one integer: the cost in its high digits, the
audit letters in positional low digits. A row has one place of three letter
digits (at most two inserts, then the row's own letter; a third insert would
come back to the state after the first), unused digits are zero, and letter
digits are in ASCII order. No place's letters are the beginning of another's, as
each ends with the row's letter, so comparing places is comparing audits, and
zero at the end lets the shorter audit win. Weights add along a path, so the least
integer decides cost and audit at once, in an ordinary DAG of (row, state) nodes.
The letters determine every role: after u only a is legal, else only u can be made.

A long conversation is cut into blocks of rows over many tasks. Each block
yields its least weight from every entry to every exit state; a pass over these
small matrices, from the last block to the first, picks the states between blocks,
comparing audits by their rank within the block.

Defined results
  null role or text: one space; null conv_id: a conversation of its own
  null turn: before the others; equal turns: by role, then text
  empty text: blank, so deleted; very long text: held by its task as it is
  repeated rows: duplicates, all but the first
  ties between audits: the ASCII-least
  a conversation without rows left: zeros, an empty audit, the empty string's hash
  empty table: no rows
  extra columns of the input are ignored
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.llm import conversations as C
from claimspark.session import materialize

RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LETTERS = {letter: digit for digit, letter in enumerate("DIKR", 1)}
NAMES = {digit: letter for letter, digit in LETTERS.items()}
#: Bits of a letter digit, and letter digits of a row's place.
WIDTH, PLACE = 3, 3
#: States by the last initial: none yet, s, u, a. The end is legal in the first and the last.
NONE, S, U, A = range(4)
STATES, ACCEPTED = (NONE, S, U, A), (NONE, A)
INITIALS = "sua"
MADE = {NONE: U, S: U, U: A, A: U}
LEGAL_PAIRS = {"su", "ua", "au"}
WORDS = r"[^\x20\x09-\x0D]"
#: Rows of a block of a long conversation.
BLOCK_ROWS = 2048


def _place(letters: str) -> int:
    """The digits of one place, zero where it has fewer letters."""
    out = 0
    for i in range(PLACE):
        out = out << WIDTH | (LETTERS[letters[i]] if i < len(letters) else 0)
    return out


def _steps(initial: str | None, must_go: bool, truncated: bool) -> dict[int, list[tuple[int, int, int]]]:
    """From each state the least (next state, cost, place) to each next state over
    one row; over the end of the conversation if ``initial`` is None."""
    out = {}
    for state in STATES:
        best: dict[int, tuple[int, int]] = {}
        at = state
        for inserts in range(PLACE):
            before = "I" * inserts
            cost = INSERT * inserts
            if initial is None:
                options = [(at, cost, before)] if at in ACCEPTED else []
            else:
                options = [(at, cost + DELETE, before + "D")]
                if not must_go:
                    options.append((MADE[at], cost + RENAME + TRUNCATED * truncated, before + "R"))
                    own = INITIALS.find(initial) + 1 if len(initial) == 1 else 0
                    if own and (own == MADE[at] or (at, own) == (NONE, S)):
                        options.append((own, cost + TRUNCATED * truncated, before + "K"))
            for after, price, letters in options:
                best[after] = min(best.get(after, (price, _place(letters))), (price, _place(letters)))
            at = MADE[at]
        out[state] = [(after, *best[after]) for after in sorted(best)]
    return out


#: A row's kind is (initial or "", must go, truncated); None is the end.
_STEPS = {(i, g, t): _steps(i, g, t) for i in ["", *INITIALS] for g in (False, True) for t in (False, True)}
_STEPS[None] = _steps(None, False, False)


def least_weights(kinds: list, entry: int) -> dict[int, int]:
    """The least weight from ``entry`` to each state over rows of these kinds."""
    bits = WIDTH * PLACE * len(kinds)
    best = {entry: 0}
    for i, kind in enumerate(kinds):
        shift = bits - WIDTH * PLACE * (i + 1)
        ahead: dict[int, int] = {}
        for state, weight in best.items():
            for after, cost, place in _STEPS[kind][state]:
                new = weight + (cost << bits) + (place << shift)
                if after not in ahead or new < ahead[after]:
                    ahead[after] = new
        best = ahead
    return best


def read_weight(weight: int, n: int) -> tuple[int, list[str]]:
    """(cost, the letters of each of ``n`` places) of a weight."""
    bits = WIDTH * PLACE * n
    digits = weight & ((1 << bits) - 1)
    # octal digits are letter digits
    octal = f"{digits:0{PLACE * n}o}" if n else ""
    letters = octal.translate({ord("0"): None} | {ord(str(d)): c for d, c in NAMES.items()})
    places, begin = [], 0
    for i in range(n):
        size = PLACE - octal[PLACE * i:PLACE * (i + 1)].count("0")
        places.append(letters[begin:begin + size])
        begin += size
    return weight >> bits, places


def rows_of(places: list[str], rows: list[tuple[str, str]], state: int) -> tuple[list[tuple[str, str]], int]:
    """The repaired (role, text) rows that the letters ask for, and the state after.
    ``places`` may have one more than ``rows``, for the end."""
    out = []
    name = {U: "user", A: "assistant"}
    for i, letters in enumerate(places):
        for letter in letters:
            if letter == "D":
                continue
            if letter == "K":
                role, text = rows[i]
                state = INITIALS.index(role[0]) + 1
            else:
                state = MADE[state]
                role, text = name[state], "" if letter == "I" else rows[i][1]
            out.append((role, text))
    return out, state


def faults(rows: list[dict]) -> list[str]:
    """Each row's first fault ("" for none) by the text's columns and by what came before."""
    seen, out = set(), []
    for r in rows:
        key = (r["role"], r["text"])
        out.append("blank" if r["blank"] else "duplicate" if key in seen else "truncated" if r["cut"] else "")
        seen.add(key)
    return out


def kind(role: str, fault: str) -> tuple[str, bool, bool]:
    return role[:1] if role[:1] in INITIALS else "", fault in ("blank", "duplicate"), fault == "truncated"


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL_PAIRS for a, b in pairwise(initials))


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_SHORT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired", pa.list_(_TURN))])
_SHORT_SQL = f"conv_id long, {', '.join(c + ' long' for c in _COUNTS)}, audit string, repaired array<struct<role: string, text: string>>"


def repair_rows(conv_id: int | None, rows: list[dict]) -> tuple:
    """One conversation, its rows in order (``gone`` ones only say that it exists)."""
    rows = [r for r in rows if not r["gone"]]
    found = faults(rows)
    kinds = [kind(r["role"], f) for r, f in zip(rows, found, strict=True)] + [None]
    cost, places = read_weight(min(least_weights(kinds, NONE).values()), len(kinds))
    turns = {r["turn"] for r in rows if r["turn"] is not None}
    repaired, _ = rows_of(places, [(r["role"], r["text"]) for r in rows], NONE)
    return (conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[found.count(f) for f in ("blank", "duplicate", "truncated")],
            illegal_pairs([r["role"][:1] for r in rows]), cost, "".join(places), [{"role": r, "text": t} for r, t in repaired])


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return C.record_batches((repair_rows(i, rows) for i, rows in C.runs(batches)), _SHORT)


def _prepared(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone; what of a text decides its faults."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
    last = F.regexp_extract(text, rf"({WORDS})[\x20\x09-\x0D]*\z", 1)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"), gone.alias("gone"),
                       (~text.rlike(WORDS)).alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))


def repaired_sha256(turns: Column) -> Column:
    return F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n"), 256)


# --- long conversations ------------------------------------------------------------------
_BLOCK_SQL = ("conv_id long, block long, costs array<long>, ranks array<int>, audits array<string>, n_illegal long, "
              "first_initial string, last_initial string")
_LINE_SQL = "conv_id long, block long, nth int, turn long, role string, text string, fault string"


def _numbering(block_rows: int):
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("nth", pa.int32()), ("turn", pa.int64()), ("role", pa.string()),
                        ("text", pa.string()), ("fault", pa.string())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((conv_id, block, i, r["turn"], r["role"], r["text"], r["fault"])
                for block, conv_id, held in C.blocks(batches, block_rows, C.LONG_BYTES) for i, r in enumerate(held))
        return C.record_batches(rows, schema)

    return number


def _matrix(block: pa.Table) -> pa.Table:
    """Least costs and audits of a block from each state to each state, and the
    audits' ranks, so that they need not be compared again."""
    rows = sorted(block.select(["nth", "role", "fault"]).to_pylist(), key=lambda r: r["nth"])
    kinds = [kind(r["role"], r["fault"]) for r in rows]
    costs, audits = [None] * 16, [None] * 16
    for entry in STATES:
        for leave, weight in least_weights(kinds, entry).items():
            cost, places = read_weight(weight, len(kinds))
            costs[4 * entry + leave], audits[4 * entry + leave] = cost, "".join(places)
    rank = {a: i for i, a in enumerate(sorted({a for a in audits if a is not None}))}
    initials = [r["role"][:1] for r in rows]
    columns = [block.column("conv_id")[0].as_py(), block.column("block")[0].as_py(), costs, [rank.get(a) for a in audits], audits,
               illegal_pairs(initials), initials[0], initials[-1]]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(), pa.string(), pa.string()]
    return pa.table([pa.array([c], t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in _BLOCK_SQL.split(", ")])


def choose_states(blocks: list[dict]) -> tuple[int, list[tuple[int, int]], str]:
    """Least cost and the (entry, exit) states of each block, from the blocks' costs
    and ranks in order, and the letters at the end of the conversation.

    From the last block to the first: each state's best way on is the least of
    (cost, rank of the block's audit). Two audits of a block are never one the
    beginning of the other, so what follows is compared only where they are equal,
    and then they lead to the same state."""
    ends = {s: min((cost, place) for _, cost, place in steps) for s, steps in _STEPS[None].items()}
    onward, choices = {s: cost for s, (cost, _) in ends.items()}, []
    for b in reversed(blocks):
        best = {entry: min((b["costs"][4 * entry + leave] + onward[leave], b["ranks"][4 * entry + leave], leave)
                           for leave in STATES if b["costs"][4 * entry + leave] is not None) for entry in STATES}
        choices.append({entry: leave for entry, (_, _, leave) in best.items()})
        onward = {entry: cost for entry, (cost, _, _) in best.items()}
    state, path = NONE, []
    for choice in reversed(choices):
        path.append((state, choice[state]))
        state = choice[state]
    return onward[NONE], path, "".join(read_weight(ends[state][1], 1)[1])


_PATH_SQL = "conv_id long, block long, entry int, way int, ending string, cost long, illegal long"


def _path(matrices: pa.Table) -> pa.Table:
    blocks = sorted(matrices.to_pylist(), key=lambda b: b["block"])
    cost, path, ending = choose_states(blocks)
    illegal = sum(b["n_illegal"] for b in blocks) + sum(
        a["last_initial"] + b["first_initial"] not in LEGAL_PAIRS for a, b in pairwise(blocks))
    rows = [(b["conv_id"], b["block"], entry, 4 * entry + leave, ending if b is blocks[-1] else "", cost, illegal)
            for b, (entry, leave) in zip(blocks, path, strict=True)]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=[c.split()[0] for c in _PATH_SQL.split(", ")])


def split_audit(audit: str) -> list[str]:
    """An audit as the letters of each row: inserts and the row's own; then the end."""
    places, begin = [], 0
    for i, letter in enumerate(audit):
        if letter != "I":
            places.append(audit[begin:i + 1])
            begin = i + 1
    return [*places, audit[begin:]]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash a conversation over its rows in order; holds a row at a time."""

    def rows():
        now, block, digest, n = None, None, None, 0
        for batch in batches:
            for r in batch.to_pylist():
                if digest is None or r["conv_id"] != now:
                    if digest is not None:
                        yield now, digest.hexdigest()
                    now, block, digest, n = r["conv_id"], None, hashlib.sha256(), 0
                if r["block"] != block:
                    block, state, places = r["block"], r["entry"], split_audit(r["audit"])
                # what a block ends with are inserts at the end of the conversation
                own = places[r["nth"]:r["nth"] + 1]
                last = places[-1:] if r["nth"] == len(places) - 2 else []
                turns, state = rows_of([*own, *last], [(r["role"], r["text"])], state)
                for role, text in turns:
                    digest.update(("\n" * (n > 0) + f"{role}:{text}").encode())
                    n += 1
        if digest is not None:
            yield now, digest.hexdigest()

    return C.record_batches(rows(), pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())]))


def _long(rows: DataFrame, block_rows: int) -> DataFrame:
    """As for short ones, by blocks; ``repaired`` is null. One task holds a block of a
    conversation, or 300 bytes a block, or its audit of one letter a row; its rows
    stream through one task for the hash, in order."""
    there = materialize(rows.where(~F.col("gone")).withColumn("uid", F.monotonically_increasing_id()), "long-rows")
    # the first of equal rows, found by an aggregate, which a hot group does not stop
    firsts = there.groupBy("conv_id", "role", F.sha2("text", 256)).agg(
        F.min(F.struct(F.col("turn").isNotNull(), "turn", "uid")).alias("m")).select(F.col("m.uid").alias("first_uid"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first_uid").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    marked = there.join(firsts, F.col("uid") == F.col("first_uid"), "left").withColumn("fault", fault)
    lines = materialize(C.by_range(marked.select("conv_id", "turn", "role", "text", "fault", "uid"))
                        .mapInArrow(_numbering(block_rows), _LINE_SQL), "long-lines")
    matrices = materialize(lines.select("conv_id", "block", "nth", "role", "fault").groupBy("conv_id", "block")
                           .applyInArrow(_matrix, _BLOCK_SQL), "long-matrices")
    path = matrices.drop("audits").groupBy("conv_id").applyInArrow(_path, _PATH_SQL)
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    path = path.select(F.col("conv_id").alias("p_conv"), F.col("block").alias("p_block"), "entry", "way", "ending", "cost", "illegal")
    parts = materialize(
        matrices.join(path, same("conv_id", "p_conv") & (F.col("block") == F.col("p_block")))
        .select("p_conv", "p_block", "entry", "cost", "illegal", F.concat(F.col("audits")[F.col("way")], "ending").alias("audit")), "long-audits")
    lined = lines.join(parts, same("conv_id", "p_conv") & (F.col("block") == F.col("p_block"))) \
        .select("conv_id", "block", "nth", "role", "text", "entry", "audit")
    hashes = lined.repartition("conv_id").sortWithinPartitions("conv_id", "block", "nth") \
        .mapInArrow(_hashed, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "h_conv")
    audits = parts.groupBy("p_conv").agg(
        F.max("cost").alias("cost"), F.max("illegal").alias("illegal"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_block", "audit"))), lambda s: s["audit"]), "").alias("audit"))
    n = lambda f: F.count_if(F.col("fault") == f).alias(f)
    facts = lines.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        n("blank"), n("duplicate"), n("truncated"))
    whole = facts.join(audits, same("conv_id", "p_conv")).join(hashes, same("conv_id", "h_conv"))
    empty = rows.groupBy("conv_id").agg(F.bool_and("gone").alias("none")).where("none").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in _COUNTS], F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"))
    return whole.select("conv_id", *_COUNTS, "audit", "repaired_sha256").unionByName(empty) \
        .withColumn("repaired", F.lit(None).cast("array<struct<role: string, text: string>>"))


def repair(rows: DataFrame, most_rows: int = C.LONG_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row a conversation: figures of its faults, the cheapest edits' cost and
    audit, the repaired rows (null for a long conversation) and their hash.

    ``rows`` has conv_id, turn, role, text and, if there, ``gone``: a row that only
    says that its conversation exists."""
    short, long = C.split_long(_prepared(rows), most_rows)
    out = C.by_conversation(short).mapInArrow(_short, _SHORT_SQL)
    out = out.withColumn("repaired_sha256", repaired_sha256(F.col("repaired")))
    return out if long is None else out.unionByName(_long(long, block_rows))


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by crc32(conv_id:turn) % 20, as a test of the repair: 0 is gone, 1
    loses its text, 2 its sentence ends, 3 comes twice, 4 becomes a user's."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("code") == 0).alias("gone"),
                       F.explode(times).alias("time")).drop("time")
