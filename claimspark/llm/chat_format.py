"""Operator 13: chat formatting by a grammar round trip.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. The deterministic
parser reads that grammar and nothing else: a role has no newline and no control
string, a text ends at the first control string, which must close the turn. What
is rendered is parsed again and compared with its source; a turn that comes
back otherwise is escaped and tried again until it is identical, and a whole
part is parsed once more before it is returned.

Escapes: in a text, a control string gets a backslash after its ``<``, and one
that has backslashes there gets one more; in a role, backslash, newline and
``<`` are written ``\\\\``, ``\\n`` and ``\\l``. The parser takes them back.

The formatted text comes in parts: a short conversation is one part, a long
one as many as its size asks, made in parallel where its rows lie.

Defined results
  null text or role: empty
  empty text: a turn with nothing inside; very long text: a part by itself
  null turn: before the others; equal turns: by role, then text
  repeated rows: every row is a turn
  null conv_id: a conversation of its own
  empty table: no rows
  extra columns of the input are ignored
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm import conversations as C
from claimspark.session import materialize

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that may stand in no text unescaped: the template's own and the end of a document.
CONTROLS = (START, END, "<|endoftext|>")
#: The role that is learned.
LEARNED = "assistant"
#: Characters of source text in a part of a long conversation.
PART_CHARS = 4_000_000

_NAMES = "|".join(re.escape(c[1:]) for c in CONTROLS)
_CONTROL = re.compile(f"<(?:{_NAMES})")
_ANY_LEVEL = re.compile(rf"<(\\*)({_NAMES})")
_ESCAPED = re.compile(rf"<\\(\\*)({_NAMES})")
_ROLE_OUT = {"\\": "\\\\", "\n": "\\n", "<": "\\l"}
_ROLE_IN = {v[1]: k for k, v in _ROLE_OUT.items()}


def escape_text(text: str) -> str:
    return _ANY_LEVEL.sub(r"<\\\1\2", text)


def unescape_text(text: str) -> str:
    return _ESCAPED.sub(r"<\1\2", text)


def escape_role(role: str) -> str:
    return "".join(_ROLE_OUT.get(c, c) for c in role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ROLE_IN.get(m[1], m[0]), role)


def spans(text: str) -> list[tuple[str, int, int]] | None:
    """(role as written, begin, end of the text) of each turn; None if ``text`` is not
    of the grammar. One pass, no choice anywhere."""
    out, at = [], 0
    while at < len(text):
        line = text.find("\n", at)
        if not text.startswith(START, at) or line < 0:
            return None
        role = text[at + len(START):line]
        close = _CONTROL.search(text, line + 1)
        if "<" in role or close is None or close[0] != END or not text.startswith("\n", close.end()):
            return None
        out.append((role, line + 1, close.start()))
        at = close.end() + 1
    return out


def parse(text: str) -> list[tuple[str, str]] | None:
    """The turns (role, text) of a formatted text, or None."""
    found = spans(text)
    return None if found is None else [(unescape_role(r), unescape_text(text[i:j])) for r, i, j in found]


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(rendered turn, begin and end of its text inside), escaped as far as the round
    trip asks: not at all, the text, the role, both."""
    for r, t in ((role, text), (role, escape_text(text)), (escape_role(role), text), (escape_role(role), escape_text(text))):
        out = f"{START}{r}\n{t}{END}\n"
        if parse(out) == [(role, text)]:
            begin = len(START) + len(r) + 1
            return out, begin, begin + len(t)
    raise ValueError(f"no escape brings this turn back: {role!r} {text[:80]!r}")


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of ``turns`` and the spans of the texts to learn."""
    out, learned, at = [], [], 0
    for role, text in turns:
        turn, begin, end = render_turn(role, text)
        out.append(turn)
        if role == LEARNED:
            learned.append((at + begin, at + end))
        at += len(turn)
    whole = "".join(out)
    if parse(whole) != turns:
        raise ValueError("a part does not come back as its turns")
    return whole, learned


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
                    ("loss_spans", pa.list_(_SPAN))])
_PARTS_SQL = "conv_id long, part long, n_turns long, formatted string, loss_spans array<struct<start: long, end: long>>"
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_DIGEST_SQL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _row(part: int, conv_id: int | None, rows: list[dict]) -> tuple:
    formatted, learned = render([(r["role"], r["text"]) for r in rows])
    return conv_id, part, len(rows), formatted, [{"start": i, "end": j} for i, j in learned]


def format_conversations(rows: DataFrame, most_rows: int = C.LONG_ROWS, part_chars: int = PART_CHARS) -> tuple[DataFrame, DataFrame | None]:
    """Formatted parts (conv_id, part, n_turns, formatted, loss_spans in code points)
    of short conversations, one each, and those of long ones (landed) or None.
    Parts of a conversation follow each other by ``part``."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    short, long = C.split_long(rows, most_rows)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return C.record_batches((_row(0, conv_id, held) for conv_id, held in C.runs(batches)), _PARTS)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = C.blocks(batches, most_rows, part_chars)
        return C.record_batches((_row(part, conv_id, held) for part, conv_id, held in cut), _PARTS, 1)

    out = C.by_conversation(short).mapInArrow(whole, _PARTS_SQL)
    return out, long if long is None else materialize(
        C.by_range(long.withColumn("uid", F.monotonically_increasing_id())).mapInArrow(parts, _PARTS_SQL), "formatted-parts")


class _Reader:
    """Digests of a conversation, fed with its formatted parts in order."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, loss_spans: list[dict]) -> None:
        for role, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for span in loss_spans:
            text = unescape_text(formatted[span["start"]:span["end"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self, conv_id: int | None) -> tuple:
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        now, reader = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if reader is not None and (r["conv_id"] != now or r["part"] == 0):
                    yield reader.row(now)
                    reader = None
                now, reader = r["conv_id"], reader or _Reader()
                reader.add(r["formatted"], r["loss_spans"])
        if reader is not None:
            yield reader.row(now)

    return C.record_batches(rows(), _DIGEST)


def read_back(formatted: tuple[DataFrame, DataFrame | None]) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, from the formatted
    parts alone. A long conversation's parts stream through one task in order, as
    its one hash asks; the task holds a part at a time."""
    short, long = formatted
    out = short.mapInArrow(_read, _DIGEST_SQL)
    if long is None:
        return out
    in_order = long.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    # parts of long ones are numbered from 1 here, since 0 marks a conversation of one part
    return out.unionByName(in_order.withColumn("part", F.col("part") + 1).mapInArrow(_read, _DIGEST_SQL))
