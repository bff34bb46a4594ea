"""Operator 3: quality rules as a learned decision list.

Sequential covering: a rule (a conjunction of thresholds on statistics of a
text) grows on two thirds of the labelled rows by information gain, is pruned
on the other third, and the rows it covers leave; the next rule is learned on
the rest. The list becomes one ordered Spark conditional expression, so it
can be read, changed and stored.

Statistics are exact and over whole texts: repeated windows are found by rank
doubling (ranks of word pairs, then of pairs of pairs), without hashing.

Defined results
  null or empty text: all counts 0, fails the base rules
  very long text: a slice by itself; its task holds its words and its eight-word windows' hashes
  empty labels, or labels of one class: no learned rule; the base rules stand
  null labels, and labels of unknown documents, are not learned from
  repeated rows: judged each by itself, alike
  empty table: no rows
  extra columns of the input stay in ``row``; no name can clash with them
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.llm.common import WORD_RE, slices

#: Most labelled rows that the rules are learned from, chosen by a hash.
LABEL_BOUND = 20_000
WINDOW = 8
#: Text of a slice: a task holds some forty times that in words, numbers and sorts of them.
SLICE_BYTES = 1_000_000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["symbol_share", "pipe_share", "upper_share", "bang_share", "repeat_share", "dup_line_share", "mean_word",
          "distinct_share", "top_word_share"]
_STATS = T.StructType([*[T.StructField(c, T.LongType()) for c in COUNTS], *[T.StructField(c, T.DoubleType()) for c in SHARES]])


def _table(chars: str) -> np.ndarray:
    hit = np.zeros(256, bool)
    hit[[ord(c) for c in chars]] = True
    return hit


_SYMBOL, _SPACE = _table("#*$%&|<>"), _table("\x20\x09\x0a\x0b\x0c\x0d")


def _repeated(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether each word is in a window of eight that its text has twice."""
    ranks = ids
    for step in (1, 2, 4):  # ranks of 2, 4 and 8 words in a row
        if len(ranks) <= step:
            return np.zeros(len(ids), bool)
        ranks = pd.factorize(ranks[:-step] * (int(ranks.max()) + 1) + ranks[step:])[0]
    starts = np.flatnonzero(doc[:len(ranks)] == doc[WINDOW - 1:])
    key = pd.factorize(ranks[starts] * (int(doc[-1]) + 1) + doc[starts])[0]
    starts = starts[np.bincount(key)[key] > 1] if len(key) else starts
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def text_statistics(texts: list[str | None]) -> dict[str, np.ndarray]:
    """COUNTS and SHARES of each text."""
    n = len(texts)
    words = [WORD_RE.findall(t) if t else [] for t in texts]
    n_words = np.fromiter(map(len, words), np.int64, n)
    flat = [w for ws in words for w in ws]
    known = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    ids = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
    doc = np.repeat(np.arange(n), n_words)
    repeat = np.bincount(doc, _repeated(ids, doc), n).astype(np.int64) if len(ids) else np.zeros(n, np.int64)
    distinct, top = np.zeros(n), np.zeros(n)
    if len(ids):
        pair, first = np.unique(doc * len(known) + ids, return_counts=True)
        owner = pair // len(known)
        distinct = np.bincount(owner, minlength=n).astype(float)
        np.maximum.at(top, owner, first)
    chars, symbols, pipes, upper, bangs, dups, lines = (np.zeros(n, np.int64) for _ in range(7))
    for i, t in enumerate(texts):
        if not t:
            continue
        raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
        chars[i] = len(t) - np.count_nonzero(_SPACE[raw])
        symbols[i] = np.count_nonzero(_SYMBOL[raw])
        pipes[i], bangs[i] = t.count("|"), t.count("!")
        upper[i] = np.count_nonzero((raw >= 65) & (raw <= 90))
        full = [x for x in t.split("\n") if WORD_RE.search(x)]
        lines[i] = len(full)
        dups[i] = len(full) - len(set(full))
    share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dups, "n_repeat_words": repeat,
            "symbol_share": share(symbols, chars), "pipe_share": share(pipes, n_words), "upper_share": share(upper, chars),
            "bang_share": share(bangs, n_words), "repeat_share": share(repeat, n_words),
            "dup_line_share": share(dups, lines), "mean_word": share(chars, n_words),
            "distinct_share": share(distinct, n_words), "top_word_share": share(top, n_words)}


def with_statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``stats`` (COUNTS and SHARES)."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_column).cast("string").alias("text"))
    kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(SHARES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            found = text_statistics(part.column("text").to_pylist())
            stats = pa.StructArray.from_arrays(
                [pa.array(found[c], k) for c, k in zip(COUNTS + SHARES, kinds, strict=True)], names=COUNTS + SHARES)
            yield pa.RecordBatch.from_arrays([part.column("row"), stats], names=["row", "stats"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("stats", _STATS)]))


@dataclass
class DecisionList:
    """Ordered rules; a row that one fits is rejected, any other is kept."""

    rules: list[list[tuple[str, str, float]]] = field(default_factory=list)

    def rejects(self, stats: str = "stats") -> Column:
        out = None
        for rule in self.rules:
            fits = F.lit(True)
            for name, op, at in rule:
                value = F.col(f"{stats}.{name}")
                fits = fits & (value >= at if op == ">=" else value < at)
            out = F.when(fits, True) if out is None else out.when(fits, True)
        return F.lit(False) if out is None else out.otherwise(False)

    def covers(self, frame: pd.DataFrame) -> np.ndarray:
        hit = np.zeros(len(frame), bool)
        for rule in self.rules:
            hit |= _fits(rule, frame)
        return hit


def _fits(rule: list[tuple[str, str, float]], frame: pd.DataFrame) -> np.ndarray:
    hit = np.ones(len(frame), bool)
    for name, op, at in rule:
        v = frame[name].to_numpy()
        hit &= v >= at if op == ">=" else v < at
    return hit


def _grow(frame: pd.DataFrame, bad: np.ndarray, names: list[str], most: int, cuts: int) -> list[tuple[str, str, float]]:
    rule: list[tuple[str, str, float]] = []
    inside = np.ones(len(frame), bool)
    while len(rule) < most and bad[inside].any() and not bad[inside].all():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best = (1e-9, None)
        for name in names:
            v = frame[name].to_numpy()
            seen = np.unique(v[inside])
            if len(seen) < 2:
                continue
            mid = (seen[:-1] + seen[1:]) / 2
            for at in mid if len(mid) <= cuts else np.unique(np.quantile(mid, np.linspace(0, 1, cuts), method="nearest")):
                for op in (">=", "<"):
                    hit = inside & (v >= at if op == ">=" else v < at)
                    p1, n1 = bad[hit].sum(), (~bad[hit]).sum()
                    if p1:
                        gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                        if gain > best[0]:
                            best = (gain, (name, op, float(at)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside = _fits(rule, frame)
    return rule


def learn(frame: pd.DataFrame, bad: np.ndarray, names: list[str] | None = None, max_rules: int = 12,
          max_conditions: int = 4, cuts: int = 48, min_precision: float = 0.95, min_cover: int = 5) -> DecisionList:
    """Sequential covering of the ``bad`` rows of ``frame``. Every third row
    prunes; a rule counts if at least ``min_precision`` of what it covers in
    all rows left is bad."""
    names, out = names or SHARES, DecisionList()
    frame, bad = frame.reset_index(drop=True), np.asarray(bad, bool)
    while len(out.rules) < max_rules and bad.sum() >= min_cover and not bad.all():
        prune = np.arange(len(frame)) % 3 == 2
        rule = _grow(frame[~prune].reset_index(drop=True), bad[~prune], names, max_conditions, cuts)
        if not rule:
            break
        held, held_bad = frame[prune].reset_index(drop=True), bad[prune]

        def worth(r, held=held, held_bad=held_bad):
            hit = _fits(r, held)
            return (held_bad[hit].sum() - (~held_bad[hit]).sum()) / max(1, hit.sum()), hit.sum()

        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (*worth(r), -len(r)))
        hit = _fits(rule, frame)
        if bad[hit].sum() < min_cover or bad[hit].mean() < min_precision:
            break
        out.rules.append(rule)
        frame, bad = frame[~hit].reset_index(drop=True), bad[~hit]
    return out


def learn_rules(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> DecisionList:
    """Rules from at most ``bound`` labelled documents (labels: doc_id, quality;
    0 is bad). The labels are chosen by a hash of doc_id; the chosen ones are
    two numbers each, so their side of the join has a proven bound."""
    chosen = labels.where("doc_id is not null and quality is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("labelled_id")).agg(F.min("quality").alias("quality")) \
        .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(bound)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text") \
        .join(F.broadcast(chosen), F.col("id") == F.col("labelled_id")).select("id", "text", "quality")
    got = with_statistics(rows).select("row.id", "row.quality", "stats.*") \
        .orderBy(F.xxhash64("id"), "id", *COUNTS).limit(bound).toPandas()
    return learn(got, got["quality"].to_numpy() == 0) if len(got) else DecisionList()


def base_failed(stats: str = "stats") -> Column:
    words, repeat = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < 20) | (100 * repeat > 30 * words)


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``row``, ``stats``, ``base_failed``, ``rejected`` (by a learned rule), ``kept``."""
    return with_statistics(docs).select("row", "stats", base_failed().alias("base_failed"),
                                        rules.rejects().alias("rejected")) \
        .withColumn("kept", ~F.col("base_failed") & ~F.col("rejected"))
