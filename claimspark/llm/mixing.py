"""Operator 1: mixing sources to target weights by raking.

Documents fall into cells of source, language and topic. Iterative
proportional fitting scales the cells' token weights until each marginal has
its target share of the budget; a cell's weight never exceeds its tokens, so
the quotient is a probability, and each document is sampled with its cell's.

The cells are a Spark table: a sweep scales by window sums over it and is
written at its end. Documents are only scanned: once for
the cells' tokens, once to be sampled by a hash of doc_id.

Defined results
  null source or language: a value of its own, like any other
  very long text: counted by one expression over the whole of it, in one row's memory
  null or empty text: 0 tokens, topic ``prose``; sampled at its cell's
  probability (a cell without tokens: the budget's share)
  targets that cannot be met (too few tokens): the cells go in whole, the rest
  of the budget is spread over the others; ``error`` says how far off they are
  repeated rows of one doc_id: all or none; null doc_id: decided by the text
  empty table: no rows; extra columns of the input stay in ``row``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.session import materialize

#: Share of all tokens that is sampled.
BUDGET = 0.5
#: Targets: shares in proportion to tokens ** SMOOTHING (1: as they are, 0: all alike).
SMOOTHING = {"source": 0.7, "lang": 0.7, "topic": 0.9}
SWEEPS, TOLERANCE = 40, 1e-4
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"

#: Topics by what a text holds, first match first: one of the literals, and then
#: (tried only on texts with a literal) the pattern.
TOPICS = [
    ("legal", ["icense", "icence", "opyright", "ights reserved"], None),
    ("contact", ["@", "+"], r"@[A-Za-z0-9-]+\.|\+[0-9][0-9 ().-]{7}"),
    ("table", [" | "], r"\S \| \S[^\n|]* \| "),
]


def topic(text: Column) -> Column:
    out = F
    for name, literals, pattern in TOPICS:
        holds = F.lit(False)
        for x in literals:
            holds = holds | text.contains(x)
        out = out.when(holds & text.rlike(pattern) if pattern else holds, name)
    return out.otherwise("prose")


def with_cells(docs: DataFrame) -> DataFrame:
    """``row``, the cell (source, lang, topic) and tokens of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), topic(text).alias("topic"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"))


def smoothed_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """value, share: the dimension's tokens to ``power``, as shares of 1."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("tokens"))
    total = sums.agg(F.sum(F.pow("tokens", F.lit(power)))).first()[0] or 1.0
    return sums.select("value", (F.pow("tokens", F.lit(power)) / total).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], budget: float = BUDGET, sweeps: int = SWEEPS,
         tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (the dimensions, tokens) with ``weight``, expected sampled tokens, and
    ``error``, the largest difference of a reached share from its target: above
    ``tolerance`` if a cell has too few tokens for the targets or the sweeps ran out.

    targets: by dimension, value and share of the budget. They are joined to the cells
    once; a sweep scales by window sums over the cell table, so that nothing is
    broadcast, however many sweeps there are."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0) * budget
    now = cells.withColumn("weight", F.col("tokens") * F.lit(budget))
    for d, target in targets.items():
        target = target.select(F.col("value").alias(f"_{d}"), F.col("share").alias(f"share_{d}"))
        now = now.join(target.hint("merge"), F.col(d).eqNullSafe(F.col(f"_{d}")), "left").drop(f"_{d}")
    reached = lambda d: F.sum("weight").over(Window.partitionBy(d))
    off = [F.abs(reached(d) / F.lit(total or 1.0) - F.col(f"share_{d}")) for d in targets]
    worst = before = None
    for _ in range(sweeps):
        for d in targets:
            factor = F.when(reached(d) > 0, F.col(f"share_{d}") * F.lit(total) / reached(d)).otherwise(1.0)
            now = now.withColumn("weight", F.least(F.col("tokens").cast("double"), F.col("weight") * F.coalesce(factor, F.lit(1.0))))
        now = materialize(now, "cells")
        worst = now.select(F.greatest(*off, F.lit(0.0)).alias("off")).agg(F.max("off")).first()[0] or 0.0
        if worst <= tolerance or before is not None and abs(worst - before) <= tolerance / 10:
            break  # met, or as near as the cells' tokens allow
        before = worst
    return now.drop(*[f"share_{d}" for d in targets]).withColumn("error", F.lit(worst))


def marginals(cells: DataFrame, dimension: str, target: DataFrame, budget_tokens: float) -> DataFrame:
    """value, share (the target), reached (by the cells' weights)."""
    sums = cells.groupBy(dimension).agg(F.sum("weight").alias("sum"))
    return sums.join(target, F.col(dimension).eqNullSafe(F.col("value"))) \
        .select("value", "share", (F.col("sum") / F.lit(float(budget_tokens or 1))).alias("reached"))


def calibrated(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """``row``, the cell, tokens, ``probability``, ``sampled`` and the targets' ``error`` of every document."""
    rows = with_cells(docs)
    cells = materialize(rows.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")), "cells")
    if targets is None:
        targets = {d: materialize(smoothed_targets(cells, d, p), "targets") for d, p in SMOOTHING.items()}
    found = rake(cells, targets, budget).select(
        F.col("source").alias("s"), F.col("lang").alias("l"), F.col("topic").alias("t"), "error",
        F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(float(budget))).alias("probability"))
    same = F.col("source").eqNullSafe(F.col("s")) & F.col("lang").eqNullSafe(F.col("l")) & (F.col("topic") == F.col("t"))
    key = F.coalesce(F.col("row.doc_id").cast("string"), F.md5(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), key).cast("binary")), 1, 13), 16, 10).cast("double") / 2.0**52
    return rows.join(found, same).drop("s", "l", "t").withColumn("sampled", draw < F.col("probability"))
