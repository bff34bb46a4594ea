"""Operator 2: line dedup by a log-template tree.

A line is parsed to a fixed depth: its number of tokens, then its leading
tokens; tokens with a digit are fields and read as ``<*>``. Under such a leaf
the other tokens form four segments. Lines of a leaf that agree but for one
segment share a template in which that segment is a field, so a template is
the line itself or the line with one segment generalised (three quarters of
its tokens or more agree).

A template recurs if the texts of at least ``min_docs`` documents have it; a
whole-document copy counts as the same text, because whole copies are the
near-duplicate operator's work. The first occurrence of a recurring template
(smallest doc_id, then line) stays, in all whole copies of its document; the
others are dropped, and with them what their generalised fields held.

Leaves that only one text has cannot hold a recurring template. They go
after one partial aggregate of hashes; texts are shuffled once, to the
decisions on their lines. Only DataFrame functions run.

Defined results
  null or empty text: unchanged, no line
  very long text: its lines are rows of their own; split and joined again in one row's memory
  lines of fewer than ``min_tokens`` tokens, blank ones too, are kept
  repeated rows (equal doc_id and text): alike
  null doc_id: comes first in the order of occurrences
  empty table: no rows; extra columns of the input stay in ``row``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import text_key
from claimspark.session import materialize

MIN_DOCS = 3
MIN_TOKENS = 4
DEPTH = 3
SEGMENTS = 4
#: Tokens of a line from which on segments (of two or more tokens) are generalised.
SEGMENT_TOKENS = DEPTH + 2 * SEGMENTS
GAP = r"[\x20\x09-\x0D]+"
FIELD = "<*>"


def hashed(*parts: Column) -> Column:
    """A 128-bit identity as two longs."""
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def _tokens(line: Column) -> Column:
    """A line's tokens, those with a digit as fields."""
    field = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+", FIELD)).otherwise(line)
    return F.filter(F.split(field, GAP), lambda t: t != "")


def line_rows(docs: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """doc_id, key, line_no, leaf and segments (hashes) of the lines of ``docs``."""
    # the generator's output is a column: tokens are made once, whatever filters on them
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"),
                       F.posexplode(F.transform(F.split(F.col("text"), "\n"), _tokens)).alias("line_no", "tokens")) \
        .where(F.size("tokens") >= min_tokens).withColumn("n", F.size("tokens"))
    tokens = F.col("tokens")
    width = F.ceil((F.col("n") - DEPTH) / SEGMENTS).cast("int")
    segments = [hashed(F.slice(tokens, F.lit(DEPTH + 1) + i * width, width)) for i in range(SEGMENTS)]
    return rows.select("doc_id", "key", "line_no", (F.col("n") >= SEGMENT_TOKENS).alias("wide"),
                       hashed("n", F.slice(tokens, 1, DEPTH)).alias("leaf"), F.array(*segments).alias("segments"))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """doc_id, key, line_no of the lines to drop."""
    lines = materialize(line_rows(docs, min_tokens), "lines")
    text = F.xxhash64("key")
    leaves = lines.groupBy("leaf").agg(F.min(text).alias("low"), F.max(text).alias("high")).where("low <> high").select("leaf")
    lines = lines.join(leaves, "leaf")
    # level 0: the line itself; level i: segment i is a field
    level = lambda i: F.struct(F.lit(i).alias("level"), hashed(
        F.lit(i), F.col("leaf"), *[F.col("segments")[j] for j in range(SEGMENTS) if j != i - 1]).alias("template"))
    levels = F.when(F.col("wide"), F.array(*map(level, range(SEGMENTS + 1)))).otherwise(F.array(level(0)))
    found = materialize(lines.select("doc_id", "key", "line_no", F.inline(levels)), "templates")
    recurs = found.select("template", "key").distinct().groupBy("template").agg(F.count("*").alias("support")) \
        .where(F.col("support") >= min_docs)
    place = F.struct("doc_id", "line_no", "key")
    found = found.join(recurs, "template")
    first = found.groupBy("template").agg(F.min(place).alias("first"))
    best = F.struct(F.col("level") > 0, -F.col("support"), "level")
    stays = (F.col("first.key") == F.col("key")) & (F.col("first.line_no") == F.col("line_no"))
    return found.join(first, "template").groupBy("doc_id", "key", "line_no").agg(F.min_by(stays, best).alias("stays")) \
        .where(~F.col("stays")).select("doc_id", "key", "line_no")


def drop_templates(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``row`` (all columns of ``docs``), text without the dropped lines,
    n_lines, n_dropped."""
    gone = dropped_lines(docs, min_docs, min_tokens).groupBy("doc_id", "key").agg(F.collect_set("line_no").alias("gone"))
    gone = gone.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("i"), text_key(F.col("text")).alias("t"),
                       F.col("text").cast("string").alias("text"))
    rows = rows.join(gone, F.col("i").eqNullSafe(F.col("d")) & (F.col("t") == F.col("k")), "left")
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("gone", i)), "\n")
    return rows.select("row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
                       F.when(F.col("text").isNull() | (F.col("text") == ""), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")) \
        .withColumn("n_dropped", F.greatest("n_dropped", F.lit(0).cast("long")))
