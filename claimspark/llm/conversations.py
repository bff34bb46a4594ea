"""Helpers for operators on conversations: rows in order, long ones apart.

A conversation is short if it has at most ``LONG_ROWS`` rows and ``LONG_BYTES``
of text: a task may hold such a one. A longer one, which may be a third of the
table, is dealt over range partitions and handled by blocks of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.session import materialize

LONG_ROWS = 4096
LONG_BYTES = 32_000_000


def order() -> list[Column]:
    """Rows of a conversation by turn, nulls first; equal turns by role and text."""
    return [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]


def split_long(rows: DataFrame, most_rows: int = LONG_ROWS, most_bytes: int = LONG_BYTES) -> tuple[DataFrame, DataFrame | None]:
    """(rows of short conversations, rows of long ones or None if there is none)."""
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size"))
    long = materialize(sizes.where((F.col("n") > most_rows) | (F.col("size") > most_bytes))
                       .select(F.col("conv_id").alias("long_id")), "long-conversations")
    if long.isEmpty():
        return rows, None
    here = F.col("conv_id").eqNullSafe(F.col("long_id"))
    return rows.join(long, here, "left_anti"), rows.join(long, here, "left_semi")


def by_conversation(rows: DataFrame) -> DataFrame:
    """Each (short) conversation in one task, its rows together and in order."""
    return rows.repartition("conv_id").sortWithinPartitions(*order())


def by_range(rows: DataFrame) -> DataFrame:
    """Rows in order over all partitions; a long conversation spans many. ``uid``, a
    number of each row, tells equal rows apart, so that these are split too."""
    spread = [*order(), F.col("uid").asc()]
    return rows.repartitionByRange(*spread).sortWithinPartitions(*spread).drop("uid")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[dict]]]:
    """(conv_id, rows) of consecutive rows with the same conv_id, also over batches."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv_id"] != now:
                yield now, held
                held = []
            now = row["conv_id"]
            held.append(row)
    if held:
        yield now, held


def blocks(batches: Iterator[pa.RecordBatch], most_rows: int, most_chars: int) -> Iterator[tuple[int, int | None, list[dict]]]:
    """(block, conv_id, rows) of sorted rows: at most so many rows, or characters of
    text (one longer text stands alone), of one conversation. Block numbers rise
    in the order of the rows over all range partitions."""
    block = (TaskContext.get().partitionId() << 33) - 1
    now, held, chars = None, [], 0
    for batch in batches:
        for row in batch.to_pylist():
            size = len(row["text"] or "")
            if held and (row["conv_id"] != now or len(held) == most_rows or chars + size > most_chars):
                block += 1
                yield block, now, held
                held, chars = [], 0
            now = row["conv_id"]
            held.append(row)
            chars += size
    if held:
        yield block + 1, now, held


def record_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 500) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most so many rows."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
