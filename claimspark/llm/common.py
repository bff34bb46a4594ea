"""Helpers shared by the training-data operators."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """Sixteen-byte identity of a whole text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def hash64(text: str, seed: bytes = b"") -> int:
    """Stable signed 64-bit hash, the same in every process."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8, key=seed).digest(),
                          "little", signed=True)


def slices(batches: Iterator[pa.RecordBatch], text_column: str, max_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about ``max_bytes`` of text (one
    longer text stands alone): Python objects exist for one slice at a time."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_pylist()
        begin = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < len(sizes):
            yield batch.slice(begin)
