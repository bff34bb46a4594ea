"""Operator 4: best-fit packing of token sequences.

Bounded-space online best-fit. A fixed number of bins is open at any time;
a bitset has one bit for each amount of free space that some open bin has.
An item goes to the open bin that it fills best: the lowest set bit at or
above its length. When more bins than allowed are open, the fullest one
closes. Items are dealt over partitions by hash, so the lengths in each are
alike, and come to the packer longest first, which is the best order for it.

Defined results
  null or empty text: one piece, the end id alone
  text over the capacity: cut at multiples of the capacity; others stay whole
  repeated rows, equal or null doc_ids: every row is packed by itself
  empty table: no rows
  extra columns of the input are ignored
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import slices
from claimspark.session import materialize

CAPACITY = 4096
#: Open bins of one packer (one task); a bin is one small tuple.
OPEN_BINS = 32_768
#: Tokens that one packer gets, about as many as OPEN_BINS bins hold.
PACKER_TOKENS = OPEN_BINS * CAPACITY
END_ID = 1
#: Text of a slice (its chunks and ids are Python objects meanwhile).
SLICE_BYTES = 1_000_000
#: Chunks that a Python worker remembers the ids of, in each of two generations.
CACHE_CHUNKS = 400_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_CHUNK = re.compile(r"[^ \t\n\r]+")
_ENCODERS: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Byte-level symbols of the vocabulary: printable bytes stand for themselves.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_SYMBOLS = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(_OTHERS)}


class Memory:
    """A dictionary in two generations: what was not used since the last change
    of generation goes when ``most`` is reached, so that it stays bounded."""

    def __init__(self, most: int):
        self.most, self.now, self.old = most, {}, {}

    def missing(self, keys: set[str]) -> set[str]:
        """The keys without a value; ``now`` has the others afterwards."""
        new = keys.difference(self.now)
        if len(self.now) + len(new) > self.most:
            self.now, self.old, new = {}, self.now, keys
        self.now.update((k, self.old[k]) for k in new if k in self.old)
        return new.difference(self.now)


class ChunkEncoder:
    """Token ids of whole texts as little-endian uint32 bytes.

    The tokenizer drops white space and never joins over it, so a text's ids are
    those of its chunks in a row and chunks can be remembered. Letters up to
    U+00FF and the punctuation after them are also separate words to it, and
    it lower-cases, so a new chunk is looked up by its letters first, and
    these need only the vocabulary's merges. Probes show whether a tokenizer is
    of this kind; if not, whole texts go through it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.chunks, self.parts = Memory(CACHE_CHUNKS), Memory(CACHE_CHUNKS)
        self.by_chunk = True
        probes = ["Abc dE.\n\tgh!! Éa,b  ñß|| x", "It's 42 a1b2 re-do; ÀÉÎ... cl\u00f4ture"]
        self.by_chunk = self.encode(probes) == self._whole(probes)

    def _whole(self, texts) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: set[str]) -> None:
        split = {}
        for c in chunks:
            letters = c.rstrip(".,!|#$%&*")
            split[c] = (letters.lower(), c[len(letters):]) if letters.isalpha() and max(letters) < "Ā" else (c, "")
        fresh = self.parts.missing({p for pair in split.values() for p in pair})
        parts, tokenize, rest = self.parts.now, self.tokenizer.model.tokenize, []
        for p in fresh:
            if p.isalpha() and max(p) < "Ā" and p == p.lower():
                symbols = p if p.isascii() else p.encode().decode("latin-1").translate(_SYMBOLS)
                parts[p] = array("I", [t.id for t in tokenize(symbols)]).tobytes()
            else:
                rest.append(p)
        parts.update(zip(rest, self._whole(rest), strict=True))
        self.chunks.now.update((c, parts[a] + parts[b]) for c, (a, b) in split.items())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.by_chunk:
            return self._whole([t or "" for t in texts])
        split = [_CHUNK.findall(t) if t else [] for t in texts]
        self._learn(self.chunks.missing(set().union(*split)))
        get = self.chunks.now.__getitem__
        return [b"".join(map(get, chunks)) for chunks in split]


def _encoder(path: str) -> ChunkEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length,
    ids_crc32 and, ``with_ids``, the ids as little-endian uint32 bytes."""
    path = tokenizer or default_tokenizer()
    end = end_id.to_bytes(4, "little")
    schema = PIECES + (", ids binary" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for part in slices(batches, "text", SLICE_BYTES):
            rows = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text").to_pylist()),
                                   strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at:at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece), piece))
            columns = list(zip(*rows, strict=True))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)][:len(names)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(cut, schema)


class OpenBins:
    """The open bins of one packer."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.by_free: list[list[int]] = [[] for _ in range(capacity)]
        self.bits = 0
        self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of an item of ``length``."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.capacity, self.made
            self.made += 1
        if left := free - length:
            self.by_free[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return bin_, self.capacity - free

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_ = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return bin_


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         packer_tokens: int = PACKER_TOKENS) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 to capacity.

    ``pieces`` is read twice: give a written table. The number of packers
    follows the sum of lengths, so each task has a like amount of work."""
    total = pieces.agg(F.sum("length")).first()[0] or 0
    packers = max(1, -(-total // packer_tokens))
    schema = pieces.schema.simpleString()[len("struct<"):-1].replace(":", " ") + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            places = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + b for b, _ in places], pa.int64()),
                 pa.array([o for _, o in places], pa.int64())], names=[*batch.schema.names, "sequence_id", "offset"])

    key = F.xxhash64("doc_id", "piece", "ids_crc32", "length")
    return pieces.repartition(packers, key).sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32") \
        .mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (doc_id, text)."""
    return pack(materialize(token_pieces(docs, tokenizer, capacity, with_ids=with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves from ``pack_documents(with_ids=True)``:
    sequence_id, doc_ids and starts in order, ids (at most 4 * capacity bytes)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"),
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
