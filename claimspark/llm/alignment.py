"""Operator 12: cross-tokenizer alignment by interval coalescing.

Both tokenizers tile the bytes of space+text. All tokens of both are lexsorted by
start; ``maximum.accumulate`` of their ends gives the reach so far, and a group
breaks where a start reaches it, that is at every byte where a token of both
sides ends. Inside a group every A token is linked with every B token.

No token of either side reaches over a single space between two other characters
(see ``words``), so a group never does, and a block of texts is aligned by its
distinct words; a tokenizer of another kind gets whole texts as words.

The corpus-wide counts (how many documents hold an id pair linked) travel by
block, a slice of about ``SLICE_BYTES`` of text: a block sends each of its id
pairs once with the number of its documents that hold it, and gets one count
back for each, so that what is shuffled are a block's distinct pairs, not the
links. Nothing is broadcast but the highest count of each A id, which the
vocabulary bounds.

Defined results
  null or empty text, or one that a tokenizer does not give back byte for byte:
    no tokens, zeros, an empty groups_sha256
  very long text: a block by itself, split by segments of ``SEGMENT_CHARS``; its
    task holds the text, 4 bytes a word and its distinct words' tokens
  repeated rows, equal or null doc_ids: every row is a document of its own
  ties for an A id's highest count: every pair that reaches it counts
  empty table: no rows
  extra columns of the input are ignored
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import slices
from claimspark.session import materialize

#: Text of a block, the unit in which pairs are counted before they are shuffled.
SLICE_BYTES = 4_000_000
#: Id pairs of a block that are in one row.
PAIRS_ROW = 4_096
#: Links of words that are written out at a time, and pairs of texts' words.
CHUNK_LINKS = 100_000
CHUNK_PAIRS = 100_000
#: Characters of a text that are split into words at a time.
SEGMENT_CHARS = 500_000
#: Characters of distinct words that are aligned at a time: the encoders hold a few hundred bytes for each.
ALIGN_CHARS = 100_000

_CUT = re.compile(r"(?<=\S) (?=\S)")
_SIDES: dict = {}


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def words(text: str, size: int | None = None) -> Iterator[list[str]]:
    """Lists of the pieces of ``text`` between single spaces that have no white space
    beside them. Byte-level BPE starts a word at such a space, and a SentencePiece
    vocabulary with spaces only in front of its pieces (checked) a piece."""
    size, begin = size or SEGMENT_CHARS, 0
    while len(text) - begin > size and (cut := _CUT.search(text, begin + size)):
        yield _CUT.split(text[begin:cut.start()])
        begin = cut.end()
    yield _CUT.split(text[begin:])


def runs(names: Iterable[str]) -> Iterator[list[str]]:
    """Lists of ``ALIGN_CHARS`` characters, or one longer word by itself."""
    run, held = [], 0
    for name in names:
        if run and held + len(name) > ALIGN_CHARS:
            yield run
            run, held = [], 0
        run.append(name)
        held += len(name)
    if run:
        yield run


def byte_symbols() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable
    Latin-1 for itself, the others in order from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class SideBytes:
    """Side A, a byte-level BPE of the ``tokenizers`` library.

    Where its merges are in the order of their ids and it splits words as usual,
    the same vocabulary as ranks gives the same ids faster; otherwise the
    library encodes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        spec, symbols = json.loads(self.library.to_str()), byte_symbols()
        special = {t["content"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in self.library.get_vocab().items() if t not in special}
        self.tokens = [b""] * (max(self.library.get_vocab().values()) + 1)
        for token, i in vocab.items():
            self.tokens[i] = bytes(map(symbols.__getitem__, token))
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.ranks = self._as_ranks(spec, vocab)

    def _as_ranks(self, spec: dict, vocab: dict):
        model, words = spec["model"], spec["pre_tokenizer"] or {}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model.get("merges", [])]
        usual = (model["type"] == "BPE" and spec["normalizer"] is None and words.get("type") == "ByteLevel" and words["use_regex"]
                 and not words["add_prefix_space"] and not any(model.get(k) for k in ("ignore_merges", "dropout", "unk_token"))
                 and merged == sorted(set(merged)) and len(merged) + 256 == len(vocab))
        if not usual:
            return None
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={t: i for i, t in enumerate(self.tokens) if t})

    @property
    def by_word(self) -> bool:
        return self.ranks is not None

    def encode(self, text: str) -> np.ndarray:
        if self.ranks is None:
            return np.array(self.library.encode(" " + text, add_special_tokens=False).ids, np.int64)
        return self.ranks.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)


class SidePieces:
    """Side B, a SentencePiece model, which puts the space in front itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.tokens = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode()
                       for i, p in enumerate(pieces)]
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        # a space inside or at the end of a piece would let it reach over a cut
        self.by_word = not any(b" " in t.lstrip(b" ") for t in self.tokens)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text), np.int64)


def _sides(paths: tuple[str, str]) -> tuple[SideBytes, SidePieces]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if paths not in _SIDES:
        _SIDES[paths] = (SideBytes(paths[0]), SidePieces(paths[1]))
    return _SIDES[paths]


@cache
def _names(most: int) -> list[str]:
    """Ids below ``most`` with the mark that follows them: inside a side, after A, after B."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(most)]


class Aligned:
    """Tokens and groups of texts, each in a byte range of its own, one after the other.

    ``a``, ``b``: ids in order; ``group_a``, ``group_b``: the group of each token; for
    each group its text ``doc``, its ``sizes_a``, ``sizes_b`` and its first A and B
    token, with one more at the end (``first_a``, ``first_b``). ``whole``: whether
    both sides give the text back; one that is not whole has no tokens."""

    def __init__(self, texts: list[str], paths: tuple[str, str]):
        sides = _sides(paths)
        self.n, self.most = len(texts), max(len(side.tokens) for side in sides)
        want = [(" " + t).encode() for t in texts]
        self.whole = np.ones(self.n, bool)
        ids = self._together(texts, b"".join(want), sides)
        if ids is None:
            each = [[side.encode(t) for t in texts] for side in sides]
            for side, of in zip(sides, each, strict=True):
                back = (b"".join(map(side.tokens.__getitem__, x.tolist())) for x in of)
                self.whole &= np.fromiter((x == w for x, w in zip(back, want, strict=True)), bool, self.n)
            ids = [np.concatenate([np.zeros(0, np.int64), *[x for x, ok in zip(of, self.whole, strict=True) if ok]]) for of in each]
        there = np.flatnonzero(self.whole)
        base = np.cumsum([0, *[len(want[i]) for i in there]])
        spans = []
        for side, of in zip(sides, ids, strict=True):
            lengths = side.lengths[of]
            end = np.cumsum(lengths)
            spans.append((end - lengths, end))
        (self.a, self.b), ((start_a, end_a), (start_b, end_b)) = ids, spans
        start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
        order = np.lexsort((end, start))
        reach = np.maximum.accumulate(end[order])
        fresh = np.ones(len(order), bool)
        fresh[1:] = start[order][1:] >= reach[:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(fresh) - 1
        self.group_a, self.group_b = group[:len(self.a)], group[len(self.a):]
        groups = np.arange(int(fresh.sum()) + 1)
        self.first_a, self.first_b = np.searchsorted(self.group_a, groups), np.searchsorted(self.group_b, groups)
        self.doc = there[np.searchsorted(base, start_a[self.first_a[:-1]], "right") - 1] if len(there) else groups[:0]
        self.sizes_a, self.sizes_b = np.diff(self.first_a), np.diff(self.first_b)

    def _together(self, texts: list[str], want: bytes, sides) -> list[np.ndarray] | None:
        """Ids of all texts at once where cuts between them are none to either side."""
        clean = not any(t[:1].isspace() or t[-1:].isspace() for t in texts)
        if not texts or not clean or not all(side.by_word for side in sides):
            return None
        ids = [side.encode(" ".join(texts)) for side in sides]
        back = [b"".join(map(side.tokens.__getitem__, x.tolist())) for side, x in zip(sides, ids, strict=True)]
        return ids if back[0] == back[1] == want else None

    def per_text(self, weights: np.ndarray | None = None) -> np.ndarray:
        """How many groups each text has, or the sum of their ``weights``."""
        out = np.zeros(self.n, np.int64)
        np.add.at(out, self.doc, 1 if weights is None else weights)
        return out

    def written(self) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        a, b = self.group_a, self.group_b
        last_a, last_b = np.ones(len(a), bool), np.ones(len(b), bool)
        last_a[:-1], last_b[:-1] = a[1:] != a[:-1], b[1:] != b[:-1]
        most, name = self.most, _names(self.most)
        places = np.empty(len(a) + len(b), np.int64)
        places[np.arange(len(a)) + self.first_b[a]] = self.a + most * last_a
        places[np.arange(len(b)) + self.first_a[b + 1]] = self.b + 2 * most * last_b
        ids = list(map(name.__getitem__, places.tolist()))
        ends = [0, *np.cumsum(self.per_text(self.sizes_a + self.sizes_b)).tolist()]
        return ["".join(ids[i:j])[:-1] for i, j in pairwise(ends)]

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, A id * width + B id, links) of each id pair of each text, in order."""
        keys, counts = [], []
        links = self.sizes_a * self.sizes_b
        radix = (int(self.a.max(initial=0)) + 1) * width
        begin = 0
        bounds = np.cumsum(links)
        while begin < len(links):
            done = bounds[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(bounds, done + CHUNK_LINKS, "right")))
            if links[begin] > CHUNK_LINKS:  # one large group: its distinct ids and how often each comes
                stop = begin + 1
                a, n_a = np.unique(self.a[self.first_a[begin]:self.first_a[stop]], return_counts=True)
                b, n_b = np.unique(self.b[self.first_b[begin]:self.first_b[stop]], return_counts=True)
                keys.append(self.doc[begin] * radix + (a[:, None] * width + b).ravel())
                counts.append((n_a[:, None] * n_b).ravel())
            else:
                of = np.repeat(np.arange(begin, stop), links[begin:stop])
                nth = np.arange(len(of)) - np.repeat(bounds[begin:stop] - links[begin:stop] - done, links[begin:stop])
                a = self.a[self.first_a[of] + nth // self.sizes_b[of]]
                b = self.b[self.first_b[of] + nth % self.sizes_b[of]]
                key, n = np.unique(self.doc[of] * radix + a * width + b, return_counts=True)
                keys.append(key)
                counts.append(n)
            begin = stop
        if not keys:
            return (np.zeros(0, np.int64),) * 3
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, back, np.concatenate(counts))
        return key // radix, key % radix, total


class Block:
    """Figures of a block of texts, from its distinct words' alignment.

    ``word``: the words of all texts in order, as numbers of ``found``'s texts;
    ``bounds``: where each text's words begin, and the end."""

    def __init__(self, texts: list[str | None], paths: tuple[str, str]):
        by_word = all(side.by_word for side in _sides(paths))
        numbers: dict[str, int] = {}
        edges, parts, bounds = set(), [np.zeros(0, np.int32)], [0]
        for text in texts:
            n = bounds[-1]
            for some in (words(text) if by_word else [[text]]) if text else ():
                for w in dict.fromkeys(some):
                    if w not in numbers:
                        numbers[w] = len(numbers)
                parts.append(np.fromiter(map(numbers.__getitem__, some), np.int32, len(some)))
                n += len(some)
                edges.update(w for w in (some[0], some[-1]) if w[:1].isspace() or w[-1:].isspace())
            bounds.append(n)
        # words with white space at an end are apart, so that the others can be encoded together
        names = [*runs(w for w in numbers if w not in edges), *runs(edges)]
        place = np.empty(len(numbers), np.int32)
        place[np.fromiter((numbers[w] for some in names for w in some), np.int64, len(numbers))] = np.arange(len(numbers))
        del numbers
        self.found = [Aligned(some, paths) for some in names or [[]]]
        #: The first word of each of ``found``, and the end.
        self.first = np.cumsum([0, *[f.n for f in self.found]])
        self.word, self.bounds = place[np.concatenate(parts)], np.array(bounds)
        whole = np.concatenate([f.whole for f in self.found])
        bad = np.zeros(len(texts), bool)
        bad[np.searchsorted(self.bounds, np.flatnonzero(~whole[self.word]), "right") - 1] = True
        # a text with a word that does not come back has no tokens
        keep = ~np.repeat(bad, np.diff(self.bounds))
        self.bounds = np.concatenate([[0], np.cumsum(np.diff(self.bounds) * ~bad)])
        self.word = self.word[keep]

    def sums(self, of) -> np.ndarray:
        """A figure of each text: the sum of ``of(found)`` over its words."""
        total = np.concatenate([[0], np.cumsum(np.concatenate([of(f) for f in self.found])[self.word])])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def digests(self) -> list[str]:
        """The hash of each text's groups, as ``a1,a2|b1;a3|b2,b3``; '' without any."""
        names = [w for f in self.found for w in f.written()]
        out = []
        for i, j in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True):
            digest = hashlib.sha256()
            for k in range(i, j, SEGMENT_CHARS):
                part = ";".join(map(names.__getitem__, self.word[k:min(j, k + SEGMENT_CHARS)].tolist()))
                digest.update((part if k == i else ";" + part).encode())
            out.append(digest.hexdigest() if j > i else "")
        return out

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, A id * width + B id, links) of each id pair of each text, in order."""
        each = [f.pairs(width) for f in self.found]
        of = np.concatenate([x[0] + i for x, i in zip(each, self.first, strict=False)])
        pair, links = (np.concatenate([x[k] for x in each]) for k in (1, 2))
        del each
        n_words = int(self.first[-1])
        begin = np.searchsorted(of, np.arange(n_words + 1))
        radix, out = int(pair.max(initial=0)) + 1, [(np.zeros(0, np.int64),) * 3]
        # as many texts at a time as write out so many pairs, one at least
        held = np.concatenate([[0], np.cumsum(np.diff(begin)[self.word])])[self.bounds]
        i = 0
        while i < len(held) - 1:
            j = max(i + 1, int(np.searchsorted(held, held[i] + CHUNK_PAIRS, "right")) - 1)
            docs = np.repeat(np.arange(i, j), np.diff(self.bounds[i:j + 1]))
            key, times = np.unique(docs * max(n_words, 1) + self.word[self.bounds[i]:self.bounds[j]], return_counts=True)
            doc, word = key // max(n_words, 1), key % max(n_words, 1)
            size = begin[word + 1] - begin[word]
            at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - begin[word], size)
            key, back = np.unique(np.repeat(doc, size) * radix + pair[at], return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, back, links[at] * np.repeat(times, size))
            out.append((key // radix, key % radix, total))
            i = j
        return tuple(np.concatenate([x[k] for x in out]) for k in range(3))

    def groups(self, i: int) -> list[np.ndarray]:
        """A ids, A sizes, B ids and B sizes of the groups of text ``i``."""
        out = [[np.zeros(0, np.int64)] for _ in range(4)]
        for w in self.word[self.bounds[i]:self.bounds[i + 1]].tolist():
            k = int(np.searchsorted(self.first, w, "right")) - 1
            f = self.found[k]
            g, h = np.searchsorted(f.doc, [w - self.first[k], w - self.first[k] + 1])
            for held, values in zip(out, (f.a[f.first_a[g]:f.first_a[h]], f.sizes_a[g:h], f.b[f.first_b[g]:f.first_b[h]], f.sizes_b[g:h]),
                                    strict=True):
                held.append(values)
        return [np.concatenate(held) for held in out]


_GROUPS = "doc_id long, a_ids array<int>, a_sizes array<int>, b_ids array<int>, b_sizes array<int>"
_BLOCKS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pair_at array<int>, links array<int>, first int, pairs array<long>, holders array<int>")
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
_COUNTED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def alignment_groups(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """The alignment itself, one row a document: its A and B ids and how many of
    each every group has, in order. Local to a row, nothing is shuffled."""
    paths = tokenizers or default_tokenizers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            block = Block(part.column("text").to_pylist(), paths)
            for i, doc_id in enumerate(part.column("doc_id")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id.as_py()], pa.int64()), *[pa.array([v], pa.list_(pa.int32())) for v in block.groups(i)]],
                    names=["doc_id", "a_ids", "a_sizes", "b_ids", "b_sizes"])

    return _columns(docs).mapInArrow(run, _GROUPS)


def _width(paths: tuple[str, str]) -> int:
    return len(_sides(paths)[1].tokens)


def aligned_blocks(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """Rows of two kinds, none of which holds more than a text's or ``PAIRS_ROW`` pairs.
    One for each text: its figures and digest, and its pairs as places among its
    block's id pairs, with their links. And the block's id pairs with the number of
    its texts that hold each (``pairs``, ``holders``), from the place ``first`` on."""
    paths = tokenizers or default_tokenizers()
    names, types = zip(*((c.split()[0], _TYPES[c.split()[1]]) for c in _BLOCKS.split(", ")), strict=True)

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[c].cast(t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names=list(names))

    def lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values))

    def of_block(block: pa.Scalar, part: pa.RecordBatch) -> list[pa.RecordBatch]:
        n, found = part.num_rows, Block(part.column("text").to_pylist(), paths)
        sums = {"n_a": lambda f: f.per_text(f.sizes_a), "n_b": lambda f: f.per_text(f.sizes_b), "n_groups": lambda f: f.per_text(),
                "n_links": lambda f: f.per_text(f.sizes_a * f.sizes_b)}
        figures = {c: pa.array(found.sums(of)) for c, of in sums.items()} | {"groups_sha256": pa.array(found.digests(), pa.string())}
        doc, pair, links = found.pairs(_width(paths))
        del found
        pairs, at, holders = np.unique(pair, return_inverse=True, return_counts=True)
        ends = np.cumsum(np.bincount(doc, minlength=n))
        first = np.arange(0, len(pairs), PAIRS_ROW)
        stop = np.minimum(first + PAIRS_ROW, len(pairs))
        return [rows(n, block=pa.repeat(block, n), doc_id=part.column("doc_id"), **figures, pair_at=lists(ends, at), links=lists(ends, links)),
                rows(len(first), block=pa.repeat(block, len(first)), first=pa.array(first), pairs=lists(stop, pairs), holders=lists(stop, holders))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nth, part in enumerate(slices(batches, "text", SLICE_BYTES)):
            # nothing of a block is held while the next is made
            yield from of_block(pa.scalar((TaskContext.get().partitionId() << 33) + nth, pa.int64()), part)

    return _columns(docs).mapInArrow(run, _BLOCKS)


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): the number of documents that hold each id pair, and
    whether no other pair of its A id is held by more."""
    counts = blocks.where("first IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "holders")).alias("p")) \
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("count"))
    counts = materialize(counts.withColumn("a", F.expr(f"pair div {width}")), "pair-counts")
    # one row for each id of the A vocabulary at most
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """Token, group and link figures of each document, its groups' digest, and its
    links weighed by the corpus-wide counts of their id pairs: ``n_best`` links whose
    count is the highest of their A id, ``count_sum`` over all links."""
    paths = tokenizers or default_tokenizers()
    blocks = materialize(aligned_blocks(docs, paths), "aligned-blocks")
    asked = blocks.where("first IS NOT NULL").select(F.col("block").alias("asks"), "first", F.posexplode("pairs").alias("nth", "pair")) \
        .select("asks", (F.col("first") + F.col("nth")).alias("at"), "pair")
    told = asked.join(pair_counts(blocks, _width(paths)), "pair").select("asks", "at", "count", "best")

    def weigh(told: pa.Table, texts: pa.Table) -> pa.Table:
        count, best = (np.zeros(told.num_rows, np.int64) for _ in range(2))
        at = told.column("at").to_numpy()
        count[at], best[at] = told.column("count").to_numpy(), told.column("best").to_numpy(zero_copy_only=False)
        found = {"n_best": [], "count_sum": []}
        for batch in texts.to_batches():
            pair_at, links = (batch.column(c).flatten().to_numpy() for c in ("pair_at", "links"))
            of = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("pair_at")).to_numpy())
            for c, values in (("n_best", best), ("count_sum", count)):
                out = np.zeros(batch.num_rows, np.int64)
                np.add.at(out, of, links * values[pair_at])
                found[c].append(pa.array(out))
        names = [c.split()[0] for c in _COUNTED.split(", ")]
        return pa.table([pa.chunked_array(found[c], pa.int64()) if c in found else texts.column(c) for c in names], names=names)

    figures = blocks.where("first IS NULL").drop("first", "pairs", "holders")
    return told.groupBy("asks").cogroup(figures.groupBy("block")).applyInArrow(weigh, _COUNTED)
