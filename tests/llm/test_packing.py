import collections
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from claimspark.llm import packing as P

TEXTS = [None, "", "Hello, World!!", "don't stop", "ÉTÉ İstanbul ß ǅ e\u0301 x", "<|endoftext|> a<|startoftext|>b", "a\x1fb\u00a0c",
         "日本 🙂 ok.", "x" * 300 + "...", "tab\tnew\r\nline\x0b", "42 a1b2!,", "ˣ².", "word " * 9000, "'S 'll we'LL."]


TOKENIZER = Tokenizer.from_file(P.default_tokenizer())


def ids_of(text):
    return [*(TOKENIZER.encode(text, add_special_tokens=False).ids if text else []), 1]


def test_chunked_ids_equal_the_tokenizers():
    rng = random.Random(3)
    alphabet = ["a", "B", "'", "s", "é", "e\u0301", " ", "\n", "\x1c", "\u2003", ".", "!", "7", "ß", "Σ", "ς", "|", "#", "İ", "ª"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(400)]
    encoder = P.ChunkEncoder(P.default_tokenizer())
    got = [list(np.frombuffer(b, "<u4")) + [1] for b in encoder.encode(texts)]
    assert got == [ids_of(t) for t in texts]


def test_cache_limit_changes_nothing(monkeypatch):
    texts = [" ".join(f"w{i}x{j}" for j in range(9)) for i in range(40)]
    want = P.ChunkEncoder(P.default_tokenizer()).encode(texts)
    monkeypatch.setattr(P, "CACHE_CHUNKS", 20)
    encoder = P.ChunkEncoder(P.default_tokenizer())
    assert [encoder.encode([t])[0] for t in texts] == want == encoder.encode(texts)


def check(rows, capacity, originals):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    for doc_id, ids in originals.items():
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [p.start for p in pieces] == list(range(0, len(ids), capacity))
        for k, p in enumerate(pieces):
            part = np.array(ids[k * capacity:(k + 1) * capacity], "<u4").tobytes()
            assert (p.piece, p.length, p.ids_crc32) == (k, len(part) // 4, zlib.crc32(part))
    return len(by_sequence)


def test_documents_round_trip(spark, docs_of):
    docs = docs_of(list(enumerate(TEXTS)))
    packed = P.pack_documents(docs, capacity=128, with_ids=True).cache()
    originals = {i: ids_of(t) for i, t in enumerate(TEXTS)}
    n = check(packed.collect(), 128, originals)
    assert n <= -(-sum(map(len, originals.values())) // 128) + 1
    whole = collections.defaultdict(dict)
    for s in P.sequences(packed).collect():
        ids = np.frombuffer(bytes(s.ids), "<u4")
        for d, a, b in zip(s.doc_ids, s.offsets, [*s.offsets[1:], len(ids)], strict=True):
            whole[d].setdefault("n", 0)
            whole[d]["n"] += b - a
    assert {d: w["n"] for d, w in whole.items()} == {i: len(x) for i, x in originals.items()}


def test_equal_and_null_ids_and_empty_table(spark, docs_of):
    rows = P.pack_documents(docs_of([(None, "a b"), (None, "a b"), (1, "c"), (1, "c"), (1, "d")])).collect()
    assert len(rows) == 5 and sorted(r.offset for r in rows)[0] == 0
    assert P.pack_documents(docs_of([])).count() == 0


def test_bounded_bins_close_the_fullest():
    bins = P.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 5)] == [(0, 0), (1, 0), (2, 0)]  # the third opens: bin 1 (7 used) closes
    assert bins.place(3) == (0, 6) and bins.place(5) == (2, 5) and bins.place(1) == (0, 9) and bins.open == 0


def test_packer_against_naive_best_fit():
    rng = random.Random(5)
    bins, free = P.OpenBins(64, 10**9), []
    for _ in range(800):
        n = rng.randint(1, 64)
        fit = [f for f in free if f >= n]
        _, offset = bins.place(n)
        if fit:
            best = min(fit)
            free.remove(best)
            assert offset == 64 - best
        else:
            best = 64
            assert offset == 0
        if best > n:
            free.append(best - n)
    assert bins.open == len(free)
