import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from claimspark.llm import alignment as L

PATHS = L.default_tokenizers()
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
A_NAME = {i: t for t, i in A.get_vocab().items()}

TEXTS = [None, "", "Hello, World!!", "don't stop  now", "ÉTÉ İstanbul ß ǅ é x", "<|endoftext|> a<s></s><unk>", "日本 🙂 ok.",
         " lead and trail ", "tab\tnew\r\nline\x0b", "▁a", "a" * 3000, " " * 50, "\x00<0x41>", "word other " * 2000, "Hello, World!!"]


def bytes_of_a(i):
    return bytes(map(L.byte_symbols().__getitem__, A_NAME[i]))


def bytes_of_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def plain_groups(text):
    """Cut where a token of both sides ends, by sets of ends."""
    want = (" " + (text or "")).encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids if text else [], B.encode(text) if text else []
    if not text or b"".join(map(bytes_of_a, a)) != want or b"".join(map(bytes_of_b, b)) != want:
        return []
    ends_a, ends_b = (list(np.cumsum([len(f(i)) for i in ids])) for f, ids in ((bytes_of_a, a), (bytes_of_b, b)))
    cuts = sorted(set(ends_a) & set(ends_b))
    return [([i for i, e in zip(a, ends_a) if lo < e <= hi], [i for i, e in zip(b, ends_b) if lo < e <= hi])
            for lo, hi in zip([0, *cuts[:-1]], cuts)]


def brute(texts):
    groups = [plain_groups(t) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    held = Counter(p for one in links for p in one)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for i, (g, one) in enumerate(zip(groups, links)):
        name = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        yield (i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(one.values()),
               sum(n for p, n in one.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in one.items()),
               hashlib.sha256(name.encode()).hexdigest() if g else "")


@pytest.fixture(params=["usual", "small"])
def sizes(request, monkeypatch):
    """The usual block size, and one that makes a block of every text or two."""
    if request.param == "small":
        monkeypatch.setattr(L, "SLICE_BYTES", 40)


def test_figures_equal_brute_force(docs_of, sizes):
    rng = random.Random(4)
    letters = list("abcdehilnorstu") * 2 + list(" .,!'\n\t0é") + ["  ", "日", "\U0001f600"]
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(60)]
    got = L.align_documents(docs_of(enumerate(texts)).repartition(3), PATHS).collect()
    assert sorted(map(tuple, got)) == list(brute(texts))
    assert {r.n_a == 0 for r in got if texts[r.doc_id] in (None, "", "▁a")} == {True}


def test_groups_are_the_alignment(docs_of):
    for r in L.alignment_groups(docs_of(enumerate(TEXTS)), PATHS).collect():
        a, b = np.split(r.a_ids, np.cumsum(r.a_sizes)), np.split(r.b_ids, np.cumsum(r.b_sizes))
        assert [(list(x), list(y)) for x, y in zip(a, b)][:len(r.a_sizes)] == plain_groups(TEXTS[r.doc_id])


def test_repeated_rows_are_documents_of_their_own(docs_of):
    rows = [(1, "one two"), (1, "one two"), (None, "one two"), (2, None)]
    got = L.align_documents(docs_of(rows), PATHS).collect()
    assert len(got) == 4 and {r.count_sum for r in got if r.n_links} == {6}
    assert L.align_documents(docs_of([]).limit(0), PATHS).count() == 0


def test_ranks_equal_the_library_on_every_character():
    """The faster encoder against the file's own library, all code points in words and out."""
    side = L.SideBytes(PATHS[0])
    assert side.ranks is not None
    points = [c for c in range(0x11000) if not 0xD800 <= c < 0xE000] + list(range(0x1F300, 0x1FB00))
    texts = [f" x{chr(c)}1{chr(c)} {chr(c)}a  {chr(c)}{chr(c)}'s" for c in points]
    want = A.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
    assert all(side.encode(t).tolist() == w.ids for t, w in zip(texts, want, strict=True))


def test_words_change_no_token():
    """Every word by itself, and all of them at once, give the tokens of the whole text."""
    text = ("It's a long text, with  gaps and 42 numbers.\nIt goes\u00a0on \x1c " * 40).strip()
    for side in (L.SideBytes(PATHS[0]), L.SidePieces(PATHS[1])):
        assert side.by_word
        for size in (25, None):
            parts = [w for some in L.words(text, size) for w in some]
            assert " ".join(parts) == text and len(parts) > 200
            assert np.concatenate([side.encode(w) for w in parts]).tolist() == side.encode(text).tolist()


def test_other_tokenizers_get_whole_texts(docs_of, monkeypatch):
    """Where cuts between words are not known to be safe, the results are the same."""
    texts = [t for t in TEXTS if t and len(t) < 100]
    want = [x.tolist() for x in L.Block(texts, PATHS).pairs(32_000)], L.Block(texts, PATHS).digests()
    monkeypatch.setattr(L.SideBytes, "by_word", False)
    assert ([x.tolist() for x in L.Block(texts, PATHS).pairs(32_000)], L.Block(texts, PATHS).digests()) == want


def test_links_by_chunks_and_large_groups(monkeypatch):
    """Pairs of a text, written out at once, in chunks and as one large group, are the same."""
    texts = [t for t in TEXTS if t] + ["a\u0301" * 40 + "日本" * 30]
    whole = [x.tolist() for x in L.Aligned(texts, PATHS).pairs(32_000)]
    for most in (1, 2, 7):
        monkeypatch.setattr(L, "CHUNK_LINKS", most)
        assert [x.tolist() for x in L.Aligned(texts, PATHS).pairs(32_000)] == whole


def test_a_block_is_aligned_by_runs_of_words(monkeypatch):
    """The encoders get a run of a block's words at a time, texts' pairs are written out by runs of texts; the results are the same."""
    rng, longest = random.Random(7), []
    texts = [*TEXTS, *(" ".join(rng.choice(["one", "two", "x́", "日本", "\ttab", "long" * 9, str(i)]) for _ in range(50)) for i in range(20))]

    def figures():
        block = L.Block(texts, PATHS)
        groups = [[x.tolist() for x in block.groups(i)] for i in range(len(texts))]
        return [x.tolist() for x in block.pairs(32_000)], block.digests(), block.sums(lambda f: f.per_text()).tolist(), groups

    encode = L.SidePieces.encode
    monkeypatch.setattr(L.SidePieces, "encode", lambda side, text: longest.append(len(text)) or encode(side, text))
    want = figures()
    for most in (1, 60, 300):
        longest.clear()
        monkeypatch.setattr(L, "ALIGN_CHARS", most)
        monkeypatch.setattr(L, "CHUNK_PAIRS", most)
        assert figures() == want
        # and the spaces between them; one long word is by itself
        assert sorted(set(longest))[-1] == 3000 and max(n for n in longest if n < 3000) <= max(2 * most, 100)


def test_no_row_holds_a_whole_block(docs_of, monkeypatch):
    """What a block lands are rows of a text each, and of some of its id pairs, as many in all."""
    monkeypatch.setattr(L, "PAIRS_ROW", 5)
    texts = [t for t in TEXTS if t and len(t) < 100]
    rows = L.aligned_blocks(docs_of(enumerate(texts)).coalesce(1), PATHS).collect()
    some = sorted((r for r in rows if r["first"] is not None), key=lambda r: r["first"])
    assert len({r.block for r in rows}) == 1 and len(some) > 3 and {len(r.pairs) for r in some[:-1]} == {5}
    assert [r["first"] for r in some] == list(range(0, 5 * len(some), 5))
    doc, pair, links = L.Block(texts, PATHS).pairs(L._width(PATHS))
    pairs, holders = np.unique(pair, return_counts=True)
    assert [p for r in some for p in r.pairs] == pairs.tolist() and [n for r in some for n in r.holders] == holders.tolist()
    for r in rows:
        if r["first"] is None:
            assert pairs[r.pair_at].tolist() == pair[doc == r.doc_id].tolist() and r.links == links[doc == r.doc_id].tolist()
    assert sum(r["first"] is None for r in rows) == len(texts)


def test_figures_of_pairs_in_many_rows(docs_of, monkeypatch):
    monkeypatch.setattr(L, "PAIRS_ROW", 7)
    texts = [t for t in TEXTS if not t or len(t) < 3000]
    assert sorted(map(tuple, L.align_documents(docs_of(enumerate(texts)).repartition(2), PATHS).collect())) == list(brute(texts))
