"""Operator 5: personal data by rules and a character BiLSTM with a CRF.

Rules find emails, IP addresses, card and phone numbers in whole texts. A
character-level bidirectional LSTM with CRF transitions, trained in numpy on
windows whose spans the rules labelled and on variants of these (a spaced or
bracketed at sign, phone numbers without the country part, spaced or bracketed
dots of IPs, other signs in card numbers), adds what the rules' grammar misses.
Every span has a digit, an at sign or the word "at" in or beside it, so
characters far from all of these need no decoding. Stretches
around them are cut into overlapping windows; the windows' emissions are
blended by the distance to the window's ends, and one Viterbi pass over the
whole stretch reconciles them. An added span must be sure (mean marginal),
must be of its kind's digits, and must not overlap a rule's span or a match
that its own kind's rule has rejected in spite of digits enough (such as a
card-long number that fails Luhn).

Defined results
  null or empty text: no spans
  very long text: a slice by itself, searched whole; its stretches are decoded in overlapping windows
  no text with a digit or at sign to learn from: rules only
  repeated rows: each by itself, alike; empty table: no rows
  extra columns of the input stay in ``row``; no name can clash with them
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.llm.common import slices

KINDS = ["email", "ip", "card", "phone"]
#: The base rules' patterns.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_EMAIL_HEAD = re.compile(r"[A-Za-z0-9._%+-]+")
_TRIGGER = re.compile(r"[0-9@]")
#: What an added span has in or beside it: the above, or an at sign written as a word.
_NEAR = re.compile(r"[0-9@]|(?<![A-Za-z0-9])[Aa][Tt](?![A-Za-z0-9])")

#: Windows that the tagger is trained on, chosen by a hash of the text.
TRAIN_WINDOWS = 2_000
WINDOW, STRIDE, BEFORE, AFTER = 96, 48, 24, 32
SURE = 0.9
#: Digits that a match has at least before a rule's refusal of it counts.
LEAST_DIGITS = {"email": 0, "ip": 4, "card": 13, "phone": 9}


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind: str, text: str) -> bool:
    """What a match of the kind's pattern must fulfil."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(_at_most_255(p) for p in text.split("."))
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def base_spans(text: str | None) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """(accepted, rejected) matches of each kind's pattern, leftmost first."""
    accepted: dict[str, list] = {k: [] for k in KINDS}
    rejected: dict[str, list] = {k: [] for k in KINDS}
    if not text or not _TRIGGER.search(text):
        return accepted, rejected
    for kind, pattern in PATTERNS.items():
        if kind == "email" and "@" not in text or kind == "phone" and "+" not in text:
            continue
        matches = _emails(text) if kind == "email" else pattern.finditer(text)
        for m in matches:
            (accepted if valid(kind, m.group()) else rejected)[kind].append(m.span())
    return accepted, rejected


def _emails(text: str) -> Iterator[re.Match]:
    """The pattern's leftmost matches, tried only in runs that an @ ends."""
    at, head = 0, PATTERNS["email"]
    while (sign := text.find("@", at)) >= 0:
        begin = sign
        while begin > at and _EMAIL_HEAD.fullmatch(text, begin - 1, begin):
            begin -= 1
        m = head.match(text, begin) if begin < sign else None
        if m:
            yield m
        at = m.end() if m else sign + 1


# ---- the tagger ----------------------------------------------------------------
TAGS = 1 + 2 * len(KINDS)  # outside; first and inner characters of each kind
CHARS, EMBED, HIDDEN = 100, 12, 16
_CODES = np.full(128, 98)
_CODES[32:127] = np.arange(1, 96)
_CODES[[9, 10, 13]] = 96


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CODES[np.minimum(points, 127)], 97)


def allowed() -> np.ndarray:
    """Which tag may follow which: an inner one only its own kind."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inner = 2 * k + 2
        out[:, inner] = -1e4
        out[[inner - 1, inner], inner] = 0
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _logsum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Parameters by name; ``b`` after a name: of the backward direction."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = 0) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {"embed": rng.normal(0, 0.3, (CHARS, EMBED)), "out": rng.normal(0, 0.2, (2 * HIDDEN, TAGS)), "bias": np.zeros(TAGS),
             "trans": np.zeros((TAGS, TAGS))}
        for d in ("", "b"):
            p["w" + d] = rng.normal(0, 0.25, (EMBED + HIDDEN, 4 * HIDDEN))
            p["c" + d] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states (length, batch, HIDDEN) of one direction over x (length, batch)."""
        e, h = self.p["embed"][x], np.zeros((x.shape[1], HIDDEN), np.float32)
        c, out = h, np.empty((*x.shape, HIDDEN), np.float32)
        we = e @ self.p["w" + d][:EMBED] + self.p["c" + d]
        for t in range(len(x)):
            z = we[t] + h @ self.p["w" + d][EMBED:]
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            before = c
            c = f * c + i * g
            tc = np.tanh(c)
            if keep is not None:
                keep.append((h, before, i, f, o, g, tc))
            h = o * tc
            out[t] = h
        return out

    def emissions(self, x: np.ndarray, keep: tuple | None = None) -> np.ndarray:
        """(length, batch, TAGS)"""
        ahead = self._run(x, "", keep and keep[0])
        back = self._run(x[::-1], "b", keep and keep[1])[::-1]
        both = np.concatenate([ahead, back], axis=2)
        if keep:
            keep[2].append(both)
        return both @ self.p["out"] + self.p["bias"]

    def step(self, x: np.ndarray, y: np.ndarray, live: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of a batch (length, batch); ``live``: real characters."""
        keep = ([], [], [])
        em = self.emissions(x, keep)
        trans = self.p["trans"] + allowed()
        n = x.shape[1]
        own, pair, total = marginals(em, trans, live)
        gold = np.zeros_like(em)
        np.put_along_axis(gold, y[:, :, None], 1, axis=2)
        gold *= live[:, :, None]
        steps = live[1:]
        score = (em * gold).sum() + (trans[y[:-1], y[1:]] * steps).sum()
        loss = float(total.sum() - score) / n
        g_em = (own * live[:, :, None] - gold) / n
        g_trans = pair.copy()
        np.add.at(g_trans, (y[:-1][steps], y[1:][steps]), -1)
        both = keep[2][0]
        grad = {"trans": g_trans / n, "bias": g_em.sum((0, 1)), "out": np.einsum("tbh,tbk->hk", both, g_em)}
        g_both = g_em @ self.p["out"].T
        grad["embed"] = np.zeros_like(self.p["embed"])
        for d, xs, gs, kept in (("", x, g_both[:, :, :HIDDEN], keep[0]), ("b", x[::-1], g_both[::-1, :, HIDDEN:], keep[1])):
            w = self.p["w" + d]
            gh, gc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            gz_all = np.empty((len(x), n, 4 * HIDDEN))
            hs = np.empty((len(x), n, HIDDEN))
            for t in range(len(x) - 1, -1, -1):
                h, before, i, f, o, g, tc = kept[t]
                gh = gh + gs[t]
                gc = gc + gh * o * (1 - tc * tc)
                gz = np.concatenate([gc * g * i * (1 - i), gc * before * f * (1 - f), gh * tc * o * (1 - o), gc * i * (1 - g * g)], 1)
                gz_all[t], hs[t] = gz, h
                gh, gc = gz @ w[EMBED:].T, gc * f
            e = self.p["embed"][xs]
            grad["w" + d] = np.concatenate([np.einsum("tbe,tbz->ez", e, gz_all), np.einsum("tbh,tbz->hz", hs, gz_all)])
            grad["c" + d] = gz_all.sum((0, 1))
            np.add.at(grad["embed"], xs, gz_all @ w[:EMBED].T)
        return loss, grad


def marginals(em: np.ndarray, trans: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tag marginals (length, batch, TAGS), summed pair marginals, log-sums."""
    length, n, k = em.shape
    ahead, back = np.empty((length, n, k)), np.zeros((length, n, k))
    ahead[0] = em[0]
    for t in range(1, length):
        new = em[t] + _logsum(ahead[t - 1][:, :, None] + trans[None], 1)
        ahead[t] = np.where(live[t][:, None], new, ahead[t - 1])
    for t in range(length - 2, -1, -1):
        new = _logsum(trans[None] + (em[t + 1] + back[t + 1])[:, None, :], 2)
        back[t] = np.where(live[t + 1][:, None], new, back[t + 1])
    total = _logsum(ahead[-1], 1)
    pair = np.zeros((k, k))
    for t in range(1, length):
        x = np.exp(ahead[t - 1][:, :, None] + trans[None] + (em[t] + back[t])[:, None, :] - total[:, None, None])
        pair += x[live[t]].sum(0)
    return np.exp(ahead + back - total[None, :, None]), pair, total


def viterbi(em: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags of one stretch (length, TAGS)."""
    length = len(em)
    came = np.empty((length, em.shape[1]), np.int64)
    score = em[0]
    for t in range(1, length):
        step = score[:, None] + trans
        came[t] = step.argmax(0)
        score = step.max(0) + em[t]
    tags = np.empty(length, np.int64)
    tags[-1] = score.argmax()
    for t in range(length - 1, 0, -1):
        tags[t - 1] = came[t, tags[t]]
    return tags


def viterbi_all(parts: list[np.ndarray], trans: np.ndarray, cells: int = 65_536) -> list[np.ndarray]:
    """``viterbi`` of many stretches, those of like length side by side."""
    out: list = [np.zeros(0, np.int64)] * len(parts)
    order = sorted((i for i in range(len(parts)) if len(parts[i])), key=lambda i: -len(parts[i]))
    while order:
        n = max(1, cells // len(parts[order[0]]))
        own, order = order[:n], order[n:]
        if len(own) == 1:
            out[own[0]] = viterbi(parts[own[0]], trans)
            continue
        ends = np.array([len(parts[i]) for i in own])  # falling
        came = np.zeros((ends[0], len(own), trans.shape[0]), np.int8)
        score, rows = np.array([parts[i][0] for i in own]), np.arange(len(own))
        em = np.zeros((ends[0], len(own), trans.shape[0]))
        for j, i in enumerate(own):
            em[:ends[j], j] = parts[i]
        for t in range(1, ends[0]):
            live = int(np.searchsorted(-ends, -t))  # stretches longer than t come first
            step = score[:live, :, None] + trans
            came[t, :live] = step.argmax(1)
            score[:live] = step.max(1) + em[t, :live]
        tags = np.zeros((ends[0], len(own)), np.int64)
        tags[ends - 1, rows] = score.argmax(1)
        for t in range(ends[0] - 1, 0, -1):
            live = int(np.searchsorted(-ends, -t))
            tags[t - 1, :live] = came[t, rows[:live], tags[t, :live]]
        for j, i in enumerate(own):
            out[i] = tags[:ends[j], j]
    return out


def tags_of(spans: dict[str, list[tuple[int, int]]], begin: int, end: int) -> np.ndarray:
    out = np.zeros(end - begin, np.int64)
    for k, kind in enumerate(KINDS):
        for a, b in spans[kind]:
            if a >= begin and b <= end:
                out[a - begin:b - begin] = 2 * k + 2
                out[a - begin] = 2 * k + 1
    return out


def spans_of(tags: np.ndarray) -> list[tuple[str, int, int]]:
    out, t = [], 0
    while t < len(tags):
        if tags[t]:
            k, a = (tags[t] - 1) // 2, t
            t += 1
            while t < len(tags) and tags[t] == 2 * k + 2:
                t += 1
            out.append((KINDS[k], a, t))
        else:
            t += 1
    return out


def stretches(text: str, trigger: re.Pattern = _NEAR) -> list[tuple[int, int]]:
    """The parts of a text that lie near a digit or an at sign, also one in letters."""
    out: list[list[int]] = []
    for m in trigger.finditer(text):
        a, b = max(0, m.start() - BEFORE), min(len(text), m.end() + AFTER)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def variant(text: str, spans: dict[str, list[tuple[int, int]]], rng: random.Random) -> tuple[str, dict[str, list[tuple[int, int]]]]:
    """A window with its spans written another way, and where they are now."""
    found = sorted((a, b, kind) for kind in KINDS for a, b in spans[kind])
    out, new, at = "", {k: [] for k in KINDS}, 0
    for a, b, kind in found:
        if a < at:
            continue
        body = text[a:b]
        if kind == "email":
            body = body.replace("@", rng.choice([" @ ", "(at)", " [at] ", " at ", "@"]), 1)
        elif kind == "phone":
            body = rng.choice([body.partition(" ")[2] or body, re.sub(r"[ ()]+", "-", body).strip("-+"), body])
        elif kind == "ip":
            body = body.replace(".", rng.choice([" . ", "[.]", "."]))
        else:
            sign, digits = rng.choice([".", " - ", ""]), _digits(body)
            body = sign.join(digits[i:i + 4] for i in range(0, len(digits), 4)) if sign else body
        out += text[at:a]
        new[kind].append((len(out), len(out) + len(body)))
        out += body
        at = b
    return out + text[at:], new


def train(windows: list[str], seed: int = 0, epochs: int = 8, batch: int = 64, rate: float = 0.02) -> Tagger | None:
    """A tagger from texts of at most ``WINDOW`` characters, labelled by the rules."""
    rng = random.Random(seed)
    rows = []
    for w in windows:
        spans, _ = base_spans(w)
        rows.append((w, spans))
        if any(spans.values()):
            text, new = variant(w, spans, rng)
            rows.append((text[:WINDOW], {k: [s for s in v if s[1] <= WINDOW] for k, v in new.items()}))
    if not any(s[k] for _, s in rows for k in KINDS):
        return None
    x = np.zeros((WINDOW, len(rows)), np.int64)
    y = np.zeros((WINDOW, len(rows)), np.int64)
    live = np.zeros((WINDOW, len(rows)), bool)
    for i, (w, spans) in enumerate(rows):
        x[:len(w), i], y[:len(w), i], live[:len(w), i] = codes(w), tags_of(spans, 0, len(w)), True
    tagger = Tagger.new(seed)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(a) for k, a in tagger.p.items()}
    order, t = np.arange(len(rows)), 0
    shuffle = np.random.default_rng(seed)
    for epoch in range(epochs):
        shuffle.shuffle(order)
        for at in range(0, len(order), batch):
            own, t = order[at:at + batch], t + 1
            _, grad = tagger.step(x[:, own], y[:, own], live[:, own])
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / (size + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                step = rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
                tagger.p[k] = (tagger.p[k] - step).astype(np.float32)
    return tagger


def tag_stretches(tagger: Tagger, parts: list[str], batch: int = 1024) -> list[list[tuple[str, int, int, float]]]:
    """(kind, start, end, mean marginal) in each part; its overlapping windows'
    emissions are blended before one pass over the whole part."""
    places = [(i, a) for i, p in enumerate(parts) for a in range(0, max(1, len(p) - WINDOW + STRIDE), STRIDE)]
    coded = [codes(p) for p in parts]
    em = [np.zeros((len(p), TAGS)) for p in parts]
    mass = [np.zeros(len(p)) for p in parts]
    ramp = np.minimum(np.arange(WINDOW) + 1, np.arange(WINDOW, 0, -1)).astype(float)
    for at in range(0, len(places), batch):
        own = places[at:at + batch]
        x = np.zeros((WINDOW, len(own)), np.int64)
        for j, (i, a) in enumerate(own):
            c = coded[i][a:a + WINDOW]
            x[:len(c), j] = c
        e = tagger.emissions(x)
        for j, (i, a) in enumerate(own):
            n = min(WINDOW, len(parts[i]) - a)
            em[i][a:a + n] += e[:n, j] * ramp[:n, None]
            mass[i][a:a + n] += ramp[:n]
    trans = tagger.p["trans"] + allowed()
    em = [e / w[:, None] for e, w in zip(em, mass, strict=True)]
    out = []
    for p, e, tags in zip(parts, em, viterbi_all(em, trans), strict=True):
        found = []
        if len(p):
            spans = spans_of(tags)
            if spans:
                own = marginals(e[:, None], trans, np.ones((len(p), 1), bool))[0][:, 0]
                for kind, a, b in spans:
                    k = KINDS.index(kind)
                    tags = np.array([2 * k + 1] + [2 * k + 2] * (b - a - 1))
                    found.append((kind, a, b, float(own[np.arange(a, b), tags].mean())))
        out.append(found)
    return out


def plausible(kind: str, text: str) -> bool:
    """What an added span must hold of its kind."""
    digits = _digits(text)
    if kind == "email":
        return bool(re.search(r"@|(?<![A-Za-z0-9])at(?![A-Za-z0-9])", text, re.IGNORECASE)) and "." in text and len(text) >= 6
    if kind == "ip":
        return len(parts := re.findall(r"[0-9]+", text)) == 4 and all(map(_at_most_255, parts))
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def refused(text: str, kind: str, rejected: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The rejected matches of a kind with digits enough for it: these are no such
    data. Shorter ones are parts of anything, as the groups of a phone number."""
    return [(a, b) for a, b in rejected if len(_digits(text[a:b])) >= LEAST_DIGITS[kind]]


def find(texts: list[str | None], tagger: Tagger | None) -> list[tuple[dict, list[tuple[str, int, int, float]]]]:
    """(rules' spans by kind, added spans with their marginals) of each text."""
    base = [base_spans(t) for t in texts]
    owners, parts = [], []
    for i, t in enumerate(texts):
        if t and tagger:
            for a, b in stretches(t):
                owners.append((i, a))
                parts.append(t[a:b])
    added: list[list] = [[] for _ in texts]
    for (i, at), found in zip(owners, tag_stretches(tagger, parts) if parts else [], strict=True):
        accepted, rejected = base[i]
        taken = {k: [s for spans in accepted.values() for s in spans] + refused(texts[i], k, rejected[k]) for k in KINDS}
        for kind, a, b, sure in found:
            a, b = a + at, b + at
            if sure >= SURE and plausible(kind, texts[i][a:b]) and not any(a < y and x < b for x, y in taken[kind]):
                added[i].append((kind, a, b, sure))
    return [(accepted, more) for (accepted, _), more in zip(base, added, strict=True)]


def learn(docs: DataFrame, bound: int = TRAIN_WINDOWS) -> Tagger | None:
    """A tagger from at most ``bound`` windows around digits and at signs of
    ``docs`` (text), those with the smallest hashes."""
    rows = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            cut = [t[a:min(b, a + WINDOW)] for t in part.column("text").to_pylist() for a, b in stretches(t, _TRIGGER)]
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.string())], names=["window"])

    got = rows.mapInArrow(run, "window string").orderBy(F.xxhash64("window"), "window").limit(bound).toPandas()
    return train(list(got.window))


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                      T.StructField("sure", T.DoubleType())])


def find_personal_data(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``row`` (all columns of ``docs``), ``base`` and ``added`` spans (kind,
    start, end in code points, sure), by kind and then start."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # a few thousand numbers
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("sure", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = find(part.column("text").to_pylist(), shared.value)
            base = [[{"kind": k, "start": a, "end": b, "sure": 1.0} for k in KINDS for a, b in spans[k]] for spans, _ in found]
            more = [[{"kind": k, "start": a, "end": b, "sure": s} for k, a, b, s in
                     sorted(x, key=lambda y: (KINDS.index(y[0]), y[1]))] for _, x in found]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(base, kind), pa.array(more, kind)],
                                             names=["row", "base", "added"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("base", T.ArrayType(_SPAN)),
                                              T.StructField("added", T.ArrayType(_SPAN))]))
