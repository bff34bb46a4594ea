"""Operator 8: toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is the logistic of
a bias and the sum of its words' weights; the document's is the noisy-or of
its sentences, 1 - prod(1 - p). Only document labels are known: the gradient
of the bag likelihood shares each label among the sentences. A word's weight
is the sum of the weights of its features: the lower-cased word and its
first three, four and five letters, hashed into a table. The trained sentence
scores then say which sentences offend.

Weights are L1-shrunk (proximal gradient), so words without evidence weigh
nothing, and long clean documents don't add up to toxic ones.

Defined results
  null or empty text, or one without words: no sentence, score 0
  very long text: a slice by itself; every sentence of it is scored
  no usable labels, or labels of one class: all scores 0, nothing predicted
  null labels, and labels of unknown documents, are not learned from
  repeated rows: scored each by itself, alike; empty table: no rows
  extra columns of the input stay in ``row``; no name can clash with them
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.llm.common import slices

#: Most labelled documents of each class that the model is fitted on, chosen by a hash.
LABEL_BOUND = 2_000
FEATURE_BITS = 20
THRESHOLD = 0.7
CACHE_WORDS = 500_000

#: A sentence ends at . ! ? or a line break.
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_WORD = re.compile(r"[^\W_]+")
#: A sentence that has a word.
_FILLED = re.compile(r"[^\W_][^.!?\n]*")


def features(word: str) -> list[int]:
    """Hashed features of a lower-cased word."""
    mask = (1 << FEATURE_BITS) - 1
    return [xxhash.xxh64_intdigest(f"{n}:{word[:n]}".encode("utf-8", "surrogatepass")) & mask for n in (3, 4, 5) if len(word) > n] \
        + [xxhash.xxh64_intdigest(f"={word}".encode("utf-8", "surrogatepass")) & mask]


@dataclass
class SentenceModel:
    """weights: of features; bias: of a sentence without a weighty word."""

    weights: dict[int, float]
    bias: float

    def word_weight(self, word: str) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features(word))


def screen(doc: np.ndarray, column: np.ndarray, width: int, toxic: np.ndarray, least: float, most: int) -> np.ndarray:
    """The columns that more toxic documents hold than chance explains (by the
    two-proportion z score, ``least`` or more), at most ``most``."""
    pairs = np.unique(doc.astype(np.int64) * width + column)
    where = pairs % width
    yes = np.bincount(where, toxic[pairs // width], width)
    both = np.bincount(where, minlength=width)
    n1 = toxic.sum()
    n0 = len(toxic) - n1
    p = both / len(toxic)
    z = (yes / n1 - (both - yes) / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    z[both < 2] = 0  # what one document holds can't carry over to others
    kept = np.flatnonzero(z >= least)
    return kept[np.argsort(-z[kept], kind="stable")[:most]]


def fit(bag: np.ndarray, lengths: np.ndarray, flat: np.ndarray, toxic: np.ndarray, l1: float = 2e-5, rounds: int = 400,
        rate: float = 0.3, least_z: float = 3.0, most: int = 20_000) -> SentenceModel | None:
    """A model from sentences: the document each is of, its number of features,
    and their numbers in a row; ``toxic`` by document. Proximal ascent with
    adaptive steps on the noisy-or likelihood; both classes weigh alike."""
    toxic = np.asarray(toxic, float)
    n = len(toxic)
    if not 0 < toxic.sum() < n:
        return None
    names, column = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(lengths)), lengths)
    chosen = screen(bag[row], column, len(names), toxic, least_z, most)
    new = np.full(len(names), -1)
    new[chosen] = np.arange(len(chosen))
    column = new[column]
    row, column = row[column >= 0], column[column >= 0]
    d = len(chosen)
    share = np.where(toxic == 1, 0.5 / toxic.sum(), 0.5 / (n - toxic.sum()))
    w, bias = np.zeros(d), -4.0
    m, v, mb, vb = np.zeros(d), np.zeros(d), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.clip(np.bincount(row, w[column], len(lengths)) + bias, -30, 30)
        clean = np.minimum(np.bincount(bag, -np.logaddexp(0, z), n), -1e-12)  # log of the document's 1 - P
        # its gradient: -1 for clean documents; for toxic ones exp(clean) / (1 - exp(clean))
        pull = np.where(toxic == 1, np.exp(clean) / -np.expm1(clean), -1.0) * share
        gz = pull[bag] / (1 + np.exp(-z))
        g, gb = np.bincount(column, gz[row], d), gz.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.99**t
        step = rate / (np.sqrt(v / c2) + 1e-5)
        w += step * m / c1
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        bias += rate * 0.5 * (mb / c1) / (np.sqrt(vb / c2) + 1e-5)
    kept = w != 0
    return SentenceModel(dict(zip(names[chosen][kept].tolist(), w[kept].tolist(), strict=True)), float(bias))


def sentence_features(text: str | None) -> tuple[list[int], list[int]]:
    """Number of features of each sentence, and the features in a row."""
    lengths, flat = [], []
    for s in _SENTENCE.findall((text or "").lower()):
        if words := _WORD.findall(s):
            own = {f for w in set(words) for f in features(w)}
            lengths.append(len(own))
            flat += own
    return lengths, flat


def learn(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> SentenceModel | None:
    """A model from at most ``bound`` documents of either label (doc_id, toxic).

    The labels are chosen by a hash of doc_id, and are two numbers each, so
    their side of the join has a proven bound; the texts become hashed
    features on the executors."""
    one = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("labelled_id")) \
        .agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("labelled_id"), F.col("labelled_id")]
    chosen = one.where("toxic = 1").orderBy(*order).limit(bound).unionByName(one.where("toxic <> 1").orderBy(*order).limit(bound))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), F.col("id") == F.col("labelled_id")).select("id", "toxic", "text")
    raw = lambda x: np.array(x, np.int32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [sentence_features(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("toxic").cast(pa.int32()), pa.array([raw(n) for n, _ in found], pa.binary()),
                 pa.array([raw(f) for _, f in found], pa.binary())], names=["id", "toxic", "lengths", "features"])

    got = rows.mapInArrow(run, "id long, toxic int, lengths binary, features binary") \
        .dropDuplicates(["id"]).orderBy("id").limit(2 * bound).toPandas()
    if not len(got):
        return None
    lengths = [np.frombuffer(x, np.int32) for x in got.lengths]
    flat = np.concatenate([np.frombuffer(x, np.int32) for x in got.features])
    bag = np.repeat(np.arange(len(got), dtype=np.int32), [len(x) for x in lengths])
    return fit(bag, np.concatenate(lengths), flat, got.toxic.to_numpy() == 1)


SCORED = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("sentences", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                                         T.StructField("score", T.DoubleType())])))])


def score_texts(docs: DataFrame, model: SentenceModel | None, least: float = 0.5) -> DataFrame:
    """``row`` (all columns of ``docs``), ``score`` of the document and the
    ``sentences`` (start, end in code points, score) with at least ``least``."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 ** FEATURE_BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        known: dict[str, float] = {}
        floor = math.log1p(math.exp(own.bias)) if own else 0.0  # -log(1 - p) of a plain sentence
        for part in slices(batches, "text"):
            scores, spans = [], []
            for text in part.column("text").to_pylist():
                found, gone = [], 0.0
                if own and text:
                    low = text.lower()
                    words = set(_WORD.findall(low))
                    fresh = words.difference(known)
                    if len(known) + len(fresh) > CACHE_WORDS:
                        known.clear()
                        fresh = words
                    for w in fresh:
                        known[w] = own.word_weight(w)
                    if any(map(known.__getitem__, words)):
                        # lower-casing can lengthen a text, but splits no sentence
                        for match, sentence in zip(_SENTENCE.finditer(text), _SENTENCE.findall(low), strict=True):
                            if not (inside := set(_WORD.findall(sentence))):
                                continue
                            z = min(30.0, max(-30.0, own.bias + sum(map(known.__getitem__, inside))))
                            gone += math.log1p(math.exp(z))
                            p = 1 / (1 + math.exp(-z))
                            if p >= least:
                                found.append({"start": match.start(), "end": match.end(), "score": p})
                    else:
                        gone = floor * len(_FILLED.findall(low))
                scores.append(-math.expm1(-gone))
                spans.append(found)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(scores, pa.float64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))],
                names=["row", "score", "sentences"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *SCORED]))
