"""Operator 7: near-duplicate documents by SuperMinHash.

1. Signatures. Every element (hash of a word shingle) draws one random
   permutation of the registers; its j-th register gets rank j plus a random
   fraction, registers keep minima. The ranks of one element are correlated
   (each is used once), which lowers the variance; a document stops as soon as
   no later rank can lower a register.
2. Banding. Documents with equal sets are one node from here on. Nodes with
   an equal band share a bucket.
3. Verification. A bucket's leader is the member that shares most buckets (a
   near copy's original); the buckets of leaders with one most central leader
   of their own form a group under it, its head (or under the member nearest
   to what most members have, see ``better_heads``). A group's members are
   compared with the head on full sets. Those that are then still in different
   components can be linked only if they share shingles outside the head's
   set, or if both are little more than parts of it (see ``rest_pairs``); only
   such pairs are compared, so no group emits all its pairs and none loses a link.
4. Union-find over the links, as parent pointers contracted by joins
   (large-star, small-star) with a written table after each round.
All joined tables grow with the corpus, so joins are by merge: on small inputs Spark
would else send some fifty tables through the driver and hold them there. What two
branches of a step read is written first: a plan of many exchanges starts all of
them at once, each with a thread, its state and its text in the driver.

Defined results
  null or empty text, or one without words: n_shingles 0, its own component
  very long text: a slice by itself; its task holds its words and one hash a shingle
  fewer words than a shingle: the whole sequence is the one shingle
  repeated rows: equal results; null doc_id: linked like others, never a
  component's name while another member has an id (component_id null if none has)
  kept: doc_id equals component_id (nulls are equal), so nulls are not lost
  empty table: no rows; extra columns of the input are ignored
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import slices, text_key
from claimspark.session import materialize

#: 24 bands of 4: a pair at Jaccard 0.8 shares none with probability 3e-6.
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
#: Members that are compared with one copy of their leader's set.
MEMBERS_PER_HEAD = 500
#: Members of a group in one deal of the search for pairs within it.
GROUP_ROWS = 4096

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_U = np.uint64
_GAMMA = 0x9E3779B97F4A7C15


def _seed(k: int) -> np.uint64:
    return _U(k * _GAMMA % 2**64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of ``size`` words
    (A-Z lower-cased)."""
    words = [_WORD.findall(t.encode("utf-8", "surrogatepass").lower()) if t else [] for t in texts]
    flat = [w for ws in words for w in ws]
    known = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    table = np.fromiter(map(xxhash.xxh64_intdigest, known), _U, len(known))
    hashes = table[np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))] if flat else np.zeros(0, _U)
    n = len(hashes)
    out, at = [], 0
    run = np.zeros(max(0, n - size + 1), _U)
    for k in range(size):
        run = run * _U(0x100000001B3) + _mix(hashes[k:k + len(run)] + _seed(k + 1))
    run = _mix(run + _U(size))
    for ws in words:
        if not ws:
            out.append(np.zeros(0, _U))
        elif len(ws) < size:
            out.append(np.array([xxhash.xxh64_intdigest(b"\n".join(ws), seed=len(ws))], _U))
        else:
            out.append(np.unique(run[at:at + len(ws) - size + 1]))
        at += len(ws)
    return out


def super_minhash(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Signatures, one row of ``registers`` for each set; equal registers mean
    that one element had the lowest rank in both. Empty sets: all ones."""
    m = registers
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    low = np.full((len(sets), m), np.iinfo(_U).max, _U)
    doc = np.repeat(np.arange(len(sets)), sizes)
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, _U)
    order = None  # each element's permutation so far, for those that go on
    for j in range(m):
        draw = _mix(elements + _seed(j + 1))
        k = j + (((draw & _U(0xFFFF)) * _U(m - j)) >> _U(16)).astype(np.int64)
        if j == 0:
            register = k
        else:
            rows = np.arange(len(order))
            register = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
        np.minimum.at(low.reshape(-1), doc * m + register, (_U(j) << _U(48)) | (draw >> _U(16)))
        goes_on = (low.max(axis=1) >> _U(48) > j)[doc]  # some register can still be lowered
        if not goes_on.any():
            break
        first = k[goes_on] if j == 0 else None
        elements, doc = elements[goes_on], doc[goes_on]
        if j == 0:
            order = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(elements), 1))
            order[np.arange(len(elements)), first] = 0
        else:
            order = order[goes_on]
    return low


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One signed 64-bit key for each band."""
    rows = signatures.shape[1] // bands
    cut = signatures.reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.array([_seed(b + 1) for b in range(bands)]), cut.shape[:2])
    for r in range(rows):
        key = _mix(key * _U(0x100000001B3) + cut[:, :, r])
    return key.view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, key (of the text), n_shingles, digest (of the set), bands."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"),
                       F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text").to_pylist(), size)
            keys = band_keys(super_minhash(sets))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), pa.array(map(len, sets), pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array([k.tolist() if len(s) else [] for k, s in zip(keys, sets, strict=True)], pa.list_(pa.int64()))],
                names=["doc_id", "key", "n_shingles", "digest", "bands"])

    return rows.mapInArrow(run, "doc_id long, key binary, n_shingles long, digest binary, bands array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """digest, shingles (little-endian uint64 bytes) of the ``wanted`` nodes
    (digest, doc_id, key), each from the one document named."""
    rows = docs.select(F.col("doc_id").cast("long").alias("d"), text_key(F.col("text")).alias("k"),
                       F.col("text").cast("string").alias("text"))
    rows = rows.join(wanted.hint("merge"), F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("key"))).select("digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text").to_pylist(), size)
            yield pa.RecordBatch.from_arrays(
                [part.column("digest"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["digest", "shingles"])

    return rows.mapInArrow(run, "digest binary, shingles binary").dropDuplicates(["digest"])


def _beside(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The distinct ``pairs`` (head, member) as rows for one pass in order: a
    head's set, then some hundred of its members' sets. No task holds a group."""
    heads = pairs.groupBy("head").agg(F.ceil(F.count("*") / MEMBERS_PER_HEAD).cast("int").alias("parts"))
    members = pairs.join(heads.hint("merge"), "head").select(
        "head", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"),
        F.col("member").alias("digest"))
    leads = heads.select("head", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"),
                         F.col("head").alias("digest"))
    return leads.unionByName(members).join(sets.hint("merge"), "digest").select("head", "part", "role", "digest", "shingles") \
        .repartition("head", "part").sortWithinPartitions("head", "part", "role", "digest")


def _past(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, np.ndarray, bytes, np.ndarray, np.ndarray]]]:
    """(head, its set, member, its set, which of these the head has), by batch."""
    lead = np.zeros(0, _U)
    for batch in batches:
        out = []
        for head, role, digest, raw in zip(*(batch.column(c).to_pylist() for c in ("head", "role", "digest", "shingles")),
                                           strict=True):
            own = np.frombuffer(raw, _U)
            if role == 0:
                lead = own
                continue
            at = np.searchsorted(lead, own)
            at[at == len(lead)] = 0
            out.append((head, lead, digest, own, lead[at] == own))
        yield out


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """head, member, same, n_head, n_member, all (sizes of the intersection,
    of either set and of the union) of distinct ``pairs`` (head, member)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _past(batches):
            out = [(h, m, int(np.count_nonzero(hit)), len(lead), len(own)) for h, lead, m, own, hit in rows]
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.binary(), pa.binary(), *[pa.int64()] * 3], strict=True)],
                names=["head", "member", "same", "n_head", "n_member"])

    return _beside(pairs, sets).mapInArrow(run, "head binary, member binary, same long, n_head long, n_member long") \
        .withColumn("all", F.col("n_head") + F.col("n_member") - F.col("same"))


def outside(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """head, member, shingle: a row for each shingle of the member that the head lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _past(batches):
            for h, _, m, own, hit in rows:
                rest = own[~hit].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * len(rest), pa.binary()), pa.array([m] * len(rest), pa.binary()), pa.array(rest)],
                    names=["head", "member", "shingle"])

    return _beside(pairs, sets).mapInArrow(run, "head binary, member binary, shingle long")


def rest_pairs(group: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """head, member (any two members of one group) of the pairs that can still be linked.

    ``group``: head, member, same, n, label (its component), for groups whose
    members are in several components; the head is a member of its own. A
    link of x and y needs |x & y| of at least p (|x| + |y|) / (100 + p), and p |x| / 100,
    and |x & y| is at most the lesser of |x & head|, |y & head| plus what x and y
    share outside the head. Either the lesser alone is enough, or they share
    shingles outside; pairs of the second kind are found by these shingles."""
    near = 100 + percent
    away = 1 - F.col("same") / (F.col("n") + F.col("n_head") - F.col("same"))
    group = group.withColumn("away", away).select("head", "member", "same", "n", "label", "away")
    other = group.select("head", *[F.col(c).alias(f"o_{c}") for c in group.columns[1:]])
    # two components differ in at least one that is not the group's largest: only its members look for partners
    main = materialize(group.groupBy("head", "label").agg(F.count("*").alias("size")).groupBy("head").agg(
        F.max_by("label", F.struct("size", "label")).alias("main")), "main")
    apart = (F.col("label") != F.col("o_label")) \
        & (F.abs(F.col("away") - F.col("o_away")) <= 1 - percent / 100 + 1e-9)  # the distance is a metric
    both = percent * (F.col("n") + F.col("o_n"))
    pair = [F.least("member", "o_member").alias("member"), F.greatest("member", "o_member").alias("o_member")]
    # first kind: each one's size is at most what the other's part in the head allows
    most = F.floor(near * F.col("same") / percent) - F.col("n")
    small = group.groupBy("head").agg(F.min("n").alias("least"))
    part = group.join(small.hint("merge"), "head").where(most >= F.col("least")).drop("least")
    mixed = part.groupBy("head").agg((F.min("label") != F.max("label")).alias("mixed"), F.count("*").alias("size")).where("mixed") \
        .join(main.hint("merge"), "head").select("head", "main", F.ceil(F.col("size") / GROUP_ROWS).cast("int").alias("deals"))
    part = materialize(part.join(mixed.hint("merge"), "head"), "parts")
    # a large group is dealt out; the few members of other components go to every deal
    few = part.where("label <> main").withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("main", "deals")
    dealt = part.select("head", F.expr("pmod(xxhash64(member), deals)").cast("int").alias("deal"),
                        *[F.col(c).alias(f"o_{c}") for c in group.columns[1:]])
    first = few.join(dealt.hint("merge"), ["head", "deal"]).where(apart & (near * F.least("same", "o_same") >= both)).select(*pair)
    # second kind: a member needs at least ``need`` shared shingles outside, so one of them is among
    # its first (outside - need + 1) by rarity in the group; common ones come last and find no pairs
    own = materialize(outside(group.where("head <> member").select("head", "member"), sets), "outside")
    seen = own.groupBy("head", "shingle").agg(F.count("*").alias("seen"))
    need = F.greatest(F.lit(1), F.ceil(F.col("n") * percent / 100) - F.col("same"))
    order = F.row_number().over(Window.partitionBy("head", "member").orderBy("seen", "shingle"))
    first_ones = own.join(seen.hint("merge"), ["head", "shingle"]).withColumn("order", order) \
        .join(group.select("head", "member", "n", "same", "label").hint("merge"), ["head", "member"]) \
        .where((F.col("order") <= F.col("n") - F.col("same") - need + 1) & (F.col("seen") > 1))
    rare = materialize(first_ones.select("head", "member", "shingle", "label"), "outside")
    twin = rare.withColumnsRenamed({"member": "o_member", "label": "o_label"})
    second = rare.join(main.hint("merge"), "head").where("label <> main").join(twin.hint("merge"), ["head", "shingle"]).where("label <> o_label") \
        .select("head", "member", "o_member").distinct() \
        .join(group.hint("merge"), ["head", "member"]).join(other.hint("merge"), ["head", "o_member"]).where(apart).select(*pair)
    return first.unionByName(second).distinct().select(F.col("member").alias("head"), F.col("o_member").alias("member"))


def better_heads(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """head, better: for groups whose head lacks shingles that most members have (a
    copy whose signature happens to be the original's), the member that is
    nearest to what most have."""
    open_ = stars.groupBy("head").agg(F.min(100 * F.col("same") - percent * F.col("all")).alias("least"), F.count("*").alias("members")) \
        .where("least < 0").select("head", "members")
    own = materialize(outside(stars.join(open_.hint("merge"), "head").select("head", "member"), sets), "outside")
    most = materialize(own.groupBy("head", "shingle").agg(F.count("*").alias("seen")).join(open_.hint("merge"), "head")
                       .where(2 * F.col("seen") > F.col("members")).select("head", "shingle", F.lit(1).alias("common")), "common")
    gain = own.join(most.hint("merge"), ["head", "shingle"], "left").groupBy("head", "member") \
        .agg(F.sum(F.coalesce("common", F.lit(-1))).alias("gain"))
    near = F.col("same") + F.coalesce("gain", F.lit(0))
    return stars.join(most.select("head").distinct().hint("merge"), "head").join(gain.hint("merge"), ["head", "member"], "left") \
        .groupBy("head").agg(F.max_by("member", F.struct(near, "member")).alias("better"))


def settled(edges: DataFrame) -> bool:
    """Whether the distinct ``edges`` (u, v; u > v) are stars around their smallest
    nodes: each u has one edge, and no v is a u. Needs no further round to see it."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    return ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least")) \
        .where("ups > 1 or ups = 1 and least = 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node reachable) of all nodes of ``edges`` (u, v)."""
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                      "edges")
    while not settled(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label"))) \
        .groupBy("node").agg(F.min("label").alias("label"))


def links(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """u, v: links between the nodes (digest, doc_id, key, bands) that hold all
    components together."""
    near = lambda p: p.where(100 * F.col("same") >= percent * F.col("all")).select(
        F.col("head").alias("u"), F.col("member").alias("v"))
    members = nodes.select("digest", F.explode("bands").alias("band"))
    sizes = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = materialize(members.join(sizes.hint("merge"), "band"), "buckets")
    central = members.groupBy("digest").agg(F.sum("size").alias("central"))
    leaders = members.join(central.hint("merge"), "digest").groupBy("band").agg(
        F.max_by("digest", F.struct("central", "digest")).alias("leader"))
    led = materialize(members.select("band", "digest").join(leaders.hint("merge"), "band").select("leader", "digest").distinct(), "led")
    # a bucket without the original has one of its copies as leader: that copy's own most central leader heads the group
    own = led.join(central.withColumnRenamed("digest", "leader").hint("merge"), "leader").groupBy("digest").agg(
        F.max_by("leader", F.struct("central", "leader")).alias("head"))
    grouped = materialize(led.join(own.select(F.col("digest").alias("leader"), "head").hint("merge"), "leader")
                          .select("head", F.col("digest").alias("member")).distinct(), "grouped")
    sets = materialize(sets_of(docs, nodes.select("digest", "doc_id", "key").join(central.select("digest").hint("merge"), "digest"), size), "sets")
    stars = materialize(compare(grouped.where("head <> member"), sets), "stars")
    better = materialize(better_heads(stars, sets, percent), "better")
    again = grouped.join(better.hint("merge"), "head").select(F.col("better").alias("head"), "member").where("head <> member").distinct()
    again = materialize(compare(materialize(again, "pairs"), sets), "stars")
    found = near(stars).unionByName(near(again))
    labels = components(found)
    # a better head may head a group of its own too; each pair counts once
    stars, known = stars.join(better.hint("merge"), "head", "left_anti").unionByName(again).dropDuplicates(["head", "member"]), stars.unionByName(again)
    # groups whose members are still in different components; the head is one of them
    group = stars.select("head", "member", "same", F.col("n_member").alias("n"), "n_head")
    lead = stars.select("head", F.col("head").alias("member"), F.col("n_head").alias("same"), F.col("n_head").alias("n"), "n_head").distinct()
    group = group.unionByName(lead).join(labels.withColumnRenamed("node", "member").hint("merge"), "member", "left") \
        .withColumn("label", F.coalesce("label", "member"))
    mixed = group.groupBy("head").agg((F.min("label") != F.max("label")).alias("mixed")).where("mixed").select("head")
    group = materialize(group.join(mixed.hint("merge"), "head"), "groups")
    known = known.select("head", "member").unionByName(known.select(F.col("member").alias("head"), F.col("head").alias("member")))
    rest = rest_pairs(group, sets, percent).join(known.hint("merge"), ["head", "member"], "left_anti")
    return found.unionByName(near(compare(materialize(rest, "pairs"), sets)))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, key, n_shingles, component_id, kept of every row of ``docs``
    (doc_id, text), shingles of ``size`` words, linked from ``percent`` on."""
    found = materialize(signatures(docs, size), "signatures")
    real = found.where("n_shingles > 0")
    nodes = real.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"),
                                       F.any_value("bands").alias("bands")) \
        .select("digest", "first.doc_id", "first.key", "bands")
    nodes = materialize(nodes, "nodes")
    labels = components(links(docs, nodes, size, percent))
    named = nodes.select("digest", "doc_id").join(labels.withColumnRenamed("node", "digest").hint("merge"), "digest", "left") \
        .withColumn("label", F.coalesce("label", "digest"))
    names = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    names = named.join(names.hint("merge"), "label").select("digest", "component_id")
    linked = real.join(names.hint("merge"), "digest").select("doc_id", "key", "n_shingles", "component_id")
    alone = found.where("n_shingles = 0").select("doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
