"""N-gram Jaccard join by PartEnum signatures.

Two shingle sets link when their Jaccard similarity is at least ``percent`` / 100. For sets of
sizes a <= b that means a Hamming distance (elements in just one of them) of at most
(100 - percent) / (100 + percent) * (a + b), and b <= 100 a / percent. Sizes fall into bands;
a band fixes a bound K that holds for every set of it taken as the smaller one, and cuts the
domain of shingles into n > K partitions. Linked sets agree on at least n - K partitions:

* K <= 6: n = K + 2, and a set's signatures are its projections on every pair of partitions;
* larger K: n is about 1.15 K + 6, and they are its projections on single partitions.

A set signs for its own band and for the bands of the smaller sets it may link with, so linked
sets share a signature. An empty projection tells nothing and is not a signature; a set with so
many empty partitions that the bound no longer gives a shared non-empty projection also signs
with its prefix (its least hashes), which finds the links among such sets.

Sets with equal content are one node. Signature groups of up to ``GROUP`` nodes give all their
pairs. A larger group gives the links to its most central node only. Then the nodes that could
have shared nothing but such groups (the bound tells which) and are not connected yet are joined
by prefix filtering, rare shingles first, so frequent passages and the common part of many
near copies make no candidates there.
Candidates are verified on the whole sets. Links between different texts that the
components need are all found: a pair left out is already connected or shares a small group.

Nodes are 64-bit keys of whole sets and shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packs
from . import textkit as tk
from .frames import HOT_SHARE, components, drop_shuffles, join_by_key, keep_plan, partitions, pick

PERCENT = 75
GROUP = 12  # nodes of a signature group up to which all pairs are made
LEAST_SKETCH, SKETCH_LOAD = 64, 6  # counters of a sketch at least, shingles per counter at most
FREQUENT = 1 << 22  # places of the table of shingle frequencies, one byte each (a power of two)
ID_PLACES = 1 << 20  # places of the table of doc_ids whose texts are wanted (a power of two)
SEEN = 1 << 20  # set keys that a task remembers, so that it signs equal sets once
U64 = np.uint64


def hamming_bound(size: int, percent: int) -> int:
    """Largest distance between a set of this size and any linked set that is no smaller."""
    most = 100 * size // percent
    return (size + most) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def bands(top: int) -> tuple[int, ...]:
    """Distance bounds K of the bands: 0..6 one by one, then twice as much each time."""
    k = [0, 1, 2, 3, 4, 5, 6]
    while k[-1] < top:
        k.append(2 * k[-1])
    return tuple(k)


def band_of(size: int, percent: int) -> int:
    """Index of the least band whose bound covers a set of this size as the smaller one."""
    bound = hamming_bound(size, percent)
    return int(np.searchsorted(bands(max(bound, 64) * 2), bound))


@lru_cache(maxsize=None)
def layout(band: int) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    """(K, subset size, partition bounds as shingle hashes, salt of each partition, subset list)."""
    k = bands(6)[band] if band < 7 else bands(6 << (band - 5))[band]
    n = k + 2 if k <= 6 else k + -(-15 * k // 100) + 6
    cuts = np.array([(i << 64) // n for i in range(1, n)], U64)
    salt = tk.mix(np.arange(n, dtype=U64) + U64((band + 1) << 40))
    pairs = np.array([(i, j) for i in range(n) for j in range(i + 1, n)]) if k <= 6 else np.zeros((0, 2), int)
    return k, 2 if k <= 6 else 1, cuts, salt, pairs


def signatures(s: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """Signatures of a sorted shingle set, and how many of them any linked set shares at least."""
    size = len(s)
    if hamming_bound(size, percent) == 0 and -(-percent * size // 100) >= size:
        return np.zeros(0, U64), 1 << 30  # links with equal sets only
    sums = np.zeros(size + 1, U64)
    np.cumsum(tk.mix(s), out=sums[1:])
    out, shared = [], 1 << 30
    for band in range(band_of(-(-percent * size // 100), percent), band_of(size, percent) + 1):
        k, q, cuts, salt, pairs = layout(band)
        k = min(k, hamming_bound(size, percent))  # no pair of the band with this set is further apart
        edge = np.concatenate(([0], np.searchsorted(s, cuts), [size]))
        proj = sums[edge[1:]] - sums[edge[:-1]]
        full = edge[1:] > edge[:-1]
        empty = len(salt) - int(full.sum())
        if q == 1:
            out.append(tk.mix(proj[full] + salt[full]))
            sure = len(salt) - k - empty
        else:
            part = tk.mix(proj + salt)
            some = full[pairs].any(axis=1)
            out.append(tk.mix(part[pairs[some, 0]] * U64(3) + part[pairs[some, 1]]))
            same = len(salt) - k
            sure = comb(same, 2) - comb(min(empty, same), 2)
        if sure < 1:
            out.append(tk.mix(s[:size - -(-percent * size // 100) + 1] + U64((band + 1) << 20)))
            sure = 1
        shared = min(shared, sure)
    return np.concatenate(out), shared


def set_key(s: np.ndarray) -> np.uint64:
    return tk.mix(np.array([tk.mix(s).sum(dtype=U64) + U64(len(s))], U64))[0]


def sketch(s: np.ndarray) -> np.ndarray:
    """Shingles counted by their low bits (a power of two of counters, each up to 255)."""
    size = max(LEAST_SKETCH, 1 << (-(-len(s) // SKETCH_LOAD) - 1).bit_length())
    return np.minimum(np.bincount(s.view(np.int64) & (size - 1), minlength=size), 255).astype(np.uint8)


def sketch_distance(x: bytes, y: bytes) -> int:
    """At most the Hamming distance of the two sets; the longer sketch is folded onto the shorter."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    full = len(a) > len(b) and (a.max() == 255 or b.max() == 255)
    if full:
        return 0  # capped counters cannot be added up
    return int(np.abs(a.reshape(-1, len(b)).sum(0, dtype=np.int64) - b).sum())


def _nodes(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.zeros(b.num_rows, np.int64)
            node = np.zeros(b.num_rows, U64)
            sure = np.zeros(b.num_rows, np.int64)
            counts = [b""] * b.num_rows
            for row, buf, offs in tk.chunks(b.column(1)):
                for i, s in enumerate(tk.shingle_sets(buf, offs), row):
                    n[i] = len(s)
                    if len(s):
                        node[i], sure[i] = set_key(s), signatures(s, percent)[1]
                        counts[i] = sketch(s).tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(tk.as_long(node), mask=n == 0), pa.array(sure),
                 pa.array(counts, pa.binary())], ["doc_id", "n_shingles", "node", "sure", "sketch"])
    return run


def _signed(percent: int, buckets: int):
    """Each text chunk's signatures, dealt to buckets by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for _, buf, offs in tk.chunks(b.column(0)):
                keys, sigs = [], []
                for s in tk.shingle_sets(buf, offs):
                    if len(s) and (key := int(set_key(s))) not in seen:
                        if len(seen) < SEEN:
                            seen.add(key)
                        sig, _ = signatures(s, percent)
                        if len(sig):
                            keys.append(key)
                            sigs.append(sig)
                if keys:
                    yield packs.pack(np.concatenate(sigs), np.repeat(np.arange(len(keys)), [len(x) for x in sigs]),
                                     np.array(keys, U64), buckets)
    return run


def _grouped(group: int):
    """Of one bucket: pairs (0, a, b) of nodes in small groups, and rows (1, signature, node) of large ones."""
    def run(t: pa.Table) -> pa.Table:
        bucket, sig, node = packs.unpack(t)
        order = np.argsort(sig)
        sig, node = sig[order], node[order]
        same = sig[1:] == sig[:-1]
        multi = np.r_[same, False] | np.r_[False, same]  # signatures of one row link nothing
        sig, node = sig[multi], node[multi]
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        new = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])] if len(sig) else np.zeros(0, bool)
        sig, node = sig[new], node[new]
        at = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, int)
        count = np.diff(np.r_[at, len(sig)])
        large = np.repeat(count > group, count)
        kind, a, b = [], [], []
        s, n = sig[~large], node[~large]
        for step in range(1, group):
            hit = np.flatnonzero(s[step:] == s[:-step]) if len(s) > step else np.zeros(0, int)
            a.append(n[hit])
            b.append(n[hit + step])
        a, b = np.concatenate(a or [np.zeros(0, U64)]), np.concatenate(b or [np.zeros(0, U64)])
        if len(a):
            pair = np.unique(np.stack([a, b], 1), axis=0)
            a, b = pair[:, 0], pair[:, 1]
        full = tk.mix(sig[large] + U64(bucket))
        kind = np.r_[np.zeros(len(a), np.int8), np.ones(len(full), np.int8)]
        return pa.table({"kind": pa.array(kind, pa.int8()), "a": pa.array(tk.as_long(np.r_[a, full])),
                         "b": pa.array(tk.as_long(np.r_[b, node[large]]))})
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row, buf, offs in tk.chunks(b.column(0)):
            sets = [s for s in tk.shingle_sets(buf, offs) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tk.as_long(np.array([set_key(s) for s in sets], U64))),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])


def _near(percent: int):
    """Drop pairs whose sketches alone put them beyond the distance bound (never a linked pair)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = (b.column("_na").to_numpy() + b.column("_nb").to_numpy()) * (100 - percent)
            far = np.array([sketch_distance(x, y) for x, y in zip(b.column("_ka").to_pylist(), b.column("_kb").to_pylist())], np.int64)
            hit = pa.array(far * (100 + percent) <= n)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(hit), b.column(1).filter(hit)], ["a", "b"])
    return run


def _places(s: np.ndarray) -> np.ndarray:
    return (s >> U64(64 - FREQUENT.bit_length() + 1)).astype(np.int64)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets of the task have a shingle at each place of the table of frequencies, where
    there are several (a place that is left out only counts as rare)."""
    count = np.zeros(FREQUENT, np.int64)
    for b in batches:
        for x in b.column(0):
            count[_places(np.frombuffer(x.as_buffer(), U64))] += 1
    at = np.flatnonzero(count > 1)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(count[at])], ["place", "n"])


def _prefixes(percent: int, frequent: Broadcast):
    """Per set, the shingles that a linked set must share one of, the likely rare ones first:
    ``index`` marks those that suffice when the linked set is no smaller."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                token, index, pos, n = [], [], [], []
                for x in part.column(2):
                    s = np.frombuffer(x.as_buffer(), U64)
                    probe = len(s) - -(-percent * len(s) // 100) + 1
                    inner = len(s) - -(-2 * percent * len(s) // (100 + percent)) + 1
                    token.append(s[np.argsort(frequent.value[_places(s)], kind="stable")[:probe]])
                    index.append(np.arange(probe) < inner)
                    pos.append(np.arange(probe))
                    n.append(len(s))
                each = np.array([len(t) for t in token])
                at = pa.array(np.repeat(np.arange(part.num_rows), each))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(np.repeat(np.array(n, np.int64), each)),
                     pa.array(tk.as_long(np.concatenate(token))), pa.array(np.concatenate(index)),
                     pa.array(np.concatenate(pos))], ["node", "comp", "n", "token", "index", "pos"])
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3))):
                s, t = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(s) + len(t) - both)
            hit = pa.array(keep)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(hit), b.column(1).filter(hit)], ["a", "b"])
    return run


def jaccard_components(docs: DataFrame, percent: int = PERCENT, group: int = GROUP,
                       buckets: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Null or blank texts have empty sets and link with nothing: component_id is their own doc_id.
    Rows with a null doc_id link like any others; they have no id to offer, so the component_id of a
    component that only such rows form is null. Repeated rows are
    returned as often as they come. An empty table gives no rows. Columns other than doc_id and text are ignored. ``buckets`` (default: the session's
    shuffle partitions) is the number of signature groups tasks; give more for larger inputs.
    """
    spark = docs.sparkSession
    docs = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = keep_plan(docs.mapInArrow(_nodes(percent), "doc_id long, n_shingles long, node long, sure long, sketch binary"))
    nodes = keep_plan(rows.where("node is not null").groupBy("node")
                      .agg(F.min("doc_id").alias("rep"), F.first("sure").alias("sure"), F.first("sketch").alias("sketch"),
                           F.first("n_shingles").alias("n"), F.count("*").alias("copies")))
    drop_shuffles(spark)
    found = keep_plan(docs.select("text").mapInArrow(_signed(percent, buckets or partitions(spark)), packs.SCHEMA)
                      .groupBy("bucket").applyInArrow(_grouped(group), "kind byte, a long, b long"))
    drop_shuffles(spark)
    large = found.where("kind = 1").select(F.col("a").alias("sig"), F.col("b").alias("node"))
    weight = large.groupBy("node").agg(F.count("*").alias("h"))
    central = (large.join(weight, "node").groupBy("sig")
               .agg(F.max(F.struct("h", "node")).getField("node").alias("hub")))
    star = large.join(central, "sig").where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    pairs = found.where("kind = 0").select("a", "b").unionByName(star).distinct()

    def near(p: DataFrame) -> DataFrame:
        left = nodes.select(F.col("node").alias("a"), F.col("n").alias("_na"), F.col("sketch").alias("_ka"))
        right = nodes.select(F.col("node").alias("b"), F.col("n").alias("_nb"), F.col("sketch").alias("_kb"))
        return keep_plan(p.join(left, "a").join(right, "b").select("a", "b", "_na", "_nb", "_ka", "_kb")
                         .mapInArrow(_near(percent), "a long, b long"))

    tried = near(pairs)
    # nodes whose links may all lie in large groups
    open_ = keep_plan(large.groupBy("node").agg(F.count("*").alias("h")).join(nodes.select("node", "sure"), "node")
                      .where("h >= sure").select("node"))
    need = (tried.select(F.explode(F.array("a", "b")).alias("node"), F.lit(True).alias("tried"))
            .unionByName(open_.select("node", F.lit(False).alias("tried"))).groupBy("node").agg(F.max("tried").alias("tried")))
    need = keep_plan(nodes.join(need, "node").select("node", "tried", F.col("rep").alias("doc_id")))
    # texts go by a table of ID_PLACES places first, so that most others are not shuffled
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - ID_PLACES.bit_length() + 1)
    some = docs.where("doc_id is not null").withColumn("_place", place).join(
        F.broadcast(need.where("doc_id is not null").select(place.alias("_place")).distinct()), "_place", "left_semi")  # ID_PLACES rows at most
    some = some.join(need.select("doc_id").distinct(), "doc_id", "left_semi").select("text")
    sets = keep_plan(some.unionByName(docs.where("doc_id is null").select("text"))  # texts that only rows without id may hold
                     .mapInArrow(_sets, "node long, shingles binary")
                     .groupBy("node").agg(F.first("shingles").alias("shingles")).join(need.select("node", "tried"), "node"))
    drop_shuffles(spark)

    def verified(p: DataFrame, sets: DataFrame) -> DataFrame:
        sets = sets.select("node", "shingles")
        return keep_plan(p.join(sets.toDF("a", "_sa"), "a").join(sets.toDF("b", "_sb"), "b").select("a", "b", "_sa", "_sb")
                         .mapInArrow(_linked(percent), "a long, b long"))

    links = verified(tried, sets.where("tried"))
    drop_shuffles(spark)
    known = nodes.count()

    def labels(linked: DataFrame) -> DataFrame:
        """(node, comp, copies, component_id): components of nodes, then the least doc_id that one of them has."""
        at = keep_plan(nodes.join(components(linked), "node", "left").select("node", "copies", "rep", "root"))
        least = keep_plan(at.where("root is not null").groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("_m")))
        hot = least.where(F.col("_m") * HOT_SHARE > known)
        in_one = join_by_key(at.where("root is not null"), least.drop("_m"), "root", hot)
        return (in_one.select("node", F.col("root").alias("comp"), "copies", "component_id")
                .unionByName(at.where("root is null").select("node", F.col("node").alias("comp"), "copies", F.col("rep").alias("component_id"))))

    label = keep_plan(labels(links))
    # Open nodes that are not connected yet: prefix filtering, rare shingles first. Any order is
    # exact; frequencies come from a table of fixed size.
    frequent = np.zeros(FREQUENT, np.uint8)
    loose = sets.join(open_, "node", "left_semi")
    counted = (loose.select("shingles").mapInArrow(_tally, "place int, n long").groupBy("place").agg(F.least(F.sum("n"), F.lit(255)).alias("n"))
               .toArrow())  # FREQUENT rows at most
    frequent[counted.column("place").to_numpy()] = counted.column("n").to_numpy()
    order = spark.sparkContext.broadcast(frequent)
    tokens = keep_plan(loose.join(label.select("node", "comp"), "node").select("node", "comp", "shingles")
                       .mapInArrow(_prefixes(percent, order), "node long, comp long, n long, token long, index boolean, pos long"))
    index = tokens.where("index").select("token", F.col("comp").alias("_ci"), F.col("node").alias("_i"), F.col("n").alias("_ni"), F.col("pos").alias("_pi"))
    probe = tokens.select("token", F.col("comp").alias("_cp"), F.col("node").alias("_p"), F.col("n").alias("_np"), F.col("pos").alias("_pp"))
    # components that meet at a shingle first, so that nodes of one component never meet, and only
    # those whose sizes and places leave room for a link
    left = index.groupBy("token", "_ci").agg(F.min("_ni").alias("_a"), F.max("_ni").alias("_b"), F.max(F.expr("_ni - _pi")).alias("_c"))
    right = probe.groupBy("token", "_cp").agg(F.min("_np").alias("_x"), F.max("_np").alias("_y"), F.max(F.expr("_np - _pp")).alias("_z"))
    meet = left.join(right, "token").where(
        f"_ci <> _cp and _a <= _y and 100 * _b >= {percent} * _x and {100 + percent} * least(_c, _z) >= {percent} * (_a + _x)").select(
        "token", "_ci", "_cp", "_x", "_y", "_z")
    met = index.join(meet, ["token", "_ci"]).where(
        f"_ni <= _y and 100 * _ni >= {percent} * _x and {100 + percent} * least(_ni - _pi, _z) >= {percent} * (_ni + _x)")
    more = (met.join(probe, ["token", "_cp"])
            .where(f"(_ni < _np or _ni = _np and _i < _p) and 100 * _ni >= {percent} * _np and "  # and by what may still follow
                   f"{100 + percent} * least(_ni - _pi, _np - _pp) >= {percent} * (_ni + _np)")
            .select(F.least("_i", "_p").alias("a"), F.greatest("_i", "_p").alias("b")).distinct())
    more = near(more.join(tried, ["a", "b"], "left_anti"))
    found_late = verified(more, sets)
    if not found_late.isEmpty():
        label = keep_plan(labels(links.unionByName(found_late)))
    total = nodes.agg(F.sum("copies")).first()[0] or 0
    hot = label.where(F.col("copies") * HOT_SHARE > total)
    out = join_by_key(rows.where("node is not null").select("doc_id", "n_shingles", "node"),
                      label.select("node", "component_id"), "node", hot)
    return out.select("doc_id", "n_shingles", "component_id").unionByName(
        rows.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
