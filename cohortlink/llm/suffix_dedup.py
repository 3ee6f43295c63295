"""Removal of byte strings that repeat across documents, by blockwise suffix sorting.

A byte goes when it is covered by a ``length``-byte string that also starts in a document with a
smaller doc_id, judged on the input. The suffixes that matter are those whose first ``length``
bytes occur in two documents. They are found, dealt into suffix buckets and sorted bucket by
bucket, so that a task never holds more than one bucket:

1. Every ``length``-byte string has an anchor: the least hash among its ``GRAM``-byte grams.
   Equal strings have equal anchors, so a suffix bucket is the set of anchors with one hash
   value modulo the bucket count. Anchors that stand in one document only are dropped.
2. Suffixes with consecutive starts and the same anchor travel as one piece of text (with the
   bytes that their last suffix needs). Equal pieces of a bucket are one piece with the least
   doc_id. An anchor with a single piece is settled by that; the suffixes of the others are
   sorted.
3. Sorting uses a difference cover modulo ``PERIOD``: ranks of the suffixes at cover positions
   come first; the bucket's suffixes are ordered by their first ``PERIOD`` bytes, and longer ties
   by the rank of the cover position that follows both at the same distance. Pieces are laid out
   with their anchors at multiples of the period, so equal strings stand at equal residues;
   ties among different residues (periodic text) are ordered by their bytes.
   Neighbours are compared on all ``length`` bytes, which gives classes of equal strings.
4. A suffix is a repeat if the least doc_id of its class is smaller than its own. Runs of such
   starts return to their texts, which are cut and hashed.

Texts are shuffled once (by a hash of the row) and used twice; bytes that repeat nowhere stay
where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packs
from . import textkit as tk
from .frames import partitions, pick

LENGTH = 50
GRAM = 20
PERIOD = 16
BLOCK = 1 << 19  # suffixes that are sorted at once inside a bucket
CHUNK = 2 << 20
U64 = np.uint64
PIECES = ("bucket int, grp int, owners binary, counts binary, vals binary, pos binary, "
          "runs binary, shift binary, bytes binary")


@lru_cache(maxsize=None)
def difference_cover(period: int) -> tuple[int, ...]:
    """Smallest-first greedy set of residues whose differences give every residue."""
    best: tuple[int, ...] = tuple(range(period))
    def grow(cover: tuple[int, ...]) -> None:
        nonlocal best
        gaps = {(a - b) % period for a in cover for b in cover}
        if len(gaps) == period and len(cover) < len(best):
            best = cover
        if len(cover) + 1 < len(best):
            for nxt in range(cover[-1] + 1, period):
                grow(cover + (nxt,))
    grow((0,))
    return best


@lru_cache(maxsize=None)
def cover_shift(period: int) -> np.ndarray:
    """shift[a, b]: least d with a + d and b + d both in the difference cover."""
    cover = set(difference_cover(period))
    return np.array([[next(d for d in range(period) if (a + d) % period in cover and (b + d) % period in cover)
                      for b in range(period)] for a in range(period)])


def anchor_runs(buf: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first start, starts, anchor hash, text, grams' hashes) of each run of starts with one anchor."""
    gram = min(GRAM, length)
    if len(buf) < length:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(U64), z, z.astype(U64)
    c = tk.prefix_hash(buf)
    i = np.arange(len(buf) - gram + 1)
    h = tk.span_hash(c, i, i + gram)
    m = tk.sliding_min(h, length - gram + 1)
    edge = np.zeros(len(m) + 1, np.int32)  # starts whose string ends in the same text
    long_ = np.flatnonzero(np.diff(offs) >= length)
    np.add.at(edge, offs[long_], 1)
    np.add.at(edge, offs[long_ + 1] - length + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    change = np.empty(len(m), bool)
    change[0] = True
    np.not_equal(m[1:], m[:-1], out=change[1:])
    change[1:] |= valid[1:] != valid[:-1]
    change[offs[long_]] = True
    at = np.flatnonzero(change)
    size = np.diff(np.r_[at, len(m)])
    ok = valid[at]
    at, size = at[ok], size[ok]
    return at, size, m[at], np.searchsorted(offs, at, "right") - 1, h


def _anchors(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid = b.column(0).to_numpy().view(U64)
            for row, buf, offs in tk.chunks(b.column(1), CHUNK):
                _, _, value, text, _ = anchor_runs(buf, offs, length)
                if len(value):
                    yield packs.pack(value, text, rid[row:row + len(offs) - 1], buckets)
    return run


def _shared(groups: int):
    """Of one bucket, the anchors that stand in two documents, once per group of texts that has them."""
    def run(t: pa.Table) -> pa.Table:
        bucket, value, owner = packs.unpack(t)
        order = np.argsort(value)
        value, owner = value[order], owner[order]
        new = np.r_[True, value[1:] != value[:-1]]
        at = np.flatnonzero(new)
        several = np.minimum.reduceat(owner, at) != np.maximum.reduceat(owner, at)
        keep = several[np.cumsum(new) - 1]
        value, grp = value[keep], (owner[keep].view(np.int64) % groups).astype(np.int32)
        order = np.lexsort((value, grp))
        value, grp = value[order], grp[order]
        one = np.r_[True, (value[1:] != value[:-1]) | (grp[1:] != grp[:-1])] if len(grp) else np.zeros(0, bool)
        value, grp = value[one], grp[one]
        cut = np.flatnonzero(np.r_[True, grp[1:] != grp[:-1], True]) if len(grp) else np.zeros(1, int)
        return pa.table({"grp": pa.array(grp[cut[:-1]], pa.int32()),
                         "bucket": pa.array(np.full(len(cut) - 1, bucket), pa.int32()),
                         "vals": pa.array([tk.pack6(value[a:z]) for a, z in zip(cut[:-1], cut[1:])], pa.binary())})
    return run


def _key(values: np.ndarray, bucket: np.ndarray | int) -> np.ndarray:
    return (values & ~U64(0xFFFF)) | (np.asarray(bucket).astype(U64) & U64(0xFFFF))


def _ordered(t: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The texts of a group in an order that depends on the rows alone, and where each begins."""
    t = t.sort_by([("rid", "ascending"), ("ord", "ascending")]).combine_chunks()
    size = pa.compute.binary_length(t.column("text").cast(pa.large_binary())).to_numpy() if t.num_rows else np.zeros(0, np.int64)
    return t, np.r_[0, np.cumsum(size)].astype(np.int64)


def _pieces(length: int, tallies: int, buckets: int):
    """Of one group of texts: the pieces whose anchor is shared, dealt to the suffix buckets."""
    schema = pa.schema([("bucket", pa.int32()), ("grp", pa.int32())] + [(n, pa.binary()) for n in
                       ("owners", "counts", "vals", "pos", "runs", "shift", "bytes")])

    def run(texts: pa.Table, shared: pa.Table) -> pa.Table:
        if texts.num_rows == 0 or shared.num_rows == 0:
            return schema.empty_table()
        grp = texts.column("grp")[0].as_py()
        texts, base = _ordered(texts)
        ords = texts.column("ord").to_numpy()
        known = np.sort(np.concatenate([_key(tk.unpack6(v), b) for v, b in zip(
            shared.column("vals").to_pylist(), shared.column("bucket").to_pylist())]))
        parts = []
        for row, buf, offs in tk.chunks(texts.column("text"), CHUNK):
            at, runs, value, text, h = anchor_runs(buf, offs, length)
            to = packs.bucket_of(value, buckets)
            key = _key(value, packs.bucket_of(value, tallies))
            hit = known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key
            at, runs, value, text, to = at[hit], runs[hit], value[hit], text[hit], to[hit]
            if not len(at):
                continue
            shift = np.zeros(len(at), np.uint8)
            span = np.arange(length - min(GRAM, length) + 1)
            for a in range(0, len(at), 1 << 16):
                p = at[a:a + (1 << 16)]
                shift[a:a + (1 << 16)] = (h[p[:, None] + span] == value[a:a + (1 << 16), None]).argmax(1)
            order, cut = packs.deal(to)
            size = runs + length - 1
            for a, z in zip(cut[:-1], cut[1:]):
                o = order[a:z]
                who, counts = packs.owner_lists(text[o] + row, ords)
                n = size[o]
                step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                parts.append((int(to[o[0]]), grp, who, counts, tk.pack6(value[o]),
                              (at[o] + base[row]).astype(np.int64).tobytes(), runs[o].astype(np.uint32).tobytes(),
                              shift[o].tobytes(), pa.compress(buf[np.repeat(at[o], n) + step].tobytes(), "zstd", asbytes=True)))
        return pa.table([pa.array([p[i] for p in parts], f.type) for i, f in enumerate(schema)], schema=schema)
    return run


def _words8(text: np.ndarray) -> np.ndarray:
    """Big-endian 8-byte word at every byte position."""
    w = np.zeros(len(text) - 7, U64)
    for i in range(8):
        w = (w << U64(8)) | text[i:len(text) - 7 + i].astype(U64)
    return w


def _ranks(word: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Dense rank of the suffixes at these positions by their first ``depth`` bytes."""
    if not len(at):
        return np.zeros(0, np.int64)
    cols = [word[at + 8 * i] for i in range(-(-depth // 8))]
    order = np.lexsort(cols[::-1])
    new = np.zeros(len(at), bool)
    for c in cols:
        new[1:] |= c[order][1:] != c[order][:-1]
    rank = np.empty(len(at), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def suffix_classes(text: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Class of each start: equal for starts whose first ``length`` bytes are equal.

    ``text`` must go on for length + 2 * PERIOD + 8 bytes after each start. Starts are sorted as
    suffixes; see the module's text for the difference cover.
    """
    word = _words8(text)
    deep = length + 8
    shift = cover_shift(PERIOD).diagonal()
    residue = start % PERIOD
    follow = start + shift[residue]
    cover, inv = np.unique(follow, return_inverse=True)
    rank = _ranks(word, cover, deep)[inv]
    heads = [word[start + 8 * i] for i in range(PERIOD // 8)]
    order = np.lexsort([rank, residue, *heads[::-1]])
    tie = np.ones(len(start), bool)  # same head as the one before
    for c in heads:
        tie[1:] &= c[order][1:] == c[order][:-1]
    tie[:1] = False
    block = np.cumsum(~tie)
    mixed = tie.copy()
    mixed[1:] &= residue[order][1:] != residue[order][:-1]
    bad = np.isin(block, block[mixed])
    if bad.any():  # ties among different residues: order by their bytes
        o = order[bad]
        cols = [word[start[o] + 8 * i] for i in range(-(-length // 8))]
        order[bad] = o[np.lexsort([*cols[::-1], block[bad]])]
    s = start[order]
    new = np.zeros(len(s), bool)
    for i in range(length // 8):
        new[1:] |= word[s[1:] + 8 * i] != word[s[:-1] + 8 * i]
    if length % 8:
        low = U64(8 * (8 - length % 8))
        i = 8 * (length // 8)
        new[1:] |= (word[s[1:] + i] >> low) != (word[s[:-1] + i] >> low)
    out = np.empty(len(s), np.int64)
    out[order] = np.cumsum(new)
    return out


def _least_docs(blob: np.ndarray, first: np.ndarray, runs: np.ndarray, shift: np.ndarray, doc: np.ndarray,
                length: int) -> np.ndarray:
    """For pieces at blob[first:], the least doc of the class of each of their starts, end to end."""
    size = runs + length - 1
    pad = 2 * PERIOD + 16 + length % 8
    lead = (-shift) % PERIOD  # the anchor of each piece comes to a multiple of the period
    room = -(-(size + pad + PERIOD) // PERIOD) * PERIOD
    base = np.cumsum(room) - room + lead
    text = np.zeros(int(room.sum()) + length + 64, np.uint8)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    text[np.repeat(base, size) + step] = blob[np.repeat(first, size) + step]
    step = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    cls = suffix_classes(text, np.repeat(base, runs) + step, length)
    least = np.full(int(cls.max()) + 1 if len(cls) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, cls, np.repeat(doc, runs))
    return least[cls]


def _repeats(length: int):
    """Of one suffix bucket: the runs of starts that repeat an earlier document, per group of texts."""
    def run(t: pa.Table) -> pa.Table:
        doc = packs.unpack_owners(t.column("owners"), t.column("counts")).view(np.int64)
        cols = {n: np.concatenate([np.frombuffer(x, d) for x in t.column(n).to_pylist()])
                for n, d in (("pos", np.int64), ("runs", np.uint32), ("shift", np.uint8))}
        raw = [int(np.frombuffer(x, np.uint32).sum(dtype=np.int64)) + len(x) // 4 * (length - 1) for x in t.column("runs").to_pylist()]
        blob = np.concatenate([np.frombuffer(pa.decompress(x, n, "zstd"), np.uint8) for x, n in zip(t.column("bytes").to_pylist(), raw)])
        value = np.concatenate([tk.unpack6(x) for x in t.column("vals").to_pylist()])
        per_row = [len(x) // 8 for x in t.column("pos").to_pylist()]
        grp = np.repeat(np.array(t.column("grp").to_pylist(), np.int32), per_row)
        pos, runs, shift = cols["pos"], cols["runs"].astype(np.int64), cols["shift"].astype(np.int64)
        size = runs + length - 1
        first = np.cumsum(size) - size
        content = np.empty(len(pos), U64)
        a = 0
        while a < len(pos):  # hash the pieces, a few megabytes at a time
            z = max(a + 1, int(np.searchsorted(first, first[a] + CHUNK)))
            c = tk.prefix_hash(blob[first[a]:first[z - 1] + size[z - 1]])
            content[a:z] = tk.span_hash(c, first[a:z] - first[a], first[a:z] - first[a] + size[a:z])
            a = z
        order = np.lexsort((content, size, value))
        v, s, h = value[order], size[order], content[order]
        new_value = np.r_[True, v[1:] != v[:-1]]
        new = new_value | np.r_[True, (s[1:] != s[:-1]) | (h[1:] != h[:-1])]
        at = np.flatnonzero(new)
        kind = np.cumsum(new) - 1  # distinct piece of each sorted piece
        least = np.minimum.reduceat(doc[order], at)
        anchor = (np.cumsum(new_value) - 1)[at]
        rival = np.bincount(anchor)[anchor] > 1  # distinct pieces whose anchor has others too
        lo = np.full(len(at), -1, np.int64)  # where the classes of a distinct piece begin in ``flat``
        flat, used = [], 0
        chosen = np.flatnonzero(rival)
        n = runs[order[at]]
        a = 0
        while a < len(chosen):  # whole anchors, one block of suffixes at a time
            total = np.cumsum(n[chosen[a:]])
            z = a + max(1, int(np.searchsorted(total, BLOCK)))
            while z < len(chosen) and anchor[chosen[z]] == anchor[chosen[z - 1]]:
                z += 1
            k = chosen[a:z]
            o = order[at[k]]
            # the suffixes of one anchor are compared among themselves; others differ anyway
            flat.append(_least_docs(blob, first[o], runs[o], shift[o], least[k], length))
            lo[k] = used + np.cumsum(n[k]) - n[k]
            used += int(n[k].sum())
            a = z
        flat = np.concatenate(flat) if flat else np.zeros(0, np.int64)
        mine, piece = doc[order], order
        whole = ~rival[kind] & (least[kind] < mine)
        out_pos, out_len, out_grp = [pos[piece[whole]]], [runs[piece[whole]]], [grp[piece[whole]]]
        some = np.flatnonzero(rival[kind])
        for a in range(0, len(some), 1 << 16):
            x = some[a:a + (1 << 16)]
            r = runs[piece[x]]
            step = np.arange(int(r.sum())) - np.repeat(np.cumsum(r) - r, r)
            hit = flat[np.repeat(lo[kind[x]], r) + step] < np.repeat(mine[x], r)
            begin = hit & (np.r_[True, ~hit[:-1]] | (step == 0))
            end = hit & np.r_[~hit[1:] | (step[1:] == 0), True]
            b, e = np.flatnonzero(begin), np.flatnonzero(end)
            out_pos.append((np.repeat(pos[piece[x]], r) + step)[b])
            out_len.append(e - b + 1)
            out_grp.append(np.repeat(grp[piece[x]], r)[b])
        p, m, g = np.concatenate(out_pos), np.concatenate(out_len), np.concatenate(out_grp)
        order = np.argsort(g, kind="stable")
        p, m, g = p[order], m[order], g[order]
        cut = np.flatnonzero(np.r_[True, g[1:] != g[:-1], True]) if len(g) else np.zeros(1, int)
        return pa.table({"grp": pa.array(g[cut[:-1]], pa.int32()),
                         "pos": pa.array([p[a:z].tobytes() for a, z in zip(cut[:-1], cut[1:])], pa.binary()),
                         "runs": pa.array([m[a:z].astype(np.uint32).tobytes() for a, z in zip(cut[:-1], cut[1:])], pa.binary())})
    return run


def _cut(length: int, with_text: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["text"] * with_text
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * with_text

    def run(texts: pa.Table, repeats: pa.Table) -> pa.Table:
        texts, base = _ordered(texts)
        edge = np.zeros(int(base[-1]) + 1, np.int32)
        for p, m in zip(repeats.column("pos").to_pylist(), repeats.column("runs").to_pylist()):
            p, m = np.frombuffer(p, np.int64), np.frombuffer(m, np.uint32)
            np.add.at(edge, p, 1)
            np.add.at(edge, p + m + (length - 1), -1)
        gone = np.cumsum(edge[:-1]) > 0
        col = texts.column("text").cast(pa.large_binary())
        out = []
        for i, x in enumerate(col):
            data = x.as_buffer()
            g = gone[base[i]:base[i + 1]]
            n = int(np.count_nonzero(g))
            kept = bytes(data) if n == 0 else np.frombuffer(data, np.uint8)[~g].tobytes()
            spans = int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])) if n else 0
            out.append((len(g), n, spans, hashlib.sha256(kept).hexdigest()) + ((kept,) if with_text else ()))
        return pa.table([texts.column("doc_id").combine_chunks() if texts.num_rows else pa.array([], pa.int64())] +
                        [pa.array([o[i] for o in out], types[i + 1]) for i in range(len(types) - 1)], names=names)
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, buckets: int | None = None,
                   groups: int | None = None, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, text]) for every row of (doc_id, text).

    Null texts count as empty and have no removed bytes. A null doc_id counts as larger than all
    others. Rows with the same doc_id never remove from one another. Texts shorter than ``length``
    bytes stay whole. An empty table gives no rows; other columns are ignored. ``with_text`` adds
    the kept bytes (a cut may fall inside a character). ``buckets`` and ``groups`` are the numbers
    of suffix buckets and of text groups held by one task at a time (default: two per shuffle
    partition); anchors are counted in half as many buckets.
    """
    n = partitions(docs.sparkSession)
    buckets, groups = buckets or 2 * n, groups or 2 * n
    tallies = max(1, buckets // 2)
    rows = (pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("ord", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
        .withColumn("rid", F.xxhash64("doc_id", "text")))
    anchors = rows.select("rid", "text").mapInArrow(_anchors(length, tallies), packs.SCHEMA)
    shared = anchors.groupBy("bucket").applyInArrow(_shared(groups), "grp int, bucket int, vals binary")
    texts = rows.select(F.pmod("rid", F.lit(groups)).cast("int").alias("grp"), "doc_id", "ord", "rid", "text")
    pieces = texts.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(_pieces(length, tallies, buckets), PIECES)
    repeats = pieces.groupBy("bucket").applyInArrow(_repeats(length), "grp int, pos binary, runs binary")
    return texts.groupBy("grp").cogroup(repeats.groupBy("grp")).applyInArrow(
        _cut(length, with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        + (", text binary" if with_text else ""))
