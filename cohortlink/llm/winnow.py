"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points is hashed; of each window of consecutive hashes the least is
chosen (the rightmost of equal ones) and kept with its position. The window follows from the
text's length alone (``window_of``): ``WINDOW`` from 784 code points on, less in classes of powers
of two below, 1 under 48. Two texts that share a run of GRAM + window - 1 code points, by the
larger of their windows, share a chosen hash, as a smaller window chooses all that a larger one
does; so a text of 31 code points or more shares one with every text that keeps its first half.
Nothing shorter than GRAM matches except in texts shorter than that, whose fingerprint is the
hash of all they hold.

A stored fingerprint is ``<grams>:<window>:<hashes>:<positions>``: the number of grams of the text, and hashes and positions in
hexadecimal, 8 digits each, in order of position. Fingerprints are compared without their texts (``likeness_of``): where
windows differ, the choice by the larger window is derived from the finer fingerprint, which holds it.

Neighbours in ascending doc_id come from a range partition: split points (one per partition) are
taken from the ids, each text is dealt to its range once, and the first text of a range also goes
to the range before, so that every task meets the successor of its last text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .frames import partitions, pick

GRAM = 16
WINDOW = 48
U64 = np.uint64
LAST = (1 << 63) - 1


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def window_of(n: int) -> int:
    """The window of a text of ``n`` code points."""
    room = (n - 2 * GRAM) // 16 + 1  # at most what half of the text has room for
    return WINDOW if room >= WINDOW else 1 << (max(1, room).bit_length() - 1)


def winnow(code: np.ndarray, gram: int = GRAM, window: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Chosen 32-bit hashes and their positions, in order of position; the window is ``window_of`` unless given."""
    n = len(code)
    window = window or window_of(n)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    gram = min(gram, n)
    up, _ = tk.powers(n)
    c = np.zeros(n + 1, U64)
    np.cumsum(tk.mix(code.astype(U64) + U64(1)) * up, out=c[1:])
    at = np.arange(n - gram + 1)
    h = tk.span_hash(c, at, at + gram) >> U64(32)
    key = (h << U64(32)) | (U64(0xFFFFFFFF) - at.astype(U64))  # least hash first, then rightmost
    low = tk.sliding_min(key, min(window, len(key)))
    low = low[np.r_[True, low[1:] != low[:-1]]]
    return (low >> U64(32)).astype(np.uint32), (U64(0xFFFFFFFF) - (low & U64(0xFFFFFFFF))).astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice coefficient of two sorted sets of hashes; 1 if both are empty."""
    if len(a) + len(b) == 0:
        return 1.0
    return 2 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


class Print(NamedTuple):
    """A text's fingerprint: how many grams the text has, the window, the chosen hashes and their positions."""

    grams: int
    window: int
    hashes: np.ndarray
    positions: np.ndarray

    def text(self) -> str:
        """Form for storing; empty for the empty text."""
        if not self.grams:
            return ""
        return f"{self.grams}:{self.window}:{self.hashes.astype('>u4').tobytes().hex()}:{self.positions.astype('>u4').tobytes().hex()}"

    def by_window(self, window: int) -> np.ndarray:
        """The hashes that a larger window would have chosen: each larger window's least hash, and the rightmost of
        equal ones, is also some smaller window's choice, so nothing but the fingerprint is needed."""
        if window <= self.window or not self.grams:
            return self.hashes
        key = np.full(self.grams, ~U64(0))
        key[self.positions] = (self.hashes.astype(U64) << U64(32)) | (U64(0xFFFFFFFF) - self.positions.astype(U64))
        low = tk.sliding_min(key, min(window, self.grams))
        return (low[np.r_[True, low[1:] != low[:-1]]] >> U64(32)).astype(np.uint32)


def print_of(code: np.ndarray, gram: int = GRAM, window: int | None = None) -> Print:
    hashes, positions = winnow(code, gram, window)
    return Print(max(0, len(code) - min(gram, len(code)) + 1) if len(code) else 0, window or window_of(len(code)), hashes, positions)


def read_print(text: str) -> Print:
    """A stored fingerprint."""
    if not text:
        return Print(0, 1, np.zeros(0, np.uint32), np.zeros(0, np.int64))
    grams, window, hashes, positions = text.split(":")
    return Print(int(grams), int(window), np.frombuffer(bytes.fromhex(hashes), ">u4").astype(np.uint32), np.frombuffer(bytes.fromhex(positions), ">u4").astype(np.int64))


def likeness_of(a: Print, b: Print) -> float:
    """Likeness of two fingerprints, by the larger of their windows; no text is needed."""
    window = max(a.window, b.window) if a.grams and b.grams else 0
    return likeness(np.unique(a.by_window(window)), np.unique(b.by_window(window)))


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int | None = None) -> DataFrame:
    """(doc_id, hashes array<long>, positions array<long>) of every row of (doc_id, text).

    Null texts count as empty; empty texts have empty arrays; repeated rows give repeated results.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 256):
                got = [winnow(codes(t or ""), gram, window) for t in b.column(1).slice(a, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, 256).cast(pa.int64()), pa.array([g[0].astype(np.int64) for g in got], pa.list_(pa.int64())),
                     pa.array([g[1] for g in got], pa.list_(pa.int64()))], ["doc_id", "hashes", "positions"])
    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


def in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """(range, tail, ord, doc_id, text), range by range in order, each followed by its successor.

    ``tail`` marks the copies of the next range's first doc_id (of the first, after the last).
    Null doc_ids come last; equal ones go by text.
    """
    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("ord", F.coalesce("doc_id", F.lit(LAST)))
    ids = rows.select("ord")
    at = [i / ranges for i in range(1, ranges)]
    cuts = ids.approxQuantile("ord", at, 1 / (4 * ranges)) if at else []  # none for an empty table
    cuts = np.array(sorted({int(x) for x in cuts if x < LAST}), np.int64)

    @F.pandas_udf("int")
    def range_of(ord_: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ord_.to_numpy(), "right").astype(np.int32))

    heads = sorted((r.range, r.head) for r in ids.select("ord", range_of("ord").alias("range"))
                   .groupBy("range").agg(F.min("ord").alias("head")).collect())  # one row per range
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}

    @F.pandas_udf("array<int>")
    def places(ord_: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, ord_.to_numpy(), "right")
        return pd.Series([[r, before[o]] if o in before else [r] for r, o in zip(own.tolist(), ord_.tolist())])

    return (rows.select("ord", "doc_id", "text", F.posexplode(places("ord")).alias("_place", "range"))
            .select("range", (F.col("_place") > 0).alias("tail"), "ord", "doc_id", "text")
            .repartition(ranges, "range").sortWithinPartitions("range", "tail", "ord", "text"))


def edited_fingerprints(docs: DataFrame, gram: int = GRAM, window: int | None = None, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every row of (doc_id, text) and of its text edited by its successor's.

    The edited text has its last floor(n_chars / 2) code points replaced by as many of the first
    of the next document's (or all). Null texts count as empty (n_chars 0, empty fingerprint, both
    likenesses to another empty fingerprint 1). Rows with a null doc_id come last; rows with equal
    doc_id follow each other by text. A single row is its own successor; an empty table gives no rows.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.int32())]

    def one(doc_id, text, own, nxt_text, nxt) -> tuple:
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt_text[:half]
        e = print_of(codes(edited), gram, window)
        return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own.text(), e.text(),
                likeness_of(own, e), likeness_of(own, nxt), own.positions.astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, out = None, []
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                for rng, tail, doc_id, text in zip(part.column("range").to_pylist(), part.column("tail").to_pylist(),
                                                   part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    if last is not None or not tail:
                        print_ = print_of(codes(text), gram, window)
                    if last is not None:
                        out.append(one(*last[:3], text, print_))
                    last = None if tail else (doc_id, text, print_)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)
                    out = []

    return in_ranges(docs, ranges or 2 * partitions(docs.sparkSession)).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, positions array<int>")
