"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Test items are short and documents long, so the Jaccard similarity of an item and a whole
document says little. Items are partitioned by the size of their shingle set (classes up to
1, 2, 4, 8 ... shingles). For a class of up to u shingles every text is read as windows of 2u
shingles that start every u, so that any stretch of an item's length lies inside one window.
An item q of the class (u/2 < q <= u) contained to the threshold t in such a window has Jaccard
similarity of at least t q / (2u + (1 - t) q) with it; that bound gives the number of MinHash
functions (one-row bands) for which a match of every function is missed with probability
``MISS`` at most. A window and an item that share a minimum are a candidate pair of document and
item, which is verified by the exact containment of the item's shingles in the whole document.

Items are taken in blocks of at most ``BLOCK_BYTES`` of text; only a block's shingles travel to
the tasks. Each block reads the documents once and nothing is shuffled.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .frames import filter_rows, pick

PERCENT = 75
MISS = 1e-5
BLOCK_BYTES = 8 << 20
U64 = np.uint64


class ItemIndex:
    """MinHash minima of one block of items, by size class."""

    def __init__(self, ids: list, sets: list[np.ndarray], percent: int):
        self.ids, self.sets, self.percent = ids, sets, percent
        by_class = defaultdict(list)
        for i, s in enumerate(sets):
            if len(s):
                by_class[1 << (len(s) - 1).bit_length()].append(i)
        self.classes = []  # (u, functions, per function: sorted minima and their items)
        t = percent / 100
        for u, items in sorted(by_class.items()):
            q = min(len(sets[i]) for i in items)
            similar = t * q / (2 * u + (1 - t) * q)
            count = math.ceil(math.log(MISS) / math.log(1 - similar))  # 60 at most, as q > u / 2
            functions = tk.mix(np.arange(1, count + 1, dtype=U64)) | U64(1)
            minima = []
            for f in functions:
                least = np.array([(sets[i] * f).min() for i in items], U64)
                order = np.argsort(least)
                minima.append((least[order], np.array(items)[order]))
            self.classes.append((u, functions, minima))

    def matches(self, column: pa.Array) -> list[tuple[int, int, int]]:
        """(row, item, shared shingles) for every text of the column that contains an item."""
        found = []
        for row, buf, offs in tk.chunks(column):
            value, at = tk.shingle_runs(buf, offs)
            if not len(value):
                continue
            pairs: set[tuple[int, int]] = set()
            n = np.diff(at)
            for u, functions, minima in self.classes:
                blocks = -(-n // u)
                text = np.repeat(np.arange(len(n)), blocks)
                step = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                first = at[text] + step * u
                joined = text[1:] == text[:-1]
                for f, (least, items) in zip(functions, minima):
                    low = np.minimum.reduceat(value * f, first)
                    low[:-1] = np.where(joined, np.minimum(low[:-1], low[1:]), low[:-1])
                    place = np.minimum(np.searchsorted(least, low), len(least) - 1)
                    for w in np.flatnonzero(least[place] == low):
                        p = place[w]
                        while p < len(least) and least[p] == low[w]:
                            pairs.add((int(text[w]), int(items[p])))
                            p += 1
            sets: dict[int, np.ndarray] = {}
            for doc, item in sorted(pairs):
                if doc not in sets:
                    sets[doc] = np.unique(value[at[doc]:at[doc + 1]])
                shared = len(np.intersect1d(sets[doc], self.sets[item], assume_unique=True))
                if 100 * shared >= self.percent * len(self.sets[item]):
                    found.append((row + doc, item, shared))
        return found


def item_blocks(items: DataFrame, percent: int = PERCENT) -> Iterator[ItemIndex]:
    """The items (item_id, text) in blocks of bounded size, indexed."""
    items = pick(items, "item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // BLOCK_BYTES))
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        if not block:
            continue
        sets = [s for _, buf, offs in tk.chunks(pa.array([r.text for r in block])) for s in tk.shingle_sets(buf, offs)]
        yield ItemIndex([r.item_id for r in block], sets, percent)


def find_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) for every document row that holds an item.

    ``n_item`` counts the item's distinct five-word shingles, ``n_shared`` those found in the
    document; at least ``percent`` per cent are. Texts of fewer than five words are one shingle, so
    such an item is found only in an equal text. Null and blank texts and items match nothing.
    Repeated rows (of either table) give repeated results; null ids are passed on. Empty tables
    give no rows; other columns are ignored.
    """
    docs = pick(docs, "doc_id", "text")
    schema = "doc_id long, item_id long, n_item long, n_shared long, containment double"

    def scan(index: ItemIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hit = index.matches(b.column(1))
                if hit:
                    n = [len(index.sets[i]) for _, i, _ in hit]
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array([r for r, _, _ in hit])).cast(pa.int64()),
                         pa.array([index.ids[i] for _, i, _ in hit], pa.int64()), pa.array(n, pa.int64()),
                         pa.array([s for _, _, s in hit], pa.int64()),
                         pa.array([s / m for (_, _, s), m in zip(hit, n)])],
                        ["doc_id", "item_id", "n_item", "n_shared", "containment"])
        return run

    out = None
    for index in item_blocks(items, percent):
        part = docs.mapInArrow(scan(index), schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) whose text holds no item; see find_items."""
    at = docs.columns.index("text")

    def keep(index: ItemIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ok = np.ones(b.num_rows, bool)
                ok[[r for r, _, _ in index.matches(b.column(at))]] = False
                yield b.filter(pa.array(ok))
        return run

    for index in item_blocks(items, percent):
        docs = filter_rows(docs, keep(index))
    return docs
