"""Vector code compression: integer product quantisation with exact slice-and-intersect search.

Every component becomes ``floor(1024 * x)``; a vector is cut into PARTS consecutive parts, and each
part is replaced by the number of the nearest of up to ENTRIES codebook entries (squared Euclidean distance, ties to the
lower number). Codebooks start as the parts of the vectors of smallest id and are refined by
ROUNDS rounds of assignment and componentwise floored means.

The nearest entry is found by slicing and intersecting. A codebook keeps, per dimension, its
entries' coordinates in ascending order and at every position the bit mask of the entries before
it. A radius selects a range of positions per dimension; prefix masks at both ends give
its entries (one exclusive-or), and ANDing the dimensions' uint64 masks gives exactly the entries inside the cube of that
half-width, among them all within that Euclidean distance. The initial radius is the distance to the entry of
the last round, or at first to the middle entry of the first dimension: some entry is that near, so
the cube holds the nearest one. A quarter of the radius is tried first; it decides all parts whose best entry
lies within it and tightens the radius of the others. Where vectors are so spread that masks name more than 1/DENSE
of the entries, the candidates' distances of a block come from one matrix product instead of one by one.

Rows stay where they are: a round sends one row per task, part and entry (count and sums) to a sum by (part,
entry). Codebooks (PARTS x ENTRIES integer parts) are all that the driver holds.

Definitions: vectors that are null, empty, or hold null or non-finite components are dropped;
shorter vectors are taken as ending in zeros, up to the longest length rounded up to a multiple of
PARTS; of equal ids the smaller vector comes first, null ids come last; null labels are one label; an empty
table gives no rows. Integer components beyond 2**26 either way raise an error, as errors would
not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import HOT_SHARE, join_by_key, keep_plan, pick

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
LARGEST = 1 << 26
STEP = 2048  # vectors searched together
SMALL, DENSE = 1 << 20, 8  # integers whose distances are exact in doubles; 1 / the share of candidates from which they are computed together
U64 = np.uint64


class Codebook:
    """Entries of one part position with their sorted coordinates and prefix masks."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.small = bool(np.abs(entries).max(initial=0) <= SMALL and entries.shape[1] <= 1 << 8)
        k, dims = entries.shape
        self.words = -(-k // 64)
        own = np.zeros((k, self.words), U64)
        own[np.arange(k), np.arange(k) // 64] = U64(1) << (np.arange(k) % 64).astype(U64)
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        self.prefix = np.zeros((dims, k + 1, self.words), U64)
        for j in range(dims):
            np.bitwise_or.accumulate(own[self.order[:, j]], axis=0, out=self.prefix[j, 1:])

    def inside(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Per row of ``x``, the mask of the entries that differ by at most ``radius`` in every dimension."""
        mask = np.full((len(x), self.words), ~U64(0))
        for j in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, j], x[:, j] - radius, "left")
            high = np.searchsorted(self.sorted[:, j], x[:, j] + radius, "right")
            mask &= self.prefix[j, high] ^ self.prefix[j, low]
        return mask

    def distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return ((x - self.entries[entry]) ** 2).sum(1)

    def _all(self, x: np.ndarray) -> np.ndarray:
        """All squared distances by one matrix product; exact, as SMALL integers keep every sum below 2**53."""
        a, e = x.astype(np.float64), self.entries.astype(np.float64)
        return (a * a).sum(1)[:, None] + (e * e).sum(1)[None, :] - 2 * (a @ e.T)

    def _best(self, x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest entry inside the radius' cube, its squared distance); no entry: 0 and the largest long."""
        bits = np.unpackbits(self.inside(x, radius).view(np.uint8), axis=1, bitorder="little")
        if self.small and len(x) and np.abs(x).max() <= SMALL and bits.sum() * DENSE > bits.size:
            d = np.where(bits[:, :len(self.entries)], self._all(x), np.inf)
            at = d.argmin(1)  # the first of equal ones
            best = d[np.arange(len(x)), at]
            none = np.isinf(best)
            far = np.where(none, 0, best).astype(np.int64)
            far[none] = np.iinfo(np.int64).max
            return at, far
        row, entry = np.divmod(np.flatnonzero(bits), bits.shape[1])
        best, at = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
        if len(row):
            d = self.distance(x[row], entry)
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            least = np.minimum.reduceat(d, first)
            best[row[first]] = least
            hit = np.flatnonzero(d == np.repeat(least, np.diff(np.r_[first, len(row)])))
            one = np.r_[True, row[hit][1:] != row[hit][:-1]]  # entries ascend within a row
            at[row[hit][one]] = entry[hit][one]
        return at, best

    def nearest(self, x: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest entry, squared distance) per row; ``start``: some entry for each row."""
        if start is None:
            middle = np.searchsorted(self.sorted[:, 0], x[:, 0]).clip(0, len(self.entries) - 1)
            start = self.order[middle, 0]
        bound = self.distance(x, start)
        radius = np.ceil(np.sqrt(bound.astype(np.float64))).astype(np.int64) + 1
        at, best = self._best(x, radius // 4)
        open_ = np.flatnonzero(best > (radius // 4) ** 2)  # an entry outside the cube may be nearer
        if len(open_):
            bound = np.minimum(bound[open_], best[open_])
            radius = np.ceil(np.sqrt(bound.astype(np.float64))).astype(np.int64) + 1
            at[open_], best[open_] = self._best(x[open_], radius)
        return at, best


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    """A batch's vectors as integers, short ones filled with zeros."""
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError(f"components beyond {LARGEST} / {SCALE} do not fit")
    sizes = np.asarray(column.value_lengths())
    out = np.zeros((len(column), dims), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _assign(x: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances), both vectors x PARTS."""
    wide = x.shape[1] // PARTS
    codes, far = np.zeros((len(x), PARTS), np.int64), np.zeros((len(x), PARTS), np.int64)
    for p, book in enumerate(books):
        for at in range(0, len(x), STEP):
            codes[at:at + STEP, p], far[at:at + STEP, p] = book.nearest(x[at:at + STEP, p * wide:(p + 1) * wide])
    return codes, far


def _gather(entries: np.ndarray):
    """Arrow task: vectors -> one row per (part, entry) that the task has met, with count and sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in entries]
        k, wide = entries.shape[1:]
        n, sums = np.zeros((PARTS, k), np.int64), np.zeros((PARTS, k, wide), np.int64)
        for b in batches:
            x = _integers(b.column("v"), PARTS * wide)
            codes, _ = _assign(x, books)
            for p in range(PARTS):
                n[p] += np.bincount(codes[:, p], minlength=k)
                np.add.at(sums[p], codes[:, p], x[:, p * wide:(p + 1) * wide])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry], pa.int64()),
                                          pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])
    return run


def _encode(entries: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(e) for e in entries]
        for b in batches:
            codes, far = _assign(_integers(b.column("v"), PARTS * entries.shape[2]), books)
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(text, pa.string()), pa.array(far.sum(1), pa.int64())],
                                             ["vec_id", "label", "code", "error"])
    return run


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, v) of the vectors that have only finite components."""
    src = pick(vectors, id_col, vector_col, label_col).toDF("vec_id", "v", "label")
    v = F.transform("v", lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return src.select(F.col("vec_id").cast("long"), "label", v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & fine)


def fit(kept: DataFrame, rounds: int = ROUNDS) -> np.ndarray | None:
    """The codebooks (PARTS x entries x components of a part) after ``rounds`` rounds; None without vectors."""
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    dims = -(-longest // PARTS) * PARTS
    first = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    x = _integers(pa.array([r.v for r in first], pa.list_(pa.float64())), dims)
    entries = np.ascontiguousarray(x.reshape(len(x), PARTS, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        sums = kept.select("v").mapInArrow(_gather(entries), "part int, entry int, n long, sums array<long>")
        total = (sums.select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
                 .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
                 .groupBy("part", "entry").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "s"))).s.alias("s")))
        for r in total.collect():  # at most PARTS x ENTRIES rows
            entries[r.part, r.entry] = np.array(r.s, np.int64) // r.n
    return entries


def codebooks_text(entries: np.ndarray) -> str:
    return ",".join(map(str, entries.reshape(-1).tolist()))


def encode(kept: DataFrame, entries: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    kind = kept.schema["label"].dataType.simpleString()
    return kept.mapInArrow(_encode(entries), f"vec_id long, label {kind}, code string, error long")


def vector_codes(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error (over equal labels), codebooks_sha256 of every usable vector."""
    kept = usable(vectors)
    entries = fit(kept, rounds)
    if entries is None:
        return kept.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    sha = hashlib.sha256(codebooks_text(entries).encode()).hexdigest()
    label = F.when(F.col("label").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("label").cast("string")))
    rows = keep_plan(encode(kept, entries).select("vec_id", "code", "error", label.alias("key")))
    facts = rows.groupBy("key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    hot = facts.where(F.col("n") * HOT_SHARE > rows.count())
    out = join_by_key(rows, facts.drop("n"), "key", hot)
    return out.select("vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
