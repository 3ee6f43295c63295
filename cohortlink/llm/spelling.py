"""Spelling variant grouping: each word's most frequent word one edit away.

Words are the maximal runs of letters of ``documents`` texts (``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased),
counted over all rows. One edit changes the letter counts of a word by at most two in L1: a
replaced letter moves one count down and one up, an inserted or deleted letter one count. So near
words are found by range searches in k-d trees over letter-count vectors, one tree per word
length: words of equal length within 2, words one letter longer within 1; what is left is
verified on the order of the letters.

The tree has two levels. Its top is built per length from a sample of about ``SAMPLE`` words (those whose
hash a divisor divides: it decides the balance, not the results) down to cells of about ``CELL`` words. Every word
is stored in one cell and sent as a query to each cell that its L1 ball touches. In a cell, a
tree of tight boxes is searched: letter counts are held in unary, one bit per (letter, k) "has k or more", so
the AND and OR of a node's words are the corners of its box and popcounts are L1 distances. Cells
answer with counts and best words per query, never with pairs.

Definitions: null texts have no words; a null doc_id reads as empty text in the key of the
deletion rule; repeated rows count as often as they occur; ties of the largest n go to the smallest word in
code-point order; an empty table has no words. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import keep_plan, pick

LEAST_LENGTH, LEAST_COUNT = 5, 3
DELETED = 97  # runs whose key hash this divides lose a letter
RATIO = 2  # a form has at least so many times the word's count
CELL = 8192
SAMPLE = 20_000
LEAF = 48
CHUNK = 1 << 20  # code points of a text looked at in one step
FLUSH = 200_000  # distinct words a task gathers before it hands them on
ROWS = 4096  # words of a packed row
ASKED = 1 << 15  # queries searched together in a cell
U64 = np.uint64
_RUN = re.compile("[a-zÀ-ÿ]+")


def _runs(text: str, step: int = CHUNK) -> Iterator[list[str]]:
    """The lower-cased runs of a text, in parts that end between runs."""
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z only
    at = 0
    while at < len(low):
        end = min(len(low), at + step)
        if end < len(low) and (rest := _RUN.match(low, end)):
            end = rest.end()
        yield _RUN.findall(low, at, end)
        at = end


def count_runs(doc_id: int | None, text: str | None, into: Counter, least: int = LEAST_LENGTH) -> None:
    """Add a text's runs, after the deletion rule, to ``into``."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for runs in _runs(text or ""):
        for run, n in Counter(runs).items():
            if len(run) >= least:
                h = zlib.crc32(run.encode(), start)
                if h % DELETED == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < least:
                        continue
                into[run] += n


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
        seen.clear()
        return batch

    for b in batches:
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
            count_runs(doc_id, text.as_py(), seen)
            if len(seen) >= FLUSH:
                yield out()
    yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the words of at least LEAST_LENGTH letters and LEAST_COUNT occurrences."""
    src = pick(docs, "doc_id", "text").where("text is not null").select(F.col("doc_id").cast("long"), "text")
    return (src.mapInArrow(_count_task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


# --- top of the trees -------------------------------------------------------------------------

def letters(words: np.ndarray | list[bytes]) -> np.ndarray:
    """Words of one length, in latin-1, as a matrix of letters."""
    data = words.tobytes() if isinstance(words, np.ndarray) else b"".join(words)
    return np.frombuffer(data, np.uint8).reshape(len(words), -1)


def letter_counts(chars: np.ndarray) -> np.ndarray:
    """Letter counts (words x 256) of a matrix of letters."""
    out = np.zeros((len(chars), 256), np.uint16 if chars.shape[1] < 1 << 16 else np.uint32)
    rows = np.arange(len(chars))
    for j in range(chars.shape[1]):
        out[rows, chars[:, j]] += 1
    return out


def _split(counts: np.ndarray) -> tuple[int, int, np.ndarray] | None:
    """The letter and count k whose plane "k or more" halves the words best."""
    best = None
    for letter in np.flatnonzero(counts.min(0) < counts.max(0)):
        col = counts[:, letter]
        ks, n = np.unique(col, return_counts=True)
        above = len(col) - np.cumsum(n)[:-1]
        i = int(np.argmin(np.abs(2 * above - len(col))))
        off = abs(2 * int(above[i]) - len(col))
        if best is None or off < best[0]:
            best = (off, int(letter), int(ks[i + 1]))
    if best is None:
        return None
    return best[1], best[2], counts[:, best[1]] >= best[2]


class Trees:
    """Planes per word length; cells are numbered, lengths without sample are one cell (-length)."""

    def __init__(self, sample: list[str], total: int, cell: int = CELL):
        self.cells, self.roots = 0, {}
        by: dict[int, list[bytes]] = {}
        for w in sorted(sample):
            by.setdefault(len(w), []).append(w.encode("latin-1"))
        weight = total / max(1, len(sample))
        for length in sorted(by):
            self.roots[length] = self._grow(letter_counts(letters(by[length])), weight, cell)

    def _grow(self, counts: np.ndarray, weight: float, cell: int):
        cut = _split(counts) if len(counts) * weight > cell else None
        if cut is None:
            self.cells += 1
            return self.cells - 1
        letter, k, up = cut
        return letter, k, self._grow(counts[~up], weight, cell), self._grow(counts[up], weight, cell)

    def home(self, length: int, counts: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(cell, rows stored there)."""
        return self.reach(length, counts, 0)

    def reach(self, length: int, counts: np.ndarray, radius: int) -> list[tuple[int, np.ndarray]]:
        """(cell of the tree of that length, rows whose L1 ball of that radius touches it)."""
        out: list[tuple[int, np.ndarray]] = []
        if length not in self.roots:
            return [(-length, np.arange(len(counts)))]

        def walk(node, rows: np.ndarray, far: np.ndarray, box: dict[int, tuple[int, int]]) -> None:
            if not len(rows):
                return
            if isinstance(node, int):
                out.append((node, rows))
                return
            letter, k, low, high = node
            lo, hi = box.get(letter, (0, 1 << 30))
            col = counts[rows, letter].astype(np.int64)
            old = np.maximum(lo - col, 0) + np.maximum(col - hi, 0)
            for child, (a, z) in ((low, (lo, k - 1)), (high, (k, hi))):
                d = far - old + np.maximum(a - col, 0) + np.maximum(col - z, 0)
                ok = d <= radius
                walk(child, rows[ok], d[ok], {**box, letter: (a, z)})

        walk(self.roots[length], np.arange(len(counts)), np.zeros(len(counts), np.int64), {})
        return out


PACKED = "cell int, length int, stored boolean, words binary, counts binary"


def _send(trees: Trees, rows_each: int = ROWS):
    """Words -> packed rows: each word to its own cell (stored) and to every cell in reach."""
    names = ["cell", "length", "stored", "words", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: dict[int, list[tuple[bytes, int]]] = {}
            for w, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist()):
                by.setdefault(len(w), []).append((w.encode("latin-1"), n))
            for length, pairs in by.items():
                words, ns = np.array([w for w, _ in pairs], f"S{length}"), np.array([n for _, n in pairs], np.int64)
                counts = letter_counts(letters(words))
                out: list[list] = [[], [], [], [], []]
                for goal, radius, stored in ((length, 0, True), (length, 2, False), (length + 1, 1, False)):
                    for cell, rows in trees.reach(goal, counts, radius):
                        for at in range(0, len(rows), rows_each):
                            part = rows[at:at + rows_each]
                            for col, x in zip(out, (cell, length, stored, words[part].tobytes(), ns[part].tobytes())):
                                col.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.bool_()),
                                                  pa.array(out[3], pa.binary()), pa.array(out[4], pa.binary())], names)
    return run


# --- search in a cell -------------------------------------------------------------------------

class Cell:
    """k-d tree with tight boxes over the words (one length, sorted) of a cell."""

    def __init__(self, words: np.ndarray, leaf: int = LEAF):
        self.words = words
        self.chars = letters(words)
        counts = letter_counts(self.chars)
        self.most = counts.max(0)
        self.planes = [(letter, k) for letter in np.flatnonzero(self.most) for k in range(1, self.most[letter] + 1)]
        bits = self._unary(counts)
        self.wide = max(1, -(-len(self.planes) // 64))
        self.code = self._packed(bits)
        self.tree = self._grow(np.arange(len(words)), bits, leaf)

    def _unary(self, counts: np.ndarray) -> np.ndarray:
        letters, ks = np.array([p[0] for p in self.planes], int), np.array([p[1] for p in self.planes], int)
        return counts[:, letters] >= ks

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        """Bits as rows of 64-bit words, one row per 64 planes (word index last)."""
        full = np.zeros((len(bits), self.wide * 64), bool)
        full[:, :bits.shape[1]] = bits
        return np.ascontiguousarray(np.packbits(full, axis=1).view(U64).T)

    def _grow(self, rows: np.ndarray, bits: np.ndarray, leaf: int):
        own = self.code[:, rows]
        box = np.bitwise_and.reduce(own, axis=1), np.bitwise_or.reduce(own, axis=1)
        if len(rows) > leaf:
            up = np.add.reduce(bits[rows], axis=0, dtype=np.int64)
            plane = int(np.argmin(np.abs(2 * up - len(rows))))
            if 0 < up[plane] < len(rows):
                side = bits[rows, plane]
                return box, None, self._grow(rows[~side], bits, leaf), self._grow(rows[side], bits, leaf)
        return box, rows, None, None

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, stored word) exactly one edit apart; queries have the stored length or one less."""
        chars = letters(words)
        same = chars.shape[1] == self.chars.shape[1]
        radius = 2 if same else 1
        counts = letter_counts(chars)
        over = np.minimum((np.maximum(counts, self.most) - self.most).sum(1), 3).astype(np.uint8)  # what no stored word can match
        code = self._packed(self._unary(counts))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def verify() -> None:
            if waiting:
                found.append(self._ordered(chars, np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]), same))
                waiting.clear()

        def walk(node, q: np.ndarray) -> None:
            (low, high), rows, a, b = node
            d = over[q]
            for i in range(self.wide):
                c = code[i, q]
                d = self._sum(d, np.bitwise_count((low[i] & ~c) | (c & ~high[i])))
            q = q[d <= radius]
            if not len(q):
                return
            if rows is None:
                walk(a, q)
                walk(b, q)
                return
            d = over[q][:, None]
            for i in range(self.wide):
                d = self._sum(d, np.bitwise_count(code[i, q][:, None] ^ self.code[i, rows][None, :]))
            x, y = np.divmod(np.flatnonzero(d <= radius), len(rows))
            if len(x):
                waiting.append((q[x], rows[y]))
                if sum(len(w[0]) for w in waiting) > 1 << 18:
                    verify()

        walk(self.tree, np.flatnonzero(over <= radius))
        verify()
        if not found:
            return np.zeros(0, int), np.zeros(0, int)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _sum(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances as bytes; long words may need more than a byte holds, and 99 is far enough."""
        return a + b if self.wide <= 3 else np.minimum(a, 99) + np.minimum(b, 99)

    def _ordered(self, chars: np.ndarray, q: np.ndarray, t: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose letters also stand in the right order."""
        n = chars.shape[1]
        ok = np.zeros(len(q), bool)
        step = max(1, (1 << 22) // n)
        for at in range(0, len(q), step):
            a, b = chars[q[at:at + step]], self.chars[t[at:at + step]]
            if same:
                ok[at:at + step] = (a != b).sum(1) == 1
            else:
                front = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(1)
                back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
                ok[at:at + step] = front + back >= n
        return q[ok], t[ok]


PARTIAL = "word string, n long, n_near long, best_n long, best string"


def _best(own: np.ndarray, size: int, n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words with near ones, how many, position of the best pair); pairs hold n and rank of the near word."""
    count = np.bincount(own, minlength=size)
    order = np.lexsort((rank, -n, own))
    first = np.r_[True, own[order][1:] != own[order][:-1]] if len(own) else np.zeros(0, bool)
    at = order[first]
    return own[at], count[own[at]], at


def _search(key: tuple, t: pa.Table) -> pa.Table:
    """A cell's answers: one row per stored word (nothing near yet), and one per word with near words among those searched together."""
    def words_of(i: int) -> np.ndarray:
        return np.frombuffer(words[i].as_py(), f"S{length[i]}")

    words, length, stored = t.column("words"), t.column("length").to_pylist(), t.column("stored").to_pylist()
    counts = [np.frombuffer(x.as_py(), np.int64) for x in t.column("counts")]
    own = [i for i, s in enumerate(stored) if s]
    cols: list[list] = [[], [], [], [], []]

    def put(names: np.ndarray, n: np.ndarray, near: np.ndarray, best_n: np.ndarray | None, best: np.ndarray | None) -> None:
        text = [w.decode("latin-1") for w in names.tolist()]
        size = len(text)
        for c, x in zip(cols, (pa.array(text, pa.string()), pa.array(n, pa.int64()), pa.array(near, pa.int64()),
                               pa.array(best_n, pa.int64()) if best_n is not None else pa.nulls(size, pa.int64()),
                               pa.array([w.decode("latin-1") for w in best.tolist()], pa.string()) if best is not None else pa.nulls(size, pa.string()))):
            c.append(x)

    if own:
        have, have_n = np.concatenate([words_of(i) for i in own]), np.concatenate([counts[i] for i in own])
        order = np.argsort(have)
        have, have_n = have[order], have_n[order]
        put(have, have_n, np.zeros(len(have), np.int64), None, None)
        cell = Cell(have)
        for size in sorted({n for n, s in zip(length, stored) if not s}):
            rows = [i for i, s in enumerate(stored) if not s and length[i] == size]
            asked, asked_n = np.concatenate([words_of(i) for i in rows]), np.concatenate([counts[i] for i in rows])
            order = np.argsort(asked)
            for a in range(0, len(order), ASKED):
                ask, ask_n = asked[order[a:a + ASKED]], asked_n[order[a:a + ASKED]]
                q, h = cell.near(ask)
                if len(q):
                    who, near, at = _best(q, len(ask), have_n[h], h)
                    put(ask[who], ask_n[who], near, have_n[h[at]], have[h[at]])
                    if size < have.dtype.itemsize:  # the pair of lengths is searched from the shorter side only
                        who, near, at = _best(h, len(have), ask_n[q], q)
                        put(have[who], have_n[who], near, ask_n[q[at]], ask[q[at]])
    return pa.Table.from_arrays([pa.chunked_array(c, ty) for c, ty in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                ["word", "n", "n_near", "best_n", "best"])


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """(word, n, n_near, form, form_n) of a checkpointed (word, n): how many words are one edit away, and
    the most frequent of them if it has at least RATIO times the word's count."""
    total = words.count()
    every = max(1, total // sample)
    some = [r.word for r in words.select("word").where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).collect()]
    trees = Trees(some, total, cell)
    sent = words.mapInArrow(_send(trees), PACKED)
    parts = sent.groupBy("cell").applyInArrow(_search, PARTIAL)
    out = parts.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
                                    F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))).alias("b"))
    form = -F.col("b.m") >= RATIO * F.col("n")
    return out.select("word", "n", "n_near", F.when(form, F.col("b.w")).alias("form"), F.when(form, -F.col("b.m")).alias("form_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """Adds ``root``: forms followed to the last word. A form has at least RATIO times the count, so
    chains are short (a logarithm of the counts); each step doubles the length that is followed."""
    at = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = keep_plan(at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if at.where("moved").isEmpty():
            break
        at = at.drop("moved")
    return forms.join(at.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    words = keep_plan(word_counts(docs))
    found = keep_plan(near_words(words, cell, sample))
    return with_roots(found).select("word", "form", "root", "n", "n_near", "form_n")
