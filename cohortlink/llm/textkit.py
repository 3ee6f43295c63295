"""Vectorised text helpers for code that runs inside Spark tasks.

Every function works on a *chunk*: a few megabytes of whole texts laid end to end as UTF-8
bytes, so one task holds a chunk (or one text, if a single text is longer) and never a
partition. Words are maximal runs of bytes other than space and 0x09-0x0D, and only A-Z are
lower-cased. Hashes are 64 bits wide; where a result must be exact, callers compare content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
SHINGLE_WORDS = 5
U64 = np.uint64

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling (SplitMix64 finaliser), new array."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def mix_int(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], U64))[0])


_BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_BYTE_CODE_LOWER = _BYTE_CODE[_LOWER]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First n powers of the hash base and of its inverse modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 64)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, U64(base))
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _powers[name] = p
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(buf: np.ndarray, lower: bool = False) -> np.ndarray:
    """c with c[i] = sum of code(buf[j]) * base**j for j < i, modulo 2**64; length len(buf)+1."""
    up, _ = powers(len(buf))
    c = np.zeros(len(buf) + 1, U64)
    np.cumsum((_BYTE_CODE_LOWER if lower else _BYTE_CODE)[buf] * up, out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte span [start, end): equal bytes give equal hashes wherever they stand."""
    _, down = powers(len(c))
    return mix((c[end] - c[start]) * down[start])


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string column into (first row, bytes, offsets of the texts in them); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offs, offs[row] + limit, "right")) - 1
        last = min(max(last, row + 1), len(column))
        yield row, data[offs[row]:offs[last]], offs[row:last + 1] - offs[row]
        row = last


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text number of every word of a chunk, in order."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_SEP[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offs[(offs > 0) & (offs < n)]  # a text's border ends a word too
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offs, starts, "right") - 1


def word_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased word, and offsets of each text's words among them."""
    starts, ends, text = words(buf, offs)
    h = span_hash(prefix_hash(buf, lower=True), starts, ends) if len(starts) else np.zeros(0, U64)
    return h, np.searchsorted(text, np.arange(len(offs)))


_PLACE = [U64(mix_int(0xA5A5 + j) | 1) for j in range(SHINGLE_WORDS)]


def run_hash(w: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (len(w) - size + 1 of them)."""
    acc = np.full(len(w) - size + 1, U64(mix_int(size)))
    for j in range(size):
        acc += w[j:len(w) - size + 1 + j] * _PLACE[j]
    return mix(acc)


def shingle_sets(buf: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """Per text, its sorted distinct five-word shingle hashes; fewer words count as one shingle."""
    w, at = word_hashes(buf, offs)
    wide = run_hash(w, SHINGLE_WORDS) if len(w) >= SHINGLE_WORDS else np.zeros(0, U64)
    for i in range(len(offs) - 1):
        a, b = at[i], at[i + 1]
        if b - a >= SHINGLE_WORDS:
            s = np.sort(wide[a:b - SHINGLE_WORDS + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
        elif b > a:
            yield run_hash(w[a:b], int(b - a))
        else:
            yield np.zeros(0, U64)


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    m, have = h, 1
    while have < width:
        step = min(have, width - have)
        m = np.minimum(m[:len(m) - step], m[step:])
        have += step
    return m


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == U64 else x.astype(np.int64)


def pack6(x: np.ndarray) -> bytes:
    """High 48 bits of each value, six bytes each."""
    return np.ascontiguousarray((x >> U64(16)).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack6(blob: bytes) -> np.ndarray:
    """The packed values with their low 16 bits zero."""
    raw = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(U64).ravel()


def shingle_runs(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All five-word shingles of a chunk in text order (repeats kept), and each text's offsets."""
    w, at = word_hashes(buf, offs)
    n = np.diff(at)
    if len(w) >= SHINGLE_WORDS:
        wide = run_hash(w, SHINGLE_WORDS)
        text = np.repeat(np.arange(len(n)), n)
        ok = text[:len(wide)] == text[SHINGLE_WORDS - 1:]
        value, text = wide[ok], text[:len(wide)][ok]
    else:
        value, text = np.zeros(0, U64), np.zeros(0, np.int64)
    few = np.flatnonzero((n > 0) & (n < SHINGLE_WORDS))
    if len(few):
        short = np.concatenate([run_hash(w[at[i]:at[i + 1]], int(n[i])) for i in few])
        order = np.argsort(np.r_[text, few], kind="stable")
        value, text = np.r_[value, short][order], np.r_[text, few][order]
    return value, np.searchsorted(text, np.arange(len(offs)))
