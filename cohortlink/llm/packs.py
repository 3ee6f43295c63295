"""Compact rows for shuffling many 64-bit hashes: one binary row per (text chunk, bucket).

A hash goes to bucket (low 32 bits modulo the bucket count) and travels as its high 48 bits, so
that bucket and bits together tell hashes apart; owners (documents) are listed once per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .textkit import U64, pack6, unpack6

SCHEMA = "bucket int, owners binary, counts binary, vals binary"


def bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return (values & U64(0xFFFFFFFF)) % U64(buckets)


def deal(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stable order by bucket, borders of the buckets in that order)."""
    order = np.argsort(bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket, kind="stable")
    to = bucket[order]
    return order, np.flatnonzero(np.r_[True, to[1:] != to[:-1], True]) if len(to) else np.zeros(1, int)


def owner_lists(own: np.ndarray, keys: np.ndarray) -> tuple[bytes, bytes]:
    """Run-length form of the owners of consecutive values: keys and counts."""
    at = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
    return keys[own[at[:-1]]].tobytes(), np.diff(at).astype(np.uint32).tobytes()


def pack(values: np.ndarray, own: np.ndarray, keys: np.ndarray, buckets: int) -> pa.RecordBatch:
    """values[i] belongs to keys[own[i]]; own must not fall."""
    to = bucket_of(values, buckets)
    order, at = deal(to)
    values, own, to = values[order], own[order], to[order]
    cols: list[list] = [[], [], [], []]
    for a, z in zip(at[:-1], at[1:]):
        who, counts = owner_lists(own[a:z], keys)
        for c, x in zip(cols, (int(to[a]), who, counts, pack6(values[a:z]))):
            c.append(x)
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                      ["bucket", "owners", "counts", "vals"])


def unpack_owners(owners, counts) -> np.ndarray:
    return np.concatenate([np.repeat(np.frombuffer(a, U64), np.frombuffer(c, np.uint32))
                           for a, c in zip(owners.to_pylist(), counts.to_pylist())])


def unpack(t: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    """(bucket, values with their low bits zero, owner of each)."""
    return (t.column("bucket")[0].as_py(), np.concatenate([unpack6(x) for x in t.column("vals").to_pylist()]),
            unpack_owners(t.column("owners"), t.column("counts")))
