import hashlib

import numpy as np
import pytest

from cohortlink.llm import suffix_dedup as sd

from .cases import SCHEMA, clashing, edge_rows, rows, sentence


def brute(docs, length):
    first, out = {}, []
    for i, t in sorted(docs):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p:p + length], i)
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [50, 23, 12])
def test_equals_brute_force(spark, rng, length):
    passage, docs = sentence(rng, 30), []
    for i in range(60):
        t = sentence(rng, rng.randrange(1, 60))
        if rng.random() < 0.5:
            a = rng.randrange(len(passage) // 2)
            t = t[:20] + passage[a:a + rng.randrange(10, 120)] + t[20:]
        if rng.random() < 0.2:
            t += "ab" * rng.randrange(20, 60) + "x" * rng.randrange(60)
        docs.append((i, t))
    docs += [(100 + i, t) for i, t in rng.sample(docs, 8)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(sd.remove_repeats(df, length, buckets=3, groups=4)) == brute(docs, length)


def test_classes_equal_brute_force():
    rng = np.random.default_rng(2)
    text = np.r_[rng.integers(97, 99, 400), np.full(80, 97), rng.integers(97, 99, 60), np.zeros(120, int)].astype(np.uint8)
    text[200:330] = text[37:167]
    for length in (20, 50):
        start = np.arange(480)
        cls = sd.suffix_classes(text, start, length)
        want = [bytes(text[s:s + length]) for s in start]
        seen = {}
        for c, w in zip(cls.tolist(), want):
            assert seen.setdefault(c, w) == w
        assert len(seen) == len(set(want))


def test_difference_cover():
    for period in (4, 8, 16):
        d = sd.difference_cover(period)
        assert {(a - b) % period for a in d for b in d} == set(range(period))
        shift = sd.cover_shift(period)
        assert all((a + shift[a, b]) % period in d and (b + shift[a, b]) % period in d for a in range(period) for b in range(period))


def test_edges(spark, rng):
    df = spark.createDataFrame(edge_rows(rng), SCHEMA)
    got = rows(sd.remove_repeats(clashing(df)))
    assert got == rows(sd.remove_repeats(df)) and len(got) == 12
    by_id = {r[0]: r for r in got}
    assert by_id[1][2:4] == (0, 0) and by_id[2][1] == by_id[2][2] and by_id[2][3] == 1
    assert by_id[None][1] == by_id[None][2]  # a null id is larger than all
    assert by_id[6][2] == 0  # rows with one id do not remove from one another
    empty = hashlib.sha256(b"").hexdigest()
    assert by_id[3] == (3, 0, 0, 0, empty) and by_id[4][4] == empty
    assert sd.remove_repeats(df.limit(0)).count() == 0
