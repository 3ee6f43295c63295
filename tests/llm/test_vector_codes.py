import hashlib
import math

import numpy as np
import pytest

from cohortlink.llm import vector_codes as vc

from .cases import clashing, rows

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(data, rounds=4):
    """By definition, with Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in data
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    wide = -(-max(len(v) for _, v, _ in kept) // 4)
    parts = [[(v + [0] * (4 * wide - len(v)))[p * wide:(p + 1) * wide] for p in range(4)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:256]
    books = [[parts[k][p] for k in first] for p in range(4)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            at = [near(x[p], books[p])[1] for x in parts]
            for e in set(at):
                own = [x[p] for x, a in zip(parts, at) if a == e]
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = []
    for (i, _, lab), x in zip(kept, parts):
        best = [near(x[p], books[p]) for p in range(4)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), lab))
    total = {}
    for _, _, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    return sorted(((i, c, e, total[lab], sha) for i, c, e, lab in out), key=repr)


def test_nearest_entry_is_exact(rng):
    r = np.random.default_rng(3)
    for k, dims, spread in ((256, 16, 400), (256, 2, 9), (70, 1, 5), (1, 3, 50), (256, 4, 2)):
        book = vc.Codebook(r.integers(-spread, spread + 1, (k, dims)))
        x = r.integers(-2 * spread, 2 * spread + 1, (500, dims))
        d = ((x[:, None, :] - book.entries[None]) ** 2).sum(2)
        for start in (None, r.integers(0, k, len(x))):
            at, far = book.nearest(x, start)
            assert (at == d.argmin(1)).all() and (far == d.min(1)).all()
        cube = np.abs(x[:, None, :] - book.entries[None]).max(2) <= spread
        bits = np.unpackbits(book.inside(x, np.full(len(x), spread)).view(np.uint8), axis=1, bitorder="little")[:, :k]
        assert (bits.astype(bool) == cube).all()


def test_equals_brute_force(spark, rng):
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    data = [(rng.randrange(10**6), [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], rng.choice([1, 2, 3, None])) for _ in range(420)]
    data += [(i, data[0][1], 7) for i in range(10**6, 10**6 + 250)]  # one vector and label hold a third of the rows
    df = spark.createDataFrame(rng.sample(data, len(data)), SCHEMA).repartition(5)
    got = rows(vc.vector_codes(df))
    assert got == brute(data) and len(got) == 670


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    data = [(5, [0.1, -0.2, 0.3, 0.4], 1), (2, None, 1), (3, [], 1), (4, [0.1, None, 0.3, 0.4], 1), (6, [0.1, nan, 0.3, 0.4], 1),
            (7, [0.1, inf, 0.3, 0.4], 1), (8, [-inf, 0.0, 0.3, 0.4], None), (None, [0.5, 0.5, 0.5, 0.5], None), (9, [0.2, 0.1], None),
            (5, [0.1, -0.2, 0.3, 0.4], 1), (5, [0.0, -0.2, 0.3, 0.4], 2), (1, [1.0, 2.0, 3.0, 4.0, 5.0], 2)]
    df = spark.createDataFrame(data, SCHEMA)
    got = rows(vc.vector_codes(df))
    assert got == brute(data) and len(got) == 6
    names = df.withColumnsRenamed({"vec_id": "doc_id", "embedding": "text"})
    named = clashing(names).withColumnsRenamed({"doc_id": "vec_id", "text": "embedding"})
    assert rows(vc.vector_codes(named)) == got
    assert vc.vector_codes(df.limit(0)).count() == 0 == vc.vector_codes(df.where("vec_id = 2")).count()
    assert vc.vector_codes(df.limit(0)).columns == vc.vector_codes(df).columns
    with pytest.raises(Exception, match="do not fit"):
        vc.vector_codes(spark.createDataFrame([(1, [1e9], 1)], SCHEMA)).count()
