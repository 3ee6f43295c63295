import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cohortlink.llm import spelling as sp

from .cases import SCHEMA, clashing, edge_rows, rows

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


def noisy(rng, base, times):
    out = []
    for _ in range(times):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            at = rng.randrange(len(w))
            w[at:at + rng.randrange(2)] = rng.choice(["", "a", "é", "B", "ÿ", "e"])
        out.append("".join(w) or "x")
    return out


def test_equals_brute_force(spark, rng):
    base = ["".join(rng.choice("abcdeoàé") for _ in range(rng.randrange(4, 10))) for _ in range(60)]
    base += [b[:3] + b[4:] + "x" for b in base[:20]] + ["a" * 300, "a" * 301, "ab" * 40]
    docs = [(i * 13 - 50, rng.choice([" ", ", ", "×1÷ ", "\n"]).join(noisy(rng, base, rng.randrange(0, 120)))) for i in range(120)]
    docs += [(9999, " ".join(noisy(rng, base[:2], 3000)))]  # one text holds a third of all words
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = brute(docs)
    assert any(r[1] for r in want) and any(r[2] != r[1] and r[1] for r in want)
    for cell, sample in ((8192, 20_000), (12, 200), (5, 40)):  # one cell per length, many, and lengths without sample
        got = rows(sp.spelling_variants(df, cell, sample).select(*COLUMNS))
        assert got == want


def test_cells_give_all_pairs(rng):
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.choice([5, 6]))) for _ in range(900)})
    by = {n: np.array([w.encode("latin-1") for w in words if len(w) == n], f"S{n}") for n in (5, 6)}
    for leaf in (1, 7, 5000):
        cell = sp.Cell(by[6], leaf)
        for n in (5, 6):
            q, t = cell.near(by[n])
            got = {(by[n][i], by[6][j]) for i, j in zip(q, t)}
            assert len(got) == len(q) and got == {(a, b) for a in by[n] for b in by[6] if a != b and one_edit(a.decode("latin-1"), b.decode("latin-1"))}


def test_long_texts_in_steps(rng):
    text = "".join(rng.choice(["word", "Ünït ", " ", "a1b", "xyzzy"]) for _ in range(4000))
    whole = [r for part in sp._runs(text, 1 << 30) for r in part]
    for step in (1, 7, 100):
        assert [r for part in sp._runs(text, step) for r in part] == whole


def test_chains_and_hot_root(spark):
    """Forms are followed to the end, also when one form has a third of all words."""
    words = [("chain" + "a" * i, 3 * 3 ** (12 - i), "chain" + "a" * (i - 1) if i else None) for i in range(12)]
    words += [(f"chain{chr(0xe0 + i % 24)}{i}", 3, "chain") for i in range(500)]
    df = spark.createDataFrame(words, "word string, n long, form string")
    got = {r.word: r.root for r in sp.with_roots(df).collect()}
    assert len(got) == len(words) and set(got.values()) == {"chain"}
    assert sp.with_roots(df.where("form is null")).first().root == "chain"


def test_edges(spark, rng):
    docs = edge_rows(rng)
    df = spark.createDataFrame(docs, SCHEMA)
    got = rows(sp.spelling_variants(df).select(*COLUMNS))
    assert got == brute([(d[0], d[1]) for d in docs]) == rows(sp.spelling_variants(clashing(df)).select(*COLUMNS))
    assert got and sp.spelling_variants(df.limit(0)).count() == 0
    assert sp.spelling_variants(df.withColumn("text", F.lit(None).cast("string"))).count() == 0
    assert rows(sp.spelling_variants(df.withColumn("doc_id", F.col("doc_id").cast("int"))).select(*COLUMNS)) == got
