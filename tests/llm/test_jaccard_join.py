import random

import numpy as np

from cohortlink.llm import jaccard_join as jj
from cohortlink.llm import textkit as tk

from .cases import SCHEMA, clashing, edge_rows, rows, sentence, shingles


def brute(docs):
    """(doc_id, n, component) by comparing all pairs; docs have distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(sets[i]), find(i)) for i in ids), key=repr)


def edited(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(w)


def corpus(rng):
    docs, passage = [], sentence(rng, 70)
    for _ in range(12):
        base = sentence(rng, rng.choice([6, 9, 15, 40, 120, 400]))
        docs += [base] + [edited(rng, base, rng.randrange(0, 1 + len(base.split()) // 20)) for _ in range(rng.choice([1, 3, 8]))]
    hub = sentence(rng, 90)
    docs += [hub] + [edited(rng, hub, rng.choice([1, 2, 3])) for _ in range(40)]
    docs += [passage + " " + sentence(rng, rng.randrange(5, 90)) for _ in range(60)]
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_equals_brute_force_with_hot_groups(spark, rng):
    docs = corpus(rng)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for group in (2, 12):
        assert rows(jj.jaccard_components(df, group=group)) == brute(docs)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for size in [*range(3, 40), 77, 150, 333, 1000]:
        for _ in range(12):
            pool = rng.choice(2 ** 62, 2 * size, replace=False).astype(np.uint64)
            pool = tk.mix(pool)
            both = -(-75 * size // 100)
            a = np.sort(pool[:size])
            extra = max(0, (100 * both - 75 * size) // 75)
            b = np.sort(np.r_[pool[:both], pool[size:size + extra]])
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 75 * (len(a) + len(b) - shared):
                (x, sx), (y, sy) = jj.signatures(a), jj.signatures(b)
                hit = len(np.intersect1d(x, y))
                assert hit >= 1 and (hit >= min(sx, sy) or min(sx, sy) > 10 ** 6), (size, hit, sx, sy)
            assert jj.sketch_distance(jj.sketch(a).tobytes(), jj.sketch(b).tobytes()) <= len(a) + len(b) - 2 * shared


def test_edges(spark, rng):
    df = spark.createDataFrame(edge_rows(rng), SCHEMA)
    got = rows(jj.jaccard_components(clashing(df)))
    assert got == rows(jj.jaccard_components(df))
    by_id = {r[0]: r for r in got}
    assert len(got) == 12
    assert by_id[1][2] == by_id[2][2] == by_id[None][2] == 1
    assert by_id[7][1:] == (1, 7) and by_id[8][1:] == (1, 7)
    for i in (3, 4, 5):
        assert by_id[i] == (i, 0, i)
    assert jj.jaccard_components(df.limit(0)).count() == 0


def test_word_rules(spark):
    text = "ONE\x0btwo\x1cthree Éa four five"
    df = spark.createDataFrame([(1, text), (2, text.replace("ONE", "one")), (3, text.replace("É", "é"))], "doc_id long, text string")
    assert rows(jj.jaccard_components(df)) == [(1, len(shingles(text)), 1), (2, len(shingles(text)), 1), (3, len(shingles(text)), 3)]


def test_set_keys_and_chunks_agree():
    import pyarrow as pa
    rng = random.Random(1)
    texts = [sentence(rng, rng.randrange(0, 30)) for _ in range(50)] + [None, ""]
    one = [set(s.tolist()) for _, b, o in tk.chunks(pa.array(texts)) for s in tk.shingle_sets(b, o)]
    cut = [set(s.tolist()) for _, b, o in tk.chunks(pa.array(texts), 64) for s in tk.shingle_sets(b, o)]
    assert one == cut and [len(s) for s in one] == [len(shingles(t)) for t in texts]


def test_rows_without_id_are_bridges(spark, rng):
    """Texts that only rows without doc_id hold link like any others, and lead from one document to the next."""
    w = sentence(rng, 60).split()
    texts = [" ".join(w[:60 - cut]) for cut in (0, 9, 18, 26)]
    sets = [shingles(t) for t in texts]

    def linked(a, b):
        return 100 * len(a & b) >= 75 * len(a | b)

    assert [linked(sets[i], sets[i + 1]) for i in range(3)] == [True] * 3 and not linked(sets[0], sets[2]) and not linked(sets[1], sets[3])
    alone = sentence(rng, 40)
    rows_ = [(5, texts[0]), (None, texts[1]), (3, texts[2]), (None, texts[3]), (None, alone), (None, alone), (9, sentence(rng, 30))]
    df = spark.createDataFrame(rows_, "doc_id int, text string")  # narrower ids are taken as well
    got = {}
    for r in jj.jaccard_components(df).collect():
        got.setdefault(r.doc_id, []).append(r.component_id)
    assert got[5] == [3] and got[3] == [3] and sorted(map(str, got[None])) == ["3", "3", "None", "None"]
    ids = spark.createDataFrame([r for r in rows_ if r[0] in (5, 3)], "doc_id int, text string")
    assert {r.component_id for r in jj.jaccard_components(ids).collect()} == {5, 3}  # without the bridge
