import numpy as np

from cohortlink.llm import quality as ql
from cohortlink.llm import textkit as tk

from .cases import SCHEMA, clashing, edge_rows, rows, sentence


def labelled(spark, rng, n=500):
    docs, labels = [], []
    for i in range(n):
        t = sentence(rng, rng.randrange(5, 60))
        bad = rng.random() < 0.4
        if bad:
            t = rng.choice([t.upper() + "!!", " ".join(w + "###" for w in t.split()), " ".join(w + " " + w + " " + w for w in t.split())])
        docs.append((i, t))
        labels.append((i, int(not bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(spark, rng):
    docs, labels = labelled(spark, rng)
    out = ql.score(docs, ql.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert len(out) > 100 and np.mean([r.predicted == r.quality for r in out]) > 0.95
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality")
    a, b = ql.fit(docs, labels), ql.fit(docs, flipped)
    assert np.array_equal(a.weight, b.weight) and a.curve == b.curve


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    grams = [np.unique(rng.integers(0, 300, 12)) for _ in range(60)]
    y = np.where([10 in g or 20 in g or (g % 7 == 0).sum() > 2 for g in grams], 1.0, -1.0)
    weight, square, bias = ql.descend(grams, y, epochs=400)
    count = {s: np.full(1 << ql.BITS, ql.ALPHA) for s in (1, -1)}
    for g, s in zip(grams, y):
        count[int(s)][g] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[-1] / count[-1].sum())
    x = np.zeros((60, 301))
    for i, g in enumerate(grams):
        x[i, g] = ratio[g] / np.linalg.norm(ratio[g])
    x[:, 300] = 1
    w = np.r_[np.divide(weight[:300], ratio[:300], out=np.zeros(300), where=ratio[:300] != 0), bias]

    def primal(v):
        return 0.5 * v @ v + ql.PENALTY * np.maximum(0, 1 - y * (x @ v)).sum()
    best = primal(w)
    for _ in range(300):  # convex: no small step improves
        assert primal(w + rng.normal(0, 0.01, 301)) >= best - 1e-3


def test_chunks_do_not_matter():
    import pyarrow as pa
    texts = ["One two two", None, "", "x", "ÄÖ !! a a a a", "word " * 50]
    a = [g for _, b, o in tk.chunks(pa.array(texts)) for g in ql.gram_sets(b, o)]
    z = [g for _, b, o in tk.chunks(pa.array(texts), 4) for g in ql.gram_sets(b, o)]
    assert all(np.array_equal(x, y) for x, y in zip(a, z)) and len(a) == len(z) == 6 and not a[1].any() and not a[2].any()


def test_edges(spark, rng):
    df = spark.createDataFrame(edge_rows(rng), SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 11)] + [(None, 1), (2, None)], "doc_id long, quality int")
    for l in (labels, labels.limit(0), labels.where("quality = 1")):
        model = ql.fit(clashing(df), clashing(l))
        got = rows(ql.score(clashing(df), model))
        assert got == rows(ql.score(df, model)) and len(got) == 12 and all(0 <= r[2] <= 1 for r in got)
        assert ql.score(df.limit(0), model).count() == 0
