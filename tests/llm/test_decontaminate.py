from cohortlink.llm import decontaminate as dc

from .cases import SCHEMA, clashing, edge_rows, rows, sentence, shingles


def brute(docs, items):
    out = []
    for i, t in docs:
        for j, q in items:
            a, b = shingles(t), shingles(q)
            if b and 100 * len(a & b) >= 75 * len(b):
                out.append((i, j, len(b), len(a & b), len(a & b) / len(b)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark, rng, monkeypatch):
    items = [(j, sentence(rng, rng.choice([2, 5, 7, 20, 21, 60, 150]))) for j in range(30)] + [(30, None), (31, ""), (32, "Once")]
    docs = []
    for i in range(50):
        w = sentence(rng, rng.choice([3, 50, 900])).split()
        for _ in range(rng.randrange(3)):
            q = rng.choice(items[:30])[1].split()
            q[rng.randrange(len(q))] = rng.choice(["changed", q[0]])
            a = rng.randrange(len(w))
            w[a:a] = q
        docs.append((i, " ".join(w).upper() if i % 7 == 0 else " ".join(w)))
    docs += [(60, items[3][1]), (61, "once"), (62, None), (63, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 20
    assert rows(dc.find_items(d, q)) == want
    hit = {r[0] for r in want}
    assert {r.doc_id for r in dc.without_items(d, q).collect()} == {i for i, _ in docs} - hit
    monkeypatch.setattr(dc, "BLOCK_BYTES", 2000)  # several blocks
    assert rows(dc.find_items(d, q)) == want


def test_edges(spark, rng):
    df = spark.createDataFrame(edge_rows(rng), SCHEMA)
    items = df.selectExpr("doc_id as item_id", "text")
    got = rows(dc.find_items(clashing(df), items))
    assert got == rows(dc.find_items(df, items))
    assert {(r[0], r[1]) for r in got} >= {(1, 1), (1, 2), (2, 1), (None, 1), (7, 8), (6, 6)}
    full = clashing(df)
    kept = dc.without_items(full, items.where("item_id = 1"))
    assert kept.columns == full.columns and {r[0] for r in kept.collect()} == {3, 4, 5, 6, 7, 8, 9, 10}
    assert dc.find_items(df.limit(0), items).count() == 0 and dc.find_items(df, items.limit(0)).count() == 0
    assert dc.without_items(df, items.limit(0)).count() == 12


def test_functions_suffice_for_every_size(rng):
    """The MinHash functions of a class miss a match of its smallest item with probability MISS at most."""
    for n in [*range(1, 70), 200, 1000]:
        text = " ".join(f"w{i}" for i in range(n + 4))
        index = dc.ItemIndex([1], [next(s for _, b, o in dc.tk.chunks(dc.pa.array([text])) for s in dc.tk.shingle_sets(b, o))], 75)
        (u, functions, _), = index.classes
        least = 0.75 * n / (2 * u + 0.25 * n)
        assert n <= u < 2 * n and (1 - least) ** len(functions) <= dc.MISS and len(functions) <= 66


def test_items_of_few_shingles(spark, rng):
    items = [(j, sentence(rng, 5 + j % 4)) for j in range(60)]
    docs = []
    for i in range(120):
        w = sentence(rng, rng.choice([0, 40, 400])).split()
        for _ in range(2):
            a = rng.randrange(len(w) + 1)
            w[a:a] = rng.choice(items)[1].split()
        docs.append((i, " ".join(w)))
    want = brute(docs, items)
    assert len(want) > 200
    got = dc.find_items(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == want
