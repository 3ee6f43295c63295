import itertools
import random

import numpy as np

from cohortlink.llm import toxicity as tx

from .cases import SCHEMA, clashing, edge_rows, rows, sentence


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_brute_force():
    rng = random.Random(4)
    terms = ["abba", "abbab", "babbabab", "aabbaabbaa", "bababababab", "bb", "cab*", "abab*"]
    lex = tx.Lexicon(dict.fromkeys(terms, 1.0))
    whole = [t for t in terms if not t.endswith("*")]
    stems = [t[:-1] for t in terms if t.endswith("*")]
    for n in range(1, 13):
        for _ in range(300):
            w = "".join(rng.choice("abc") for _ in range(n)) if rng.random() < 0.4 else "".join(
                c if rng.random() < 0.85 else rng.choice(["", "a", "b", c + "a"]) for c in rng.choice(whole + [s + "a" for s in stems]))
            if not w:
                continue
            near = sorted((distance(w, t), -len(t), t) for t in whole if distance(w, t) <= tx.edits_allowed(t))
            hit = lex.match(w)
            begins = [s for s in stems if w.startswith(s) and len(w) > len(s)] or [s for s in stems if w == s]
            if near and near[0][0] == 0:
                assert hit[1] == "exact" and lex.terms[hit[0]] == w
            elif begins:
                assert hit[1] == "begins"
            elif near:
                assert hit[1] == "near" and distance(w, lex.terms[hit[0]]) == near[0][0]
            else:
                assert hit is None, (w, hit)


def test_quotation_and_abuse_differ():
    lex = tx.Lexicon(dict.fromkeys(tx.INSULTS, 1.0))
    f = dict(zip(tx.FEATURES, lex.features("You stupid idiot!")))
    q = dict(zip(tx.FEATURES, lex.features('The word "idiot" comes from Greek')))
    m = dict(zip(tx.FEATURES, lex.features("what an idoit and a wortless cloown")))
    assert f["exact"] > 0 and f["attack"] > 0 and f["quoted"] == 0
    assert q["exact"] == 0 and q["quoted"] > 0
    assert m["near"] > 0 and m["exact"] == 0
    assert lex.features(None) == lex.features("") == [0.0] * len(tx.FEATURES)


def labelled(spark, rng, n=600):
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        t = sentence(rng, 40).split()
        if bad:
            for _ in range(4):
                t.insert(rng.randrange(len(t)), rng.choice(["idiot", "stupid", "grakmolo" + rng.choice(["s", "ta", "ren"]), "grakmoloxx"]))
        docs.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_pass_through(spark, rng):
    docs, labels = labelled(spark, rng)
    model = tx.fit(docs, labels)
    out = tx.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert len(out) > 60 and np.mean([r.predicted == r.toxic for r in out]) > 0.97
    full = clashing(docs.selectExpr("doc_id", "text", "'x' as lang", "'y' as source", "1 as n_chars"))
    kept = tx.without_toxic(full, model)
    assert kept.columns == full.columns
    assert {r[0] for r in kept.collect()} == {r.doc_id for r in tx.score(docs, model).where("predicted = 0").collect()}


def test_held_out_labels_are_never_used(spark, rng):
    docs, labels = labelled(spark, rng, 300)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    a, b = tx.fit(docs, labels), tx.fit(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and a.lexicon.terms == b.lexicon.terms


def test_edges(spark, rng):
    df = spark.createDataFrame(edge_rows(rng), SCHEMA)
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (2, None), (1, 0)], "doc_id long, toxic int")
    for l in (labels, labels.limit(0)):
        model = tx.fit(clashing(df), clashing(l))
        got = rows(tx.score(clashing(df), model))
        assert got == rows(tx.score(df, model)) and len(got) == 12 and all(0 <= r[2] <= 1 for r in got)
        assert tx.score(df.limit(0), model).count() == 0
    assert tx.fit(df.limit(0), labels) is not None


def test_terms_are_unique():
    assert all(t == t.lower() for t in itertools.chain(tx.INSULTS, tx.REPORTING, tx.ADDRESS))
