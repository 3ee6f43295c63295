import hashlib

from cohortlink.llm import winnow as wn

from .cases import SCHEMA, clashing, edge_rows, rows, sentence


def test_windows_and_guarantee(rng):
    for gram, window in ((4, 5), (16, 48), (3, 1)):
        for _ in range(20):
            t = sentence(rng, rng.randrange(1, 40)) + "aaaa" * rng.randrange(12)
            c = wn.codes(t)
            h, pos = wn.winnow(c, gram, window)
            g = min(gram, len(c))
            whole = {p: int(x) for p in range(len(c) - g + 1) for x in wn.winnow(c[p:p + g], g, 1)[0]}
            want = []
            n = len(c) - g + 1
            for a in range(max(1, n - window + 1)):
                span = range(a, min(a + window, n))
                best = max(p for p in span if whole[p] == min(whole[q] for q in span))  # rightmost least
                if not want or want[-1] != best:
                    want.append(best)
            assert pos.tolist() == want and h.tolist() == [whole[p] for p in want]
    common = sentence(rng, 20)[:63]
    a, b = (wn.winnow(wn.codes(sentence(rng, 9) + common + sentence(rng, 9)))[0] for _ in range(2))
    assert set(a.tolist()) & set(b.tolist())


def dice(a, b):
    """Likeness of two texts by definition: both winnowed anew by the larger of their windows."""
    window = max(wn.window_of(len(a)), wn.window_of(len(b))) if a and b else None
    x, y = (set(wn.winnow(wn.codes(t), wn.GRAM, window)[0].tolist()) for t in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def test_coarser_choice_from_the_fingerprint(rng):
    for _ in range(60):
        code = wn.codes("".join(rng.choice("ab ") for _ in range(rng.randrange(1, 400))))
        for small, large in ((1, 2), (1, 48), (4, 16), (8, 9), (16, 48), (48, 4)):
            want = wn.winnow(code, wn.GRAM, max(small, large))[0].tolist()
            assert wn.print_of(code, wn.GRAM, small).by_window(large).tolist() == want


def test_neighbours_and_edits(spark, rng):
    docs = [(i * 7 - 40, sentence(rng, rng.randrange(0, 50)) + ("é😀" if i % 3 else "")) for i in range(90)]
    df = spark.createDataFrame(rng.sample(docs, len(docs)), "doc_id long, text string").repartition(6)
    for ranges in (1, 5, 40):
        got = {r.doc_id: r for r in wn.edited_fingerprints(df, ranges=ranges).collect()}
        assert len(got) == 90
        for k, (i, t) in enumerate(docs):
            nxt = docs[(k + 1) % len(docs)][1]
            half = len(t) // 2
            e = t[:len(t) - half] + nxt[:half]
            r = got[i]
            assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
            for stored, whole in ((r.fingerprint, t), (r.edited_fingerprint, e)):
                hashes, positions = wn.winnow(wn.codes(whole))
                again = wn.read_print(stored)
                assert again.hashes.tolist() == hashes.tolist() and again.positions.tolist() == positions.tolist() and again.text() == stored
            # the likenesses are those of the returned fingerprints, by the definition: Dice by the larger window
            follows = got[docs[(k + 1) % len(docs)][0]].fingerprint
            assert r.near_edited == dice(t, e) == wn.likeness_of(wn.read_print(r.fingerprint), wn.read_print(r.edited_fingerprint))
            assert r.near_next == dice(t, nxt) == wn.likeness_of(wn.read_print(r.fingerprint), wn.read_print(follows))


def test_edges(spark, rng):
    df = spark.createDataFrame(edge_rows(rng), SCHEMA)
    got = rows(wn.edited_fingerprints(clashing(df)))
    assert got == rows(wn.edited_fingerprints(df)) and len(got) == 12
    by_id = {r[0]: r for r in got}
    assert by_id[1][3] == by_id[2][3] == by_id[None][3] and by_id[1][6] == 1.0
    assert by_id[3][1] == 0 and by_id[3][3] == "" and by_id[3][5] == 1.0
    single = wn.edited_fingerprints(df.where("doc_id = 9")).first()
    assert single.near_next == 1.0
    assert wn.edited_fingerprints(df.limit(0)).count() == 0
    assert rows(wn.fingerprints(clashing(df))) == rows(wn.fingerprints(df))


def test_short_edited_texts_stay_alike(spark, rng):
    docs = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rng.choice([rng.randrange(31, 128), rng.randrange(128, 1200)]))))
            for i in range(300)]
    got = wn.edited_fingerprints(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == 300 and all(0 < r.near_edited < 1 for r in got)
    for n in range(31, 1000):  # one text's choices by a larger window are among those by a smaller one
        assert wn.window_of(n) <= wn.window_of(n + 1) <= wn.WINDOW and wn.window_of(n) <= (n + 1) // 2 - wn.GRAM + 1
    long_ = wn.codes(docs[0][1] * 9)
    by = [set(zip(*(x.tolist() for x in wn.winnow(long_, wn.GRAM, w)))) for w in (1, 2, 4, 8, 16, 32, 48)]
    assert all(b <= a for a, b in zip(by, by[1:]))
