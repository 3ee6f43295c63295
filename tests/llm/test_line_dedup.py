import hashlib

from cohortlink.llm import line_dedup as ld

from .cases import SCHEMA, clashing, edge_rows, rows, sentence


def within_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return len(b) - len(a) <= 1 and a[k + (len(a) == len(b)):] == b[k + 1:]


def brute(docs, equal_chars=ld.MIN_CHARS):
    """Lines go that equal an earlier one (not blank, ``equal_chars`` or longer) or, from MIN_CHARS on, are within one edit of it."""
    first = {}
    for i, t in sorted(docs):
        for p, s in enumerate((t or "").split("\n")):
            if len(s) >= ld.MIN_CHARS or len(s) >= equal_chars and s.strip("\t\n\x0b\x0c\r "):
                first.setdefault(s, (i, p))
    least = {s: min(first[r] for r in first if r == s or min(len(r), len(s)) >= ld.MIN_CHARS and within_one(s, r)) for s in first}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [s for p, s in enumerate(lines) if s not in least or least[s] >= (i, p)]
        text = "\n".join(kept)
        out.append((i, 0 if t is None else len(lines), len(lines) - len(kept), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_equals_brute_force(spark, rng):
    base = [sentence(rng, rng.randrange(3, 30)) for _ in range(25)] + ["é" * 10 + "ü" * 12, "a" * 40, "ab" * 30]
    docs = []
    for i in range(70):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            s = rng.choice(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                p = rng.randrange(len(s) + 1)
                s = rng.choice([s[:p] + "z" + s[p:], s[:max(0, p - 1)] + s[p:], s[:max(0, p - 1)] + "q" + s[p:]])
            lines.append(rng.choice([s, s, sentence(rng, 2), ""]))
        docs.append((i, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = rows(ld.line_summary(df))
    assert got == brute(docs)
    assert sum(r[2] for r in got) > 40


def test_edges(spark, rng):
    df = spark.createDataFrame(edge_rows(rng), SCHEMA)
    assert rows(ld.line_summary(clashing(df))) == rows(ld.line_summary(df))
    full = clashing(df)
    out = ld.dedup_lines(full)
    assert out.columns == full.columns + ["dedup_n_lines", "dedup_n_removed"] and out.count() == 12
    at = {r[0]: r for r in out.collect()}
    assert at[3][1] is None and at[4][1] == "" and at[5][1] == " \n\t "
    assert at[10][1] == "same line again and again here\n" and at[2][1] == ""
    kept = {r[0] for r in ld.dedup_lines(full, drop_emptied=True).collect()}
    assert kept == {1, 3, 4, 5, 6, 7, 8, 9, 10}
    assert ld.line_summary(df.limit(0)).count() == 0


def test_query_drops_equal_short_lines(spark, tmp_path):
    from cohortlink.llm.queries import QUERIES

    long_ = "a line of more than twenty characters"
    docs = [(1, "Les.\n\n" + long_ + "\nLes."), (2, "Les!\n   \nAnd ornd.\n"), (3, "And ornd.\n   \n" + long_ + "s\n短い行です"), (4, "短い行です\nLes!\nLes. ")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(QUERIES["op8_line_dedup"](spark, str(tmp_path)))
    kept = {1: "Les.\n\n" + long_, 2: "Les!\n   \nAnd ornd.\n", 3: "   \n短い行です", 4: "Les. "}
    assert [(r[0], r[2], r[3]) for r in got] == [
        (i, t.count("\n") - kept[i].count("\n"), hashlib.sha256(kept[i].encode()).hexdigest()) for i, t in docs]
