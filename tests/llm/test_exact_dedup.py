import hashlib
import re

import pytest

from cohortlink.llm.exact_dedup import DigestIndex, exact_duplicates

from .cases import SCHEMA, clashing, edge_rows, rows, sentence


def brute(docs):
    """(doc_id, keep_id, group_size, kept, sha) per row; of repeated rows one is kept."""
    groups = {}
    for k, (i, t) in enumerate(docs):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append(k)
    out = []
    for norm, own in groups.items():
        keep = min(own, key=lambda k: (-len(docs[k][1] or ""), docs[k][0] is None, docs[k][0] or 0))
        out += [(docs[k][0], docs[keep][0], len(own), k == keep, hashlib.sha256(norm.encode()).hexdigest()) for k in own]
    return sorted(out, key=repr)


def spaced(rng, t):
    return "".join(c + rng.choice(["", "", "", " ", "\n\t", "\x0b\x0c\r"]) for c in t)


def test_equals_brute_force(spark, rng):
    texts = [sentence(rng, rng.randrange(0, 12)) + rng.choice(["", "é😀", " ", " "]) for _ in range(60)]
    docs = [(i * 3 % 1009, spaced(rng, rng.choice(texts))) for i in range(400)] + [(2000 + i, "hot  text") for i in range(200)]
    df = spark.createDataFrame(rng.sample(docs, len(docs)), "doc_id long, text string").repartition(6)
    for buckets in (1, 8, 40):
        assert rows(exact_duplicates(df, buckets)) == brute(docs)


def test_edges(spark, rng):
    docs = edge_rows(rng)
    df = spark.createDataFrame(docs, SCHEMA)
    got = rows(exact_duplicates(df))
    assert got == brute([(d[0], d[1]) for d in docs]) == rows(exact_duplicates(clashing(df)))
    assert sum(r[3] for r in got) == len({r[4] for r in got}) and exact_duplicates(df.limit(0)).count() == 0


def test_index_takes_batches_and_reruns(spark, tmp_path):
    def docs(*pairs):
        return spark.createDataFrame(list(pairs), "doc_id long, text string")

    path = f"file://{tmp_path}/index"
    index = DigestIndex(spark, path, "seen_texts", buckets=4)
    one = docs((1, "a b"), (2, "ab"), (3, "c"))
    two = docs((4, "a  b "), (5, "d"), (6, "d "), (None, None))
    assert [r[:4] for r in rows(index.decide(one, "b1"))] == [(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True)]
    first = [r[:4] for r in rows(index.decide(two, "b2"))]
    assert first == [(4, 1, 1, False), (5, 6, 2, False), (6, 6, 2, True), (None, None, 1, True)]
    assert [r[:4] for r in rows(index.decide(two, "b2"))] == first and index.table().count() == 4  # run again
    assert rows(index.decide(two.limit(0), "b3")) == []
    spark.sql("DROP TABLE seen_texts")  # only the files stay, as for another session
    again = DigestIndex(spark, path, "seen_texts", buckets=99)
    assert again.buckets == 4 and again.table().count() == 4
    again.compact()
    assert {r.batch for r in again.table().select("batch").distinct().collect()} == {"all"}
    assert [r[:4] for r in rows(again.decide(docs((9, "d"), (10, "e")), "b4"))] == [(10, 10, 1, True), (9, 6, 1, False)]
    plan = again.table().select("digest").hint("merge").join(again.table().select("digest", "n"), "digest")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan  # the index does not move
    with pytest.raises(ValueError):
        again.decide(one, "b'1")
    again.drop()
    assert not (tmp_path / "index").exists()
