from cohortlink.llm import secrets as sc

from .cases import SCHEMA, clashing, edge_rows, rows, sentence


def corpus(rng):
    out = []
    for i in range(160):
        h = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        word = rng.choice([f'token = "{h}"', f"password={h[:18]}", f"mail.{i}@host{i}.example.com", f"{rng.randrange(10 ** 15, 10 ** 16)}",
                           f"https://site{i}.example.com/a/{i}", f"AKIA{h[:16].upper()}"])
        out.append((i, f"{sentence(rng, 12)} {word} {sentence(rng, 9)}"))
    return out


def test_finds_secrets_and_leaves_the_rest(spark, rng):
    docs = corpus(rng)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sc.scan(df).collect()
    secret = {r.doc_id for r in got if r.is_secret}
    want = {i for i, t in docs if "token =" in t or "password=" in t or "AKIA" in t}
    assert len(secret ^ want) <= 2
    value = {r.doc_id: r.value for r in got if r.is_secret}
    assert all(value[i] in t for i, t in docs if i in value)
    assert all(docs[r.doc_id][1].split()[r.pos].find(r.value) >= 0 for r in got)


def test_labelled_findings_decide(spark, rng):
    df = spark.createDataFrame(corpus(rng), "doc_id long, text string")
    found = sc.features(sc.candidates(df), sc.dictionary(df))
    labelled = found.selectExpr("*", "cast(value like '%@%' as double) as label")
    got = sc.scan(df, labelled).collect()
    assert {r.doc_id for r in got if r.is_secret} == {r.doc_id for r in got if "@" in r.value}
    one = sc.scan(df, labelled.where("label = 0")).collect()
    assert {r.probability for r in one} == {0.0}
    assert {r.probability for r in sc.scan(df, labelled.limit(0)).collect()} == {0.5}


def test_edges(spark, rng):
    df = spark.createDataFrame(edge_rows(rng) + [(20, "key=abc123def456ghi789 key=abc123def456ghi789", None, None, None)], SCHEMA)
    got = rows(sc.scan(clashing(df)))
    assert got == rows(sc.scan(df)) and sum(r[0] == 20 for r in got) == 2
    assert sc.scan(df.limit(0)).count() == 0


def test_values_beside_credential_names_are_candidates(spark, rng):
    plain = ["login password=hunter2x9 today", "my password: Tr0ub4dor now", "set password=CorrectHorseBattery here", 'use "api_key":"zebra" there',
             "the passwd is opensesame ok", "run --token=abc now", "pwd = s3cr3t", "compass hunter2x9 passage", "a secret garden grows"]
    docs = [(1000 + i, t) for i, t in enumerate(plain)]
    df = spark.createDataFrame(corpus(rng) + docs, "doc_id long, text string")
    got = [r for r in sc.scan(df).collect() if r.doc_id >= 1000]
    assert sorted((r.doc_id - 1000, r.value) for r in got) == [
        (0, "hunter2x9"), (1, "Tr0ub4dor"), (2, "CorrectHorseBattery"), (3, "zebra"), (4, "opensesame"), (5, "abc"), (6, "s3cr3t"), (8, "garden")]
    assert {0, 2} <= {r.doc_id - 1000 for r in got if r.is_secret}
