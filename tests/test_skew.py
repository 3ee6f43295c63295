"""Hot keys: ranking, salted joins and the factorised older linkage."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlink.operators import legacy_classes, linkage, ranking, skew


def _rank_rows(rng, n):
    rows = []
    for i in range(n):
        key = rng.choice([(1, "a")] * 3 + [(rng.randrange(40), rng.choice(["a", "b", None])) for _ in range(6)])
        score = rng.choice([None, float("nan"), 0.0, -0.0, 5.0, rng.randrange(50) / 2, rng.randrange(50) / 2])
        rows.append((*key, score, i, rng.randrange(3)))
    return rows


def test_rank_of_a_hot_partition(spark):
    rng = random.Random(4)
    df = spark.createDataFrame(_rank_rows(rng, 6000), "student long, term string, score double, event long, tie int").repartition(7)
    df = df.unionByName(df.where("event < 50"))  # some rows equal in every order column
    args = (["student", "term"], "score", ["tie", "event"])
    want = df.withColumn("score_rank", ranking.plain_rank(*args))
    got = ranking.ranked(df, *args, least=100, pieces=8, sample=64)
    assert got.columns == want.columns
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "_before" in plan  # the hot way
    key = ["student", "term", "score", "event", "tie", "score_rank"]
    assert sorted(repr(tuple(r)) for r in got.select(*key).collect()) == sorted(repr(tuple(r)) for r in want.select(*key).collect())
    source = df.select("student", "term")
    assert ranking.ranked(df, *args, source=source, least=100).count() == want.count()
    assert ranking.ranked(df, *args).drop("score_rank").columns == df.columns  # nothing hot: the plain window
    assert ranking.ranked(df.limit(0), *args).count() == 0


def test_no_task_ranks_the_hot_partition(spark):
    """A third of all rows in one partition: it is cut into pieces of about a 1/pieces each, also where scores tie."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("student"), F.lit(5.0).alias("score"), F.col("id").alias("event"))
    hot = skew.hot_hashes(df, skew.key_hash("student"), least=1000)
    assert [r.hot for r in hot.collect()] == [df.where("student = 0").select(F.xxhash64("student").alias("h")).first().h]
    bounds = ranking._boundaries(df, hot, ["student"], "score", ["event"], 16, 2048).first().bounds
    cuts = [b.t0 for b in bounds]
    own = [r.id for r in spark.range(0, 30_000, 3).collect()]
    sizes = [sum(a <= x < b for x in own) for a, b in zip([-1] + cuts, cuts + [10**9])]
    assert len(sizes) == 16 and sum(sizes) == 10_000 and max(sizes) < 1200
    got = ranking.ranked(df, ["student"], "score", ["event"], least=1000, pieces=16)
    assert got.where("student = 0 AND score_rank <> event / 3 + 1").count() == 0


def test_salted_join_equals_join(spark):
    many = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), "id")
    one = many.select("k").distinct().withColumn("v", F.length("k")).where("k <> 'k7'")
    hot = skew.hot_hashes(many, skew.key_hash("k"), least=100)
    assert hot.count() >= 1
    out = skew.salted_join(many, one, ["k"], F.col("id"), hot, salts=16)
    assert sorted(out.select("k", "id", "v").collect()) == sorted(many.join(one, "k").select("k", "id", "v").collect())
    none = skew.hot_hashes(many, skew.key_hash("k"))  # nothing reaches the least size
    assert skew.salted_join(many, one, ["k"], F.col("id"), none.where("hot is null")).count() == out.count()


@pytest.fixture
def sides(spark):
    rng = random.Random(9)

    def pick(*xs):
        return rng.choice([*xs, None])

    partner = [(f"p{i}", rng.choice(["T1", "T2"]), 1 if i < 60 else pick(*range(30)), pick(*range(20)), pick("01", "02"), pick("A", "B"), pick("X", "Y"), pick("2010-01-01", "2011-02-02"))
               for i in range(240)]
    vendor = [(i, i % 50, rng.choice(["T1", "T2", "T3"]), 1 if i < 70 else pick(*range(30)), pick(*range(20)), pick("01", "02"), pick("A", "B"), pick("X", "Y"), pick("2010-01-01", "2011-02-02"))
              for i in range(260)]
    p = spark.createDataFrame(partner, "p_id string, test_name string, state_id int, local_id int, agency_code string, lname string, fname string, dob string")
    v = spark.createDataFrame(vendor, "m_id long, student_business_identifier long, test_name string, student_state_id int, student_id int, district_agency_code string, "
                                      "student_last_name string, student_first_name string, r_dob string")
    keys = ("state_id", "local_id", "student_state_id", "student_id")
    for k in keys:
        p = p.withColumn(k, F.col(k).cast("decimal(38,0)")) if k in p.columns else p
        v = v.withColumn(k, F.col(k).cast("decimal(38,0)")) if k in v.columns else v
    return p.withColumn("dob", F.to_date("dob")), v.withColumn("r_dob", F.to_date("r_dob"))


def test_classes_expand_to_the_pairs(sides):
    partner, vendor = sides
    members = legacy_classes.classes(partner, vendor)
    want = sorted((r.MATCH_TYPE, r.p_id, str(r.m_id)) for r in linkage.link_legacy(partner, vendor).collect())
    assert sorted((r.MATCH_TYPE, r.p_id, r.m_id) for r in legacy_classes.expand(members).collect()) == want
    assert len(want) > 1500 and {w[0] for w in want} == {"STATE_STID", "LOCAL", "FUZZY"}
    assert members.count() <= 3 * (240 + 260)  # linear, though one id makes hundreds of pairs
    sizes = {(r.leg, tuple(r.key)): (r.n_partner, r.n_vendor) for r in members.collect()}
    assert max(a * b for a, b in sizes.values()) > 700


def test_pair_counts_without_pairs(sides):
    partner, vendor = sides
    want = {(r.MATCH_TYPE, r.test_name): r.n for r in linkage.link_legacy(partner, vendor).groupBy("MATCH_TYPE", "test_name").agg(F.count("*").alias("n")).collect()}
    got = legacy_classes.pair_counts(partner, vendor)
    assert {(r.MATCH_TYPE, r.test_name): int(r.pairs) for r in got.collect()} == want
    big = partner.where("state_id = 1").crossJoin(partner.sparkSession.range(1)).limit(1)
    assert legacy_classes.pair_counts(big.limit(0), vendor).count() == 0 == legacy_classes.classes(big.limit(0), vendor).count()
