"""Linkage on big tables: scores are not shuffled by subject, vendor rows without a partner key are not shuffled,
partner lookups are made once, and the ordered sample is shuffled once."""

import datetime as dt

from pyspark.sql import functions as F

from cohortlink.operators import linkage, quality, reshape, sieve
from cohortlink.operators.skew import key_hash

D = dt.date(2012, 1, 1)


def _run(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_scores_are_not_shuffled_by_subject(spark):
    """The rows of the settings come from the driver, so the optimizer does not know how few they are."""
    long = spark.createDataFrame([(str(i), s, "4", "200", None, None, None) for i in range(20) for s in ("MATH", "ELA", "SCI", None)],
                                 "D_ID string, D_SUBJECT string, D_GRADE string, D_SS string, D_TERM string, D_TESTDATE string, D_DOB string")
    s = quality.prepare_settings(spark.createDataFrame([("MATH", "T1", "3-5", "202502", None), ("MATH", "T2", "6", "202502", None), ("ELA", "T3", "4", "202502", None)],
                                                       "D_SUBJECT string, VENDOR_TEST_NAME string, STUDY_GRADES string, TERM string, NOTES string"))
    flags = quality.add_flags(quality.join_settings(quality.add_clean_columns(long, dt.date(2025, 9, 1)), s), s)
    first = flags._jdf.queryExecution().executedPlan().toString()
    assert first.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in first
    n = {(r.D_SUBJECT, r.SETTINGS_VENDOR_TEST_NAME, r._merge): r["count"]
         for r in flags.groupBy("D_SUBJECT", "SETTINGS_VENDOR_TEST_NAME", "_merge").count().collect()}
    assert n == {("MATH", "T1", "both"): 20, ("MATH", "T2", "both"): 20, ("ELA", "T3", "both"): 20,
                 ("SCI", None, "left_only"): 20, (None, None, "left_only"): 20}


def test_sieve_keeps_every_key_that_is_there(spark):
    key = F.struct(F.concat(F.lit("k"), F.col("id").cast("string")).alias("t"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("n"))
    rows = spark.range(20_000).select("id", key.alias("key")).repartition(5)
    keys = rows.where("id % 40 = 7").unionByName(rows.where("id % 40 = 7"))  # every key twice
    bits = sieve.key_bits(keys, key_hash("key"))
    got = sieve.sift(rows.unionByName(rows), key_hash("key"), bits)
    assert got.columns == ["id", "key"]
    ids = [r.id for r in got.collect()]
    assert sorted(i for i in ids if i % 40 == 7) == sorted([*range(7, 20_000, 40)] * 2)
    assert len(ids) < 1_020  # some of the others may share a bit
    assert sieve.sift(rows, key_hash("key"), sieve.key_bits(keys.limit(0), key_hash("key"))).count() == 0


def test_sieve_on_full_bits(spark, monkeypatch):
    """Few bits for many keys: nearly everything passes, nothing is lost."""
    monkeypatch.setattr(sieve, "PLACES", 1 << 11)
    rows = spark.range(5_000).select("id", (F.col("id") - 2_500).alias("key"))
    bits = sieve.key_bits(rows.where("id % 2 = 0"), key_hash("key"))
    assert bits.count() == 2
    ids = {r.id for r in sieve.sift(rows, key_hash("key"), bits).collect()}
    assert ids >= set(range(0, 5_000, 2))


def _sides(spark):
    wide = spark.createDataFrame([(f"r{i}", "T", str(i), None, "ANN", f"L{i}", D, "5", "6") for i in range(30)],
                                 "RECORD_ID string, t string, s string, l string, f string, n string, d date, MATH_SS string, ELA_SS string")
    long = reshape.wide_to_long(wide, ["SS"])
    keys = linkage.link_keys(*[F.col(c) for c in "tslfnd"])
    partner = long.select(F.concat_ws("|", "RECORD_ID", "SUBJECT").alias("p_id"), *keys, F.col("SS").alias("carried"))
    v = spark.createDataFrame([(i, i % 400, f"k{i % 3}", "T", str(i % 400), str(i), "ANN", f"L{i}", D + dt.timedelta(days=i)) for i in range(1, 2_000)],
                              "m_id long, student_business_identifier long, test_key string, t string, s string, l string, f string, n string, d date")
    return partner, v.select("m_id", "student_business_identifier", "test_key", *keys).repartition(4)


def test_partner_lookups_are_made_once(spark):
    partner, vendor = _sides(spark)
    rows, plan = _run(linkage.phase_candidates(partner, vendor, ["m_id"], ["carried"]))
    assert {(r.m_id, r.p.p_id) for r in rows} == {(i, f"r{i % 400}|ELA") for i in range(1, 2_000) if i % 400 < 30}
    assert "_words" in plan  # the vendor side is sifted
    assert plan.count("Expand [") == 1 and "ReusedExchange" in plan  # by the lookups that the join reads


def test_linked_sample_is_shuffled_once(spark):
    partner, vendor = _sides(spark)
    vendor = vendor.unionByName(vendor.where("m_id < 40").withColumn("student_business_identifier", F.lit(None).cast("long")))
    rows, plan = _run(linkage.linked_sample(linkage.link_best(partner, vendor, ["carried"], in_order=True)))
    assert plan.count("rangepartitioning(") == 1 and "hashpartitioning(student" not in plan
    order = [(r.student_business_identifier is None, r.student_business_identifier or 0, r.test_key) for r in rows]
    assert order == sorted(order) and len(set(order)) == len(order)
    assert sorted(map(repr, rows)) == sorted(map(repr, linkage.link_best(partner, vendor, ["carried"]).collect()))
