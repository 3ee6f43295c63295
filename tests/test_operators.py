"""Operator tests on small fixtures: intake, stream, reshape, flags, linkage, store."""

import datetime as dt
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from cohortlink import functions as fx
from cohortlink.operators import counts, intake, linkage, quality, reshape, store
from cohortlink.sources.files import read_raw_cells, template_columns
from cohortlink.streaming.intake_stream import batch_handler, start_intake_stream


def _write(folder, name, data: bytes):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)


def _partner_folder():
    d = tempfile.mkdtemp(prefix="cohortlink-files-")
    hdr = "LNAME,FNAME,GRADE,MATH_SS\n"
    _write(d, "North District 0123.csv", (hdr + "Lee,Ann,4,200\nKim,Bo,5,210\n").encode())
    _write(d, "south_45.CSV", (hdr + "Gar\xe7on,Al,3,190\n").encode("cp1252"))
    _write(d, "East-7.csv", ("LNAME,FNAME,GRADE,MATH_SS,EXTRA\nA,B,4,1,x\n").encode())
    _write(d, "empty 5.csv", b"")
    _write(d, "blank rows 9.csv", (hdr + "A,B,4,1\nC,D,5,2\n,,,\n , , , \n,,,\n").encode())
    _write(d, "ragged 10.csv", (hdr + "A,B,4,1,9,9\n").encode())
    _write(d, "bom 11.csv", ("﻿" + hdr + '"Lee\nJr",Ann,4,200\n').encode("utf-8"))
    _write(d, "notes.txt", (hdr + "A,B,4,1\n").encode())
    _write(d, "no_extension", (hdr + "A,B,4,1\n").encode())
    _write(d, "book.xlsx", b"PK\x03\x04\x00\x00")
    _write(d, "gaps 13.csv", ("\n\n" + hdr + "\nA,B,4,1\n\nC,D,5,2\n").encode())
    _write(d, "agency 12.csv", ("LNAME,FNAME,GRADE,MATH_SS,AGENCYCODE\nA,B,4,1,12\n").encode())
    return d


def test_intake_verdicts_and_combine(spark):
    folder = _partner_folder()
    cells = read_raw_cells(spark, folder)
    v = {r["file_name"]: r for r in intake.file_verdicts(cells, 4).collect()}
    assert v["North District 0123.csv"]["STATUS"] == "WORKING_FILES"
    assert v["south_45.CSV"]["STATUS"] == "WORKING_FILES"
    assert v["East-7.csv"]["STATUS"] == "REJECTED_FILES"
    assert v["East-7.csv"]["notes"] == "expected_cols=4; received_cols=5"
    assert v["empty 5.csv"]["read_error"] is not None and v["empty 5.csv"]["STATUS"] is None
    assert v["blank rows 9.csv"]["non_blank_records"] == 2
    assert v["ragged 10.csv"]["read_error"] is not None
    assert v["bom 11.csv"]["non_blank_records"] == 1
    assert v["agency 12.csv"]["STATUS"] == "REJECTED_FILES"  # routing counts every received column
    assert v["notes.txt"]["STATUS"] == "WORKING_FILES" and v["no_extension"]["non_blank_records"] == 1
    assert v["book.xlsx"]["STATUS"] is None and v["book.xlsx"]["read_error"] == "not a text file"
    assert v["gaps 13.csv"]["non_blank_records"] == 2 and v["gaps 13.csv"]["received_cols"] == 4
    assert {r["file_name"] for r in intake.routing_rows(intake.file_verdicts(cells, 4), "d").selectExpr("original_file as file_name").collect()} == v.keys()
    verdicts = intake.file_verdicts(cells, 4, drop_provenance=True)
    combined = intake.combine_with_template(cells, ["LNAME", "FNAME", "GRADE", "MATH_SS"])
    rows = {(r["FILENAMEFROMDISTRICT"], r["LNAME"]): r for r in combined.collect()}
    assert rows[("bom 11.csv", "Lee\nJr")]["AGENCYCODE"] == "11"
    assert rows[("south_45.CSV", "Gar\xe7on")]["AGENCYCODE"] == "45"
    assert rows[("North District 0123.csv", "Lee")]["AGENCYCODE"] == "0123"
    assert not any(f == "East-7.csv" for f, _ in rows) and ("agency 12.csv", "A") in rows
    report = {r["FILE"]: r["REASON"] for r in intake.skip_report(verdicts).collect()}
    assert report == {"East-7.csv": "COL_MISMATCH", "empty 5.csv": "UNREADABLE", "ragged 10.csv": "UNREADABLE",
                      "book.xlsx": "UNREADABLE"}
    assert [r["DETAIL"] for r in intake.skip_report(verdicts).collect() if r["FILE"] == "East-7.csv"] == ["expected 4, got 5"]


def test_log_upsert_idempotent(spark):
    folder = _partner_folder()
    verdicts = intake.file_verdicts(read_raw_cells(spark, folder), 4)
    log0 = spark.createDataFrame([("NORTH DISTRICT 0123.CSV", "2025-01-01", None, "REJECTED_FILES", "old", None)],
                                 intake.LOG_SCHEMA)
    fresh = intake.new_files(verdicts, log0)
    assert "North District 0123.csv" not in [r[0] for r in fresh.select("file_name").collect()]
    log1 = intake.append_if_missing(log0, intake.routing_rows(fresh, "2025-09-01"))
    log2 = intake.append_if_missing(log1, intake.routing_rows(intake.new_files(verdicts, log1), "2025-09-02"))
    assert sorted(log1.collect()) == sorted(log2.collect())  # second run changes nothing
    up = {r["original_file"]: r for r in intake.upsert_log(log0, intake.routing_rows(verdicts, "2025-09-01")).collect()}
    row = up["NORTH DISTRICT 0123.CSV"]
    assert row["date_ingested"] == "2025-01-01" and row["STATUS"] == "WORKING_FILES" and row["notes"] == "old"
    assert up["empty 5.csv"]["STATUS"] is None and up["empty 5.csv"]["date_ingested"] == "2025-09-01"


def test_edited_promotion(spark):
    d = tempfile.mkdtemp(prefix="cohortlink-edited-")
    _write(d, "edited_East-7.csv", b"A,B,C,D\n1,2,3,4\n")
    _write(d, "edited_Bad-8.csv", b"A,B,C\n1,2,3\n")
    v = {r["original_name"]: r["STATUS"] for r in intake.edited_verdicts(read_raw_cells(spark, d), 4).collect()}
    assert v == {"East-7.csv": "EDITED_WORKING", "Bad-8.csv": "EDITED_REJECTED"}


def test_intake_stream_available_now(spark):
    folder = _partner_folder()
    ckpt = tempfile.mkdtemp(prefix="cohortlink-stream-")
    got = []

    def on_log(rows, batch_id):
        got.extend(rows.collect())

    def log():
        return spark.createDataFrame(got, intake.LOG_SCHEMA)

    q = start_intake_stream(spark, folder, ckpt, 4, on_log, "2025-09-01", log)
    q.awaitTermination(120)
    names = {r["original_file"] for r in got}
    assert "North District 0123.csv" in names and "ragged 10.csv" in names  # zero-byte files: batch path only
    q2 = start_intake_stream(spark, folder, ckpt, 4, on_log, "2025-09-01", log)  # restart: nothing new
    q2.awaitTermination(120)
    batch = spark.read.format("binaryFile").load(folder)
    batch_handler(4, on_log, "2025-09-01", log)(batch, 0)  # the batch delivered once more
    assert len(got) == len(names)


def test_case_variants_of_a_name_are_one_file(spark):
    rows = spark.createDataFrame([("b.CSV", "d", "1", "WORKING_FILES", None, None), ("B.csv", "d", "2", "WORKING_FILES", None, None)],
                                 intake.LOG_SCHEMA)
    out = intake.append_if_missing(intake.empty_log(spark), rows).collect()
    assert [r["original_file"] for r in out] == ["B.csv"]
    assert len(intake.upsert_log(intake.empty_log(spark), rows).collect()) == 1


def test_mark_edited(spark):
    log = spark.createDataFrame([("A.csv", "d0", "1", "REJECTED_FILES", "n", None)], intake.LOG_SCHEMA)
    names = spark.createDataFrame([("a.csv",), ("new.csv",)], "file_name string")
    got = {r["original_file"]: (r["date_ingested"], r["STATUS"], r["notes"]) for r in intake.mark_edited(log, names, "d1").collect()}
    assert got == {"A.csv": ("d0", "EDITED", "n"), "new.csv": ("d1", "EDITED", None)}


def test_wide_to_long(spark):
    wide = spark.createDataFrame([("1", "200", " ", "x", None, "7"), ("2", None, None, None, None, None)],
                                 "ID string, MATH_SS string, MATH_PLCODE string, ela_ss string, ELA_TESTDATE string, "
                                 "Reading_Ss string")
    long = reshape.wide_to_long(wide, ["SS", "PLCODE", "TESTDATE"], drop_rows_missing_ss=False)
    rows = sorted((r["ID"], r["SUBJECT"], r["SS"], r["PLCODE"]) for r in long.collect())
    assert rows == [("1", "MATH", "200", None), ("1", "Reading", "7", None), ("1", "ela", "x", None)]
    none = reshape.wide_to_long(spark.createDataFrame([("1",)], "ID string"), ["SS"])
    assert none.collect()[0]["SUBJECT"] is None


def test_flags_and_split_invariant(spark):
    long = spark.createDataFrame([
        ("1", "MATH", "4", "200", "Spring 2025", "03/05/2025", "01/02/2012"),
        ("2", "MATH", "9", "abc", "Fall 2024", "07/05/2025", None),
        ("3", "ELA", "K", "180", "SP25", "03/05/2025", None),
        ("4", "SCI", "4", "1", "2025", "03/05/2025", None),
        ("5", "MATH", None, None, None, None, None),
    ], "D_ID string, D_SUBJECT string, D_GRADE string, D_SS string, D_TERM string, D_TESTDATE string, D_DOB string")
    long = quality.add_clean_columns(long, dt.date(2025, 9, 1))
    settings = quality.prepare_settings(spark.createDataFrame(
        [("MATH", "T1", "3-5", "202502", None), ("MATH", "T2", "6,7 8", "202502", None), ("ELA", "T3", "K-2", "202502", None)],
        "D_SUBJECT string, VENDOR_TEST_NAME string, STUDY_GRADES string, TERM string, NOTES string"))
    flags = quality.add_flags(quality.join_settings(long, settings), settings)
    got = {(r["D_ID"], r["SETTINGS_VENDOR_TEST_NAME"]): (r["FLAG_REASON"], r["s"])
           for r in flags.select("*", quality.split_label(flags).alias("s")).collect()}
    assert got[("1", "T1")] == (None, "kept") and got[("1", "T2")] == (None, "not_allowed")
    assert got[("2", "T1")] == ("grade_not_in_study|non_numeric_SS|incorrect_term|test_date_out_of_range", "flagged")
    assert got[("3", "T3")] == ("grade_not_in_study", "flagged")  # K-2 parses to no grades
    assert got[("4", None)] == (None, "dropped_subject")
    assert got[("5", "T1")][0] == "missing_grade"
    flagged, clean, not_allowed = quality.split_flagged(flags)
    kept_rows = flags.where(F.col("_merge") == "both").count()
    assert flagged.count() + clean.count() + not_allowed.count() == kept_rows
    assert flagged.columns[0] == "FLAG_REASON"


def test_missingness_invariant(spark):
    df = spark.createDataFrame([("a", None, " "), ("a", 1.0, "x"), (None, float("nan"), None)],
                               "g string, v double, t string")
    out = counts.missingness_long(df, ["g"]).collect()
    for r in out:
        assert r["missing_count"] + r["non_missing_count"] == r["total_count"]
    m = {(r["g"], r["col_name"]): r["missing_count"] for r in out}
    assert m[("a", "v")] == 1 and m[("a", "t")] == 1 and m[(None, "v")] == 1


def _naive_or_join(partner, vendor):
    p, v = partner.alias("p"), vendor.alias("v")
    cond = (F.col("p.test_name") == F.col("v.test_name")) & (
        (F.col("p.state_key") == F.col("v.state_key")) | (F.col("p.local_key") == F.col("v.local_key"))
        | (F.col("p.dob") == F.col("v.dob")))
    ids = (F.col("p.state_key") == F.col("v.state_key")) | (F.col("p.local_key") == F.col("v.local_key"))
    names = (F.col("p.fname_key") == F.col("v.fname_key")) & (F.col("p.lname_key") == F.col("v.lname_key"))
    dob = F.col("p.dob") == F.col("v.dob")
    rank = F.when(ids & names & dob, 1).when(ids & dob, 3).otherwise(4)
    pairs = p.join(v, cond).select("v.m_id", "v.student_business_identifier", "v.test_key", "p.p_id",
                                   rank.alias("phase_rank"))
    best = pairs.groupBy("student_business_identifier", "test_key").agg(
        F.min(F.struct("phase_rank", "p_id", "m_id")).alias("b"))
    return {(r["student_business_identifier"], r["test_key"]): (r["b"]["phase_rank"], r["b"]["p_id"], r["b"]["m_id"])
            for r in best.collect()}


def test_linkage_lookups_equal_or_join(spark):
    d1, d2 = dt.date(2012, 1, 1), dt.date(2013, 5, 5)
    praw = [("p1", "T", "11", None, "Ann", "LEE", d1), ("p2", "T", "11", None, "ann", "LEE", d1),
            ("p3", "T", None, "L9", "BO", "KIM", d2), ("p4", "T", None, None, "X", "Y", d2),
            ("p5", "T", " ", "", "BO", "KIM", d2), ("p6", "U", "11", None, "ANN", "LEE", d1),
            ("p0", "T", "11", None, "ANN", "LEE", d2)]
    vraw = [(1, 100, "k1", "T", "11", None, "ANN", "LEE", d1), (2, 100, "k1", "T", "11", "L9", "ANN", "LEE", d2),
            (3, 200, "k2", "T", None, "L9", "BO", "KIM", d2), (4, 300, "k3", "T", None, None, "Q", "R", d2),
            (5, 400, "k4", "T", "99", None, "Q", "R", dt.date(2000, 1, 1))]
    p = spark.createDataFrame(praw, "p_id string, t string, s string, l string, f string, n string, d date")
    v = spark.createDataFrame(vraw, "m_id long, student_business_identifier long, test_key string, t string, "
                                    "s string, l string, f string, n string, d date")
    partner = p.select("p_id", *linkage.link_keys(F.col("t"), F.col("s"), F.col("l"), F.col("f"), F.col("n"), F.col("d")))
    vendor = v.select("m_id", "student_business_identifier", "test_key",
                      *linkage.link_keys(F.col("t"), F.col("s"), F.col("l"), F.col("f"), F.col("n"), F.col("d")))
    fast = {(r["student_business_identifier"], r["test_key"]): (r["MATCH_TYPE"], r["p_id"], r["m_id"])
            for r in linkage.link_best(partner, vendor).collect()}
    naive = _naive_or_join(partner, vendor)
    labels = {1: "PHASE_1_FULL_ID_NAME_DOB", 3: "PHASE_3_ID_DOB", 4: "UNMATCHED"}
    assert fast == {k: (labels[r], p_id, m_id) for k, (r, p_id, m_id) in naive.items()}
    assert fast[(100, "k1")] == ("PHASE_1_FULL_ID_NAME_DOB", "p0", 2)  # least partner id over both events
    assert (400, "k4") not in fast  # no candidate -> no row
    assert all(t != "PHASE_2_ID_NAME_DOB" for t, _, _ in fast.values())


def test_insert_if_absent_null_safe(spark):
    target = spark.createDataFrame([(1, None, "a.csv"), (2, "x", "a.csv")], "k int, v string, f string")
    staged = spark.createDataFrame([(1, None, "b.csv"), (2, "y", "b.csv"), (3, None, "b.csv"), (3, None, "b.csv")],
                                   "k int, v string, f string")
    out = sorted((r["k"], r["v"]) for r in store.absent_rows(staged, target, ignore=["f"]).collect())
    assert out == [(2, "y"), (3, None), (3, None)]


def test_versioned_log_save(spark):
    root = tempfile.mkdtemp(prefix="cohortlink-log-")
    empty = intake.empty_log(spark)
    assert store.load_log(spark, root + "/none", empty).count() == 0
    with pytest.raises(FileNotFoundError):
        store.load_log(spark, root, empty)
    log = spark.createDataFrame([("a.csv", "2025-09-01", "2", "WORKING_FILES", None, None)], intake.LOG_SCHEMA)
    v1 = store.save_log_versioned(log, root)
    assert store.load_log(spark, root, empty).count() == 1
    v2 = store.save_log_versioned(intake.append_if_missing(store.load_log(spark, root, empty), log), root)
    assert v1 < v2 and store.load_log(spark, root, empty).count() == 1
    os.makedirs(os.path.join(root, "v-000000000003"))  # an interrupted save
    assert store.load_log(spark, root, empty).count() == 1
    v4 = store.save_log_versioned(empty, root)
    assert v4.endswith("v-000000000004") and store.load_log(spark, root, empty).count() == 0


def test_table_writers(spark):
    d = tempfile.mkdtemp(prefix="cohortlink-store-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    store.write_parquet(df, f"{d}/t", partition_by=["v"])
    assert spark.read.parquet(f"{d}/t").where("v = 'a'").count() == 1
    store.write_reports({"r1": df, "r2": df.limit(0)}, d)
    assert spark.read.parquet(f"{d}/r1").count() == 2 and spark.read.parquet(f"{d}/r2").columns == ["k", "v"]
    name = f"t_{os.path.basename(d).replace('-', '_')}".lower()
    store.publish_table(df, name, replace=False)
    with pytest.raises(Exception):
        store.publish_table(df, name, replace=False)
    store.publish_table(df.limit(1), name)
    assert spark.table(name).count() == 1
    assert store.insert_if_absent(spark, df, name) == 1 and store.insert_if_absent(spark, df, name) == 0
    assert store.insert_if_absent(spark, df, name + "_new") == 2
    for t in (name, name + "_new"):
        spark.sql(f"DROP TABLE {t}")


def test_column_layout(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, a_CLEAN int, x_CLEAN int")
    assert reshape.place_clean_next_to_originals(df).columns == ["a", "a_CLEAN", "b", "x_CLEAN"]
    assert reshape.move_column(df, "b").columns[-1] == "b" and reshape.move_column(df, "b", "first").columns[0] == "b"
    assert reshape.keep_existing(df, ["b", "zz", "a"]).columns == ["b", "a"]
    got = reshape.score_columns(["MATH_SS", "my_math_ss", "SS", "_SS", "ELA_SS_CONVERTED", "X_TESTDATES"], ["SS", "SS_CONVERTED", "TESTDATE"])
    assert got == {"MATH_SS": ("MATH", "SS"), "my_math_ss": ("my_math", "SS"), "ELA_SS_CONVERTED": ("ELA", "SS_CONVERTED")}


def test_template_header(spark):
    d = tempfile.mkdtemp(prefix="cohortlink-template-")
    _write(d, "t.csv", b" lname ,Grade\n")
    assert template_columns(spark, f"{d}/t.csv") == ["LNAME", "GRADE"]


def test_sentinels_and_gender(spark):
    df = spark.createDataFrame([(-1, "M"), (-99, " female "), (7, None)], "n int, g string")
    got = df.select(fx.sentinel_to_null(F.col("n"), -1, -99).alias("n"), fx.gender_fix("g").alias("g")).collect()
    assert [r["n"] for r in got] == [None, None, 7]


def test_grade_pivot_and_sets(spark):
    df = spark.createDataFrame([("a", [3, 4]), ("a", [4, 5]), ("b", [])], "k string, g array<int>")
    out = {r["k"]: r["s"] for r in reshape.collect_sorted_sets(df, "k", "g", "s").collect()}
    assert out == {"a": [3, 4, 5], "b": []}
    r = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "x")], "a string, reason string")
    p = {row["a"]: (row["x"], row["y"]) for row in reshape.reason_pivot(r, ["a"], "reason", ["x", "y"]).collect()}
    assert p["1"] == (1, 1) and p["2"][0] == 1
    assert fx is not None


def test_planning_starts_no_job(spark):
    from cohortlink.plans import roles
    long = spark.createDataFrame([("1", "MATH", "4", "200", "2025", None, None)],
                                 "D_ID string, D_SUBJECT string, D_GRADE string, D_SS string, D_TERM string, D_TESTDATE string, D_DOB string")
    tracker, group = spark.sparkContext.statusTracker(), "planning"
    spark.sparkContext.setJobGroup(group, "plan only")
    try:
        s = quality.prepare_settings(roles.settings(spark))
        flags = quality.add_flags(quality.join_settings(quality.add_clean_columns(long, dt.date(2025, 9, 1)), s), s)
        counts.record_counts(flags, ["FLAG_REASON"])._jdf.queryExecution().optimizedPlan()
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_flag_summary_reads_and_judges_once(spark):
    from cohortlink.plans.queries import QUERIES
    plan = QUERIES["flag_summary"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linenumber") and sum("Relation [l_" in line for line in plan.split("\n")) == 1
    assert sum("Generate inline" in line for line in plan.split("\n")) == 1


def test_legacy_checks_and_district_report(spark):
    from cohortlink.operators import legacy_checks
    wide = spark.createDataFrame([
        ("1", "s1", "L", "F", "4", "200", None, "01", "a.csv"), ("2", "s2", "L", "F", "9", "200", None, "01", "a.csv"),
        ("3", "s1", "L", "F", "9", "210", None, "01", "a.csv"), ("4", "s4", "L", "F", "4", "x", " ", "02", "b.csv"),
        ("5", None, "L", "F", "4", "7", None, "02", "b.csv"), ("6", None, "L", "F", "11", "7", None, "02", "b.csv"),
        ("7", "s7", None, "F", "zz", None, "5", "03", "c.csv"), ("8", "s8", "L", None, None, None, "5", "03", "c.csv")],
        "RECORD_ID string, STATE_STID string, LNAME string, FNAME string, GRADE string, MATH_SS string, ELA_SS string, "
        "AGENCYCODE string, FILENAMEFROMDISTRICT string")
    out = legacy_checks.checked_records(wide, {"MATH_SS": (3, 4), "ELA_SS": ()})
    got = {r["RECORD_ID"]: r["reasonForRemoval"] for r in out.collect()}
    # 3 and 6 do not fit, but a record with their state id (null included) does: neither accepted nor reported
    assert got == {"1": None, "2": "removed_gradeRange", "4": "removed_noScores", "5": None, "7": "removed_Lname", "8": "removed_Fname"}
    assert out.columns[0] == "reasonForRemoval"
    rep = {r["AGENCYCODE"]: r for r in legacy_checks.district_report(out).collect()}
    assert rep["01"]["final_counts"] == 1 and rep["01"]["removed_gradeRange"] == 1 and rep["01"]["removed_noScores"] is None
    assert rep["03"]["final_counts"] is None and rep["03"]["removed_Fname"] == 1


def test_roster_takes_the_enrollment_of_the_term(spark):
    from cohortlink.operators import roster
    d = dt.date(2012, 1, 1)
    schools = spark.createDataFrame([("ZZ", 1, "D", "p", "0001", 10, "S10"), ("ZZ", 1, "D", "p", "0001", 11, "S11")],
                                    "state string, district_business_identifier long, district_standard_name string, partner_id string, "
                                    "district_agency_code string, school_business_identifier long, school_standard_name string")
    enr = spark.createDataFrame([(1, 10, "p", 1, 4, 0, True), (1, 11, "p", 2, 5, 0, True), (1, 11, "p", 1, 9, 0, False), (1, 10, "q", 1, 7, 0, True)],
                                "student_bid long, organization_bid long, partner_id string, term_bid long, grade_bid int, ethnic_group_id long, primary_yn boolean")
    terms = spark.createDataFrame([("p", 1, 2025, "2024-2025"), ("p", 2, 2026, "2025-2026")], "partner_id string, term_bid long, term_number int, academic_year_name string")
    stu = spark.createDataFrame([(1, "F", " a", "b", "7", "8", d)], "student_bid long, gender string, name_first string, name_last string, "
                                "state_student_external_id string, district_student_external_id string, date_of_birth date")
    eg = spark.createDataFrame([(0, "White")], "ethnic_group_id long, ethnic_group_name string")
    out = roster.included_students(schools, enr, roster.included_terms(terms), stu, eg)
    got = sorted((r["term_number"], r["school_standard_name"], r["grade_ordinal"], r["academic_year_code"]) for r in out.collect())
    assert got == [(2025, "S10", 4, 2024), (2026, "S11", 5, 2025)]  # not the second, non-primary school; not the other partner
    assert roster.included_students(schools, enr, roster.included_terms(terms, 2026), stu, eg).count() == 1
    ev = spark.createDataFrame([("ZZ", 2025, 1, "T", 5, 3, 8, 200.0, 12, True, True, 77), ("ZZ", 2025, 1, "T", 9, 3, 8, 210.0, 12, True, True, 78)],
                               "state string, term_number int, student_business_identifier long, test_name string, grade_ordinal int, test_grade_low int, "
                               "test_grade_high int, score double, measurement_scale_bid int, valid_event_yn boolean, growth_event_yn boolean, "
                               "test_event_business_identifier long")
    births = spark.createDataFrame([(1, 2025, d), (1, 2025, d), (1, 2025, dt.date(2013, 1, 1))], "student_business_identifier long, term_number int, date_of_birth date")
    v = roster.view_events_with_roster(ev, births, "ZZ", 2025, ["T"]).collect()
    assert sorted((r["test_event_business_identifier"], r["r_dob"].year, r["measurement_scale_bid"]) for r in v) == [(77, 2012, 7), (77, 2013, 7)]


def test_structure_gate(spark):
    folder = _partner_folder()
    cells = read_raw_cells(spark, folder)
    verdicts = intake.file_verdicts(cells, 4, drop_provenance=True)
    got = {(r.file_name, r.problem): r.detail for r in intake.structure_offenders(verdicts).collect()}
    assert got[("East-7.csv", "COL_MISMATCH")] == "expected 4, got 5" and ("notes.txt", "NO_DISTRICT_CODE") in got
    assert {f for f, p in got if p == "UNREADABLE"} == {"empty 5.csv", "ragged 10.csv", "book.xlsx"}
    with pytest.raises(intake.FileStructureError) as e:
        intake.combine_strict(cells, ["LNAME", "FNAME", "GRADE", "MATH_SS"])
    assert all(f in str(e.value) for f, _ in got)  # every offender is named
    good = cells.where(F.col("file_name").isin("North District 0123.csv", "agency 12.csv"))
    rows = {(r.FILENAMEFROMDISTRICT, r.LNAME, r.AGENCYCODE) for r in intake.combine_strict(good, ["LNAME", "FNAME", "GRADE", "MATH_SS"]).collect()}
    assert rows == {("North District 0123.csv", "Lee", "0123"), ("North District 0123.csv", "Kim", "0123"), ("agency 12.csv", "A", "12")}


def test_settings_source(spark, tmp_path):
    from cohortlink.sources.settings import SETTINGS_COLUMNS, read_settings
    p = tmp_path / "settings.csv"
    p.write_text(' d_subject , VENDOR_TEST_NAME,Study_Grades,TERM, extra\nMATH, T 1 ,"3, 4",202502,x\n,,,,\nELA,T2, ,202502,\n')
    got = read_settings(spark, str(p))
    assert got.columns == list(SETTINGS_COLUMNS) and {d for _, d in got.dtypes} == {"string"}
    assert sorted(map(tuple, got.collect())) == [("ELA", "T2", None, "202502", None), ("MATH", "T 1", "3, 4", "202502", None)]
    got.write.parquet(str(tmp_path / "s.parquet"))
    assert sorted(read_settings(spark, str(tmp_path / "s.parquet")).collect()) == sorted(got.collect())
    assert quality.prepare_settings(got).where("SETTINGS_D_SUBJECT = 'MATH'").first()["SETTINGS_GRADE_LIST"] == [3, 4]
    p.write_text("D_SUBJECT,TERM\nMATH,202502\n")
    with pytest.raises(ValueError, match="VENDOR_TEST_NAME"):
        read_settings(spark, str(p))


def test_linked_sample_order(spark):
    rows = [(i * 7 % 50, f"k{i % 3}", i) for i in range(200)] + [(None, "a", 1)]
    got = [(r[0], r[1]) for r in linkage.linked_sample(spark.createDataFrame(rows, "student_business_identifier int, test_key string, x int").repartition(9)).collect()]
    assert got == sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_link_keys_are_built_in_generated_code(spark):
    """Rows with missing keys give no lookup, and no lambda runs per row on the vendor side or for pair counts."""
    from cohortlink.operators import legacy_classes
    cols = "id int, test_name string, state_key string, local_key string, fname_key string, lname_key string, dob date"
    rows = [(1, "T", "1", None, "A", "B", None), (2, None, "1", "2", "A", "B", None), (3, "T", None, None, "A", "B", None)]
    df = spark.createDataFrame(rows, cols)
    p, v = df.withColumnRenamed("id", "p_id"), df.withColumnRenamed("id", "m_id")
    cands = linkage.phase_candidates(p, v, ["m_id"])
    assert [(r.m_id, r.phase_rank, r.p.p_id) for r in cands.collect()] == [(1, 4, 1)]
    assert "lambda" not in linkage.phase_candidates(p, v, ["m_id"])._jdf.queryExecution().optimizedPlan().toString()
    part = spark.createDataFrame([(1, "T", "7", None, "a", "l", "f", None), (2, "T", "7", "8", "a", "l", "f", None)],
                                 "p_id int, test_name string, state_id string, local_id string, agency_code string, lname string, fname string, dob date")
    vend = spark.createDataFrame([(1, "T", "7", "8", "a", "l", "f", None), (2, "T", None, "8", "a", "l", "f", None)],
                                 "m_id int, test_name string, student_state_id string, student_id string, district_agency_code string, "
                                 "student_last_name string, student_first_name string, r_dob date")
    out = legacy_classes.pair_counts(part, vend)
    assert {r.MATCH_TYPE: int(r.pairs) for r in out.collect()} == {"STATE_STID": 2, "LOCAL": 1}
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_unpivot_leaves_out_unused_suffixes(spark):
    """score columns that a query does not use are not carried through the unpivot."""
    wide = spark.createDataFrame([("1", "5", " ", "t", None), ("2", None, "9", "u", "v")], "ID string, M_SS string, `a. {b}_SS` string, M_TESTNAME string, `a. {b}_TESTNAME` string")
    long = reshape.wide_to_long(wide, ("SS", "TESTNAME"), drop_rows_missing_ss=True)
    assert sorted(map(tuple, long.collect())) == [("1", "M", "5", "t"), ("2", "a. {b}", "9", "v")]
    plan = _plan(long.select("ID", "SS").where("SS <> '5'"))
    assert "Expand" in plan and "TESTNAME AS" not in plan and "struct" not in plan
    one = reshape.wide_to_long(wide.select("ID", "M_SS"), ("SS",))
    assert [tuple(r) for r in one.collect()] == [("1", "M", "5")]


def test_saved_form_of_repeated_columns_is_made_once(spark):
    """text of the record and the settings is trimmed before scores and studies repeat it."""
    from cohortlink.plans import queries as q
    plan = _plan(q.q_sanitized_flags(spark, "/root/testdata/sf0.001"))
    top, below = plan.split("Expand", 1)
    assert "regexp_replace(D_SS" in top and "regexp_replace(D_RECORD_ID" not in top and "regexp_replace(D_TERM" not in top
    assert "array_join" not in top.split("Join", 1)[0] and "regexp_replace(RECORD_ID" in below


def test_partner_lines_meet_orders_with_their_students(spark):
    """the wide rows are joined by order only, not shuffled once more by student."""
    from cohortlink.plans import roles
    plan = _plan(roles.partner_wide(spark, "/root/testdata/sf0.001"))
    assert plan.index("l_orderkey#") < plan.index("o_custkey#") and plan.index("= o_orderkey#") < plan.index("= c_custkey#")


def test_sanitize_trims_like_strip(spark):
    texts = [None, "", " ", "a", " a", "a ", "a b", "\ta\n", " a ", "~", "~x ", "é", "é　", "a ", "!\x85", "a\x1f", "0"] + [f" {i} " for i in range(3)]
    df = spark.createDataFrame([(t,) * 7 + (i,) for i, t in enumerate(texts)], ", ".join(f"t{k} string" for k in range(7)) + ", n int")
    got = fx.sanitize_columns(df).select(*[f"t{k}" for k in range(7)]).collect()
    want = [r.s for r in df.select("n", fx.strip("t0").alias("s")).orderBy("n").collect()]
    assert [tuple(r) for r in got] == [(w,) * 7 for w in want]
    part = fx.sanitize_columns(df, ["t1"]).collect()
    assert [(r.t0, r.t1) for r in part] == list(zip(texts, want))


def test_grade_and_term_of_odd_texts(spark):
    grades = {"4": 4, "04": 4, " 4 ": 4, "4.0": 4, "4.5": None, "4\n": 4, "1e1": 10, "0": None, "13": None, "14": 14, "000000004": 4, "0000000004": 4,
              "99999999999": None, "K": 14, "kg": None, " grade 0 4 ": 4, "1ST": 1, "-4": None, "+4": 4, "": None, " ": None, " 7": 7, "1 2": 12, "e": None}
    df = spark.createDataFrame([(g,) for g in grades] + [(None,)], "g string")
    assert [r.c for r in df.select(fx.clean_grade("g").alias("c")).collect()] == [*grades.values(), None]
    terms = spark.createDataFrame([(" fall 2025\n",), (" 25",), (" 2024-25 ",), (None,), ("  ",)], "t string").select(fx.term_reading("t").alias("r"))
    assert [r.r and (r.r.season, r.r.four, r.r.two) for r in terms.collect()] == [(True, [2025], []), (False, [], [25]), (False, [2024], [25]), None, (False, [], [])]
