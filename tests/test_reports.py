"""Report sets from one scan, and reports kept up to date file by file."""

import random

from pyspark.sql import functions as F

from cohortlink.operators import counts, legacy_checks, report_set
from cohortlink.operators.partial_reports import PartialReports, flag_report, flag_state, missing_report, missing_state
from cohortlink.plans import queries, roles

from .conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_event_reports_equal_single_reports(spark, tmp_path):
    ev = roles.event_view(spark, SF_SMALL)
    reports = report_set.count_reports(roles.STUDY_SCALE_CODES[:4], roles.STUDY_TEST_NAMES[:9])
    path = report_set.write_event_reports(ev, reports, str(tmp_path), "20250901_120000")
    single = {"total_by_test": counts.counts_total_by_test(ev, roles.STUDY_SCALE_CODES[:4]),
              "by_grade": counts.counts_by_grade(ev, roles.STUDY_TEST_NAMES[:9]), "by_district": counts.counts_by_district(ev, roles.STUDY_TEST_NAMES[:9]),
              "by_district_grade": counts.counts_by_district_grade(ev, roles.STUDY_TEST_NAMES[:9])}
    for r in reports:
        got, want = report_set.read_report(spark, path, r), single[r.name]
        assert sorted(got.columns) == sorted(want.columns) and _rows(got.select(*want.columns)) == _rows(want) and got.count() > 0
    plan = report_set.event_reports(ev, reports)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1  # the source is scanned once


def test_checked_reports(spark, tmp_path):
    queries.checked(spark, SF_SMALL).write.parquet(str(tmp_path / "checked"))
    checked = spark.read.parquet(str(tmp_path / "checked"))
    path = report_set.write_checked_reports(checked, str(tmp_path), "r1", list(roles.LEGACY_GRADES))
    records = spark.read.parquet(f"{path}/records")
    assert _rows(records.where("outcome = 'removed'").select(*checked.columns)) == _rows(checked.where("reasonForRemoval is not null"))
    assert _rows(records.where("outcome = 'accepted'").select(*checked.columns)) == _rows(checked.where("reasonForRemoval is null"))
    assert _rows(spark.read.parquet(f"{path}/district_counts")) == _rows(legacy_checks.district_report(checked))
    assert _rows(spark.read.parquet(f"{path}/tests_by_grade")) == _rows(report_set.tests_by_grade(checked.where("reasonForRemoval is null"), list(roles.LEGACY_GRADES)))


def _file(spark, rng, name, n):
    rows = [(name, rng.choice(["3", "4", None]), rng.choice(["x", " ", None]), rng.choice(["7", ""]), rng.choice(["MATH", "ELA"]),
             rng.choice([None, None, "missing_grade", "incorrect_term"]), "both") for _ in range(n)]
    return spark.createDataFrame(rows, "D_FILENAMEFROMDISTRICT string, GRADE string, A string, B string, D_SUBJECT string, FLAG_REASON string, _merge string")


def test_replaced_files_drop_out(spark, tmp_path):
    rng = random.Random(3)
    files = {n: _file(spark, rng, n, 30) for n in ("a", "b", "c")}
    store = PartialReports(spark, f"file://{tmp_path}/partial")

    def add(batch, delivered, names=None):
        rows = None
        for df in delivered.values():
            rows = df if rows is None else rows.unionByName(df)
        named = spark.createDataFrame([(n,) for n in names or delivered], "file_name string")
        states = {"missing": missing_state(rows, "D_FILENAMEFROMDISTRICT", ["GRADE"], ["A", "B"]), "flags": flag_state(rows, F.col("GRADE") == "3")}
        return store.add(batch, named, states)

    def whole():
        rows = None
        for df in files.values():
            rows = df if rows is None else rows.unionByName(df)
        return rows

    def check():
        rows = whole()
        want = counts.missingness_long(rows, ["GRADE"], columns_to_summarize=["A", "B"])
        assert _rows(missing_report(store, "missing", ["GRADE"])) == _rows(want)
        flagged = {(r.D_SUBJECT, r.FLAG_REASON): r.n for r in rows.where("FLAG_REASON is not null").groupBy("D_SUBJECT", "FLAG_REASON").agg(F.count("*").alias("n")).collect()}
        clean = {r.D_SUBJECT: r.n for r in rows.where("FLAG_REASON is null AND GRADE = '3'").groupBy("D_SUBJECT").agg(F.count("*").alias("n")).collect()}
        got = {(r.D_SUBJECT, r.FLAG_REASON): (r.record_count, r.clean_records) for r in flag_report(store, "flags").collect()}
        assert got == {k: (n, clean.get(k[0])) for k, n in flagged.items()}

    assert add(1, files)
    check()
    delivered = {"b": _file(spark, rng, "b", 11), "d": _file(spark, rng, "d", 17)}  # one replaced, one new: only these are read
    assert add(2, delivered) and not add(2, delivered)
    files.update(delivered)
    check()
    assert add(3, {"e": files["a"].where("false")}, names=["a"])  # the file is delivered without rows
    del files["a"]
    check()
    (tmp_path / "partial" / "_batches" / "b-000000003").unlink()  # as if batch 3 had broken before its marker
    assert store.batches() == [1, 2] and missing_report(store, "missing", ["GRADE"]).count() > 0


def test_flag_summary_deals_a_files_groups_to_many_windows(spark):
    from pyspark.sql import functions as F
    from cohortlink.operators import counts
    names = ["_merge", "FLAG_REASON", "D_FILENAMEFROMDISTRICT", "D_SUBJECT", "D_GRADE", "D_GRADE_CLEAN", "D_SS", "D_TERM", "SETTINGS_TERM", "D_TESTDATE", "D_TESTDATE_CLEAN"]
    rows = [("both", "non_numeric_SS", f, "MATH", "4", 4, f"{i}x", "t", "s", None, None) for f in ("a.csv", None) for i in range(200)]
    rows += [("both", None, f, "MATH", "4", 4, "1", "t", "s", None, None) for f in ("a.csv", None) for _ in range(8)]
    rows += [("both", "missing_grade", "b.csv", None, None, None, "1", "t", "s", None, None), ("left_only", None, "b.csv", None, "4", 4, "1", "t", "s", None, None)]
    flags = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n == 'D_GRADE_CLEAN' else 'string'}" for n in names))
    out = counts.flag_summary(flags, F.lit(True))
    got = sorted((str(r.D_FILENAMEFROMDISTRICT), r.record_count, r.total_partner_subject_records, r.pct_affected_records) for r in out.collect())
    assert got == [("None", 1, 8, 12.5)] * 200 + [("a.csv", 1, 8, 12.5)] * 200 + [("b.csv", 1, None, None)]
    keys = [n for n in out.columns if n != "_salt"]
    assert keys == out.columns and "D_SUBJECT" in keys
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.split("\n") if "Window [" in line)
    assert "_salt" in window  # one window per (file, subject) held all groups of the file


def _odd_events(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["A", None]), "SPRING 1", 1, rng.choice(["X", "Y"]), 6, rng.choice(["T1", "T2", None]), rng.choice([3, 4, None]), rng.choice(["N", "M", None]),
             rng.choice(["1", None]), rng.choice(["s1", "s2", "s3", None]), rng.choice([1, 2, 3, 4, None]), rng.choice([1.0, None]), rng.choice([True, False, None]))
            for _ in range(400)]
    return spark.createDataFrame(rows, "DISTRICT_GEOGRAPHY_NAME string, TERM_NAME string, TERM_NUMBER int, SUBJECT string, MEASUREMENT_SCALE_BID int, TEST_NAME string, "
                                 "GRADE_ORDINAL int, DISTRICT_STANDARD_NAME string, DISTRICT_AGENCY_CODE string, SCHOOL_STANDARD_NAME string, "
                                 "STUDENT_BUSINESS_IDENTIFIER long, ASSESS_SCORE double, GROWTH_EVENT_YN boolean")


def test_event_counts_shuffle_events_once(spark):
    ev = _odd_events(spark)
    reports = report_set.count_reports((6,), ("T1", "T2"))
    for out in (report_set.event_reports(ev, reports), counts.counts_grouping_sets(ev, None)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1 and "Expand" not in plan


def test_event_counts_of_odd_rows(spark):
    """Null keys and ids, against SQL; dealt over salts as well."""
    ev = _odd_events(spark)
    ev.withColumn("GRADE", F.col("GRADE_ORDINAL")).createOrReplaceTempView("odd_events")
    reports = report_set.count_reports((6,), ("T1", "T2"))
    keys = counts.DISTRICT_GRADE_KEYS
    want = []
    for r in reports:
        cols = ", ".join(k if k in r.keys else f"null AS {k}" for k in keys)
        what = ("count(*), null, null", "GROWTH_EVENT_YN") if r.name == "total_by_test" else (
            "null, count(DISTINCT SCHOOL_STANDARD_NAME), count(DISTINCT STUDENT_BUSINESS_IDENTIFIER)", "ASSESS_SCORE IS NOT NULL AND TEST_NAME IS NOT NULL")
        want += _rows(spark.sql(f"SELECT '{r.name}', {cols}, {what[0]} FROM odd_events WHERE {what[1]} GROUP BY {', '.join(r.keys)}"))
    for salts in (1, 5):
        got = report_set.event_reports(ev, reports, salts).select("report", *keys, "test_count", "school_count", "student_count")
        assert _rows(got) == sorted(want, key=repr)
