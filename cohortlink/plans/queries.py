"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame whose columns
match the oracle SQL of the same name (``plans/oracle.py``)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from .. import functions as fx
from ..config import SCORE_SUFFIXES
from ..operators import counts, extract, intake, legacy_checks, legacy_classes, linkage, quality, report_set, reshape, roster, routed, store
from ..operators.merge import MergeTable
from ..session import ensure_checkpoint_dir
from . import roles

Query = Callable[[SparkSession, str], DataFrame]


def q_counts_total_by_test(spark: SparkSession, sf: str) -> DataFrame:
    return counts.counts_total_by_test(roles.event_view(spark, sf), roles.STUDY_SCALE_CODES)


def q_counts_by_grade(spark: SparkSession, sf: str) -> DataFrame:
    return counts.counts_by_grade(roles.event_view(spark, sf), roles.STUDY_TEST_NAMES)


def q_counts_by_district(spark: SparkSession, sf: str) -> DataFrame:
    return counts.counts_by_district(roles.event_view(spark, sf), roles.STUDY_TEST_NAMES)


def q_counts_by_district_grade(spark: SparkSession, sf: str) -> DataFrame:
    return counts.counts_by_district_grade(roles.event_view(spark, sf), roles.STUDY_TEST_NAMES)


def q_counts_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    return counts.counts_grouping_sets(roles.event_view(spark, sf), roles.STUDY_TEST_NAMES)


AS_OF = _dt.date.fromisoformat(roles.STUDY_AS_OF)


def partner_long(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised wide partner table -> long (drop rows without SS), ``D_`` headers."""
    wide = fx.normalize_strings(roles.partner_wide(spark, sf))
    long = reshape.wide_to_long(wide, SCORE_SUFFIXES, drop_rows_missing_ss=True)
    return fx.rename_with_prefix(long, "D_")


def partner_clean(spark: SparkSession, sf: str, saved: Sequence[str] = ()) -> DataFrame:
    """Long rows with clean columns: those of the record are cleaned on the wide table, those of the score on the long one.
    The record's columns ``saved`` are brought into their form for saving, once the others are derived from them."""
    wide = fx.sanitize_columns(quality.clean_records(fx.normalize_strings(roles.partner_wide(spark, sf)), AS_OF), saved)
    long = fx.rename_with_prefix(reshape.wide_to_long(wide, SCORE_SUFFIXES, drop_rows_missing_ss=True), "D_")
    return quality.add_clean_columns(long, AS_OF, grade_col="", int_cols=("D_SS",), date_cols=("D_TESTDATE",))


def partner_flags(spark: SparkSession, sf: str, saved: Sequence[str] = ()) -> DataFrame:
    """Long + clean columns, settings join (fan-out per study) and flags. ``saved``: output columns of the record or the
    settings that are brought into their form for saving before scores and studies repeat them."""
    long = partner_clean(spark, sf, [c.removeprefix("D_") for c in saved])
    s = quality.prepare_settings(roles.settings(spark))
    merged = quality.join_settings(long, fx.sanitize_columns(s, saved))
    return quality.add_flags(merged, s)


def q_wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    return partner_long(spark, sf)


def q_clean_grade(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.normalize_strings(roles.partner_wide(spark, sf))
    return counts.record_counts(wide.withColumn("GRADE_CLEAN", fx.clean_grade("GRADE")),
                                ["GRADE", "GRADE_CLEAN"])


def q_clean_int(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.normalize_strings(roles.partner_wide(spark, sf))
    return wide.select("RECORD_ID", "STATE_STID", fx.clean_int("STATE_STID").alias("STATE_STID_CLEAN"),
                       "LOCAL_STID", fx.clean_int("LOCAL_STID").alias("LOCAL_STID_CLEAN"),
                       fx.clean_int("AGENCYCODE").alias("AGENCYCODE_CLEAN"))


def q_clean_date(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.normalize_strings(roles.partner_wide(spark, sf))
    cols = [F.col("RECORD_ID"), F.col("DOB"),
            fx.date_text(fx.plausible_dob(fx.parse_partner_date("DOB"), AS_OF)).alias("DOB_CLEAN")]
    for _, subj in roles.PARTNER_SUBJECTS:
        c = f"{subj}_TESTDATE"
        cols += [F.col(c), fx.date_text(fx.parse_partner_date(c)).alias(f"{c}_CLEAN")]
    return wide.select(*cols)


FLAG_OUTPUT = ("D_RECORD_ID", "D_SUBJECT", "SETTINGS_VENDOR_TEST_NAME", "D_GRADE", "D_GRADE_CLEAN",
               "D_SS", "D_SS_CLEAN", "D_TERM", "D_TESTDATE", "D_TESTDATE_CLEAN", "D_DOB_CLEAN",
               "D_STATE_STID_CLEAN", "D_LOCAL_STID_CLEAN", "D_AGENCYCODE_CLEAN", "FLAG_REASON")


def q_settings_join_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = partner_flags(spark, sf)
    return flags.select(*FLAG_OUTPUT, fx.list_to_text("SETTINGS_GRADE_LIST").alias("SETTINGS_GRADE_LIST"),
                        quality.split_label(flags).alias("SPLIT"))


def q_flag_summary(spark: SparkSession, sf: str) -> DataFrame:
    flags = partner_flags(spark, sf)
    return counts.flag_summary(flags, quality.grade_allowed(flags))


def q_long_counts_subject_grade(spark: SparkSession, sf: str) -> DataFrame:
    _, clean, _ = quality.split_flagged(partner_flags(spark, sf))
    return counts.record_counts(clean, ["D_SUBJECT", "D_GRADE_CLEAN"])


def q_missingness_by_group(spark: SparkSession, sf: str) -> DataFrame:
    docs = roles.read_table(spark, sf, "documents")
    labels = roles.read_table(spark, sf, "labels")
    df = docs.join(labels, "doc_id", "left")
    return counts.missingness_long(df, ["lang", "source"])


def q_missingness_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.normalize_strings(roles.partner_wide(spark, sf))
    return counts.missingness_long(wide.drop("RECORD_ID"), ["GRADE", "FILENAMEFROMDISTRICT"])


def vendor_extract(spark: SparkSession, sf: str) -> DataFrame:
    schools = extract.included_schools(roles.organization(spark, sf))
    return extract.event_extract(schools, roles.students(spark, sf), roles.ethnic_groups(spark, sf),
                                 roles.vendor_events(spark, sf), roles.tests(spark, sf),
                                 roles.content_tests(spark, sf), roles.STUDY_TEST_NAMES)


def q_event_extract(spark: SparkSession, sf: str) -> DataFrame:
    return vendor_extract(spark, sf)


def q_score_rank(spark: SparkSession, sf: str) -> DataFrame:
    return vendor_extract(spark, sf).select(
        "student_business_identifier", "term_number", "measurement_scale_bid_raw",
        "test_event_business_identifier", "test_key", "irit", "score_rank")


PARTNER_CARRY = ("D_SEX", "D_GRADE_CLEAN", "D_STATE_STID", "D_LOCAL_STID", "D_DOB", "D_FILENAMEFROMDISTRICT")


def linkage_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Partner side = clean, study-allowed long rows with the study's vendor test name;
    vendor side = one test event per order. Both with canonical key columns."""
    _, kept, _ = quality.split_flagged(partner_flags(spark, sf))
    p_id = F.concat_ws("|", "D_RECORD_ID", "D_SUBJECT", "SETTINGS_VENDOR_TEST_NAME")
    partner = kept.select(
        p_id.alias("p_id"),
        *linkage.link_keys(F.col("SETTINGS_VENDOR_TEST_NAME"), F.col("D_STATE_STID_CLEAN").cast("string"),
                           F.col("D_LOCAL_STID_CLEAN").cast("string"), F.col("D_FNAME"), F.col("D_LNAME"),
                           F.col("D_DOB_DATE")),
        *PARTNER_CARRY)
    v = roles.linkage_vendor(spark, sf)
    vendor = v.select(
        "m_id", "student_business_identifier", "test_key",
        *linkage.link_keys(F.col("test_name"), fx.try_number("state_student_external_id").cast("string"),
                           fx.try_number("district_student_external_id").cast("string"),
                           F.col("student_first_name"), F.col("student_last_name"), F.col("r_dob")),
        fx.sentinel_to_null(fx.try_number("state_student_external_id"), -1).alias("M_STATE_STID"),
        fx.sentinel_to_null(fx.try_number("district_student_external_id"), -1).alias("M_LOCAL_STID"),
        F.col("r_dob").alias("R_DOB"), F.col("student_gender").alias("M_SEX"))
    return partner, vendor


def q_link_best(spark: SparkSession, sf: str, in_order: bool = False) -> DataFrame:
    partner, vendor = linkage_inputs(spark, sf)
    best = linkage.link_best(partner, vendor, PARTNER_CARRY, ("M_STATE_STID", "M_LOCAL_STID", "R_DOB", "M_SEX"), in_order=in_order)
    return best.withColumn("SEX", fx.sex_code("D_SEX", "M_SEX")).withColumn("STATE", F.lit("ZZ"))


def q_link_phases(spark: SparkSession, sf: str) -> DataFrame:
    partner, vendor = linkage_inputs(spark, sf)
    return linkage.link_per_event(partner, vendor)


def q_match_rates(spark: SparkSession, sf: str) -> DataFrame:
    return linkage.match_rates(q_link_best(spark, sf), "D_GRADE_CLEAN")


def legacy_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Partner and vendor side of the older linking rule."""
    _, kept, _ = quality.split_flagged(partner_flags(spark, sf))
    partner = kept.select(
        F.concat_ws("|", "D_RECORD_ID", "D_SUBJECT", "SETTINGS_VENDOR_TEST_NAME").alias("p_id"),
        F.col("SETTINGS_VENDOR_TEST_NAME").alias("test_name"),
        F.col("D_STATE_STID_CLEAN").cast("decimal(38,0)").alias("state_id"),
        F.col("D_LOCAL_STID_CLEAN").cast("decimal(38,0)").alias("local_id"),
        F.col("D_AGENCYCODE").alias("agency_code"), F.col("D_LNAME").alias("lname"),
        F.col("D_FNAME").alias("fname"), F.col("D_DOB_DATE").alias("dob"))
    v = roles.linkage_vendor(spark, sf)
    vendor = v.select("m_id", "student_business_identifier", "test_name",
                      fx.try_number("state_student_external_id").alias("student_state_id"),
                      fx.try_number("district_student_external_id").alias("student_id"),
                      "district_agency_code", "student_last_name", "student_first_name", "r_dob")
    return partner, vendor


def q_link_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return linkage.link_legacy(*legacy_inputs(spark, sf))


def q_legacy_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The older rule's classes: one row per member, with the class's size on either side."""
    members = legacy_classes.classes(*legacy_inputs(spark, sf))
    return members.select("leg", F.array_join("key", "|").alias("class_key"), "side", "member_id", "n_partner", "n_vendor")


def q_legacy_pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many pairs the older rule has per match type and test, from the classes' counts."""
    counts_ = legacy_classes.pair_counts(*legacy_inputs(spark, sf))
    return counts_.withColumn("pairs", F.col("pairs").cast("long"))


def q_intake_routing(spark: SparkSession, sf: str) -> DataFrame:
    return intake.file_verdicts(roles.raw_cells(spark, sf), roles.INTAKE_EXPECTED_COLS)


def q_log_upsert(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = intake.file_verdicts(roles.raw_cells(spark, sf), roles.INTAKE_EXPECTED_COLS)
    return intake.upsert_log(roles.prior_log(spark, sf), intake.routing_rows(verdicts, "2025-09-01"))


def q_log_new_files(spark: SparkSession, sf: str) -> DataFrame:
    """Incremental intake: only files the log has not seen, appended to the log."""
    verdicts = intake.file_verdicts(roles.raw_cells(spark, sf), roles.INTAKE_EXPECTED_COLS)
    log = roles.prior_log(spark, sf)
    fresh = intake.new_files(verdicts, log)
    return intake.append_if_missing(log, intake.routing_rows(fresh, "2025-09-01"))


def q_combine_template(spark: SparkSession, sf: str) -> DataFrame:
    return intake.combine_with_template(roles.raw_cells(spark, sf), roles.INTAKE_HEADER)


def q_skip_report(spark: SparkSession, sf: str) -> DataFrame:
    return intake.skip_report(intake.file_verdicts(roles.raw_cells(spark, sf), roles.INTAKE_EXPECTED_COLS, drop_provenance=True))


def q_edited_promotion(spark: SparkSession, sf: str) -> DataFrame:
    """The log after edited copies were checked: each copy has an entry of its own with its status
    (or the place where it already lies), a copy logged before gets the new status only."""
    verdicts = intake.edited_verdicts(roles.edited_cells(spark, sf), roles.INTAKE_EXPECTED_COLS)
    rows = intake.routing_rows(verdicts, "2025-09-01", roles.placed_files(spark, sf))
    return intake.upsert_log(roles.edited_log(spark, sf), rows)


def _order_slice(spark: SparkSession, sf: str, priorities: tuple[str, ...], batch: str) -> DataFrame:
    o = roles.read_table(spark, sf, "orders").where(F.col("o_orderpriority").isin(list(priorities)))
    return o.select("o_orderkey", "o_custkey",
                    F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
                    "o_orderpriority", F.lit(batch).alias("source_file"))


def q_insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    target = _order_slice(spark, sf, ("1-URGENT", "2-HIGH", "3-MEDIUM"), "batch_a.csv")
    staged = _order_slice(spark, sf, ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), "batch_b.csv")
    return store.absent_rows(staged, target, ignore=["source_file"])


def q_reject_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    o = roles.read_table(spark, sf, "orders")
    rejected = o.where(F.col("o_orderstatus") == "F").select("o_custkey").distinct()
    kept = o.where(F.col("o_orderstatus") == "O").select("o_custkey")
    return rejected.join(kept, "o_custkey", "left_anti")


REASONS_BY_PRIORITY = dict(zip(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
                               ("removed_DOB", "removed_gradeRange", "removed_noScores", "removed_Lname",
                                "removed_Fname")))


def q_reason_pivot(spark: SparkSession, sf: str) -> DataFrame:
    o = roles.read_table(spark, sf, "orders")
    c = roles.read_table(spark, sf, "customer")
    m = F.create_map(*[x for kv in REASONS_BY_PRIORITY.items() for x in map(F.lit, kv)])
    removed = o.join(c, o.o_custkey == c.c_custkey).select(
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("AGENCYCODE"),
        F.element_at(m, F.col("o_orderpriority")).alias("reason"))
    reasons = list(REASONS_BY_PRIORITY.values())
    return reshape.reason_pivot(removed, ["AGENCYCODE"], "reason", reasons).na.fill(0, reasons)


def q_tests_by_grade(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.normalize_strings(roles.partner_wide(spark, sf))
    ss = [f"{s}_SS" for _, s in roles.PARTNER_SUBJECTS]
    return wide.groupBy(fx.clean_grade("GRADE").alias("GRADE_CLEAN")).agg(
        *[F.count(c).alias(f"n_{c}") for c in ss])


def q_any_score_export(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.normalize_strings(roles.partner_wide(spark, sf))
    out = wide.where(fx.is_nonblank("MATH_SS") | fx.is_nonblank("ELA_SS"))
    return reshape.drop_existing(out, ["SCI_SS", "SCI_PLCODE", "SCI_TESTDATE", "DOB", "NOT_A_COLUMN"])


def q_agency_code(spark: SparkSession, sf: str) -> DataFrame:
    o = roles.read_table(spark, sf, "orders")
    c = roles.read_table(spark, sf, "customer")
    x = o.join(c, o.o_custkey == c.c_custkey)
    return x.select("o_orderkey", roles.messy_file_name(F.col("o_orderkey"), F.col("c_nationkey")).alias("file_name")) \
            .select("o_orderkey", "file_name", fx.agency_code("file_name").alias("agency_code"),
                    fx.agency_code_legacy("file_name").alias("agency_code_legacy"),
                    fx.is_edited_file("file_name").alias("is_edited"),
                    fx.strip_edited_prefix("file_name").alias("original_name"))


def q_name_key(spark: SparkSession, sf: str) -> DataFrame:
    c = roles.read_table(spark, sf, "customer")
    ck = F.col("c_custkey")
    raw = (F.when(ck % 4 == 0, F.col("c_name")).when(ck % 4 == 1, F.lower("c_name"))
            .when(ck % 4 == 2, F.concat(F.lit("Ann-Lee "), ck.cast("string"))).otherwise(F.upper("c_mktsegment")))
    return c.select("c_custkey", raw.alias("raw_name")).select(
        "c_custkey", "raw_name", fx.name_key("raw_name").alias("name_key"),
        fx.name_key("raw_name", fold_first=True).alias("name_key_folded"))


def q_grade_list_parse(spark: SparkSession, sf: str) -> DataFrame:
    o = roles.read_table(spark, sf, "orders")
    text = roles.grade_list_text(F.col("o_orderkey"), F.col("o_custkey"))
    parsed = o.select("o_orderkey", "o_orderstatus", text.alias("grades_text")).withColumn(
        "grade_list", fx.parse_grade_list("grades_text"))
    per_status = reshape.collect_sorted_sets(parsed, "o_orderstatus", "grade_list", "status_grades")
    return parsed.join(per_status, "o_orderstatus").select(
        "o_orderkey", "o_orderstatus", "grades_text", fx.list_to_text("grade_list").alias("grade_list"),
        fx.list_to_text("status_grades").alias("status_grades"))


def q_counts_subject(spark: SparkSession, sf: str) -> DataFrame:
    _, clean, _ = quality.split_flagged(partner_flags(spark, sf))
    return counts.record_counts(clean, ["D_SUBJECT"])


def q_counts_total_by_test_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return counts.counts_total_by_test(roles.event_view(spark, sf), roles.SOME_SCALES, roles.ONE_STATE, roles.ONE_TERM)


def q_counts_by_grade_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return counts.counts_by_grade(roles.event_view(spark, sf), roles.SOME_TESTS, roles.ONE_STATE, roles.ONE_TERM)


def q_counts_by_district_grade_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return counts.counts_by_district_grade(roles.event_view(spark, sf), roles.SOME_TESTS, roles.ONE_STATE, roles.ONE_TERM)


TERM_STATEMENT = """
SELECT TEST_NAME, GRADE_ORDINAL, count(*) AS test_count, count(DISTINCT STUDENT_BUSINESS_IDENTIFIER) AS student_count
FROM IDENTIFIER(:view)
WHERE TERM_NUMBER = :term AND DISTRICT_GEOGRAPHY_NAME = :state AND array_contains(:tests, TEST_NAME) AND ASSESS_SCORE IS NOT NULL
GROUP BY TEST_NAME, GRADE_ORDINAL"""


def q_term_statement(spark: SparkSession, sf: str) -> DataFrame:
    """A study statement with named parameters and the view's name as one of them."""
    roles.event_view(spark, sf).createOrReplaceTempView("study_event_view")
    return spark.sql(TERM_STATEMENT, args={"view": "study_event_view", "term": roles.ONE_TERM, "state": roles.ONE_STATE,
                                           "tests": list(roles.SOME_TESTS)})


def q_event_extract_term(spark: SparkSession, sf: str) -> DataFrame:
    """The extract of one state and term by enrollment (grade and school of the primary one)."""
    students = roster.included_students(
        extract.included_schools(roles.organization(spark, sf), roles.ONE_STATE), roles.enrollments(spark, sf),
        roster.included_terms(roles.terms(spark, sf), roles.ONE_TERM), roles.students(spark, sf).drop("ethnic_group_id"),
        roles.ethnic_groups(spark, sf))
    return roster.term_events(students, roles.term_vendor_events(spark, sf), roles.courses(spark, sf), roles.tests(spark, sf),
                              roles.content_tests(spark, sf), roles.SOME_TESTS)


def q_event_view_roster(spark: SparkSession, sf: str) -> DataFrame:
    return roster.view_events_with_roster(roles.view_events(spark, sf), roles.student_roster(spark, sf), roles.ONE_STATE,
                                          roles.ONE_TERM, roles.STUDY_TEST_NAMES)


def checked(spark: SparkSession, sf: str) -> DataFrame:
    return legacy_checks.checked_records(fx.normalize_strings(roles.partner_wide(spark, sf)), roles.LEGACY_GRADES)


def q_legacy_checks(spark: SparkSession, sf: str) -> DataFrame:
    return checked(spark, sf).select("reasonForRemoval", "RECORD_ID", "STATE_STID", "GRADE", *roles.LEGACY_GRADES,
                                     legacy_checks.dob_text("DOB").alias("DOB_TEXT"))


def q_district_counts(spark: SparkSession, sf: str) -> DataFrame:
    return legacy_checks.district_report(checked(spark, sf))


def q_merge_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Per grade: partner rows, those linked to a vendor event, and their share."""
    partner, vendor = linkage_inputs(spark, sf)
    best = linkage.link_best(partner, vendor, ("D_GRADE_CLEAN",), ())
    return linkage.merge_rates(partner, best, "D_GRADE_CLEAN")


def q_missingness_by_file(spark: SparkSession, sf: str) -> DataFrame:
    wide = fx.normalize_strings(roles.partner_wide(spark, sf))
    return counts.missingness_long(wide.drop("RECORD_ID"), ["FILENAMEFROMDISTRICT"])


LONG_SUMMARY = ("D_SS", "D_SS_CLEAN", "D_GRADE", "D_TERM", "D_TESTNAME", "D_TESTDATE_CLEAN", "D_DOB_CLEAN", "D_STATE_STID_CLEAN")


def q_missingness_long_table(spark: SparkSession, sf: str) -> DataFrame:
    long = partner_clean(spark, sf)
    return counts.missingness_long(long, ["D_GRADE_CLEAN", "D_FILENAMEFROMDISTRICT"], columns_to_summarize=LONG_SUMMARY)


def q_routed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the working and rejected files."""
    cells = roles.raw_cells(spark, sf)
    return routed.routed_lines(cells, intake.file_verdicts(cells, roles.INTAKE_EXPECTED_COLS))


def q_structure_offenders(spark: SparkSession, sf: str) -> DataFrame:
    return intake.structure_offenders(intake.file_verdicts(roles.raw_cells(spark, sf), roles.INTAKE_EXPECTED_COLS, drop_provenance=True))


def q_merge_insert(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of a stored table after two batches of orders, of which the second is delivered twice
    and then once more under another name."""
    root = f"{ensure_checkpoint_dir(spark)}/merge-{uuid.uuid4().hex}"
    target = _order_slice(spark, sf, ("1-URGENT", "2-HIGH", "3-MEDIUM"), "batch_a.csv")
    staged = _order_slice(spark, sf, ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), "batch_b.csv")
    table = MergeTable(spark, root, target.schema, ignore=["source_file"])
    try:
        for rows, batch in ((target, "a"), (staged, "b"), (staged, "b"), (staged, "c")):
            table.insert(rows, batch)
        return table.read().checkpoint()
    finally:
        table.remove()


def q_subject_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Events per subject of the vendor's code list (null: a code outside it)."""
    ev = roles.event_view(spark, sf)
    return ev.groupBy(fx.subject_name("MEASUREMENT_SCALE_BID").alias("subject"), "TERM_NUMBER").agg(F.count(F.lit(1)).alias("test_count"))


def q_linked_sample(spark: SparkSession, sf: str) -> DataFrame:
    return linkage.linked_sample(q_link_best(spark, sf, in_order=True))


def q_simple_grades(spark: SparkSession, sf: str) -> DataFrame:
    """Grade lists by the older grammar, and per status the sorted grades of all lists that it can read."""
    o = roles.read_table(spark, sf, "orders")
    text = roles.grade_list_text(F.col("o_orderkey"), F.col("o_custkey"))
    parsed = o.select("o_orderkey", "o_orderstatus", text.alias("grades_text")).withColumn("grades", fx.simple_grade_list("grades_text"))
    per_status = reshape.collect_sorted_sets(parsed, "o_orderstatus", "grades", "status_grades")
    return parsed.join(per_status, "o_orderstatus").select(
        "o_orderkey", "o_orderstatus", "grades_text", fx.list_to_text("grades").alias("grades"), fx.list_to_text("status_grades").alias("status_grades"))


# Columns of the saved form that come from the record or the settings.
SAVED_ONCE = ("D_RECORD_ID", "D_GRADE", "D_TERM", "D_LNAME", "D_DISTRICTNAME", "SETTINGS_VENDOR_TEST_NAME", "SETTINGS_GRADE_LIST", "SETTINGS_NOTES")


def q_sanitized_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Flagged and clean long rows in the form in which they are saved."""
    flags = partner_flags(spark, sf, SAVED_ONCE).select(*[c for c in FLAG_OUTPUT if not c.endswith("_CLEAN")], "D_LNAME", "D_DISTRICTNAME",
                                                        "SETTINGS_GRADE_LIST", "SETTINGS_NOTES")
    return fx.sanitize_columns(flags, [c for c in flags.columns if c not in SAVED_ONCE])


def q_report_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names of the files that an order's reports go to: the name with the order's date before the extension."""
    o = roles.read_table(spark, sf, "orders")
    c = roles.read_table(spark, sf, "customer")
    x = o.join(c, o.o_custkey == c.c_custkey)
    name = roles.messy_file_name(F.col("o_orderkey"), F.col("c_nationkey"))
    when = F.timestamp_seconds(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400)
    return x.select("o_orderkey", name.alias("file_name"), when.alias("_when")).select(
        "o_orderkey", "file_name", fx.timestamped_name("file_name", F.col("_when")).alias("report_name"))


def q_event_report_set(spark: SparkSession, sf: str) -> DataFrame:
    """The four count reports of a study in one frame."""
    return report_set.event_reports(roles.event_view(spark, sf), report_set.count_reports(roles.STUDY_SCALE_CODES, roles.STUDY_TEST_NAMES))


def q_legacy_tests_by_grade(spark: SparkSession, sf: str) -> DataFrame:
    return report_set.tests_by_grade(checked(spark, sf).where("reasonForRemoval is null"), list(roles.LEGACY_GRADES))


QUERIES: dict[str, Query] = {
    "counts_total_by_test": q_counts_total_by_test,
    "counts_by_grade": q_counts_by_grade,
    "counts_by_district": q_counts_by_district,
    "counts_by_district_grade": q_counts_by_district_grade,
    "counts_grouping_sets": q_counts_grouping_sets,
    "wide_to_long": q_wide_to_long,
    "clean_grade": q_clean_grade,
    "clean_int": q_clean_int,
    "clean_date": q_clean_date,
    "settings_join_flags": q_settings_join_flags,
    "flag_summary": q_flag_summary,
    "long_counts_subject_grade": q_long_counts_subject_grade,
    "missingness_by_group": q_missingness_by_group,
    "missingness_wide": q_missingness_wide,
    "event_extract": q_event_extract,
    "score_rank": q_score_rank,
    "link_best": q_link_best,
    "link_phases": q_link_phases,
    "match_rates": q_match_rates,
    "link_legacy": q_link_legacy,
    "intake_routing": q_intake_routing,
    "log_upsert": q_log_upsert,
    "log_new_files": q_log_new_files,
    "combine_template": q_combine_template,
    "skip_report": q_skip_report,
    "edited_promotion": q_edited_promotion,
    "insert_if_absent": q_insert_if_absent,
    "reject_antijoin": q_reject_antijoin,
    "reason_pivot": q_reason_pivot,
    "tests_by_grade": q_tests_by_grade,
    "any_score_export": q_any_score_export,
    "agency_code": q_agency_code,
    "name_key": q_name_key,
    "grade_list_parse": q_grade_list_parse,
    "counts_subject": q_counts_subject,
    "counts_total_by_test_filtered": q_counts_total_by_test_filtered,
    "counts_by_grade_filtered": q_counts_by_grade_filtered,
    "counts_by_district_grade_filtered": q_counts_by_district_grade_filtered,
    "term_statement": q_term_statement,
    "event_extract_term": q_event_extract_term,
    "event_view_roster": q_event_view_roster,
    "legacy_checks": q_legacy_checks,
    "district_counts": q_district_counts,
    "merge_rates": q_merge_rates,
    "missingness_by_file": q_missingness_by_file,
    "missingness_long_table": q_missingness_long_table,
    "routed_lines": q_routed_lines,
    "structure_offenders": q_structure_offenders,
    "merge_insert": q_merge_insert,
    "subject_codes": q_subject_codes,
    "linked_sample": q_linked_sample,
    "simple_grades": q_simple_grades,
    "sanitized_flags": q_sanitized_flags,
    "report_names": q_report_names,
    "legacy_classes": q_legacy_classes,
    "legacy_pair_counts": q_legacy_pair_counts,
    "event_report_set": q_event_report_set,
    "legacy_tests_by_grade": q_legacy_tests_by_grade,
}
