"""Vendor test-event extract: base tables -> one row per valid growth event with district,
school, student and test attributes, recodes and a per-student score rank.

Filters are written next to the scans they belong to; Catalyst pushes them into the
parquet readers and prunes every column the final projection does not use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import yyyymm_number
from ..functions.numbers import ethnic_code, scale_code, try_number, vendor_grade
from ..functions.text import upper_trim
from .ranking import ranked

EXTRACT_COLUMNS = (
    "test_event_business_identifier", "state", "district_business_identifier", "district_standard_name",
    "district_agency_code", "school_business_identifier", "school_standard_name", "grade_ordinal",
    "student_business_identifier", "ethnic_group_name", "ethnic_group_code", "irit", "sem",
    "test_name", "test_key", "student_gender", "student_first_name", "student_last_name",
    "student_state_id", "student_id", "measurement_scale_bid", "measurement_scale_bid_raw", "subject",
    "term_number", "test_grade_low", "test_grade_high", "testdate", "language_id", "dob", "dob_yyyy_mm",
    "score_rank", "growth_event_yn")


def included_schools(organization: DataFrame, state: str | None = None) -> DataFrame:
    """Districts (optionally of one state) self-joined to their schools on partner id."""
    d = organization.where(F.col("organization_type") == "DISTRICT")
    if state is not None:
        d = d.where(F.col("state") == state)
    d = d.select("state", F.col("organization_bid").alias("district_business_identifier"),
                 F.col("custom_name").alias("district_standard_name"), "partner_id",
                 F.col("district_organization_external_id").alias("district_agency_code"))
    s = organization.where(F.col("organization_type") == "SCHOOL").select(
        F.col("organization_bid").alias("school_business_identifier"),
        F.col("custom_name").alias("school_standard_name"), F.col("partner_id").alias("_pid"))
    return s.join(d, s["_pid"] == d["partner_id"]).drop("_pid")


def event_extract(schools: DataFrame, students: DataFrame, ethnic_groups: DataFrame, events: DataFrame,
                  tests: DataFrame, content_tests: DataFrame, test_names: Sequence[str] | None,
                  term: int | None = None) -> DataFrame:
    """Join events to schools, students, tests and content tests; filter valid growth
    events with a score for the listed tests; recode grade / scale / ethnic group;
    rank scores per (student, term, raw scale), whatever share of the events one of these holds."""
    ev = events.where(F.col("valid_event_yn") & F.col("growth_event_yn") & F.col("score").isNotNull())
    if term is not None:
        ev = ev.where(F.col("term_number") == term)
    t = tests
    if test_names is not None:
        t = t.where(F.col("name").isin(list(test_names)))
    stu = students.join(ethnic_groups, "ethnic_group_id", "left")
    x = (ev.join(schools, ev["school_bid"] == schools["school_business_identifier"])
           .join(stu, ev["student_bid"] == stu["student_bid"])
           .join(t, ev["test_id"] == t["test_id"])
           .drop(stu["student_bid"]).drop(t["test_id"]))
    parsed_key = try_number(F.split_part(F.col("test_bid"), F.lit("-"), F.lit(2))).cast("bigint")
    x = x.join(content_tests, parsed_key == content_tests["test_key"], "left")
    x = x.select(
        F.col("test_event_bid").alias("test_event_business_identifier"),
        "state", "district_business_identifier", "district_standard_name", "district_agency_code",
        "school_business_identifier", "school_standard_name",
        vendor_grade("grade_bid").alias("grade_ordinal"),
        F.col("student_bid").alias("student_business_identifier"),
        "ethnic_group_name", ethnic_code("ethnic_group_name").alias("ethnic_group_code"),
        F.round("score").cast("int").alias("irit"),
        F.col("standard_error").cast("decimal(5,2)").alias("sem"),
        F.col("name").alias("test_name"), F.col("test_bid").alias("test_key"),
        F.col("gender").alias("student_gender"),
        upper_trim("name_first").alias("student_first_name"),
        upper_trim("name_last").alias("student_last_name"),
        try_number("state_student_external_id").alias("student_state_id"),
        try_number("district_student_external_id").alias("student_id"),
        scale_code("measurement_scale_bid").alias("measurement_scale_bid"),
        F.col("measurement_scale_bid").alias("measurement_scale_bid_raw"),
        "subject", "term_number", "test_grade_low", "test_grade_high",
        F.col("event_end_date").alias("testdate"), "language_id",
        F.col("date_of_birth").alias("dob"),
        yyyymm_number("date_of_birth").alias("dob_yyyy_mm"),
        F.col("score").alias("_score"),
        "growth_event_yn")
    keys = ["student_business_identifier", "term_number", "measurement_scale_bid_raw"]
    source = ev.select(F.col("student_bid").alias(keys[0]), keys[1], F.col("measurement_scale_bid").alias(keys[2]))
    order = ["test_event_business_identifier", "test_key", "school_business_identifier", "testdate", "sem"]
    return ranked(x, keys, "_score", order, source=source).select(*EXTRACT_COLUMNS)
