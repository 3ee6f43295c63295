"""Roster half of the vendor extract: schools, enrollments, terms and students, and the events
that belong to an enrollment of that student, partner and term.

Filters stand next to the scans they belong to, so they reach the readers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import yyyymm_number
from ..functions.numbers import ethnic_code, scale_code, try_number, vendor_grade
from ..functions.text import upper_trim
from .ranking import ranked

RANK_KEYS = ["student_business_identifier", "term_number", "measurement_scale_bid"]


def included_terms(terms: DataFrame, term_number: int | None = None) -> DataFrame:
    """(partner_id, term_bid, term_number, academic_year_code) of one term number, or of all."""
    if term_number is not None:
        terms = terms.where(F.col("term_number") == term_number)
    year = F.substring("academic_year_name", 1, 4).cast("int").alias("academic_year_code")
    return terms.select("partner_id", "term_bid", "term_number", year)


def included_students(schools: DataFrame, enrollments: DataFrame, terms: DataFrame, students: DataFrame,
                      ethnic_groups: DataFrame) -> DataFrame:
    """One row per primary enrollment of a student in an included school and term. Grade and
    ethnic group are those of the enrollment."""
    e = enrollments.where(F.col("primary_yn")).drop("primary_yn")
    eg = ethnic_groups.select("ethnic_group_id", "ethnic_group_name")
    s = students.select("student_bid", "gender", "name_first", "name_last", "state_student_external_id",
                        "district_student_external_id", "date_of_birth")
    return (e.join(schools.drop("partner_id"), e["organization_bid"] == schools["school_business_identifier"])
            .join(terms, ["partner_id", "term_bid"]).join(s, "student_bid").join(eg, "ethnic_group_id", "left")
            .select("state", "district_business_identifier", "district_standard_name", "district_agency_code", "partner_id",
                    "school_business_identifier", "school_standard_name", "term_number", "term_bid", "academic_year_code",
                    vendor_grade("grade_bid").alias("grade_ordinal"), F.col("student_bid").alias("student_business_identifier"),
                    "ethnic_group_name", ethnic_code("ethnic_group_name").alias("ethnic_group_code"),
                    F.col("gender").alias("student_gender"), upper_trim("name_first").alias("student_first_name"),
                    upper_trim("name_last").alias("student_last_name"),
                    try_number("state_student_external_id").alias("student_state_id"),
                    try_number("district_student_external_id").alias("student_id"), F.col("date_of_birth").alias("dob"),
                    yyyymm_number("date_of_birth").alias("dob_yyyy_mm")))


def term_events(roster: DataFrame, events: DataFrame, courses: DataFrame, tests: DataFrame, content_tests: DataFrame,
                test_names: Sequence[str] | None = None) -> DataFrame:
    """Valid growth events with a score of enrolled students, joined on (student, partner, term),
    with course and test attributes and the score rank per (student, term, scale)."""
    ev = events.where(F.col("valid_event_yn") & F.col("growth_event_yn") & F.col("score").isNotNull())
    t = tests.select("test_id", F.col("name").alias("test_name"), F.col("test_bid").alias("test_key"))
    if test_names is not None:
        t = t.where(F.col("test_name").isin(list(test_names)))
    content = content_tests.select(F.col("test_key").alias("_content_key"), "test_grade_low", "test_grade_high", "language_id")
    number = try_number(F.split_part(F.col("test_key"), F.lit("-"), F.lit(2))).cast("bigint")
    ev = ev.select("test_event_bid", F.col("student_bid").alias("student_business_identifier"), "partner_id", "term_bid",
                   "course_id", "test_id", "score", "standard_error", "event_end_date", "growth_event_yn")
    x = (ev.join(roster, ["student_business_identifier", "partner_id", "term_bid"]).join(courses, "course_id").join(t, "test_id"))
    x = x.join(content, number == F.col("_content_key"), "left")
    x = x.withColumn("test_event_business_identifier", F.col("test_event_bid"))
    x = ranked(x, RANK_KEYS, "score", ["test_event_business_identifier", "school_business_identifier"])
    return x.select(
        "test_event_business_identifier", "state", "district_business_identifier", "district_standard_name",
        "district_agency_code", "school_business_identifier", "school_standard_name", "grade_ordinal",
        "student_business_identifier", "ethnic_group_name", "ethnic_group_code", F.round("score").cast("int").alias("irit"),
        F.col("standard_error").cast("decimal(5,2)").alias("sem"), "test_name", "test_key", "student_gender",
        "student_first_name", "student_last_name", "student_state_id", "student_id",
        scale_code("measurement_scale_bid").alias("measurement_scale_bid"),
        F.col("measurement_scale_bid").alias("measurement_scale_bid_raw"), "subject", "term_number", "test_grade_low",
        "test_grade_high", F.col("event_end_date").alias("testdate"), "language_id", "dob", "dob_yyyy_mm", "score_rank",
        "growth_event_yn")


def view_events_with_roster(events: DataFrame, roster: DataFrame, state: str, term: int,
                            test_names: Sequence[str]) -> DataFrame:
    """Distinct valid scored events of one state and term, of the listed tests and within a
    test's grades, each with every birth date that the roster has for (student, term)."""
    ev = events.where((F.col("term_number") == term) & (F.col("state") == state) & F.col("valid_event_yn")
                      & F.col("score").isNotNull() & F.col("test_name").isin(list(test_names))
                      & F.col("grade_ordinal").between(F.col("test_grade_low"), F.col("test_grade_high")))
    births = roster.where(F.col("term_number") == term).select("student_business_identifier", "term_number",
                                                               F.col("date_of_birth").alias("r_dob")).distinct()
    x = ev.join(births, ["student_business_identifier", "term_number"], "left")
    x = ranked(x, RANK_KEYS, "score", ["test_event_business_identifier", "r_dob"], source=ev.select(*RANK_KEYS)).withColumn("measurement_scale_bid_raw", F.col("measurement_scale_bid"))
    return (x.withColumn("measurement_scale_bid", scale_code("measurement_scale_bid"))
            .drop("valid_event_yn", "growth_event_yn").distinct())
