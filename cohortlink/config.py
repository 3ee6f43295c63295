"""Study configuration and the fixed values the rules depend on.

What a study varies (state, term, suffixes, template, as-of date) is passed to the operators;
the fixed values below must stay exactly as they are for results to agree with the established
study rules.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the established rules; do not edit)
# ---------------------------------------------------------------------------

# Grade -> accepted spellings. Lookup uses the normal form (upper, no whitespace).
GRADE_VARIANTS: dict[int, tuple[str, ...]] = {
    1: ("1", "1ST", "ONE", "FIRST", "GRADE 1", "GRADE 01"),
    2: ("2", "2ND", "TWO", "SECOND", "GRADE 2", "GRADE 02"),
    3: ("3", "3RD", "THREE", "THIRD", "GRADE 3", "GRADE 03"),
    4: ("4", "4TH", "FOUR", "FOURTH", "GRADE 4", "GRADE 04"),
    5: ("5", "5TH", "FIVE", "FIFTH", "GRADE 5", "GRADE 05"),
    6: ("6", "6TH", "SIX", "SIXTH", "GRADE 6", "GRADE 06"),
    7: ("7", "7TH", "SEVEN", "SEVENTH", "GRADE 7", "GRADE 07"),
    8: ("8", "8TH", "EIGHT", "EIGHTH", "GRADE 8", "GRADE 08"),
    9: ("9", "9TH", "NINE", "NINTH", "GRADE 9", "GRADE 09"),
    10: ("10", "10TH", "TEN", "TENTH", "GRADE 10"),
    11: ("11", "11TH", "ELEVEN", "ELEVENTH", "GRADE 11"),
    12: ("12", "12TH", "TWELVE", "TWELFTH", "GRADE 12"),
    14: ("K", "KINDERGARTEN", "GRADE K"),
}

# Vendor ethnic group name -> code.
ETHNIC_GROUP_CODES: dict[str, int] = {
    "American Indian or Alaska Native": 1,
    "Asian": 2,
    "Black or African American": 3,
    "Hispanic or Latino": 4,
    "Multi-ethnic": 5,
    "Native Hawaiian or Other Pacific Islander": 6,
    "Not Specified or Other": 7,
    "White": 8,
}

# Vendor subject (measurement scale) code -> subject. Spanish reading is stored as 12 and reported as 7.
SUBJECT_CODES: dict[int, str] = {
    1: "Math",
    2: "Reading",
    3: "Language Usage",
    4: "Science - General Science",
    5: "Science - Concepts and Processes",
    6: "Social Studies",
    7: "Reading - Spanish",
    100: "Algebra 1",
    101: "Algebra 2",
    102: "Geometry",
    103: "Integrated Math 1",
    104: "Integrated Math 1 and 2",
    105: "Integrated Math 2",
    106: "Integrated Math 3",
    107: "Earth and Space Sciences",
    108: "Life Sciences",
    109: "Physical Sciences",
    110: "Earth, Space, and Life Sciences",
}

# Score-column suffixes of the wide partner table.
SCORE_SUFFIXES = ("SS", "PLCODE", "PLDESC", "TESTNAME", "TESTDATE", "RETEST")

# Columns that get an integer *_CLEAN twin, and date columns with a *_CLEAN twin.
INT_CLEAN_COLUMNS = ("D_LOCAL_STID", "D_STATE_STID", "D_AGENCYCODE", "D_SS")
DATE_CLEAN_COLUMNS = ("D_TESTDATE", "D_DOB")

# Provenance columns added at intake (dropped from a file before its column-count check).
PROVENANCE_COLUMNS = ("FILENAMEFROMDISTRICT", "AGENCYCODE")
PROVENANCE_DROP_BEFORE_CHECK = ("AGENCYCODE", "AGENCY_CODE", "FILENAMEFROMDISTRICT")

# Intake statuses and the log layout.
STATUS_WORKING = "WORKING_FILES"
STATUS_REJECTED = "REJECTED_FILES"
STATUS_EDITED_WORKING = "EDITED_WORKING"
STATUS_EDITED_REJECTED = "EDITED_REJECTED"
STATUS_EDITED = "EDITED"
LOG_COLUMNS = ("original_file", "date_ingested", "non_blank_records", "STATUS", "notes", "notes2")

# Flag reasons, in rule order.
FLAG_MISSING_GRADE = "missing_grade"
FLAG_GRADE_NOT_IN_STUDY = "grade_not_in_study"
FLAG_NON_NUMERIC_SS = "non_numeric_SS"
FLAG_INCORRECT_TERM = "incorrect_term"
FLAG_TEST_DATE_OUT_OF_RANGE = "test_date_out_of_range"

# Linkage match labels, best first.
MATCH_PHASES = ("PHASE_1_FULL_ID_NAME_DOB", "PHASE_2_ID_NAME_DOB", "PHASE_3_ID_DOB", "UNMATCHED")
LEGACY_MATCH_TYPES = ("STATE_STID", "LOCAL", "FUZZY", "UNMATCHED")

# Legacy reject reasons.
LEGACY_REJECT_REASONS = ("removed_DOB", "removed_gradeRange", "removed_noScores",
                         "removed_Lname", "removed_Fname")

# pandas' documented default missing-value tokens for text readers.
DEFAULT_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                       "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                       "nan", "null")

# Vendor sentinels for ids that failed to parse (vendor side, partner side).
VENDOR_ID_SENTINEL = -1
PARTNER_ID_SENTINEL = -99

# DOB plausibility window (years between as-of year and birth year).
DOB_MIN_AGE, DOB_MAX_AGE = 4, 25
# Valid test window inside the study year: 1 Feb .. 30 Jun.
TEST_WINDOW_START = (2, 1)
TEST_WINDOW_END = (6, 30)

# Season words and forms that mark a term as not spring.
NON_SPRING_PATTERNS = (
    r"\bFALL\b", r"\bAUTUMN\b", r"\bFA\b", r"\bF\d{2}\b",
    r"\bSUMMER\b", r"\bSUM\b", r"\bSU\b",
    r"\bWINTER\b", r"\bWIN\b", r"\bWI\b", r"\bW\d{2}\b",
)
