"""Typed *_CLEAN columns, the study-settings join, record flags and the split.

The settings table is a study configuration (one row per subject x vendor test) and is broadcast: a
shuffle of the scores by subject would put them into as many tasks as there are subjects, and its size is
unknown to the optimizer when its rows come from the driver. Every flag is a Column expression evaluated in the
same projection, so the long table is scanned once with no shuffle between the file
scan and the flag split.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (DATE_CLEAN_COLUMNS, FLAG_GRADE_NOT_IN_STUDY, FLAG_INCORRECT_TERM,
                      FLAG_MISSING_GRADE, FLAG_NON_NUMERIC_SS, FLAG_TEST_DATE_OUT_OF_RANGE,
                      INT_CLEAN_COLUMNS)
from ..functions.dates import (contradicts, date_text, outside_test_window, parse_partner_date, plausible_dob,
                               study_year, term_reading)
from ..functions.numbers import clean_grade, clean_int, parse_grade_list
from ..functions.text import is_nonblank, rename_with_prefix, strip
from .reshape import place_clean_next_to_originals

# Helper columns of the flag rules, dropped with the rules: what the term text says, and the study's year.
READING, STUDY_YEAR = "D__TERM_READING", "_study_year"


def add_clean_columns(long: DataFrame, as_of: _dt.date, grade_col: str = "D_GRADE",
                      int_cols: Sequence[str] = INT_CLEAN_COLUMNS,
                      date_cols: Sequence[str] = DATE_CLEAN_COLUMNS) -> DataFrame:
    """Add ``X_CLEAN`` (and ``X_DATE`` for dates) next to each source column."""
    new: list[Column] = []
    if grade_col in long.columns:
        new.append(clean_grade(grade_col).alias(f"{grade_col}_CLEAN"))
    for c in int_cols:
        if c in long.columns:
            new.append(clean_int(c).alias(f"{c}_CLEAN"))
    dates = [c for c in date_cols if c in long.columns]
    for c in dates:
        new.append(parse_partner_date(c).alias(f"{c}_DATE"))
    # parse each date once; plausibility and the text form are derived from the parsed column
    out = long.select("*", *new)
    out = out.withColumns({f"{c}_DATE": plausible_dob(f"{c}_DATE", as_of) for c in dates if c.endswith("DOB")})
    out = out.select("*", *[date_text(f"{c}_DATE").alias(f"{c}_CLEAN") for c in dates])
    return place_clean_next_to_originals(out)


def clean_records(wide: DataFrame, as_of: _dt.date, prefix: str = "D_") -> DataFrame:
    """The columns that ``add_clean_columns`` and the term rule derive from columns of the record, on the wide table
    and so once per record instead of once per score; headers get the prefix after the unpivot."""
    out = add_clean_columns(wide, as_of, "GRADE", [c.removeprefix(prefix) for c in INT_CLEAN_COLUMNS],
                            [c.removeprefix(prefix) for c in DATE_CLEAN_COLUMNS])
    return out.withColumn(READING.removeprefix(prefix), term_reading("TERM")) if "TERM" in wide.columns else out


def prepare_settings(settings: DataFrame) -> DataFrame:
    """Trim headers and grade text, prefix ``SETTINGS_``, add the parsed grade list."""
    s = settings.toDF(*[c.strip().upper() for c in settings.columns])
    s = s.withColumn("STUDY_GRADES", strip("STUDY_GRADES"))
    s = s.withColumn("GRADE_LIST", parse_grade_list("STUDY_GRADES"))
    return rename_with_prefix(s, "SETTINGS_")


def subject_grade_union(settings_prefixed: DataFrame) -> DataFrame:
    """Allowed grades per subject = union over all studies of that subject."""
    return (settings_prefixed.groupBy(F.col("SETTINGS_D_SUBJECT").alias("_subj"))
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("SETTINGS_GRADE_LIST"))))
                 .alias("_subject_grades")))


def join_settings(long: DataFrame, settings_prefixed: DataFrame) -> DataFrame:
    """Left join on subject (fan-out to every study of the subject) with a ``_merge``
    indicator: ``both`` (kept) or ``left_only`` (subject not in the study). Long rows stay where they are."""
    s = settings_prefixed.withColumn("_in_settings", F.lit(True)).withColumn(STUDY_YEAR, study_year("SETTINGS_TERM"))
    joined = long.join(F.broadcast(s), long["D_SUBJECT"] == s["SETTINGS_D_SUBJECT"], "left")
    return joined.withColumn("_merge", F.when(F.col("_in_settings"), "both").otherwise("left_only")) \
                 .drop("_in_settings")


def add_flags(merged: DataFrame, settings_prefixed: DataFrame, flag_absurd_dates: bool = False) -> DataFrame:
    """FLAG_REASON over kept rows (subjects in the study; dropped subjects stay null): missing_grade, grade_not_in_study, non_numeric_SS,
    incorrect_term, test_date_out_of_range (in that order)."""
    union = subject_grade_union(settings_prefixed)
    if READING not in merged.columns:
        merged = merged.withColumn(READING, term_reading("D_TERM"))
    if STUDY_YEAR not in merged.columns:
        merged = merged.withColumn(STUDY_YEAR, study_year("SETTINGS_TERM"))
    df = merged.join(F.broadcast(union), merged["D_SUBJECT"] == union["_subj"], "left").drop("_subj")
    grade = F.col("D_GRADE_CLEAN")
    rules = [
        (grade.isNull(), FLAG_MISSING_GRADE),
        (grade.isNotNull() & ~F.coalesce(F.array_contains("_subject_grades", grade), F.lit(False)),
         FLAG_GRADE_NOT_IN_STUDY),
        (is_nonblank("D_SS") & F.col("D_SS_CLEAN").isNull(), FLAG_NON_NUMERIC_SS),
        (contradicts(READING, STUDY_YEAR), FLAG_INCORRECT_TERM),
        (outside_test_window("D_TESTDATE_DATE", STUDY_YEAR, flag_absurd_dates),
         FLAG_TEST_DATE_OUT_OF_RANGE),
    ]
    # Each rule becomes a small boolean once; as the output of a generator it is not computed
    # again by filters on the reason.
    flags = F.struct(*[F.coalesce(cond, F.lit(False)).alias(f"_flag{i}") for i, (cond, _) in enumerate(rules)])
    df = df.select("*", F.inline(F.array(flags)))
    on = [F.col(f"_flag{i}") for i in range(len(rules))]
    reason = F.concat_ws("|", *[F.when(f, F.lit(name)) for f, (_, name) in zip(on, rules)])
    df = df.withColumn("FLAG_REASON", F.when((F.col("_merge") == "both") & reduce(lambda a, b: a | b, on), reason))
    return df.drop("_subject_grades", READING, STUDY_YEAR, *[f"_flag{i}" for i in range(len(rules))])


def grade_allowed(df: DataFrame) -> Column:
    """Grade in *this* study's list."""
    return F.coalesce(F.array_contains("SETTINGS_GRADE_LIST", F.col("D_GRADE_CLEAN")), F.lit(False))


def split_label(df: DataFrame) -> Column:
    """``dropped_subject`` / ``flagged`` / ``kept`` / ``not_allowed`` for each row."""
    return (F.when(F.col("_merge") == "left_only", "dropped_subject")
            .when(F.col("FLAG_REASON").isNotNull(), "flagged")
            .when(grade_allowed(df), "kept")
            .otherwise("not_allowed"))


def split_flagged(flags: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(flagged with reason first, clean-and-allowed, clean-but-not-allowed).
    Persist ``flags`` first when more than one output is written."""
    kept = flags.where(F.col("_merge") == "both")
    flagged = kept.where(F.col("FLAG_REASON").isNotNull())
    flagged = flagged.select("FLAG_REASON", *[c for c in flagged.columns if c not in ("FLAG_REASON", "_merge")])
    clean = kept.where(F.col("FLAG_REASON").isNull()).drop("_merge")
    return flagged, clean.where(grade_allowed(clean)), clean.where(~grade_allowed(clean))
