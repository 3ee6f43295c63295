"""Older record checks and the district report.

Records are accepted or removed with a reason, in this order: no integer score in any subject;
no scored test whose study grades hold the record's grade (a test without study grades takes any
grade); no last name; no first name. A record without a fitting test is reported as removed only
if no record with the same state id was fit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LEGACY_REJECT_REASONS
from ..functions.dates import parse_partner_date
from ..functions.numbers import try_number

_, REMOVED_GRADE, REMOVED_SCORES, REMOVED_LNAME, REMOVED_FNAME = LEGACY_REJECT_REASONS


def _any(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def checked_records(wide: DataFrame, grades: Mapping[str, Sequence[int]], id_col: str = "STATE_STID") -> DataFrame:
    """``wide`` with ``reasonForRemoval`` first (null: accepted) and scores as integers where
    accepted; records that neither fit nor are reported (see the module's text) are left out.
    ``grades`` maps each score column to the study grades of its test (empty: any grade)."""
    score = {c: try_number(c) for c in grades}
    grade = try_number("GRADE")
    has_score = _any([s.isNotNull() for s in score.values()])
    fit = F.coalesce(_any([score[c].isNotNull() & (grade.isin(list(g)) if g else F.lit(True)) for c, g in grades.items()]), F.lit(False))
    rows = wide.withColumn("_scored", has_score).withColumn("_fit", F.col("_scored") & fit)
    ids = rows.where("_fit").select(F.col(id_col).alias("_id"), F.lit(True).alias("_known")).distinct()
    rows = rows.join(ids, rows[id_col].eqNullSafe(ids["_id"]), "left")
    known = F.coalesce("_known", F.lit(False))
    reason = (F.when(~F.col("_scored"), REMOVED_SCORES).when(~F.col("_fit"), F.when(~known, REMOVED_GRADE).otherwise("_"))
              .when(F.col("LNAME").isNull(), REMOVED_LNAME).when(F.col("FNAME").isNull(), REMOVED_FNAME))
    rows = rows.withColumn("reasonForRemoval", reason).where("reasonForRemoval is null or reasonForRemoval <> '_'")
    kept = [F.when(F.col("reasonForRemoval").isNull(), score[c].cast("bigint").cast("string")).otherwise(F.col(c)).alias(c)
            if c in grades else F.col(c) for c in wide.columns]
    return rows.select("reasonForRemoval", *kept)


def dob_text(c: str) -> Column:
    """Birth date as ``MM-dd-yyyy``; null where the text is no date."""
    return F.date_format(parse_partner_date(c), "MM-dd-yyyy")


def district_report(checked: DataFrame, agency: str = "AGENCYCODE", file: str = "FILENAMEFROMDISTRICT",
                    reasons: Sequence[str] = (REMOVED_GRADE, REMOVED_SCORES, REMOVED_LNAME, REMOVED_FNAME)) -> DataFrame:
    """One row per (agency, file) of accepted or removed records: the agency's accepted records
    and its removed ones per reason (null where it has none)."""
    ok = F.col("reasonForRemoval").isNull()
    counts = checked.groupBy(agency).agg(
        F.count_if(ok).alias("final_counts"), *[F.count_if(F.col("reasonForRemoval") == r).alias(r) for r in reasons])
    counts = counts.select(F.col(agency).alias("_agency"), *[F.nullif(F.col(c), F.lit(0)).alias(c) for c in ("final_counts", *reasons)])
    files = checked.select(agency, file).distinct()
    return files.join(counts, files[agency] == counts["_agency"], "left").drop("_agency").orderBy(file)
