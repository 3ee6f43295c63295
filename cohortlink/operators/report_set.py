"""Report sets: all reports of a run from one scan of their source.

**Event counts.** Every event is shuffled once, by the keys that all reports have, and counted there in each report whose filter
it passes; the superset of the reports' key columns is null where a report does not use a key. One write partitioned by report
puts them on disk. A report is read back with its own columns only.

**Older record checks.** The checked records are written once, accepted and removed ones as two partitions of one
write; the district counts and the tests by grade are then counted from that written table, so the
source behind the checks is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import clean_grade
from .counts import BASE_KEYS, DISTRICT_GRADE_KEYS, DISTRICT_KEYS, EVENTS, GRADE_KEYS, SCHOOLS, STUDENTS, Report, tally
from .legacy_checks import district_report

def count_reports(scale_codes: Sequence[int], test_names: Sequence[str], state: str | None = None, term: int | None = None) -> list[Report]:
    """The four count reports of a study: growth events by test, and distinct schools and students by grade,
    by district, and by district and grade."""
    scope = F.lit(True)
    if state is not None:
        scope = scope & (F.col("DISTRICT_GEOGRAPHY_NAME") == state)
    if term is not None:
        scope = scope & (F.col("TERM_NUMBER") == F.lit(term))
    growth = scope & F.col("MEASUREMENT_SCALE_BID").isin(list(scale_codes)) & F.col("GROWTH_EVENT_YN")
    scored = scope & F.col("ASSESS_SCORE").isNotNull() & F.col("TEST_NAME").isin(list(test_names))
    distinct = (SCHOOLS, STUDENTS)
    return [Report("total_by_test", tuple(BASE_KEYS), growth, (EVENTS,)), Report("by_grade", tuple(GRADE_KEYS), scored, distinct),
            Report("by_district", tuple(DISTRICT_KEYS), scored, distinct), Report("by_district_grade", tuple(DISTRICT_GRADE_KEYS), scored, distinct)]


def event_reports(ev: DataFrame, reports: Sequence[Report], salts: int = 1) -> DataFrame:
    """All reports in one frame: report, the superset of their keys, the three measures (null where a
    report does not have them). One scan, one shuffle of the events (``counts.tally``, also for ``salts``)."""
    out = tally(ev.withColumn("GRADE", F.col("GRADE_ORDINAL")), reports, salts)

    def used(measure: str) -> Column:
        having = [r.name for r in reports if measure in r.measures]
        return F.col(measure) if len(having) == len(reports) else F.when(F.col("report").isin(having), F.col(measure)).alias(measure)

    return out.select(*[c for c in out.columns if c not in (EVENTS, SCHOOLS, STUDENTS)], *[used(m) for m in (EVENTS, SCHOOLS, STUDENTS)])


def write_event_reports(ev: DataFrame, reports: Sequence[Report], root: str, run: str) -> str:
    """One partitioned write of all reports, below ``root`` in a folder of the run's name (a time stamp);
    returns that folder. A run is complete when its ``_SUCCESS`` marker is there."""
    path = f"{root.rstrip('/')}/run={run}"
    event_reports(ev, reports).repartition("report").write.mode("errorifexists").partitionBy("report").parquet(path)
    return path


def read_report(spark: SparkSession, path: str, report: Report) -> DataFrame:
    """One report of a run, with its own columns, in its order."""
    rows = spark.read.parquet(path).where(F.col("report") == report.name).select(*report.keys, *report.measures)
    first = ["MEASUREMENT_SCALE_BID", F.desc(EVENTS)] if EVENTS in report.measures else ["MEASUREMENT_SCALE_BID", "TEST_NAME"]
    return rows.orderBy(*first, *report.keys)


def write_checked_reports(checked: DataFrame, root: str, run: str, score_cols: Sequence[str]) -> str:
    """The four outputs of the older checks below ``root``/run=<run>: records (partitions outcome=accepted and
    outcome=removed), district_counts and tests_by_grade."""
    path = f"{root.rstrip('/')}/run={run}"
    outcome = F.when(F.col("reasonForRemoval").isNull(), "accepted").otherwise("removed")
    checked.withColumn("outcome", outcome).write.mode("errorifexists").partitionBy("outcome").parquet(f"{path}/records")
    spark = checked.sparkSession
    records = spark.read.schema(T.StructType([*checked.schema.fields, T.StructField("outcome", T.StringType())])).parquet(f"{path}/records")
    district_report(records).write.parquet(f"{path}/district_counts")
    tests_by_grade(records.where("outcome = 'accepted'"), score_cols).write.parquet(f"{path}/tests_by_grade")
    return path


def tests_by_grade(accepted: DataFrame, score_cols: Sequence[str]) -> DataFrame:
    """Scores per grade of the accepted records, one column per subject."""
    return accepted.groupBy(clean_grade("GRADE").alias("GRADE")).agg(*[F.count(c).alias(c) for c in score_cols]).orderBy(F.col("GRADE").asc_nulls_last())
