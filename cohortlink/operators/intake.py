"""File intake: per-file verdicts, routing, the ingest log and the template combine.

Per-file facts come from one aggregation of the raw-cells frame grouped by file (partial
aggregation map-side; a file is at most a few million rows). The log is a small table
keyed by lower-cased file name; its updates are joins, never driver loops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (LOG_COLUMNS, PROVENANCE_DROP_BEFORE_CHECK, STATUS_EDITED_REJECTED,
                      STATUS_EDITED_WORKING, STATUS_REJECTED, STATUS_WORKING, STATUS_EDITED)
from ..functions.text import BLANK_RE, agency_code, agency_code_legacy, blank_to_null, is_edited_file, strip_edited_prefix

LOG_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in LOG_COLUMNS])


def _nonblank_cell(c: Column) -> Column:
    return c.isNotNull() & ~c.rlike(BLANK_RE)


def _kept_header() -> Column:
    """Per header cell, whether it is not a provenance column."""
    drop = [c.upper() for c in PROVENANCE_DROP_BEFORE_CHECK]
    return F.transform("cells", lambda h: ~F.coalesce(F.upper(F.trim(h)).isin(drop), F.lit(False)))


def file_verdicts(cells: DataFrame, expected_cols: int, working: str = STATUS_WORKING,
                  rejected: str = STATUS_REJECTED, drop_provenance: bool = False) -> DataFrame:
    """One row per file: received column count, non-blank record count, status and the mismatch
    note; unreadable files keep only their read error. Routing counts every received column;
    ``drop_provenance`` leaves the provenance columns out (the combine's own count).

    Each row is first reduced to its width, whether it holds anything, and its error if it has one, so that one
    aggregation over small rows is all: the files are decoded once and cells never move."""
    width = F.size(F.filter(_kept_header(), lambda k: k)) if drop_provenance else F.size("cells")
    small = cells.select(
        "file_name", F.when(F.col("row_idx") == 0, width).alias("w"),
        F.when((F.col("row_idx") > 0) & F.exists("cells", _nonblank_cell), 1).otherwise(0).alias("nb"), "read_error")
    per_file = small.groupBy("file_name").agg(
        F.max("w").alias("received_cols"), F.sum("nb").alias("non_blank_records"), F.max("read_error").alias("read_error"))
    readable = F.col("read_error").isNull()
    status = F.when(readable, F.when(F.col("received_cols") == expected_cols, working).otherwise(rejected))
    note = F.when(readable & (F.col("received_cols") != expected_cols),
                  F.format_string("expected_cols=%d; received_cols=%d", F.lit(expected_cols), F.col("received_cols")))
    return per_file.select("file_name", F.lit(expected_cols).alias("expected_cols"),
                           F.when(readable, F.col("received_cols")).alias("received_cols"),
                           F.when(readable, F.col("non_blank_records")).alias("non_blank_records"),
                           status.alias("STATUS"), note.alias("notes"), "read_error")


def empty_log(spark) -> DataFrame:
    return spark.createDataFrame([], LOG_SCHEMA)


def normalize_log(log: DataFrame) -> DataFrame:
    """Add missing log columns as null and fix the column order."""
    for c in LOG_COLUMNS:
        if c not in log.columns:
            log = log.withColumn(c, F.lit(None).cast("string"))
    return log.select(*[F.col(c).cast("string") for c in LOG_COLUMNS])


def new_files(verdicts: DataFrame, log: DataFrame) -> DataFrame:
    """Files not yet in the log (case-insensitive name match) -> incremental intake."""
    seen = log.select(F.lower("original_file").alias("_k"))
    return verdicts.join(seen, F.lower(verdicts["file_name"]) == seen["_k"], "left_anti")


def routing_rows(verdicts: DataFrame, date_ingested: str, existing: DataFrame | None = None) -> DataFrame:
    """Log rows for routed files. Unreadable files log name and date only. A file already
    present in working/rejected (``existing``: file_name, STATUS) keeps that location."""
    v = verdicts
    if existing is not None:
        ex = existing.select(F.lower("file_name").alias("_k"), F.col("STATUS").alias("_existing"))
        v = v.join(ex, F.lower(v["file_name"]) == ex["_k"], "left").drop("_k")
    else:
        v = v.withColumn("_existing", F.lit(None).cast("string"))
    readable = F.col("read_error").isNull()
    return v.select(
        F.col("file_name").alias("original_file"), F.lit(date_ingested).alias("date_ingested"),
        F.when(readable, F.col("non_blank_records").cast("string")).alias("non_blank_records"),
        F.when(readable, F.coalesce("_existing", "STATUS")).alias("STATUS"),
        F.when(readable, F.col("notes")).alias("notes"),
        F.lit(None).cast("string").alias("notes2"))


def _one_per_file(rows: DataFrame) -> DataFrame:
    """Of rows whose file names differ in case only, the one with the least name."""
    rows = normalize_log(rows)
    return (rows.groupBy(F.lower("original_file").alias("_k")).agg(F.min(F.struct(*LOG_COLUMNS)).alias("r")).select("r.*"))


def append_if_missing(log: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows whose file is not in the log yet (one per name, whatever its case)."""
    seen = log.select(F.lower("original_file").alias("_k"))
    rows = _one_per_file(rows)
    return normalize_log(log).unionByName(rows.join(seen, F.lower(rows["original_file"]) == seen["_k"], "left_anti"))


def mark_edited(log: DataFrame, names: DataFrame, date_ingested: str) -> DataFrame:
    """Set STATUS to EDITED for the files in ``names`` (file_name); a file that the log does not
    have gets a row with its name, the date and the status."""
    rows = names.select(F.col("file_name").alias("original_file"), F.lit(date_ingested).alias("date_ingested"),
                        F.lit(STATUS_EDITED).alias("STATUS"))
    return upsert_log(log, rows)


def upsert_log(log: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert on lower(file name): STATUS always takes the update (even a null), other
    fields are filled only where the log has null, the ingest date is never overwritten."""
    o = normalize_log(log).alias("o")
    n = _one_per_file(updates).alias("n")
    j = o.join(n, F.lower(F.col("o.original_file")) == F.lower(F.col("n.original_file")), "full_outer")
    has_new = F.col("n.original_file").isNotNull()
    has_old = F.col("o.original_file").isNotNull()
    cols = [F.coalesce("o.original_file", "n.original_file").alias("original_file"),
            F.coalesce("o.date_ingested", "n.date_ingested").alias("date_ingested")]
    for c in ("non_blank_records",):
        cols.append(F.coalesce(f"o.{c}", f"n.{c}").alias(c))
    cols.append(F.when(has_new, F.col("n.STATUS")).otherwise(F.col("o.STATUS")).alias("STATUS"))
    for c in ("notes", "notes2"):
        cols.append(F.when(has_old, F.coalesce(f"o.{c}", f"n.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
    return j.select(*cols)


def edited_verdicts(cells: DataFrame, expected_cols: int) -> DataFrame:
    """Edited copies (``edited_`` prefix) re-checked: EDITED_WORKING / EDITED_REJECTED,
    keyed by the original file name."""
    edited = cells.where(is_edited_file("file_name"))
    v = file_verdicts(edited, expected_cols, STATUS_EDITED_WORKING, STATUS_EDITED_REJECTED)
    return v.withColumn("original_name", strip_edited_prefix("file_name"))


def combine_with_template(cells: DataFrame, template: Sequence[str]) -> DataFrame:
    """Stack the files that fit the template as text: provenance columns of the received header
    removed, the other cells renamed by position, blank cells null, plus FILENAMEFROMDISTRICT
    and AGENCYCODE. Cells that were read with ``drop=PROVENANCE_DROP_BEFORE_CHECK`` carry the header's mask, so this is one
    narrow pass over the files; for other cells one join brings each file's mask to its rows."""
    fits = F.size(F.filter("keep", lambda k: k)) == len(template)
    if "keep" in cells.columns:
        body = cells.where((F.col("row_idx") > 0) & F.col("read_error").isNull() & fits).select("file_name", "cells", "keep")
    else:
        hdr = cells.where((F.col("row_idx") == 0) & F.col("read_error").isNull()).select("file_name", _kept_header().alias("keep"))
        body = cells.where(F.col("row_idx") > 0).select("file_name", "cells").join(hdr.where(fits), "file_name")
    kept = F.filter(F.arrays_zip("cells", "keep"), lambda z: z["keep"])
    body = body.select("file_name", F.transform(kept, lambda z: z["cells"]).alias("c"))
    cols = [blank_to_null(F.col("c")[i]).alias(name) for i, name in enumerate(template)]
    return body.select(*cols, F.col("file_name").alias("FILENAMEFROMDISTRICT"),
                       agency_code("file_name").alias("AGENCYCODE"))


def skip_report(verdicts: DataFrame) -> DataFrame:
    """FILE, REASON (UNREADABLE / COL_MISMATCH), DETAIL for files left out of the combine
    (verdicts with ``drop_provenance``)."""
    mismatch = F.col("received_cols") != F.col("expected_cols")
    reason = F.when(F.col("read_error").isNotNull(), "UNREADABLE").when(mismatch, "COL_MISMATCH")
    detail = F.coalesce(F.col("read_error"), F.format_string("expected %d, got %d", "expected_cols", "received_cols"))
    return verdicts.select(F.col("file_name").alias("FILE"), reason.alias("REASON"), detail.alias("DETAIL")) \
                   .where(F.col("REASON").isNotNull())


class FileStructureError(RuntimeError):
    """Some files of a set do not fit the template."""


def structure_offenders(verdicts: DataFrame) -> DataFrame:
    """(file_name, problem, detail), one row per problem of a file of the set: it cannot be read, its column
    count differs from the template's, or its name holds no district code."""
    v = verdicts
    unreadable = F.when(v["read_error"].isNotNull(), F.struct(F.lit("UNREADABLE").alias("problem"), v["read_error"].alias("detail")))
    columns = F.when(v["received_cols"] != v["expected_cols"], F.struct(
        F.lit("COL_MISMATCH").alias("problem"), F.format_string("expected %d, got %d", v["expected_cols"], v["received_cols"]).alias("detail")))
    code = F.when(agency_code_legacy(v["file_name"]).isNull(), F.struct(
        F.lit("NO_DISTRICT_CODE").alias("problem"), F.lit("no digits in the file name").alias("detail")))
    return v.select("file_name", F.inline(F.filter(F.array(unreadable, columns, code), lambda p: p.isNotNull())))


def require_structure(verdicts: DataFrame) -> None:
    """The gate of the older combine: any offender stops the whole set, with the list of all of them
    (names and reasons of files, never rows)."""
    bad = structure_offenders(verdicts).orderBy("file_name", "problem").collect()
    if bad:
        raise FileStructureError("these files do not match the data template:\n" + "\n".join(f"{r.file_name}: {r.problem} ({r.detail})" for r in bad))


def combine_strict(cells: DataFrame, template: Sequence[str]) -> DataFrame:
    """The older combine: nothing is stacked unless every file of the set fits; columns are named by the
    template and stay text, with the district code (last digits of the file name) and the file name."""
    require_structure(file_verdicts(cells, len(template), drop_provenance=True))
    out = combine_with_template(cells, template)
    return out.withColumn("AGENCYCODE", agency_code_legacy("FILENAMEFROMDISTRICT"))
