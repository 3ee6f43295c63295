"""Study settings: a sheet with one row per subject and vendor test, read with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, strip

SETTINGS_COLUMNS = ("D_SUBJECT", "VENDOR_TEST_NAME", "STUDY_GRADES", "TERM", "NOTES")
REQUIRED = ("D_SUBJECT", "VENDOR_TEST_NAME", "STUDY_GRADES", "TERM")


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """Settings rows from a CSV (with header) or parquet source. Headers are matched trimmed, whatever their
    case; every column is text, blank cells are null, other columns are left out and a missing optional column is null.
    A missing required column is an error, and rows without subject and test are no settings."""
    if path.rstrip("/").lower().endswith(".parquet"):
        raw = spark.read.parquet(path)
    else:
        names = spark.read.option("header", True).csv(path).columns  # the header only
        raw = spark.read.option("header", True).option("multiLine", True).schema(", ".join(f"`{c}` string" for c in names)).csv(path)
    by = {c.strip().upper(): c for c in reversed(raw.columns)}
    if missing := [c for c in REQUIRED if c not in by]:
        raise ValueError(f"settings without columns {missing}: {path}")
    cols = [(strip(blank_to_null(F.col(f"`{by[c]}`").cast("string"))) if c in by else F.lit(None).cast("string")).alias(c) for c in SETTINGS_COLUMNS]
    return raw.select(*cols).where(F.col("D_SUBJECT").isNotNull() | F.col("VENDOR_TEST_NAME").isNotNull())
