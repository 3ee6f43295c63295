"""Reports kept up to date file by file.

A report over partner files that only adds up (missingness, record counts, flag counts) is stored as partial states: one row per
file and report group with its sums. A batch brings the states of the files that were delivered, new ones
or replacements; the report is the sum over each file's newest state, so a replaced file's old share drops out, and only the
delivered files are read. States are a few rows per file, whatever the file's size.

A batch counts once its marker file exists, which is written after its states: a batch that broke is
overwritten when it is added again, and one that is there already is left alone.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import pct
from ..functions.text import BLANK_RE


class PartialReports:
    """States under ``root``, a folder that all executors share. Batches are numbered from 1."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def batches(self) -> list[int]:
        """The batches that count."""
        folder = self._path("_batches")
        if not self._fs.exists(folder):
            return []
        names = [st.getPath().getName() for st in self._fs.listStatus(folder)]
        return sorted(int(n[2:]) for n in names if re.fullmatch(r"b-\d{9}", n))

    def add(self, batch: int, files: DataFrame, states: Mapping[str, DataFrame]) -> bool:
        """Store the states (each with ``file_name``) of the batch's ``files`` (file_name; also files that have no rows).
        False if the batch is there already."""
        if batch in self.batches():
            return False
        files.select("file_name").distinct().write.mode("overwrite").parquet(f"{self.root}/files/batch={batch}")
        for name, state in states.items():
            state.write.mode("overwrite").parquet(f"{self.root}/state={name}/batch={batch}")
        self._fs.create(self._path(f"_batches/b-{batch:09d}"), True).close()
        return True

    def newest(self) -> DataFrame:
        """(file_name, batch): the batch that brought each file last."""
        done = self.batches()
        files = self.spark.read.option("basePath", f"{self.root}/files").parquet(*[f"{self.root}/files/batch={b}" for b in done])
        return files.groupBy("file_name").agg(F.max("batch").alias("batch"))

    def state(self, name: str) -> DataFrame:
        """State rows of each file's newest delivery."""
        base = f"{self.root}/state={name}"
        rows = self.spark.read.option("basePath", base).parquet(*[f"{base}/batch={b}" for b in self.batches()])
        return rows.join(self.newest(), ["file_name", "batch"], "left_semi").drop("batch")

    def merged(self, name: str, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
        """The report's sums over all files, per ``keys``."""
        return self.state(name).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def missing_state(rows: DataFrame, file_col: str, group_cols: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Partial missingness: (file_name, groups, col_name, total_count, missing_count). One aggregation, then a
    narrow unpivot."""
    def missing(c: str) -> Column:
        return F.count_if(F.col(c).isNull() | F.col(c).cast("string").rlike(BLANK_RE)).alias(c)

    wide = rows.groupBy(F.col(file_col).alias("file_name"), *group_cols).agg(F.count(F.lit(1)).alias("total_count"), *[missing(c) for c in columns])
    return wide.unpivot(["file_name", *group_cols, "total_count"], list(columns), "col_name", "missing_count")


def missing_report(reports: PartialReports, name: str, group_cols: Sequence[str]) -> DataFrame:
    """The missingness report from its states."""
    out = reports.merged(name, [*group_cols, "col_name"], ["total_count", "missing_count"])
    return out.select(*group_cols, "col_name", "total_count", "missing_count", (F.col("total_count") - F.col("missing_count")).alias("non_missing_count"),
                      pct("missing_count", "total_count", 2).alias("missing_percentage"))


def flag_state(flags: DataFrame, allowed: Column, file_col: str = "D_FILENAMEFROMDISTRICT") -> DataFrame:
    """Partial flag counts: (file_name, D_SUBJECT, FLAG_REASON, record_count); clean and allowed rows have reason null."""
    rows = flags.where((F.col("_merge") == "both") & (F.col("FLAG_REASON").isNotNull() | allowed))
    return rows.groupBy(F.col(file_col).alias("file_name"), "D_SUBJECT", "FLAG_REASON").agg(F.count(F.lit(1)).alias("record_count"))


def flag_report(reports: PartialReports, name: str) -> DataFrame:
    """Flagged records per (subject, reason) over all files with the subject's clean records as denominator."""
    groups = reports.merged(name, ["D_SUBJECT", "FLAG_REASON"], ["record_count"])
    clean = F.sum(F.when(F.col("FLAG_REASON").isNull(), F.col("record_count"))).over(Window.partitionBy("D_SUBJECT"))
    out = groups.withColumn("clean_records", clean).where(F.col("FLAG_REASON").isNotNull())
    return out.withColumn("pct_affected_records", pct("record_count", "clean_records", 1))
