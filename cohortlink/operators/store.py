"""Sinks: overwrite / create-only table writes, insert-if-absent, report sets and the
versioned log save. Paths and table names are arguments; nothing writes to a machine-local
folder implicitly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def publish_table(df: DataFrame, name: str, replace: bool = True) -> None:
    """Create-or-replace (``replace``) or create-only (fails if the table exists)."""
    df.write.mode("overwrite" if replace else "errorifexists").saveAsTable(name)


def absent_rows(staged: DataFrame, target: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Staged rows with no null-safe equal row in ``target`` over all columns except
    ``ignore`` (a left-anti join on ``<=>`` keys; duplicates inside the batch all stay)."""
    keys = [c for c in staged.columns if c not in ignore]
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in keys])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in keys])
    return staged.join(t, cond, "left_anti")


def insert_if_absent(spark: SparkSession, staged: DataFrame, table: str, ignore: Sequence[str] = ()) -> int:
    """Create the table like the staged data if missing, then append the absent rows; returns
    how many were written."""
    if not spark.catalog.tableExists(table):
        staged.limit(0).write.saveAsTable(table)
    seen = Observation()
    new = absent_rows(staged, spark.table(table), ignore).observe(seen, F.count(F.lit(1)).alias("n"))
    new.write.mode("append").saveAsTable(table)
    return int(seen.get["n"])


def write_reports(reports: Mapping[str, DataFrame], root: str) -> None:
    """One parquet directory per report."""
    for name, df in reports.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]] | None:
    """(number, complete) of every log version in order; None if the root does not exist."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    names = [st.getPath() for st in fs.listStatus(path) if st.isDirectory() and st.getPath().getName().startswith("v-")]
    return sorted((int(p.getName()[2:]), fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))) for p in names)


def _version_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/v-{number:012d}"


def save_log_versioned(log: DataFrame, root: str) -> str:
    """Write the log to the next version folder. A version counts once its ``_SUCCESS`` marker
    is there, so readers see the old or the new log and an interrupted save is never read.
    One writer at a time: a second writer of the same number fails."""
    number = max([n for n, _ in _versions(log.sparkSession, root) or []], default=0) + 1
    path = _version_path(root, number)
    log.write.mode("errorifexists").parquet(path)
    return path


def load_log(spark: SparkSession, root: str, empty: DataFrame) -> DataFrame:
    """The newest complete version; ``empty`` only when ``root`` does not exist. A root without
    a complete version, or an unreadable one, raises."""
    versions = _versions(spark, root)
    if versions is None:
        return empty
    done = [n for n, complete in versions if complete]
    if not done:
        raise FileNotFoundError(f"no complete log version under {root}")
    return spark.read.schema(empty.schema).parquet(_version_path(root, done[-1]))
