"""Working and rejected files: each routed partner file written under its own name.

Cells become CSV lines on the executors and are written by Spark's file committer into a staging
folder, so a failed or repeated task leaves nothing behind; only when the whole write has succeeded are the
files renamed to ``<root>/<STATUS>/<file name>`` (metadata operations on the driver, one per file). A run that
breaks before that leaves the old files, a run that breaks among the renames is finished by running it
again, which gives the same files.

A file of up to ``rows_per_part`` rows is one file; a longer one becomes a folder of its name with numbered
parts (header in the first), so that no task writes more rows than that. All output is CSV text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_PART = 1_000_000


def csv_line(cells: Column) -> Column:
    """A CSV line of an array of text: null is empty; quotes only where a cell needs them, and around a lone empty cell."""
    def cell(c: Column) -> Column:
        c = F.coalesce(c, F.lit(""))
        return F.when(c.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)

    line = F.array_join(F.transform(cells, cell), ",")
    return F.when((F.size(cells) == 1) & (line == ""), '""').otherwise(line)


def routed_lines(cells: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(STATUS, file_name, row_idx, line) of every row of the routed files; unreadable files have none."""
    to = verdicts.where(F.col("STATUS").isNotNull()).select("file_name", "STATUS")
    rows = cells.where(F.col("read_error").isNull()).select("file_name", "row_idx", csv_line(F.col("cells")).alias("line"))
    return rows.join(to, "file_name").select("STATUS", "file_name", "row_idx", "line")


def write_routed(lines: DataFrame, root: str, rows_per_part: int = ROWS_PER_PART) -> int:
    """Write ``routed_lines`` below ``root``; returns the number of partner files written."""
    spark, root = lines.sparkSession, root.rstrip("/")
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    name = F.hex(F.encode("file_name", "utf-8"))  # any name is fit for a folder in this form
    rows = lines.select("STATUS", name.alias("name"), F.floor(F.col("row_idx") / rows_per_part).cast("long").alias("part"), "row_idx", "line")
    rows = rows.repartition("STATUS", "name", "part").sortWithinPartitions("STATUS", "name", "part", "row_idx").drop("row_idx")
    try:
        rows.write.partitionBy("STATUS", "name", "part").option("lineSep", "\n").text(staging)
        return _publish(spark, staging, root)
    finally:
        _fs(spark, staging).delete(_path(spark, staging), True)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(path, name) of what lies in a folder, marker files aside."""
    found = [st.getPath() for st in _fs(spark, path).listStatus(_path(spark, path))]
    return sorted((p.toString(), p.getName()) for p in found if not p.getName().startswith(("_", ".")))


def _publish(spark: SparkSession, staging: str, root: str) -> int:
    fs, written = _fs(spark, root), 0
    for status_dir, status in _children(spark, staging):
        target = f"{root}/{status.partition('=')[2]}"
        fs.mkdirs(_path(spark, target))
        for name_dir, name in _children(spark, status_dir):
            final = f"{target}/{bytes.fromhex(name.partition('=')[2]).decode()}"
            parts = sorted((int(n.partition("=")[2]), _children(spark, p)[0][0]) for p, n in _children(spark, name_dir))
            if len(parts) == 1:
                source = parts[0][1]
            else:
                source = f"{staging}/_whole-{name}"
                fs.mkdirs(_path(spark, source))
                for i, p in parts:
                    fs.rename(_path(spark, p), _path(spark, f"{source}/part-{i:05d}.csv"))
            fs.delete(_path(spark, final), True)
            if not fs.rename(_path(spark, source), _path(spark, final)):
                raise OSError(f"cannot write {final}")
            written += 1
    return written
