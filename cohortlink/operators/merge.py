"""Insert-if-absent into a stored table, all or nothing.

A ``MergeTable`` is a folder of committed batches. Rows are bucketed and sorted by ``_key``, a hash of all compared
columns, and partitioned by batch; equal rows of a batch are one row with a count, so a row that
makes up a third of a batch is one row in its bucket. An insert is an anti-join on ``_key`` with null-safe equality
of the columns behind it: staged rows move to the target's buckets, the target does not move.

Which batches count is said by numbered version files that list them. An insert writes its batch's
partition first and then creates the next version file; creating it is the commit. A run that breaks before leaves
the old version, and its leftovers are replaced when the batch is inserted again; a
batch that is already listed adds nothing. The version file is created exclusively, so of two writers the
later one finds it taken, and judges its rows anew against what the other has committed.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..session import ensure_checkpoint_dir

_KEY, _COPIES, _BATCH = "_key", "_copies", "_batch"


class VersionTaken(RuntimeError):
    """Another writer has committed the version this one was about to write."""


class MergeTable:
    """The table stored under ``root`` (a folder that all executors share).

    ``schema`` and ``buckets`` (by default the session's shuffle partitions) hold when it is made and are read from its first version file later.
    ``ignore`` names the columns that do not take part in the comparison."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None, ignore: Sequence[str] = (), buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions")
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not self._fs.exists(path):
            if schema is None:
                raise FileNotFoundError(f"no table under {root}")
            self._commit(0, {"schema": schema.json(), "ignore": list(ignore), "batches": [],
                             "buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))})
        first = self._read(0)
        if first is None:
            raise FileNotFoundError(f"no complete version under {root}")
        self.schema = T.StructType.fromJson(json.loads(first["schema"]))
        self.ignore, self.buckets = first["ignore"], first["buckets"]
        self.keys = [c for c in self.schema.names if c not in self.ignore]
        self.name = f"merge_{uuid.uuid4().hex}"
        stored = T.StructType(self.schema.fields + [T.StructField(_KEY, T.LongType()), T.StructField(_COPIES, T.LongType()), T.StructField(_BATCH, T.StringType())])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.fields)
        spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet PARTITIONED BY ({_BATCH}) CLUSTERED BY ({_KEY}) SORTED BY ({_KEY}) "
                  f"INTO {self.buckets} BUCKETS LOCATION '{self.root}/rows'")
        self.refresh()

    # --- versions ---

    def _file(self, number: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions/v-{number:012d}")

    def _read(self, number: int) -> dict | None:
        """A version's content; None if it is not there or was not written to its end."""
        if not self._fs.exists(self._file(number)):
            return None
        stream = self._fs.open(self._file(number))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) if text.endswith("\n") else None

    def _commit(self, number: int, content: dict) -> None:
        try:
            stream = self._fs.create(self._file(number), False)
        except Exception as e:
            raise VersionTaken(f"version {number} of {self.root} is taken") from e
        try:
            stream.write(bytearray((json.dumps(content) + "\n").encode()))
        finally:
            stream.close()

    def version(self) -> tuple[int, dict[str, int]]:
        """(number of the newest file, batches of the newest complete version with their rows)."""
        names = [st.getPath().getName() for st in self._fs.listStatus(self._file(0).getParent())]
        numbers = sorted((int(n[2:]) for n in names if re.fullmatch(r"v-\d{12}", n)), reverse=True)
        for n in numbers:
            if (content := self._read(n)) is not None:
                return numbers[0], dict(content["batches"])
        raise FileNotFoundError(f"no complete version under {self.root}")

    # --- rows ---

    def refresh(self) -> None:
        """Learn the partitions that other sessions have written."""
        if self._fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/rows")):
            self.spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def _stored(self, batches: Sequence[str]) -> DataFrame:
        return self.spark.table(self.name).where(F.col(_BATCH).isin(list(batches)))

    def read(self) -> DataFrame:
        """The rows of the newest version."""
        self.refresh()
        rows = self._stored(list(self.version()[1]))
        return rows.select(*self.schema.names, F.explode(F.sequence(F.lit(1), F.col(_COPIES))).alias("_copy")).drop("_copy")

    def absent(self, staged: DataFrame, batches: Sequence[str]) -> DataFrame:
        """Staged rows (with counts) that no row of the batches equals in the compared columns."""
        rows = staged.select(*self.schema.names).groupBy(*self.schema.names).agg(F.count(F.lit(1)).alias(_COPIES))
        rows = rows.withColumn(_KEY, F.xxhash64(*self.keys)).repartition(self.buckets, _KEY)
        there = self._stored(batches).select(F.col(_KEY).alias("_there"), *[F.col(c).alias(f"_t_{c}") for c in self.keys]).hint("merge")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in self.keys], F.col(_KEY) == F.col("_there"))
        return rows.join(there, same, "left_anti")

    def stage(self, staged: DataFrame, batch: str) -> tuple[int, dict[str, int]]:
        """Write the batch's new rows as a partition nobody reads yet; (next version, its batches)."""
        self.refresh()
        number, batches = self.version()
        ensure_checkpoint_dir(self.spark)
        new = self.absent(staged, list(batches)).checkpoint()
        count = int(new.agg(F.coalesce(F.sum(_COPIES), F.lit(0))).first()[0])
        view = f"staged_{uuid.uuid4().hex}"
        new.select(*self.schema.names, _KEY, _COPIES).repartition(self.buckets, _KEY).createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE {self.name} PARTITION ({_BATCH} = '{batch}') SELECT * FROM {view}")  # also removes leftovers
        self.spark.catalog.dropTempView(view)
        return number + 1, {**batches, batch: count}

    def insert(self, staged: DataFrame, batch: str, attempts: int = 5) -> int:
        """Add the staged rows that the table does not have, as ``batch``; returns how many. A batch
        that is there already adds nothing."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        if missing := [c for c in self.schema.names if c not in staged.columns]:
            raise AnalysisException(f"columns missing from the staged rows: {missing}")
        for left in range(attempts, 0, -1):
            if batch in self.version()[1]:
                return 0
            number, batches = self.stage(staged, batch)
            try:
                self._commit(number, {"batches": list(batches.items())})
                return batches[batch]
            except VersionTaken:
                if left == 1:
                    raise
        return 0

    def close(self) -> None:
        """Forget the session's table; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def remove(self) -> None:
        """Remove the table with its files."""
        self.close()
        self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.root), True)
