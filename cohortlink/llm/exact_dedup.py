"""Exact dedup by a persistent digest index (DataFrame operations only).

Texts are equal when they are identical after deleting every character of ``[\\x20\\x09-\\x0D]``. A
``DigestIndex`` is a table with one row per different text seen so far, bucketed and sorted by the
text's SHA-256 and partitioned by the batch that brought it. A batch of documents is reduced to one row per
digest (partial aggregation, so a text in a third of all rows is one row per task), anti-joined
to the index by sort-merge join without moving the index, and what is new is appended as the batch's
partition. A batch that is run again after a failure replaces its own partition and judges itself
against the other batches only, so results agree.

The joins back from digests to rows send the facts of digests above 1/1000 of the batch by
broadcast (there are at most 1000), so no hot text meets in one task. Texts never leave the scan.

Definitions: null reads as empty, and all blank texts are equal to the empty one. Of equal texts
of a batch the row with the most code points in the original text stays, then the smallest doc_id (null
last); of repeated rows exactly one stays. A text that an earlier batch brought goes, and ``keep_id``
is that batch's row. ``group_size`` counts the batch's rows with the text. An empty batch appends nothing. Other
columns are not read.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .frames import HOT_SHARE, join_by_key, keep_plan, partitions, pick

BLANKS = " \t\n\x0b\x0c\r"


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, digest, ord) of every row; ord tells repeated rows apart once checkpointed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), F.length(text).alias("n_chars"),
        F.unhex(F.sha2(F.translate(text, BLANKS, "").cast("binary"), 256)).alias("digest"), F.monotonically_increasing_id().alias("ord"))


class DigestIndex:
    """The index under ``path``, a folder that all executors share, as table ``name``.

    Any session opens it from its files. ``buckets`` (the session's shuffle partitions by default) holds
    when it is made, and names the folder below ``path``; give more for more data: a bucket is one task of the joins."""

    COLUMNS = "digest binary, keep_id long, keep_chars int, n long, ord long, batch string"

    def __init__(self, spark: SparkSession, path: str, name: str | None = None, buckets: int | None = None):
        self.spark, self.root, self.name = spark, path.rstrip("/"), name or f"digest_index_{uuid.uuid4().hex}"
        there = self._folder()
        made = [st.getPath().getName() for st in there[0].listStatus(there[1])] if there[0].exists(there[1]) else []
        made = [int(n.removeprefix("buckets-")) for n in made if n.startswith("buckets-")]
        self.buckets = made[0] if made else buckets or partitions(spark)
        if not spark.catalog.tableExists(self.name):
            spark.sql(f"CREATE TABLE {self.name} ({self.COLUMNS}) USING parquet PARTITIONED BY (batch) CLUSTERED BY (digest) "
                      f"SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.root}/buckets-{self.buckets}'")
            if made:
                spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def _folder(self) -> tuple:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def _write(self, rows: DataFrame, batch: str) -> None:
        """The batch's partition, one sorted file per bucket, in place of what an earlier attempt left."""
        view = f"new_{uuid.uuid4().hex}"
        rows.select("digest", "keep_id", "keep_chars", "n", "ord").repartition(self.buckets, "digest").createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE {self.name} PARTITION (batch = '{batch}') SELECT * FROM {view}")
        self.spark.catalog.dropTempView(view)

    def decide(self, docs: DataFrame, batch: str) -> DataFrame:
        """Add the batch's new texts to the index; doc_id, keep_id, group_size, kept, text_sha256 of its rows."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        rows = keep_plan(digests(docs))
        best = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("doc_id").isNull().alias("none"), "doc_id", "ord")).alias("b")
        groups = keep_plan(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), best))
        total = rows.count()
        known = self.table().where(F.col("batch") != batch).select("digest").hint("merge")
        fresh = keep_plan(groups.join(known, "digest", "left_anti"))
        if not fresh.isEmpty():
            self._write(fresh.select("digest", F.col("b.doc_id").alias("keep_id"), (-F.col("b.c")).alias("keep_chars"), "n", F.col("b.ord").alias("ord")), batch)
        index = self.table().select("digest", "keep_id", F.when(F.col("batch") == batch, F.col("ord")).alias("keep_ord"))
        facts = keep_plan(groups.select("digest", F.col("n").alias("group_size")).join(index.hint("merge"), "digest"))
        hot = groups.where(F.col("n") * HOT_SHARE > total)
        out = join_by_key(rows, facts, "digest", hot)
        return out.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("ord") == F.col("keep_ord"), F.lit(False)).alias("kept"),
                          F.lower(F.hex("digest")).alias("text_sha256"))

    def compact(self, batch: str = "all") -> None:
        """Rewrite the index as one partition, so that every bucket is one sorted file again."""
        rows = keep_plan(self.table())
        old = [r.batch for r in rows.select("batch").distinct().collect()]  # one per batch
        self._write(rows, batch)
        for b in old:
            if b != batch:
                self.spark.sql(f"ALTER TABLE {self.name} DROP PARTITION (batch = '{b}')")
                fs, path = self._folder()
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path, f"buckets-{self.buckets}/batch={b}"), True)

    def drop(self) -> None:
        """Remove the table and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        fs, path = self._folder()
        fs.delete(path, True)


def exact_duplicates(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``decide`` of the whole table as one batch, against an index of its own that goes afterwards
    (the result reads checkpoints only)."""
    spark = docs.sparkSession
    index = DigestIndex(spark, f"{ensure_checkpoint_dir(spark)}/digest-index-{uuid.uuid4().hex}", buckets=buckets)
    try:
        return index.decide(docs, "all")
    finally:
        index.drop()
