"""Incremental intake with keyed state: what a file held last is remembered by the stream itself.

Drop folders are dated, so a partner's file may arrive again under another path. The stream keeps, per lower-cased file name, the
digest of the content it judged last. A delivery with the same content gives nothing; a changed or new
one is handed on once, and its verdict is computed from the file as it is. Nothing is looked up in the log, whose size
therefore does not matter, and the state survives restarts in the stream's checkpoint.

Of several deliveries of one name in a micro-batch the newest (by modification time, then path) counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import file_name_of
from ..operators import intake
from ..sources.files import cells_of
from .intake_stream import BINARY_FILE_SCHEMA

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = "name_key string, file_name string, path string, digest string"


class LastContent(StatefulProcessor):
    """Per file name: the digest judged last."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("digest", "digest string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        newest = None
        for part in rows:  # deliveries of one name: a few rows
            top = part.sort_values(["modified", "path"]).iloc[-1]
            if newest is None or (top["modified"], top["path"]) > (newest["modified"], newest["path"]):
                newest = top
        old = self.seen.get()
        if newest is not None and (old is None or old[0] != newest["digest"]):
            self.seen.update((newest["digest"],))
            yield pd.DataFrame([(key[0], newest["file_name"], newest["path"], newest["digest"])], columns=["name_key", "file_name", "path", "digest"])

    def close(self) -> None:
        pass


def changed_files(files: DataFrame) -> DataFrame:
    """Deliveries (path, modificationTime, content) -> those whose content is not the one judged last."""
    rows = files.select(F.lower(file_name_of("path")).alias("name_key"), file_name_of("path").alias("file_name"), "path",
                        F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("digest"))
    return rows.groupBy("name_key").transformWithStateInPandas(LastContent(), outputStructType=_OUT, outputMode="Append", timeMode="None")


def start_keyed_intake(spark: SparkSession, drop_root: str, checkpoint: str, expected_cols: int,
                       on_verdicts: Callable[[DataFrame, int], None], glob: str = "*"):
    """Start an availableNow stream over ``drop_root`` and the dated folders below it; ``on_verdicts(verdicts, batch_id)`` gets the
    verdicts of new and changed files. A batch may be delivered twice after a failure, with the same rows and
    number. The session must use the RocksDB state store (``STATE_STORE``)."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STATE_STORE:
        raise RuntimeError(f"set spark.sql.streaming.stateStore.providerClass to {STATE_STORE}")
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(drop_root))

    def handle(batch: DataFrame, batch_id: int) -> None:
        found = [r.path for r in batch.select("path").collect()]  # one entry per new or changed file
        if found:
            on_verdicts(intake.file_verdicts(cells_of(batch.sparkSession, found), expected_cols), batch_id)

    return (changed_files(files).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
