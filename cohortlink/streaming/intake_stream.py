"""Incremental intake as Structured Streaming over a drop folder.

``readStream.format("binaryFile")`` lists new files; ``trigger(availableNow=True)`` drains
what is there and stops; ``foreachBatch`` reads each micro-batch's files as raw cells (by their
paths: contents never pass through the stream's own rows, so files may have any size),
computes verdicts and upserts the log. The stream's file-source checkpoint remembers which
files were processed. A batch may still be delivered twice, so each is joined against the
current log first and only files that the log does not have are handed on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import intake
from ..sources.files import cells_of

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def batch_handler(expected_cols: int, on_log: Callable[[DataFrame, int], None], date_ingested: str,
                  current_log: Callable[[], DataFrame]) -> Callable[[DataFrame, int], None]:
    """The step for each micro-batch: verdicts, minus files already logged, as log rows."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in batch.select("path").collect()]  # one entry per new file
        if not paths:
            return
        verdicts = intake.file_verdicts(cells_of(batch.sparkSession, paths), expected_cols)
        fresh = intake.new_files(verdicts, current_log())
        on_log(intake.routing_rows(fresh, date_ingested), batch_id)
    return handle


def start_intake_stream(spark: SparkSession, drop_folder: str, checkpoint: str, expected_cols: int,
                        on_log: Callable[[DataFrame, int], None], date_ingested: str,
                        current_log: Callable[[], DataFrame], glob: str = "*"):
    """Start an availableNow stream; ``on_log(rows, batch_id)`` receives the new log rows
    of each batch (e.g. ``store.save_log_versioned`` after ``intake.append_if_missing``) and
    must have stored them when it returns; ``current_log()`` reads the log as it then is."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "false").load(drop_folder).select("path"))

    handle = batch_handler(expected_cols, on_log, date_ingested, current_log)

    return (files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
