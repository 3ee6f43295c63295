"""Corpus pipeline: five stages over ``documents``, each working on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the rows are
written as Parquet into the shared checkpoint folder and read again, so a lost executor costs a
stage's unfinished tasks only. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlink.llm import toxicity
from cohortlink.llm.decontaminate import without_items
from cohortlink.llm.frames import numbered, table
from cohortlink.llm.jaccard_join import jaccard_components
from cohortlink.llm.line_dedup import dedup_lines
from cohortlink.llm.mixing import mix
from cohortlink.session import ensure_checkpoint_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that occur earlier, short ones too; documents with nothing left go; n_chars follows."""
    out = numbered(dedup_lines(docs, drop_emptied=True, equal_chars=1))  # ends with the numbers of lines and of removed ones
    names = docs.columns
    cols = [F.col(f"_c{i}") for i in range(len(names))]
    if "n_chars" in names:
        i = names.index("n_chars")
        chars = F.char_length(cols[names.index("text")]).cast(docs.schema[i].dataType)
        cols[i] = F.when(F.col(f"_c{len(names) + 1}") > 0, chars).otherwise(cols[i])
    return out.select(*cols).toDF(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id; null ids stay, and so do
    repeated rows of that doc_id."""
    key = f"_c{docs.columns.index('doc_id')}"
    others = jaccard_components(docs).where("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct()
    flat = numbered(docs)
    return flat.join(others, key, "left_anti").select(*flat.columns).toDF(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: doc_id, size, source_size, target, taken, copies, rate."""
    return mix(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

ORACLE_SQL = None  # trained scores, edit distances and Newton iterations are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``, with the folder of the stages' results below the shared
    checkpoint folder: the last one is read by the result, the others are removed once their successor is written. Nulls, empty
    texts, repeated rows and empty tables are handled as each stage's operator says."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        before = f"{folder}/{name}"
    return docs
