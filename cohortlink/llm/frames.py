"""DataFrame helpers shared by the operators of this package."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

HOT_SHARE = 1000  # a key above 1/HOT_SHARE of all rows is hot; there are at most that many


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns, by exact spelling, whatever other columns (``TEXT``, ``score``) exist."""
    at = [df.columns.index(n) for n in names]
    return (df.toDF(*[f"_in{i}" for i in range(len(df.columns))])
            .select(*[F.col(f"_in{i}").alias(n) for i, n in zip(at, names)]))


def numbered(df: DataFrame) -> DataFrame:
    """The table with columns _c0, _c1, ...: names that cannot clash."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def filter_rows(df: DataFrame, run) -> DataFrame:
    """``df`` through an Arrow function that only drops rows; names may clash."""
    flat = numbered(df)
    return flat.mapInArrow(run, flat.schema).toDF(*df.columns)


def keep_plan(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder that the cluster names (lost executors lose nothing)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark's context cleaner remove the shuffle files of steps that were checkpointed.

    It does so once their plans are garbage on the driver, which may otherwise take long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_by_key(rows: DataFrame, facts: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Left join many ``rows`` to one fact per key, safe for hot keys.

    ``hot`` lists the keys above 1/HOT_SHARE of the rows, so at most HOT_SHARE of them: their
    facts are broadcast and their rows never meet in one task. The rest is a plain join.
    """
    hot = F.broadcast(hot.select(key))
    small = F.broadcast(facts.join(hot, key, "left_semi"))
    return (rows.join(small, key).unionByName(rows.join(hot, key, "left_anti")
                                              .join(facts, key, "left").select(*rows.join(small, key).columns)))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of the undirected edges (a, b), the smallest reachable node.

    Alternating large-star and small-star steps until the edge set stands still; each step is
    two aggregations and joins, and each round is checkpointed. No edge leaves the cluster.
    """
    def stamp(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = keep_plan(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = stamp(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = keep_plan(small)
        now = stamp(e)
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now
