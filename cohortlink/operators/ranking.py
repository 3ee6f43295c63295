"""``row_number`` whose partitions may hold any share of the rows.

A window sorts a whole partition in one task. Where keys are hot (see ``skew``), their rows are cut into
pieces by ranges of the order: boundaries come from a sample of the key's rows (it decides the balance, not the
result), a row's piece is the number of boundaries at or below it, rows are numbered within (key, piece), and the
counts of the pieces before are added. Ties are split by all order columns, so only rows that are equal
in every one of them stay together. Without hot keys the plain window is used; both give the same numbers wherever
the order is total, as it must be for a defined result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .skew import HOT_SHARE, hot_hashes, key_hash

PIECES = 64
SAMPLE = 4096  # sampled rows per hot key


def _position(score: str, tiebreak: Sequence[str]) -> Column:
    """A struct that ascends as (score descending, nulls last; tiebreak ascending, nulls first) does."""
    s = F.col(score).cast("double")
    return F.struct(F.col(score).isNull().alias("none"), F.when(F.isnan(s), 0).otherwise(1).alias("number"), (-F.col(score)).alias("score"),
                    *[F.col(c).alias(f"t{i}") for i, c in enumerate(tiebreak)])


def plain_rank(partition: Sequence[str], score: str, tiebreak: Sequence[str]) -> Column:
    w = Window.partitionBy(*partition).orderBy(F.col(score).desc_nulls_last(), *[F.col(c) for c in tiebreak])
    return F.row_number().over(w)


def _boundaries(rows: DataFrame, hot: DataFrame, partition: Sequence[str], score: str, tiebreak: Sequence[str], pieces: int, sample: int) -> DataFrame:
    """(partition..., bounds): up to ``pieces`` - 1 ascending positions per hot key."""
    own = rows.withColumn("_h", key_hash(*partition)).join(F.broadcast(hot), F.col("_h") == F.col("hot"), "left_semi")
    n = own.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    own = own.join(F.broadcast(n), "_h")  # one row per hot key
    some = own.where(F.pmod(F.xxhash64(score, *tiebreak), F.ceil(F.col("_n") / sample)) == 0)
    taken = some.groupBy(*partition).agg(F.array_sort(F.collect_set(_position(score, tiebreak))).alias("_s"))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(pieces - 1)), lambda i: F.get(F.col("_s"), F.floor(i * F.size("_s") / pieces).cast("int")))
    return taken.select(*partition, F.array_distinct(cuts).alias("bounds"))


def ranked(rows: DataFrame, partition: Sequence[str], score: str, tiebreak: Sequence[str], name: str = "score_rank", source: DataFrame | None = None,
           share: int = HOT_SHARE, least: int = 10_000, pieces: int = PIECES, sample: int = SAMPLE) -> DataFrame:
    """``rows`` with ``row_number`` by score descending (nulls last), then tiebreak ascending, per partition.

    ``source``: rows with the partition columns from which hot keys are found, if they are cheaper to read than
    ``rows``. Finding them is one job; the ranked rows are checkpointed only where hot keys exist."""
    hot = hot_hashes(rows if source is None else source, key_hash(*partition), share, least).collect()  # fewer than HOT_SHARE hashes
    if not hot:
        return rows.withColumn(name, plain_rank(partition, score, tiebreak))
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    hot_df = spark.createDataFrame([(r.hot,) for r in hot], "hot long")
    bounds = _boundaries(rows, hot_df, partition, score, tiebreak, pieces, sample)
    b = bounds.select(*[F.col(c).alias(f"_b_{c}") for c in partition], F.col("bounds").alias("_bounds"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in partition])
    cut = rows.join(F.broadcast(b), same, "left")  # fewer than HOT_SHARE rows of PIECES positions
    here = _position(score, tiebreak)
    piece = F.size(F.filter("_bounds", lambda x: x <= here))
    cut = cut.withColumn("_piece", F.when(F.col("_bounds").isNotNull(), piece).otherwise(0)).drop("_bounds", *[f"_b_{c}" for c in partition])
    inner = cut.withColumn("_r", plain_rank([*partition, "_piece"], score, tiebreak)).checkpoint()
    hashed = inner.withColumn("_h", key_hash(*partition))
    sizes = (hashed.join(F.broadcast(hot_df), F.col("_h") == F.col("hot"), "left_semi")
             .groupBy(*partition, "_piece").agg(F.max("_r").alias("_n")))
    before = F.sum("_n").over(Window.partitionBy(*partition).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(*[F.col(c).alias(f"_o_{c}") for c in partition], F.col("_piece").alias("_o_piece"), F.coalesce(before, F.lit(0)).alias("_before"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in partition], F.col("_piece") == F.col("_o_piece"))
    out = inner.join(F.broadcast(offsets), same, "left")  # at most HOT_SHARE x PIECES rows
    return out.select(*rows.columns, (F.col("_r") + F.coalesce("_before", F.lit(0))).cast("int").alias(name))
