"""Hot keys: finding them by a sketch, and dealing their rows to many tasks.

A key is hot when it holds more than 1/HOT_SHARE of the rows, so there are fewer than HOT_SHARE hot keys
however large the data. They are found by one frequent-items sketch over a hash of the key columns: one pass, a
few hundred kB per task, no shuffle of keys. The sketch only says which rows get a salt; a
key that is missed or named by a hash collision changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000
TRACKED = 16_384  # items of the sketch: its error is 3.5 / TRACKED of the rows, well below 1 / HOT_SHARE


def key_hash(*keys: str | Column) -> Column:
    return F.xxhash64(*keys)


def hot_hashes(rows: DataFrame, hashed: Column, share: int = HOT_SHARE, least: int = 10_000) -> DataFrame:
    """(hot): hashes of the keys with more than 1/``share`` of the rows, and ``least`` rows at least.
    Fewer than ``share`` rows, whatever the input."""
    top = rows.select(hashed.alias("_h")).agg(F.expr(f"approx_top_k(_h, {share}, {TRACKED})").alias("_top"), F.count(F.lit(1)).alias("_n"))
    item = top.select(F.explode("_top").alias("_i"), "_n")
    return item.where((F.col("_i.count") * share > F.col("_n")) & (F.col("_i.count") >= least)).select(F.col("_i.item").alias("hot"))


def salted_join(many: DataFrame, one: DataFrame, keys: Sequence[str], spread: Column, hot: DataFrame, salts: int = 64) -> DataFrame:
    """Inner join of many rows to the one row per key of ``one``. Rows of hot keys get a salt from
    ``spread`` and meet one of ``salts`` copies of their key's row; all other rows salt 0. The list of hot keys (fewer than
    HOT_SHARE) is broadcast; at most HOT_SHARE x salts copies are made."""
    hot = F.broadcast(hot.select(F.col("hot").alias("_hot")).distinct())
    left = many.withColumn("_h", key_hash(*keys)).join(hot, F.col("_h") == F.col("_hot"), "left")
    left = left.withColumn("_salt", F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(0).cast("int")).drop("_h", "_hot")
    right = one.withColumn("_h", key_hash(*keys)).join(hot, F.col("_h") == F.col("_hot"), "left")
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn("_salt", F.explode(copies)).drop("_h", "_hot")
    return left.join(right, [*keys, "_salt"]).drop("_salt")
