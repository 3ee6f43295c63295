"""A sieve for joins with few hits: one bit per key hash of one side, a table of fixed size that every task
gets, so that rows of the other side whose key is surely missing there are dropped before they are shuffled.

The table has PLACES bits (16 MB) and is made by one aggregation. A bit may stand for several keys, so a row that passes may
still find nothing in the join that follows; a row that would find its key always passes. On keys so many that the bits fill up it
drops less; results do not change. Keys must have the same types on both sides, as equal values of other types hash otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES = 1 << 27  # a power of two
WORDS = 16  # longs per row of the table
_WORD_BITS, _SLOT_BITS = 6, 10  # 64 bits in a long, 64 * WORDS in a row

_P, _SLOT = "_place", "_slot"


def _place(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(PLACES - 1).cast("bigint"))  # not null, so the join adds no filter to the side that is read twice


def key_bits(keys: DataFrame, hashed: Column) -> DataFrame:
    """(slot, words) of the hashes in ``hashed``: at most PLACES / 64 / WORDS rows, whatever the input."""
    bit = F.expr(f"shiftleft(1L, cast({_P} & 63 as int))")
    word = F.shiftright(_P, _WORD_BITS) % WORDS
    words = F.array(*[F.coalesce(F.bit_or(F.when(word == j, bit)), F.lit(0).cast("bigint")) for j in range(WORDS)])
    rows = keys.select(_place(hashed).alias(_P))
    return rows.groupBy(F.shiftright(_P, _SLOT_BITS).alias(_SLOT)).agg(words.alias("_words"))


def sift(rows: DataFrame, hashed: Column, bits: DataFrame) -> DataFrame:
    """The rows whose hash has its bit set in ``bits``."""
    at = rows.withColumn(_P, _place(hashed)).withColumn(_SLOT, F.shiftright(_P, _SLOT_BITS))
    word = F.get("_words", (F.shiftright(_P, _WORD_BITS) % WORDS).cast("int"))
    hit = F.getbit(word, (F.col(_P) % 64).cast("int")) == 1
    return at.join(F.broadcast(bits), _SLOT).where(hit).select(*rows.columns)
