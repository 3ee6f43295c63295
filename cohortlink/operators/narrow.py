"""Narrow rows for a shuffle: whole numbers, hundredths, days and single letters are put side by side into longs.

A row whose values all come back exactly travels as those longs; any other (a null, a fraction beyond
hundredths, a time of day, a longer text, a number too large for its bits) travels as it is. So the rows that arrive
are the rows that left (-0.0 comes back as 0.0, its equal); only their size differs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, FractionalType, IntegralType, StringType, StructType, TimestampNTZType, TimestampType

Words = Sequence[Sequence[tuple[str, int]]]  # per long: the columns that it holds, and their bits (63 at most)
_RAW = "_as_it_is"


def _encoded(c: str, kind: DataType) -> Column:
    if isinstance(kind, IntegralType):
        return F.col(c).cast("bigint")
    if isinstance(kind, FractionalType):
        return F.rint(F.col(c).cast("double") * 100).try_cast("bigint")
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.unix_date(F.col(c).cast("date")).cast("bigint")
    if isinstance(kind, StringType):
        return F.ascii(c).cast("bigint")
    return F.lit(None).cast("bigint")


def _decoded(code: Column, kind: DataType) -> Column:
    if isinstance(kind, FractionalType):
        return (code / F.lit(100.0)).try_cast(kind)
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.date_from_unix_date(code.cast("int")).cast(kind)
    if isinstance(kind, StringType):
        return F.chr(code)
    return code.cast(kind)


def pack(rows: DataFrame, keys: Sequence[str], words: Words) -> DataFrame:
    """``keys`` as they are, and the columns of ``words`` in longs where that is exact."""
    kind = {f.name: f.dataType for f in rows.schema}
    columns = [c for word in words for c, _ in word]

    def exact(c: str, bits: int) -> Column:
        code = F.col(f"_code_{c}")
        inside = code.between(0, (1 << bits) - 1)
        # the range first: numbers outside it are not decoded
        return F.coalesce(F.when(inside, _decoded(code, kind[c]) == F.col(c)), F.lit(False))

    coded = rows.select(*keys, *columns, *[_encoded(c, kind[c]).alias(f"_code_{c}") for c in columns])
    fits = reduce(lambda a, b: a & b, [exact(c, bits) for word in words for c, bits in word])
    coded = coded.withColumn("_fits", fits)
    longs = []
    for i, word in enumerate(words):
        value, at = F.lit(0).cast("bigint"), 0
        for c, bits in word:
            value, at = value.bitwiseOR(F.shiftleft(f"_code_{c}", at)), at + bits
        longs.append(F.when(F.col("_fits"), value).alias(f"_word_{i}"))
    return coded.select(*keys, *longs, F.when(~F.col("_fits"), F.struct(*columns)).alias(_RAW))


def unpack(packed: DataFrame, keys: Sequence[str], words: Words, schema: StructType) -> DataFrame:
    """The rows that ``pack`` was given; ``schema``: their schema."""
    kind, raw, out = {f.name: f.dataType for f in schema}, F.col(_RAW), []
    for i, word in enumerate(words):
        at = 0
        for c, bits in word:
            code = F.shiftright(f"_word_{i}", at).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
            out.append(F.when(raw.isNull(), _decoded(code, kind[c])).otherwise(raw[c]).alias(c))
            at += bits
    return packed.select(*keys, *out)
