"""Hashes that stand for values, and filters on them that travel as one small array.

Two values are taken to be equal when both of their 64-bit *lanes* are.  A *bit set* holds the
lanes of some rows in a fixed number of bits; as a scalar subquery it is computed before the rows
that it filters are moved, so rows that cannot matter never reach a shuffle.  It lets too many rows
through, never too few, and what follows must not depend on which.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a set: 128 KiB on the driver and in each task, whatever the tables hold.
BITS = 1 << 20
#: Of a set that is to tell many rows apart: 1 MiB.
MANY_BITS = 1 << 23
_WORD = 64


def lanes(c: Column, text: Column, kind: T.DataType) -> tuple[Column, Column]:
    """Both lanes of a value, NULL for NULL; ``text`` stands for nested values.

    Spark's hash passes over NULLs inside arrays and structs, so those are hashed as text.
    """
    nested = isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0).cast(kind)  # -0.0 is 0.0
    value = text if nested else c
    filled = c.isNotNull()
    return F.when(filled, F.xxhash64(value)), F.when(filled, F.xxhash64(F.lit("second lane"), value))


def _place(hashed: Column, size: int) -> tuple[Column, Column]:
    """Word of a hash's bit, and the word that has this bit only."""
    place = F.pmod(hashed, F.lit(size))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(_WORD)).cast("int"))
    return F.floor(place / F.lit(_WORD)).cast("int"), bit


def bit_set(hashes: DataFrame, size: int = BITS) -> Column:
    """The set of the hashes in the only column of a table, as a scalar subquery.

    It is an array of 64-bit words; all words are present, so a look-up is one array access.
    """
    word, bit = _place(F.col(hashes.columns[0]), size)
    blank = hashes.sparkSession.range(size // _WORD).select(
        F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits")
    )
    words = hashes.select(word.alias("word"), bit.alias("bits")).unionAll(blank)
    filled = words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = filled.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    return ordered.select("words.bits").scalar()


def in_set(bits: Column, hashed: Column, size: int = BITS) -> Column:
    """Whether a hash may be in the set."""
    word, bit = _place(hashed, size)
    return F.get(bits, word).bitwiseAND(bit) != 0
