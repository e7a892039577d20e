"""A filter of keys: tells in one look whether a key can be among many, before rows are shuffled to a join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits a key; each key sets up to four bits of one word.
_BITS_PER_KEY = 16
_WORD = 64
# The filter is one value of at most 2 MB. Beyond a million keys more and more others pass it; none is ever lost.
_MAX_WORDS = 1 << 18


_HASHED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def hashes_as_equal(data_type: T.DataType) -> bool:
    """Whether equal values of this type have one hash. Text of another collation than the binary one may not."""
    return isinstance(data_type, _HASHED) or data_type == T.StringType()


@dataclass(frozen=True)
class KeyFilter:
    """A Bloom filter in blocks of one word, made and read by built-in functions.

    A key's hash selects a word and four bits in it, so a look is one array access and one comparison. The words are
    one row, which reaches the scan's tasks as a scalar subquery: nothing is joined, and nothing goes through the
    driver's code. Keys must have the same types on both sides. NULL is hashed like any value, -0.0 like 0.0.
    """

    words: DataFrame
    size: int

    @staticmethod
    def of(rows: DataFrame, keys: Sequence[str], count: int) -> KeyFilter:
        """The filter of the ``keys`` of ``rows``, of which there are about ``count``."""
        size = 64
        while size < min(count * _BITS_PER_KEY // _WORD, _MAX_WORDS):
            size *= 2
        digest = _digest(keys)
        word, bits = _word(digest, size), _bits(digest)
        used = rows.select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        every = rows.sparkSession.range(size).select(F.col("id").cast("int").alias("word"))
        filled = every.join(used, "word", "left").select(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")).alias("w"))
        ordered = F.array_sort(F.collect_list("w"))
        return KeyFilter(filled.agg(F.transform(ordered, lambda w: w["bits"]).alias("words")), size)

    def may_hold(self, keys: Sequence[str]) -> Column:
        """False only for rows whose ``keys`` are not among those of the filter."""
        digest = _digest(keys)
        # The hash is the argument of a function for its bits, and each part of the test is named once: a condition's
        # parts are computed wherever they stand, and many keys hashed many times make code too long to be compiled.
        bits = F.get(F.transform(F.array(digest), _bits), F.lit(0))
        return F.bitwise_not(F.get(self.words.scalar(), _word(digest, self.size))).bitwiseAND(bits) == 0


def _digest(keys: Sequence[str]) -> Column:
    return F.xxhash64(*(F.col(f"`{key}`") for key in keys))


def _word(digest: Column, size: int) -> Column:
    """The word of a key. It is taken from other bits of the hash than the key's bits in that word."""
    return digest.bitwiseAND(F.lit(size - 1)).cast("int")


def _bits(digest: Column) -> Column:
    """The bits of a key in its word."""
    bits = F.lit(0).cast("long")
    for first in (40, 46, 52, 58):
        place = F.shiftrightunsigned(digest, first).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits
