"""Joins whose left side may hold a large share of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(columns: Sequence[str]) -> Column:
    """The columns as one value; NULL if any is, as a NULL matches nothing."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return F.when(known, F.struct(*columns))


def join_splittable(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """``left.join(right, on, how)`` for inner, left and semi joins, with hot keys split.

    Adaptive execution splits a skewed join only if both sides come straight out of a
    shuffle made for it, and if nothing above needs the partitioning by the key. Neither
    holds when ``right`` was aggregated by the key or the result is. With the key wrapped
    in a struct no earlier or later partitioning fits, so both sides get such a shuffle.
    """
    keyed = right.select(_key(on).alias("_key"), *[c for c in right.columns if c not in on])
    return left.withColumn("_key", _key(on)).join(keyed, "_key", how).drop("_key")


# --- filters before a shuffle --------------------------------------------------------------

#: Bits of one piece of a key filter, and of a whole one at most, which is 16 MB.
PIECE_BITS, MOST_BITS = 1 << 15, 1 << 27


def _bits(key: Column, size: int) -> Column:
    """The key's bit; ``size`` is a power of two. Never null, so that no join computes it once more to see whether it is."""
    return F.xxhash64(key).bitwiseAND(F.lit(size - 1))


def key_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """A Bloom filter of the values of ``key``, in pieces, and its size in bits.

    It has 16 bits or more for each row of ``keys``, up to ``MOST_BITS``: beyond that it lets more of other
    keys pass, but never drops one of these. ``keys`` is read twice.
    """
    n = max(1, keys.count())
    size = min(MOST_BITS, max(PIECE_BITS, 1 << (16 * n - 1).bit_length()))
    bit = _bits(F.col(key), size)
    placed = keys.filter(F.col(key).isNotNull()).select(
        F.shiftright(bit, 15).alias("_piece"), bit.bitwiseAND(F.lit(PIECE_BITS - 1)).alias("_bit"))
    return placed.groupBy("_piece").agg(F.bitmap_construct_agg("_bit").alias("_bits")), size


def _words(bits: Column) -> Column:
    """The bitmap of a piece as 64-bit words, the first byte of each the highest; done once per piece, not per row."""
    return F.transform(F.sequence(F.lit(0), F.lit(PIECE_BITS // 64 - 1)), lambda i: F.conv(
        F.hex(F.substring(bits, 8 * i + 1, F.lit(8))), 16, -10).cast("bigint"))


def perhaps_in(df: DataFrame, key: str, filter_: tuple[DataFrame, int], below: bool = False) -> DataFrame:
    """Rows whose key is in the filter's keys, and few others; nothing is shuffled.

    What is broadcast has at most ``MOST_BITS`` bits, whatever the number of keys. With ``below`` the filter may go
    below an aggregation by the key that makes ``df``; a key that is costly to compute is then computed several times.
    """
    pieces, size = filter_
    words = F.broadcast(pieces.select(F.col("_piece").alias("_of"), _words(F.col("_bits")).alias("_words")))
    bit = _bits(F.col(key), size)
    hashed = bit if below else F.col("_hash")
    word = F.get("_words", F.shiftright(hashed.bitwiseAND(F.lit(PIECE_BITS - 1)), 6).cast("int"))
    place = hashed.bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)).cast("int")
    is_set = F.call_function("shiftright", word, place).bitwiseAND(F.lit(1)) == 1
    same = F.shiftright(hashed, 15) == F.col("_of")
    if below:
        return df.join(words, same & is_set, "left_semi")
    return df.withColumn("_hash", bit).join(words, same).filter(is_set).select(*df.columns)
