"""Digest trees: where two lists of keys differ, found without joining the lists.

Keys fall into leaves by their hash. A leaf is told by how many keys it has and by 128 bits that don't
depend on their order, and a node by the same of its leaves, so what is shuffled is one short row per leaf,
combined in each task before. Trees are compared from the top; only nodes that differ are opened. Rows
of leaves that differ can then be joined, and the others are left out before any shuffle of them.

A key that one list repeats makes its leaf differ, so lists need not be distinct: the join decides.
NULL keys belong to no leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import stored
from .joins import key_filter, perhaps_in

#: Rows of a leaf, on the average, and by how many bits a level is finer than the one above it.
LEAF_ROWS, LEVEL_BITS = 16, 6
DIGEST = ("n", "x1", "x2")


def _leaf(key: str, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits)


def leaf_bits(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Bits that number the leaves of a list of so many rows."""
    return max(1, (rows // leaf_rows).bit_length())


def leaves(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """``leaf`` and its digest (``n``, ``x1``, ``x2``) of every leaf that has a row."""
    return rows.filter(F.col(key).isNotNull()).groupBy(_leaf(key, bits).alias("leaf")).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(key)).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), key)).alias("x2"))


def _level(tree: DataFrame, up: int, name: str) -> DataFrame:
    """The tree's nodes ``up`` bits above the leaves, their digests in one column."""
    return tree.groupBy(F.shiftright("leaf", up).alias("node")).agg(
        F.struct(F.sum("n"), F.bit_xor("x1"), F.bit_xor("x2")).alias(name))


def differing_leaves(left: DataFrame, right: DataFrame, bits: int) -> DataFrame:
    """``leaf`` of every leaf whose digests differ or that only one of two trees of ``bits`` has."""
    found = None
    for up in [u for u in (2 * LEVEL_BITS, LEVEL_BITS, 0) if u < bits]:
        sides = []
        for tree, name in ((left, "a"), (right, "b")):
            if found is not None:
                tree = tree.withColumn("node", F.shiftright("leaf", up + LEVEL_BITS)).join(found, "node", "left_semi")
            sides.append(_level(tree, up, name))
        # Stored, as both sides of the next level read it.
        found = stored(sides[0].join(sides[1], "node", "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("node"))
    return found.withColumnRenamed("node", "leaf")


@dataclass(frozen=True)
class Suspects:
    """The leaves in which two lists differ, as a filter of bounded size that rows pass without a shuffle."""

    bits: int
    filter: tuple[DataFrame, int]

    def of(self, rows: DataFrame, key: str) -> DataFrame:
        """The rows of all keys of those leaves, and few others; for one key all rows or none, whatever the list."""
        return perhaps_in(rows.withColumn("_leaf", _leaf(key, self.bits)), "_leaf", self.filter).drop("_leaf")


def suspects(left: DataFrame, right: DataFrame, key: str, leaf_rows: int = LEAF_ROWS) -> Suspects:
    """Where the lists differ by ``key``; each is read twice, to count it and for its leaves."""
    bits = leaf_bits(max(left.count(), right.count()), leaf_rows)
    trees = [stored(leaves(side, key, bits)) for side in (left, right)]
    return Suspects(bits, key_filter(differing_leaves(*trees, bits), "leaf"))
