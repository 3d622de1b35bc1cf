"""Connected components by alternating large and small stars, in rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldoflow.operators.joins import join_splittable
from saldoflow.sources.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node that links lead to) of every node of ``edges(a, b)``.

    Each round replaces the links by links to smaller nodes with the same components: first every
    node's larger neighbours are linked to its smallest one, then its smaller neighbours are. When
    a round changes nothing, each node is linked to its root alone. Every round is stored, so lost
    executors cost no earlier round; the number of rounds grows with the logarithm of the nodes.
    """
    links = stored(_canonical(edges))
    total = None
    while True:
        links = stored(_small_star(_large_star(links)))
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == total:
            break
        total = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _canonical(edges: DataFrame) -> DataFrame:
    """Links from the larger to the smaller node, each once."""
    return edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours, linked to the smallest of its neighbours and itself."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("least")).select(
        "a", F.least("a", "least").alias("least"))
    joined = join_splittable(both.filter("b > a"), smallest, ["a"], "inner")
    return joined.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node's smaller neighbours and the node, linked to the smallest of them."""
    smallest = links.groupBy("a").agg(F.min("b").alias("least"))
    joined = join_splittable(links, smallest, ["a"], "inner")
    moved = joined.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(smallest.select("a", F.col("least").alias("b"))).distinct()
