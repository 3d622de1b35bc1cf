"""Mixing of sources to target weights by Poisson replication.

Every source has a target weight. Its documents are wanted ``rate`` times on average, so that the
characters of the result are shared out by the weights; each document's number of copies is the
inverse of the Poisson distribution of that mean at a number in (0, 1) hashed from seed and
``doc_id``. The copies are dealt to all tasks by a second hash and sorted by it, which is a uniform
shuffle with one exchange. Only DataFrame functions are used.

A null source is a source of its own. A source without any text keeps each of its rows once. Rows
that repeat a ``doc_id`` get the same number of copies each; a null ``doc_id`` hashes like a value.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.sources.storage import stored

#: A mean above this is drawn as the sum of several Poisson numbers, whose terms can't underflow.
PIECE = 32.0


def _hashed(seed: int, *parts: Column) -> Column:
    """52 bits hashed from seed and parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def source_rates(docs: DataFrame, weights: Mapping[str, float], default_weight: float = 1.0,
                 replication: float = 1.0) -> DataFrame:
    """One row per source: ``source``, ``size`` (characters), ``n_docs``, ``rate``.

    A source that ``weights`` doesn't name has ``default_weight``. The result of mixing has about
    ``replication`` times the characters of the input.
    """
    weight = F.lit(default_weight)
    for source, value in weights.items():
        weight = F.when(F.col("source") == source, F.lit(float(value))).otherwise(weight)
    sizes = stored(docs.groupBy("source").agg(
        F.sum(F.length(F.coalesce(F.col("text"), F.lit("")))).alias("size"),
        F.count("*").alias("n_docs")).withColumn("weight", weight))
    total = sizes.agg(F.sum("size").alias("size"), F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("weight")).first()
    share = F.lit(replication * float(total.size or 0)) * F.col("weight") / (F.lit(total.weight or 1.0) * F.col("size"))
    return sizes.select("source", "size", "n_docs", F.when(F.col("size") > 0, share).otherwise(1.0).alias("rate"))


def _with_cdf(rates: DataFrame) -> DataFrame:
    """Adds ``pieces`` and ``cdf``, the Poisson distribution function of ``rate / pieces``."""
    pieced = rates.withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE)).cast("int"))
    pieced = pieced.withColumn("mean", F.col("rate") / F.col("pieces"))
    last = (F.col("mean") + 12 * F.sqrt("mean") + 40).cast("int")
    start = F.struct(F.array(F.exp(-F.col("mean"))).alias("cdf"), F.exp(-F.col("mean")).alias("term"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * F.col("mean") / k
        return F.struct(F.concat(state["cdf"], F.array(F.element_at(state["cdf"], -1) + term)).alias("cdf"),
                        term.alias("term"))

    return pieced.withColumn("cdf", F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["cdf"]))


def mix(docs: DataFrame, weights: Mapping[str, float], default_weight: float = 1.0,
        replication: float = 1.0, seed: int = 0) -> DataFrame:
    """``docs`` replicated and shuffled.

    Returns ``doc`` (a struct of all columns of the row), ``rate``, ``n_copies``, ``copy`` (from 1)
    and ``shuffle_key``, in the order of which each partition is sorted.
    """
    rates = _with_cdf(source_rates(docs, weights, default_weight, replication))
    rates = rates.select(F.struct(F.col("source")).alias("key"), "rate", "pieces", "cdf")
    named = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"),
                        F.struct(F.col("source")).alias("key"))

    def drawn(piece: Column) -> Column:
        uniform = (_hashed(seed, F.col("id"), piece).cast("double") + 0.5) / float(1 << 52)
        return F.size(F.filter("cdf", lambda c: c <= uniform))

    counted = named.join(stored(rates), "key").withColumn("n_copies", F.aggregate(
        F.sequence(F.lit(1), F.col("pieces")), F.lit(0), lambda total, piece: total + drawn(piece)))
    copies = counted.filter("n_copies > 0").select(
        "doc", "rate", "n_copies", "id", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"))
    keyed = copies.withColumn("shuffle_key", _hashed(seed, F.lit("order"), F.col("id"), F.col("copy")))
    return keyed.drop("id").repartition("shuffle_key").sortWithinPartitions("shuffle_key")
