"""Quality by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k.

A text's features are its tokens (runs of letters and digits, runs of signs) and pairs of neighbours,
hashed into ``buckets``. The target model counts them over documents labelled good, the raw model
over all documents. A document's log weight is the sum over its features of the log of the ratio of
both models; adding Gumbel noise hashed from its ``doc_id`` and taking the ``k`` largest draws ``k``
documents without replacement in proportion to their weights.

``k`` is the number of documents beyond the log weight that best parts the labelled sample. Only the
label sample is bounded (``sample`` rows, the smallest by a hash of ``doc_id``); both it and
the models, of ``buckets`` numbers, go to every task.

A null text has no features, and so log weight 0. Rows without a label count as raw text only; of
several labels of a ``doc_id`` the worst counts. Without labelled rows of both kinds all documents
stay. Rows that tie at the ``k``-th place stay together.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.llm import textarrays as ta
from saldoflow.sources.storage import stored

BUCKETS, SAMPLE, SEED = 1 << 14, 20_000, 29
#: Kinds of bytes: 0 white space, 1 letters, digits and all beyond ASCII, 2 signs.
KINDS = np.full(256, 2, np.uint8)
KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KINDS[[*range(0x09, 0x0E), 0x20]] = 0


class Model(NamedTuple):
    """Log ratio of target and raw model by bucket, and the least key of a document that stays."""

    ratios: np.ndarray
    seed: int
    least_key: float


def features(block: ta.Block, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of a block's rows, in order of rows, and their number per row."""
    data = ta.lower_ascii(block.data)
    starts, ends = ta.runs(KINDS[data], block.offsets)
    row = ta.rows_of(starts, block.offsets)
    token = ta.hash_runs(data, starts, ends)
    near = np.flatnonzero(row[:-1] == row[1:])
    pair = ta.hash_sequences([token[near], token[near + 1]])
    order = np.argsort(np.concatenate([row, row[near]]), kind="stable")
    counts = np.bincount(row, minlength=block.last - block.first)
    counts = counts + np.maximum(counts - 1, 0)
    return (np.concatenate([token, pair])[order] % np.uint64(buckets)).astype(np.int64), counts


def _counted(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of all rows and of the target's rows, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            good = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False) == 1
            for block in ta.blocks(batch.column(0)):
                found, counts = features(block, buckets)
                raw += np.bincount(found, minlength=buckets)
                chosen = np.repeat(good[block.first:block.last], counts)
                target += np.bincount(found[chosen], minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    return run


def _weights(ratios: np.ndarray) -> Callable[[Column], Column]:
    @F.arrow_udf("double")
    def weigh(texts: pa.Array) -> pa.Array:
        parts = []
        for block in ta.blocks(texts):
            found, counts = features(block, len(ratios))
            parts.append(ta.sums_by_row(ratios[found], counts))
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return weigh


def _key(weight: Column, doc_id: Column, seed: int) -> Column:
    """Log weight with Gumbel noise hashed from the ``doc_id``."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return weight - F.log(-F.log(uniform))


def label_sample(labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` rows ``(doc_id, quality)``, chosen by a hash."""
    worst = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    return worst.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight from which to take documents, with the fewest wrong of either kind."""
    if good.all() or not good.any():
        return -math.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    wrong = np.concatenate([[0], np.cumsum(g)]) + (~g).sum() - np.concatenate([[0], np.cumsum(~g)])
    place = np.concatenate([[True], w[1:] > w[:-1], [True]])  # equal weights stand together
    least = int(np.flatnonzero(place)[np.argmin(wrong[place])])
    if least == 0:
        return -math.inf
    return math.inf if least == len(w) else float((w[least - 1] + w[least]) / 2)


def kth_largest(keys: DataFrame, k: int, gathered: int = 10_000) -> float:
    """The ``k``-th largest number of column ``key``, by counts in ever finer ranges."""
    if k <= 0:
        return math.inf
    inside, above = keys, 0
    while True:
        low, high, n = inside.agg(F.min("key"), F.max("key"), F.count("key")).first()
        if k >= above + n:
            return low if low is not None else -math.inf
        if low == high:
            return low
        if n <= gathered:
            values = sorted((r.key for r in inside.collect()), reverse=True)
            return values[k - above - 1]
        step = (high - low) / 4096
        place = F.least(F.floor((F.col("key") - low) / step), F.lit(4095))
        counts = dict(inside.groupBy(place.alias("place")).agg(F.count("*").alias("n")).collect())
        for at in sorted(counts, reverse=True):
            if above + counts[at] >= k:
                break
            above += counts[at]
        inside = inside.filter(place == at)


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE,
        seed: int = SEED) -> Model:
    """Models of target and raw text, and the key that the top ``k`` of ``docs`` reach."""
    known = F.broadcast(stored(label_sample(labels, sample)))
    labelled = docs.select("doc_id", "text").join(known, "doc_id", "left")
    counts = labelled.select("text", "quality").mapInArrow(
        _counted(buckets), "bucket bigint, raw bigint, target bigint"
    ).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.ones(buckets), np.ones(buckets)
    raw[counts["bucket"]] += counts["raw"]
    target[counts["bucket"]] += counts["target"]
    ratios = np.log(target / target.sum()) - np.log(raw / raw.sum())

    weight = _weights(ratios)(F.col("text"))
    scored = stored(labelled.select("doc_id", "quality", weight.alias("weight")).select(
        "quality", "weight", _key(F.col("weight"), F.col("doc_id"), seed).alias("key")))
    judged = scored.filter("quality IS NOT NULL").limit(4 * sample).toPandas()  # rows that repeat a label's doc_id count too
    cut = best_cut(judged["weight"].to_numpy(float), judged["quality"].to_numpy() == 1)
    k = scored.filter(F.col("weight") >= cut).count()
    return Model(ratios, seed, kth_largest(scored.select("key"), k))


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """``doc`` (all columns of the row), ``log_weight``, ``key`` and ``kept`` of every row."""
    named = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"),
                        _weights(model.ratios)(F.col("text")).alias("log_weight"))
    keyed = named.withColumn("key", _key(F.col("log_weight"), F.col("id"), model.seed))
    return keyed.select("doc", "log_weight", "key", (F.col("key") >= model.least_key).alias("kept"))
