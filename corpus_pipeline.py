"""Pipeline that makes training sequences of ``documents``: filtered, deduplicated, mixed, packed.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``; all but the last return the
columns of ``documents``. Between stages the rows are written and read again, which cuts the lineage.

All stages share the memory of their executors, so texts go to Python in batches of ``BATCH_BYTES``, set for the
session, and a worker, which outlives its stage, remembers no more than ``REMEMBERED`` pieces of words.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from saldoflow.llm import exact_dedup, mixing, ngram_join, packing, quality, queries
from saldoflow.sources.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Most bytes of a batch that goes to Python (Spark's default is 64 MB), and pieces of words that a worker remembers.
BATCH_BYTES, REMEMBERED = 4 * 1024 * 1024, 100_000


def in_small_batches(stage: Stage) -> Stage:
    """The stage in a session whose batches are small from then on, as its rows may be computed later."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents among the top ``k`` of the importance resampling."""
    model = quality.fit(docs, queries.labels(spark, sf_dir))
    return quality.judge(docs, model).filter("kept").select("doc.*")


@in_small_batches
def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, by an index that begins empty."""
    index = exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}")
    kept = exact_dedup.deduplicate(docs, index, batches=2)
    index.drop()  # the decisions are stored
    return kept


@in_small_batches
def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of each group of similar ones."""
    return ngram_join.one_per_group(docs)


@in_small_batches
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the sources have their target weights, shuffled."""
    return mixing.mix(docs, queries.MIX_WEIGHTS, seed=queries.MIX_SEED).select("doc.*")


@in_small_batches
def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs, queries.TOKENIZER, remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_deduplication),
    ("n-gram Jaccard join", near_deduplication),
    ("mixing sources", source_mixing),
    ("packing", sequence_packing),
]

#: SQL can't express the quality model, the components or the packing; the tests compare each
#: stage with a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = queries.documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
