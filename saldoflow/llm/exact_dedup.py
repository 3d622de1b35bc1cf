"""Exact deduplication against a persistent index of text digests.

The index is a table bucketed and sorted by digest. A batch is reduced to one row per digest,
reduced by a sort-merge anti-join to the digests that the index doesn't hold, and those are
appended, so a later batch is only compared by digest and the index is never shuffled again.

Texts are equal when they are identical after every run of white space became one space. A null
text counts as empty. Of equal texts the row with the smallest ``doc_id`` stays, a null ``doc_id``
being larger than any other; of rows that repeat both, exactly one stays. A batch that is sent again, as after a
failure, gets the same answers: a text stays if its row is the one that the index has for it. ``doc_id`` has one type in
all batches, that of the index. An empty table gives no rows, and other columns, whatever their names, are left alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldoflow.operators.joins import join_splittable
from saldoflow.sources.storage import stored

WHITE = r"[\x20\x09-\x0D]+"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of white space as one space."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " "), 256))


def buckets_for(rows: int, per_bucket: int = 4_000_000) -> int:
    """Buckets for an index of so many texts, at least 64."""
    return max(64, -(-rows // per_bucket))


class DigestIndex:
    """Table ``(digest, keep_id)`` of all texts seen so far, one row per digest.

    ``buckets`` is fixed when the table is made; choose it so that a bucket of the final index
    fits a task (``buckets_for``). ``id_type`` is the type of ``doc_id``.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = 64, id_type: str = "bigint"):
        self.spark, self.name, self.buckets = spark, name, buckets
        if not spark.catalog.tableExists(name):
            self._append(spark.createDataFrame([], f"digest binary, keep_id {id_type}"))

    def _append(self, rows: DataFrame) -> None:
        placed = rows.repartition(self.buckets, "digest")  # one task, and so one file, per bucket
        writer = placed.write.format("parquet").mode("append").bucketBy(self.buckets, "digest")
        writer.sortBy("digest").saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def append(self, digests: DataFrame) -> DataFrame:
        """Adds the new ones of ``(digest, doc_id, row)`` to the index.

        Returns one row per digest of the batch: ``digest``, ``keep_id`` (as the index has it),
        ``group_size`` (rows of the batch), ``stays`` (not in the index before, or there by this very
        row) and ``keep_row`` (``row`` of the batch's smallest ``doc_id``).
        """
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
        groups = stored(
            digests.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size"))
            .select("digest", "group_size", F.col("first.doc_id").alias("first_id"),
                    F.col("first.row").alias("keep_row"))
        )
        fresh = stored(
            groups.join(self.read().hint("merge"), "digest", "left_anti")
            .select("digest", F.col("first_id").alias("keep_id"))
        )
        known = groups.join(self.read().hint("merge"), "digest").select(
            "digest", "keep_id", "group_size", F.col("first_id").eqNullSafe(F.col("keep_id")).alias("stays"), "keep_row")
        added = groups.join(fresh, "digest").select(
            "digest", "keep_id", "group_size", F.lit(True).alias("stays"), "keep_row")
        groups = stored(known.unionByName(added))
        self._append(fresh)
        return groups


def _appended(digests: DataFrame, index: DigestIndex, batches: int) -> DataFrame:
    """``index.append`` of each batch in order of ``doc_id``, null last; one row per digest and batch.

    Ids that are no numbers come in one batch.
    """
    numbers = isinstance(digests.schema["doc_id"].dataType, T.NumericType)
    shares = [i / batches for i in range(1, batches)] if numbers else []
    cuts = digests.agg(F.percentile_approx("doc_id", shares)).first()[0] if shares else None
    before = F.lit(False)
    found = []
    for cut in [*sorted(set(cuts or [])), None]:
        here = F.lit(True) if cut is None else F.coalesce(F.col("doc_id") <= cut, F.lit(False))
        found.append(index.append(digests.filter(here & ~before)))
        before = here
    return reduce(DataFrame.unionByName, found)


def mark(docs: DataFrame, index: DigestIndex, batches: int = 1) -> DataFrame:
    """What becomes of each row of ``docs``, whose new digests are added to the index.

    Returns ``doc_id``, ``keep_id`` (row that stays, perhaps of an earlier batch), ``group_size``
    (equal rows in ``docs``), ``kept`` and ``text_sha256``. The rows reach the index in so many
    ``batches`` by ``doc_id``, which changes no result.
    """
    digests = stored(docs.select("doc_id", text_digest(F.col("text")).alias("digest"),
                                 F.monotonically_increasing_id().alias("row")))
    appended = _appended(digests, index, batches)
    groups = appended.groupBy("digest").agg(
        F.first("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
        F.max(F.when(F.col("stays"), F.col("keep_row"))).alias("keep_row"))
    return join_splittable(digests, groups, ["digest"], "inner").select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, index: DigestIndex, batches: int = 1) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; their digests join the index.

    Rows meet their decision by digest and ``doc_id``, so copies of one text spread over all
    tasks. Rows that repeat both leave one. ``batches`` as for ``mark``.
    """
    named = docs.select(F.struct("*").alias("doc"), text_digest(F.col("text")).alias("digest"),
                        F.col("doc_id").alias("id"))
    digests = stored(named.select("digest", F.col("id").alias("doc_id"), F.lit(0).cast("bigint").alias("row")))
    groups = _appended(digests, index, batches)
    stays = groups.filter("stays").select("digest", F.col("keep_id").alias("id"))
    on = (F.col("l.digest") == F.col("r.digest")) & F.col("l.id").eqNullSafe(F.col("r.id"))
    return (named.alias("l").join(stays.alias("r"), on, "left_semi")
            .dropDuplicates(["digest", "id"]).select("doc.*"))
