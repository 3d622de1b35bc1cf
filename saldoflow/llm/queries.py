"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldoflow.llm import (
    exact_dedup,
    hash_forest,
    html_extract,
    language_id,
    license_scan,
    line_rules,
    mixing,
    ngram_join,
    oracles,
    packing,
    quality,
    spelling,
    turn_repair,
    warc,
)
from saldoflow.sources.storage import new_folder

#: Sources by name that the mix wants more or less of; all others have weight 1.
MIX_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 2.0, "src3": 0.5}
MIX_SEED = 17
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.fit(docs, ~F.coalesce(held_out, F.lit(False)))
    return language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), MIX_WEIGHTS, seed=MIX_SEED)
    return mixed.select(*[f"doc.{c}" for c in DOCUMENT_COLUMNS], "n_copies", "copy", "shuffle_key")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).drop("matches")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    judged = quality.judge(docs, quality.fit(docs, labels(spark, sf_dir)))
    return judged.select("doc.doc_id", "log_weight", "key", "kept")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    index = exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", exact_dedup.buckets_for(docs.count()))
    marked = exact_dedup.mark(docs, index, batches=2)
    index.drop()  # this query begins anew each time; the marks are stored
    return marked


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(pages(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), TOKENIZER)


def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(documents(spark, sf_dir))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write_archive(pages(spark, sf_dir), folder)
    return warc.read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turn_repair.repair(turn_repair.damage(rows), rows)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir), damage=199)


def op13_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = hash_forest.HashForest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", top=20)
    found = forest.search(forest.rows.filter("id % 20 = 0"))
    return found.select(F.col("query_id").cast("long"), "rank", F.col("id").cast("long").alias("vec_id"), "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_mix_sources": op2_mix_sources,
    "op3_ngram_join": op3_ngram_join,
    "op4_license_scan": op4_license_scan,
    "op5_quality": op5_quality,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_main_text": op7_main_text,
    "op8_packing": op8_packing,
    "op9_line_rules": op9_line_rules,
    "op10_warc": op10_warc,
    "op11_turn_repair": op11_turn_repair,
    "op12_spelling": op12_spelling,
    "op13_hash_forest": op13_hash_forest,
}

ORACLES: dict[str, str] = {
    "op2_mix_sources": oracles.mixing(MIX_WEIGHTS, MIX_SEED),
    "op3_ngram_join": oracles.NGRAM_JOIN,
    "op4_license_scan": oracles.license_scan(license_scan.TEMPLATES, license_scan.BASE_PHRASES),
    "op6_exact_dedup": oracles.EXACT_DEDUP,
    "op9_line_rules": oracles.LINE_RULES,
    "op10_warc": oracles.WARC,
    "op11_turn_repair": oracles.turn_repair(),
    "op12_spelling": oracles.SPELLING,
}
