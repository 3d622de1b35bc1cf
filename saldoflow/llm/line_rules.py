"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules look at one text: its words, symbols, repeated lines and repeated three-word windows.
The cross-document rule normalises each line (lower case, white space as one space, trimmed),
hashes it to 64 bits and counts in how many distinct texts of the same host it stands. Lines beyond
the limit are removed, and a document with too small a share of its words left is rejected.

A null text has no words. A null host is a host of its own. Documents with one text count as one, so a
text isn't held against itself for being copied; rows may repeat, and all rows of a text are judged alike.
An empty table gives an empty result; columns beyond ``doc_id``, ``text`` and the host are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldoflow.operators.joins import join_splittable
from saldoflow.sources.storage import stored

WHITE = r"[\x20\x09-\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: A text of a host, by 128 bits of it.
TEXT_KEY = ("host", "hash1", "hash2")


def _repeats(named: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``, the words in three-word windows that stand twice or more."""
    windows = F.transform(F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))), lambda w, i: F.xxhash64(
        w, F.get("words", i + 1), F.get("words", i + 2)))
    placed = F.array_sort(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("at"))))
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    same = lambda x, k: x["w"] == F.get("placed", k)["w"]
    again = F.filter("placed", lambda x, k: F.coalesce(same(x, k - 1), F.lit(False)) | F.coalesce(same(x, k + 1), F.lit(False)))
    steps = F.transform("starts", lambda s, k: F.coalesce(F.least(F.get("starts", k + 1) - s, F.lit(3)), F.lit(3)))
    return (
        named.withColumn("windows", windows)
        .withColumn("placed", F.when(some, placed).otherwise(F.slice(placed, 1, 0)))
        .withColumn("starts", F.array_sort(F.transform(again, lambda x: x["at"])))
        .withColumn("n_repeat_words", F.aggregate(steps, F.lit(0), lambda a, b: a + b).cast("bigint"))
        .drop("windows", "placed", "starts")
    )


def _normal(line: Column) -> Column:
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(WHITE_CHARS)), WHITE, " "))


def profile(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per row of ``docs``: its measures and its hashed lines; one pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE_CHARS))
    bare = F.translate(text, WHITE_CHARS, "")
    named = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("host"),
        F.xxhash64(text).alias("hash1"), F.xxhash64(F.lit(1), text).alias("hash2"),
        F.length(bare).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("texts"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE)).alias("words"))
    one = F.transform(F.transform("texts", _normal), lambda x: F.struct(
        F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("n")))
    return _repeats(named).select(
        "doc_id", *TEXT_KEY, F.size("words").cast("bigint").alias("n_words"), "word_chars", "n_symbols",
        (F.size("texts") - F.size(F.array_distinct("texts"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words", one.alias("lines"))


def text_lines(profiles: DataFrame) -> DataFrame:
    """One row per text and distinct line of it: ``words`` in all places of the line, in all rows of the text.

    A row's lines are combined before they meet other rows, and no key is coarser than a text's line.
    """
    at = profiles.select(*TEXT_KEY, F.explode("lines").alias("at"))
    return at.groupBy(*TEXT_KEY, F.col("at.line").alias("line")).agg(F.sum("at.n").alias("words"))


def frequent_lines(lines: DataFrame, limit_docs: int) -> DataFrame:
    """``host`` and ``line`` of the lines in more than ``limit_docs`` of the host's distinct texts."""
    return lines.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > limit_docs).select("host", "line")


def words_removed(profiles: DataFrame, limit_docs: int) -> DataFrame:
    """The texts with frequent lines, and ``gone``, the words of those lines in one row of the text."""
    lines = stored(text_lines(profiles))
    hit = join_splittable(lines, stored(frequent_lines(lines, limit_docs)), ["host", "line"], "inner")
    total = hit.groupBy(*TEXT_KEY).agg(F.sum("words").alias("words"))
    rows = profiles.groupBy(*TEXT_KEY).agg(F.count("*").alias("rows"))
    return rows.join(total, [*TEXT_KEY]).select(*TEXT_KEY, F.expr("words div rows").alias("gone"))


def judge(docs: DataFrame, host: str = "source", min_words: int = 50, max_repeat_pct: int = 50,
          limit_docs: int = 20, min_left_pct: int = 30) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the measures, ``n_left_words``, ``base_failed``, ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_pct`` percent of
    them in repeated windows. ``n_left_words``: words outside lines that stand in more than
    ``limit_docs`` of the host's distinct texts, at every size of the host. ``kept``: not
    failed, and at least ``min_left_pct`` percent of the words left.
    """
    profiles = stored(profile(docs, host))
    joined = join_splittable(profiles.drop("lines"), stored(words_removed(profiles, limit_docs)), [*TEXT_KEY])
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    enough = 100 * F.col("n_left_words") >= min_left_pct * F.col("n_words")
    return joined.withColumn("n_left_words", F.col("n_words") - F.coalesce("gone", F.lit(0))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_left_words",
        failed.alias("base_failed"), (~failed & enough).alias("kept"))
