"""Grouping of spelling variants by permuterm rotations.

Every word gets a terminator and is rotated. A rotation that begins after the code point at some place
ends with it, so without its last code point it is the same for all words that differ only
there, and for the word that lacks that code point it is the whole rotation. Sorted by these
prefixes, a word's replacements, deletions and insertions stand beside each other; a group holds one whole
rotation at most and one row per code point of the alphabet. A scan of the sorted groups counts
each word's neighbours and picks the largest, without listing pairs.

A word in which the skipped code point follows an equal one gives the same shorter word as that one, so
only the first of a run meets whole rotations: no two words meet twice.

Words are runs of ``A-Z a-z`` and U+00C0 to U+00FF with only A-Z lower-cased, of ``MIN_LENGTH`` code points and
``MIN_COUNT`` occurrences at least over all texts, of any length. Two words are near if one code point is
inserted, deleted or replaced. A word's form is its near word with the largest count (ties: the smallest
in order of code points) if that count is ``RATIO`` times its own at least; its root is where forms lead in the end.

A null text has no words; texts are read whole; rows that repeat count each time; a null ``doc_id`` counts as
an empty one where words are damaged; an empty table gives no rows, and other columns are left alone.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldoflow.operators.joins import join_splittable
from saldoflow.sources.storage import stored

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
END = "$"  # no word has it
#: Rotations up to this length are sorted as text, longer ones by a hash, as a word has as many as code points.
AS_TEXT = 64
_RUN = re.compile("[a-zÀ-ÿ]+")
_HELD = 200_000  # counts that a task holds before it passes them on
_MODULI = ((1 << 61) - 1, (1 << 61) - 31)
_BASES = (0x1F3D5B79A2C4E6F1, 0x0B7E151628AED2A6)


def _counting(damage: int | None) -> Callable:
    """Counts of the words of ``(doc_id as text, text)``; with ``damage``, some lose a code point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            words = [w for w in counts if len(w) >= MIN_LENGTH]
            numbers = [counts[w] for w in words]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, text in zip(*batch.columns, strict=True):
                runs = _RUN.findall((text.as_py() or "").encode().lower().decode())  # A-Z only
                if damage is None:
                    counts.update(runs)
                else:
                    begin = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                    for word, n in Counter(runs).items():
                        h = zlib.crc32(word.encode(), begin)
                        if h % damage == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                        counts[word] += n
                if len(counts) > _HELD:
                    yield flush()
        yield flush()

    return run


def vocabulary(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough.

    With ``damage``, a run whose crc32 of ``<doc_id>:<run>`` it divides loses the code point at that number
    modulo its length.
    """
    texts = docs.select(F.col("doc_id").cast("string"), "text")
    counts = texts.mapInArrow(_counting(damage), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _hashes(marked: str) -> Callable[[int, int], str]:
    """Text that stands for the part of ``marked * 2`` from a place, of a length, by two rolling hashes."""
    sums, powers = [], []
    for mod, base in zip(_MODULI, _BASES, strict=True):
        total, power, s, p = 0, 1, [0], [1]
        for c in marked + marked:
            total = (total * base + ord(c) + 1) % mod
            power = power * base % mod
            s.append(total)
            p.append(power)
        sums.append(s)
        powers.append(p)

    def part(at: int, length: int) -> str:
        values = [(s[at + length] - s[at] * p[length]) % mod for s, p, mod in zip(sums, powers, _MODULI, strict=True)]
        return f"{END}{END}{length}:{values[0]:x}:{values[1]:x}"  # no rotation has two terminators

    return part


def rotations(word: str) -> Iterator[tuple[str, int]]:
    """Sort key and kind of a word's rotations: 0 whole, 1 without the last code point, 2 the same within a run."""
    marked = word + END
    size = len(marked)
    twice = marked + marked
    whole = skipped = lambda at, length: twice[at:at + length]
    if size > AS_TEXT:
        whole = hashed = _hashes(marked)
        skipped = hashed if size - 1 > AS_TEXT else skipped
    for at in range(size):
        yield whole(at, size), 0
    for at, c in enumerate(word):
        yield skipped(at + 1, size - 1), 2 if at and word[at - 1] == c else 1


def _rotating(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "kind", "id", "n"]
    kinds = [pa.string(), pa.int8(), pa.int64(), pa.int64()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    rows: list[tuple] = []
    for batch in batches:
        for i, word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            for key, kind in rotations(word):
                rows.append((key, kind, i, n))
                if len(rows) >= 20_000:
                    yield made(rows)
                    rows = []
    if rows:
        yield made(rows)


def neighbours(words: DataFrame) -> DataFrame:
    """``id``, ``n_near`` and ``best`` (count and id of the largest near word) of words with near ones.

    ``words`` has ``id`` (in order of the words), ``word`` and ``n``. Groups are at most as large as the alphabet
    and one; in each, rows are ranked by count and id, and a row's best neighbour is the first or second.
    """
    rows = words.select("id", "word", "n").mapInArrow(_rotating, "key string, kind tinyint, id bigint, n bigint")
    group = Window.partitionBy("key")
    whole, skipping, first = F.col("kind") == 0, F.col("kind") > 0, F.col("kind") == 1
    this = F.struct((-F.col("n")).alias("less"), "id")  # the least is the largest count, then the first word
    counted = rows.withColumns({
        "others": F.count_if(skipping).over(group), "firsts": F.count_if(first).over(group), "wholes": F.count_if(whole).over(group),
        "top": F.min(F.when(skipping, this)).over(group), "top_first": F.min(F.when(first, this)).over(group),
        "top_whole": F.min(F.when(whole, this)).over(group),
    }).filter("others + wholes > 1")
    counted = counted.withColumn("second", F.min(F.when(skipping & (F.col("id") != F.col("top.id")), this)).over(group))
    other = F.when(F.col("id") != F.col("top.id"), F.col("top")).otherwise(F.col("second"))
    near = (F.when(whole, F.col("firsts")).when(first, F.col("others") - 1 + F.col("wholes")).otherwise(F.col("others") - 1))
    best = (F.when(whole, F.col("top_first")).when(first, F.least(other, "top_whole")).otherwise(other))
    return counted.select("id", near.alias("near"), best.alias("best")).groupBy("id").agg(
        F.sum("near").alias("n_near"), F.min("best").alias("best")).filter("n_near > 0").select(
        "id", "n_near", F.struct((-F.col("best.less")).alias("n"), F.col("best.id").alias("id")).alias("best"))


def _roots(words: DataFrame) -> DataFrame:
    """``id`` and ``root`` (an id), by following twice as many forms in each round.

    Each form has ``RATIO`` times the count at least, so the largest count bounds the rounds.
    """
    most = words.agg(F.max("n")).first()[0] or 1
    steps, far = 0, MIN_COUNT
    while far <= most:
        far, steps = far * RATIO, steps + 1
    at = words.select("id", F.coalesce("form_id", "id").alias("root"))
    for _ in range(max(0, steps - 1).bit_length()):
        at = stored(at)
        following = at.select(F.col("id").alias("root"), F.col("root").alias("next"))
        at = join_splittable(at, following, ["root"], "inner").select("id", F.col("next").alias("root"))
    return at


def variants(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    found = vocabulary(docs, damage)
    # Numbers in order of code points, which is the order of UTF-8.
    words = stored(found.repartitionByRange("word").sortWithinPartitions("word").select(
        F.monotonically_increasing_id().alias("id"), "word", "n"))
    near = neighbours(words)
    formed = F.col("best.n") >= RATIO * F.col("n")
    told = stored(words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, F.col("best.id")).alias("form_id"), F.when(formed, F.col("best.n")).alias("form_n")))
    named = told.join(_roots(told), "id")
    forms = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    roots = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    with_form = join_splittable(named, forms, ["form_id"], "left")
    return join_splittable(with_form, roots, ["root"], "left").select(
        "word", "form", F.col("root_word").alias("root"), "n", "n_near", "form_n")
