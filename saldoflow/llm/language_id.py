"""Language identification: the family first, then one-versus-one linear SVMs within the family.

A text's features are the relative frequencies of its byte n-grams (one to four bytes; A-Z as a-z,
every run of other ASCII characters as one space), hashed. Linear support vector machines are fitted on
at most ``per_language`` labelled texts of each language: one per family against the others, and one
per pair of languages of a family. They are fitted in parallel, one task each, and only their
weights come to the driver. A text's family is the one with the largest margin; the languages of
the family then vote pairwise, ties going to the larger sum of margins.

``und`` is returned, with score 0, for a null text, one without a letter, or without any labelled text
to learn from. The score is the softmax share of the family times the logistic value of the
language's smallest margin within it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saldoflow.llm import textarrays as ta
from saldoflow.sources.storage import stored

#: Parts in which the sample of a language is looked for before they meet.
SAMPLE_PARTS = 16
PER_LANGUAGE, ORDERS, BITS = 400, (1, 2, 3, 4), 15

#: Closely related languages by family; a language not named here is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "ug", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "semitic": ("ar", "he", "mt"),
    "malayic": ("id", "ms"),
}

_IS_SPACE = np.ones(256, bool)
_IS_SPACE[[*range(97, 123), *range(128, 256)]] = False


class Machine(NamedTuple):
    """A linear machine between two sets of languages; positive margins mean ``ours``."""

    ours: tuple[str, ...]
    others: tuple[str, ...]


class Model(NamedTuple):
    families: tuple[tuple[str, ...], ...]
    machines: tuple[Machine, ...]
    weights: np.ndarray  # a column per machine, and the last row for the biases


def family_of(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


def grams(block: ta.Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length, the features of the block's rows, in order, and their number per row."""
    data = ta.lower_ascii(block.data)
    space = _IS_SPACE[data]
    data = np.where(space, 32, data).astype(np.uint32)
    again = np.zeros(len(data), bool)
    again[1:] = space[1:] & space[:-1]
    begins = block.offsets[:-1]
    again[begins[begins < len(data)]] = False
    row = np.repeat(np.arange(block.last - block.first), np.diff(block.offsets))
    data, row = data[~again], row[~again]
    code = np.zeros(len(data), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(data) < n:
            code, at = code[:0], row[:0]
        else:
            code = (code[:len(data) - n + 1] << np.uint32(8)) | data[n - 1:]
            at = row[:len(data) - n + 1]
        if n in ORDERS:
            whole = at == row[n - 1:] if len(data) >= n else np.zeros(0, bool)
            mixed = (code[whole] * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519)
            yield (mixed >> np.uint32(32 - BITS)).astype(np.int64), np.bincount(
                at[whole], minlength=block.last - block.first)


def _sample_features() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The language, and the features and their frequencies, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in ta.blocks(batch.column(1)):
                found = [(f + (1 << BITS) * np.repeat(np.arange(len(c)), c), c) for f, c in grams(block)]
                value, count = np.unique(np.concatenate([f for f, _ in found]), return_counts=True)
                row, total = value >> BITS, np.maximum(sum(c for _, c in found), 1)
                sizes = np.bincount(row, minlength=block.last - block.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.last - block.first),
                     ta.list_column((value & ((1 << BITS) - 1)).astype(np.int32), sizes, pa.int32()),
                     ta.list_column((count / total[row]).astype(np.float32), sizes, pa.float32())],
                    ["lang", "features", "shares"])

    return run


def _fitted(rounds: int = 20, penalty: float = 1.0) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """A machine fitted by dual coordinate descent for the squared hinge loss."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["ours", "order"], ignore_index=True)
        mean = np.zeros(1 << BITS)
        for f, v in zip(rows["features"], rows["shares"], strict=True):
            mean[f] += v
        scale = 1 / np.sqrt(mean / len(rows) + 1e-4)
        xs = [(np.append(f, 1 << BITS), np.append(v * scale[f], 1.0)) for f, v in zip(rows["features"], rows["shares"], strict=True)]
        y = np.where(rows["ours"].to_numpy(bool), 1.0, -1.0)
        # Both sides count alike, however many rows each has.
        ridge = np.where(y > 0, (y > 0).mean(), (y < 0).mean()) / penalty
        square = np.array([v @ v for _, v in xs]) + ridge
        w, alpha = np.zeros((1 << BITS) + 1), np.zeros(len(xs))
        draw = np.random.default_rng(1)
        for _ in range(rounds):
            for i in draw.permutation(len(xs)):
                f, v = xs[i]
                gradient = y[i] * (w[f] @ v) - 1 + ridge[i] * alpha[i]
                new = max(alpha[i] - gradient / square[i], 0.0)
                if new != alpha[i]:
                    w[f] += (new - alpha[i]) * y[i] * v
                    alpha[i] = new
        w[:-1] *= scale
        return pd.DataFrame({"machine": [key[0]], "weights": [w.astype(np.float32)]})

    return run


def _machines(languages: Sequence[str]) -> tuple[tuple[tuple[str, ...], ...], tuple[Machine, ...]]:
    names = sorted({family_of(x) for x in languages})
    families = tuple(tuple(x for x in sorted(languages) if family_of(x) == name) for name in names)
    machines = [Machine(f, tuple(x for g in families if g != f for x in g)) for f in families if len(families) > 1]
    machines += [Machine((a,), (b,)) for f in families for a, b in combinations(f, 2)]
    return families, tuple(machines)


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Model:
    """Learns from the rows where ``learn`` holds and neither ``lang`` nor ``text`` is null.

    Of each language the ``per_language`` documents of least hash of ``doc_id`` are taken, whole texts; of rows that
    repeat doc_id and language, the text of least hash. Without rows to learn from nothing is predicted but ``und``.
    """
    spark = docs.sparkSession
    known = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # First the best of parts of a language, then of those at most SAMPLE_PARTS * per_language rows: no task reads a language.
    first, order = F.row_number(), [F.xxhash64("doc_id"), F.col("doc_id")]
    dealt = known.select("doc_id", "lang").distinct().withColumn("_part", F.spark_partition_id() % SAMPLE_PARTS)
    best = dealt.withColumn("nth", first.over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("nth") <= per_language)
    chosen = stored(best.select("doc_id", "lang").withColumn("nth", first.over(Window.partitionBy("lang").orderBy(*order)))
                    .filter(F.col("nth") <= per_language))
    languages = sorted(r.lang for r in chosen.select("lang").distinct().collect())
    families, machines = _machines(languages)
    if not machines:
        return Model(families, machines, np.zeros(((1 << BITS) + 1, 0), np.float32))
    # At most per_language rows of two numbers and a code for each language.
    picked = F.broadcast(chosen.select("doc_id", "lang", "nth"))
    sample = stored(known.join(picked, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")).select("lang", "text").mapInArrow(
        _sample_features(), "lang string, features array<int>, shares array<float>"))
    parts = spark.createDataFrame(
        [(i, x, side) for i, m in enumerate(machines) for side, xs in ((True, m.ours), (False, m.others)) for x in xs],
        "machine int, lang string, ours boolean")
    rows = sample.withColumn("order", F.xxhash64("features")).join(F.broadcast(parts), "lang")
    fitted = rows.select("machine", "ours", "order", "features", "shares").groupBy("machine").applyInPandas(
        _fitted(), "machine int, weights array<float>").orderBy("machine").toPandas()
    return Model(families, machines, np.stack([np.asarray(w, np.float32) for w in fitted["weights"]], axis=1))


def _margins(block: ta.Block, weights: np.ndarray) -> np.ndarray:
    """Margin of every machine for every row of a block."""
    sums, total = np.zeros((block.last - block.first, weights.shape[1])), np.zeros(block.last - block.first)
    for found, counts in grams(block):
        for j in range(weights.shape[1]):
            sums[:, j] += ta.sums_by_row(weights[:-1, j][found].astype(np.float64), counts)
        total += counts
    return sums / np.maximum(total, 1)[:, None] + weights[-1]


def _decided(margins: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each row of margins."""
    n = len(margins)
    names = [x for f in model.families for x in f]
    place = {x: i for i, x in enumerate(names)}
    votes, sums = np.zeros((n, len(names))), np.zeros((n, len(names)))
    least = np.full((n, len(names)), np.inf)
    of_family = np.zeros((n, len(model.families)))
    for j, machine in enumerate(model.machines):
        m = margins[:, j]
        if machine.ours in model.families and len(model.families) > 1 and j < len(model.families):
            of_family[:, j] = m
            continue
        a, b = place[machine.ours[0]], place[machine.others[0]]
        for x, value in ((a, m), (b, -m)):
            votes[:, x] += value > 0
            sums[:, x] += value
            least[:, x] = np.minimum(least[:, x], value)
    power = np.exp(4 * (of_family - of_family.max(axis=1, keepdims=True)))
    share = power / power.sum(axis=1, keepdims=True)
    family = share.argmax(axis=1)
    member = np.array([[x in f for x in names] for f in model.families])[family]
    rank = np.where(member, votes + np.tanh(sums) / 4, -np.inf)
    best = rank.argmax(axis=1)
    rows = np.arange(n)
    return np.array(names, object)[best], share[rows, family] / (1 + np.exp(-4 * least[rows, best]))


def predict(texts: DataFrame, model: Model) -> DataFrame:
    """``texts`` (any columns and ``text``, which is dropped) with ``lang_pred`` and ``score``."""
    held = texts.sparkSession.sparkContext.broadcast(model)
    others = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            letters = batch.column(len(others) + 1).fill_null(False).to_numpy(zero_copy_only=False)
            for block in ta.blocks(batch.column(len(others))):
                n = block.last - block.first
                langs, scores = np.full(n, "und", object), np.zeros(n)
                if known.families:
                    langs, scores = _decided(_margins(block, known.weights), known)
                none = ~letters[block.first:block.last]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(block.first, n) for i in range(len(others))]
                    + [pa.array(np.where(none, "und", langs), pa.string()), pa.array(np.where(none, 0.0, scores))],
                    [*others, "lang_pred", "score"])

    schema = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in others)
    letter = F.col("text").rlike(r"\p{L}")
    return texts.select(*others, "text", letter.alias("has_letter")).mapInArrow(
        run, f"{schema}, lang_pred string, score double")
