"""Packing of tokenised documents into sequences: first-fit decreasing in randomised groups.

A document is cut into pieces of the sequence length, which fill a sequence each, and a rest. Rows are
dealt at random to groups of about ``group_docs`` rows; in each group the rests, longest first, go
to the first sequence with room. A tournament tree over the sequences' room finds it in logarithmic
time. A group needs only lengths and checksums, so its memory doesn't depend on the texts, and
groups are packed independently.

A null text is an empty document: its end token alone. Rows may repeat; each row is packed.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldoflow.sources.storage import stored

#: Pieces of words whose ids a worker remembers, the longest one that it does, and characters taken at a time.
CACHED_PIECES, CACHED_LENGTH, CHARACTERS = 600_000, 48, 1 << 20

#: Runs of Latin letters and runs of ASCII signs and digits, between which no token can lie; where a word
#: has an apostrophe or any other character, it is left whole; so has U+0130, whose lower case is two characters.
_PIECE = re.compile("[a-zÀ-ÖØ-öø-ɏ]+|[^a-zÀ-ÖØ-öø-ɏ \n]+")
_ODD = re.compile("[^ -&(-~\nÀ-ÖØ-öø-įı-ɏ]")


def _pieces(text: str) -> list[str]:
    text = text.encode().lower().decode()  # A-Z only
    if not _ODD.search(text):
        return _PIECE.findall(text)
    return [p for w in text.replace("\n", " ").split(" ") for p in ([w] if _ODD.search(w) else _PIECE.findall(w))]


class PieceEncoder:
    """Token ids of whole texts, encoded by pieces of words and remembered.

    For tokenizers that lower-case, drop white space, and part letters from signs. A text that holds the string of
    a special token, in any case of letters, is encoded whole.
    """

    def __init__(self, path: str, remembered: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.remembered = remembered

    def _has_special(self, text: str) -> bool:
        lower = text.lower()
        return any(s in lower for s in self.special)

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        pieces = [[t] if self._has_special(t) else _pieces(t) for t in texts]
        distinct = {p for ps in pieces for p in ps}
        ids = {p: self.known[p] for p in distinct if p in self.known}
        missing = [p for p in distinct if p not in ids]
        found = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        new = {p: np.array(e.ids, "<u4").tobytes() for p, e in zip(missing, found, strict=True)}
        ids.update(new)
        room = max(0, self.remembered - len(self.known))
        self.known.update(islice(((p, b) for p, b in new.items() if len(p) <= CACHED_LENGTH), room))
        return [b"".join(map(ids.__getitem__, ps)) for ps in pieces]


def _portions(texts: pa.Array) -> Iterator[list[str]]:
    """The texts, in order, a bounded number of characters or a single text at a time."""
    held, size = [], 0
    for text in texts:
        text = text.as_py() or ""
        if held and size + len(text) > CHARACTERS:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


@cache
def _encoder(path: str, remembered: int) -> PieceEncoder:
    """One per worker, which may run many tasks."""
    return PieceEncoder(path, remembered)


def first_fit_decreasing(lengths: Sequence[int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; longest first, each into the first bin with room.

    ``tree[1]`` is the most room of any bin, ``tree[2 * i]`` and ``tree[2 * i + 1]`` that of the two
    halves of the bins below ``tree[i]``, and the leaves are the bins.
    """
    lengths = np.asarray(lengths, np.int64)
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    tree = [size] * (2 * leaves)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for item in np.argsort(-lengths, kind="stable"):
        length, i = int(lengths[item]), 1
        while i < leaves:
            i = 2 * i if tree[2 * i] >= length else 2 * i + 1
        bins[item], offsets[item] = i - leaves, size - tree[i]
        tree[i] -= length
        while i > 1:
            i //= 2
            tree[i] = max(tree[2 * i], tree[2 * i + 1])
    return bins, offsets


def _tokenised(path: str, size: int, end_id: int, remembered: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``doc_id``, number of ids and the checksum of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            counts, sums = [], []
            for texts in _portions(batch.column(1)):
                for ids in _encoder(path, remembered).ids(texts):
                    ids += end
                    counts.append(len(ids) // 4)
                    sums.append([zlib.crc32(ids[i:i + 4 * size]) for i in range(0, len(ids), 4 * size)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.list_(pa.int64()))],
                ["doc_id", "doc_tokens", "sums"])

    return run


def _packed(size: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """The pieces of one group's rows and where they lie."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        tokens = rows["doc_tokens"].to_numpy()
        pieces = np.array([len(s) for s in rows["sums"]], np.int64)
        at = np.repeat(np.arange(len(rows)), pieces)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = nth * size
        length = np.minimum(tokens[at] - start, size)
        rest = np.flatnonzero(length < size)
        sequence, offset = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        sequence[rest], offset[rest] = first_fit_decreasing(length[rest], size)
        used = int(sequence[rest].max()) + 1 if len(rest) else 0
        full = np.flatnonzero(length == size)
        sequence[full] = used + np.arange(len(full))
        return pd.DataFrame({
            "doc_id": rows["doc_id"].to_numpy()[at], "start": start, "length": length,
            "ids_crc32": np.concatenate(rows["sums"].to_list()).astype(np.int64), "doc_tokens": tokens[at],
            "sequence_id": (np.int64(key[0]) << 32) + sequence, "offset": offset})

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2, group_docs: int = 4096,
         remembered: int = CACHED_PIECES) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is its ids by the tokenizer file, without special tokens, and ``end_id``. No
    sequence is longer than ``size``, and each is filled from offset 0 without gaps. A worker remembers the ids of
    ``remembered`` pieces of words, some 200 bytes each, for as long as it lives; fewer take more time.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = stored(
        docs.select("doc_id", "text")
        .mapInArrow(_tokenised(tokenizer, size, end_id, remembered), f"doc_id {kind}, doc_tokens bigint, sums array<bigint>")
        .withColumn("row", F.monotonically_increasing_id()))
    groups = max(1, -(-rows.count() // group_docs))
    grouped = rows.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return grouped.groupBy("group").applyInPandas(
        _packed(size), f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint")
