"""Numpy helpers over Arrow columns of texts: runs of characters and 64-bit hashes, many rows at once.

Texts are handled as UTF-8 bytes. Rows are taken in blocks of bounded size, so the arrays of a
task stay small however many or long the rows of a batch are; only a single text larger than the
block stands alone in one of its own size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
SPACE = np.zeros(256, np.uint8)
SPACE[[0x20, *range(0x09, 0x0E)]] = 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Block(NamedTuple):
    """Rows ``first`` to ``last`` (exclusive) of a column: their bytes and where each begins."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a string column; a null is an empty text."""
    texts = column.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    _, starts, data = texts.buffers()
    offsets = np.frombuffer(starts, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield Block(first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def runs(kinds: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of one kind other than 0 within a row."""
    cut = np.empty(len(kinds) + 1, bool)
    cut[0] = cut[-1] = True
    cut[1:-1] = kinds[1:] != kinds[:-1]
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    keep = kinds[starts] != 0
    return starts[keep], ends[keep]


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of the row in which each start lies; empty rows have none."""
    return np.searchsorted(offsets, starts, "right") - 1


_powers = {"n": 0, "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, BLOCK_BYTES)
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        tables = {"n": size, "up": np.cumprod(up, dtype=np.uint64), "down": np.cumprod(down, dtype=np.uint64)}
        if size > 16 * BLOCK_BYTES:  # of a huge text; not kept
            return tables["up"], tables["down"]
        _powers.update(tables)
    return _powers["up"], _powers["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each run."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix64(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_sequences(parts: Sequence[np.ndarray], seed: int = 0) -> np.ndarray:
    """64-bit hash of the sequence that stands at each place of the given arrays of hashes."""
    state = np.full(len(parts[0]), (seed * 1000003 + len(parts)) & 0xFFFFFFFF, np.uint64)
    for part in parts:
        state = mix64(state * _BASE + part)
    return state


def sums_by_row(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the values of each row, ``counts`` values to a row, in the values' own arithmetic."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A column of lists, ``counts`` values to a row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
