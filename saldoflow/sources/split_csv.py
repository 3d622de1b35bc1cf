"""Large CSV members read by many tasks.

A member's bytes are cut into ranges of equal size. Whether a cut lies within a quoted cell can't be seen from
the bytes around it, so each range is scanned, apart from the others, for each state that it may begin in:
what state it ends in, and where its first record ends. Combining the ranges of a member in order fixes all
states, and so where records begin; ranges from record to record are then parsed apart. What moves between tasks
are these few numbers; the bytes are read where they lie. A deflated member can only be read from its
start, so one task first writes it out into the shared folder.

The states are those of the reader that parses the ranges: a quote opens a cell only at the cell's start, and two quotes
within are one. Checksums of ranges are combined too, so a damaged member is found as in one pass.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .archives import Member, store_of
from .storage import new_folder, stored

#: Bytes of a range; ends of records are looked for in each.
RANGE_BYTES = 32 * 1024 * 1024
#: Inflated bytes of a task, unless one range has more.
TASK_BYTES = 16 * 1024 * 1024
#: At a cell's start, within a plain cell, within a quoted one, after a quote within a quoted one.
START, PLAIN, QUOTED, CLOSING = range(4)
QUOTE, NEWLINE = b'"', b"\n"

MEMBER = "archive string, entry int, member string, kind string"
SOURCE = f"{MEMBER}, store string, path string, offset bigint, size bigint, crc bigint, problem string"
SCANNED = f"{SOURCE}, nth bigint, begin bigint, until bigint, sum bigint, ends array<int>, firsts array<bigint>"
UNIT = f"{SOURCE}, unit bigint, header bigint, begin bigint, until bigint"


# --- one range -----------------------------------------------------------------------------

#: Within a quoted cell up to its last quote, the rest of a cell, whole cells from a cell's start, and those of the first record.
_INNER, _REST, _CELL = rb'(?:[^"]++|"")*+', rb"[^;\r\n]*+", rb'(?:"(?:[^"]++|"")*+"|(?!"))[^;\r\n]*+'
_QUOTED, _PLAIN = re.compile(_INNER), re.compile(_REST)
_CELLS = re.compile(rb"(?:" + _CELL + rb"[;\r\n])*+")
_RECORD = re.compile(rb"(?:" + _CELL + rb"[;\r])*+" + _CELL + rb"\n")


def scan(data: bytes, state: int) -> tuple[int, int]:
    """State after ``data`` and the place after its first record's end, -1 if none ends; from a state."""
    first, at, size = -1, 0, len(data)
    if not size:
        return state, first
    if state == CLOSING:  # a second quote is a quote, anything else ends the quoted part
        state, at = (QUOTED, 1) if data[:1] == QUOTE else (PLAIN, 0)
    if state == START:
        record = _RECORD.match(data)
        first, at = record.end() if record else -1, _CELLS.match(data).end()
        if at == size:
            return START, first
        if data[at:at + 1] != QUOTE:
            return PLAIN, first
        state, at = QUOTED, at + 1
    elif state == PLAIN and data[at:at + 1] == QUOTE:
        at += 1
    if state == QUOTED:
        at = _QUOTED.match(data, at).end()
        if at == size:
            return QUOTED, first
        if (at := at + 1) == size:
            return CLOSING, first
    at = _PLAIN.match(data, at).end()  # the rest of the cell that the range begins or ends in
    if at == size:
        return PLAIN, first
    at += 1
    after, found = scan(data[at:], START) if at < size else (START, -1)
    return after, at if data[at - 1:at] == NEWLINE else at + found if found >= 0 else -1


def scans(data: bytes) -> list[tuple[int, int]]:
    """``scan`` from every state; those that the first byte makes one are scanned once."""
    quoted, plain = scan(data, QUOTED), scan(data, PLAIN)
    if not data:
        return [scan(data, s) for s in range(4)]
    if data[:1] == QUOTE:
        opened = scan(data, START)
        return [opened, plain, quoted, opened]
    return [plain, plain, quoted, plain]


def _times_x(value: int, polynomial: int = 0xEDB88320) -> int:
    return (value >> 1) ^ (polynomial if value & 1 else 0)


def _product(a: int, b: int) -> int:
    """Of two polynomials modulo the checksum's; the highest bit is the constant term."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = _times_x(b)
    return out


@lru_cache(maxsize=1024)
def _shift(size: int) -> int:
    """What a checksum is multiplied by when ``size`` bytes follow."""
    power, square = 1 << 31, 1 << 23  # x to the power of 0, and of 8
    while size:
        if size & 1:
            power = _product(power, square)
        square, size = _product(square, square), size >> 1
    return power


def combined_crc(a: int, b: int, size: int) -> int:
    """The crc32 of two texts one after the other, from those of both and the second's size."""
    return _product(_shift(size), a) ^ b


# --- on Spark ------------------------------------------------------------------------------

def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batch(rows: Sequence[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(list(rows), schema=schema)


_KINDS = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "array<int>": pa.list_(pa.int32()),
          "array<bigint>": pa.list_(pa.int64())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def _read(store: str, path: str, begin: int, until: int) -> bytes:
    with store_of(store)[0].open_input_file(path) as data:
        data.seek(begin)
        return data.read(until - begin)


def _located(folder: str) -> Callable:
    """Where a member's plain bytes lie; a deflated one is written out, a piece at a time."""

    def spooled(row: dict, data, size: int) -> tuple[str, str, int, int, int]:  # noqa: ANN001
        store, path = store_of(folder)
        store.create_dir(path)
        name = f"{path}/{zlib.crc32(row['archive'].encode()):08x}-{row['entry']}"
        inflate, total = zlib.decompressobj(-15), 0
        with store.open_output_stream(name) as out:  # a task that runs again writes the same
            while size and (some := data.read(min(size, 1 << 22))):
                size -= len(some)
                plain = inflate.decompress(some)
                total += out.write(plain)
            total += out.write(inflate.flush())
        return folder, name, 0, total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(SOURCE)
        for row in _rows(batches):
            out = {k: row[k] for k in ("archive", "entry", "member", "kind", "crc")} | dict.fromkeys(("path", "store", "offset", "size"))
            try:
                with store_of(row["store"])[0].open_input_file(row["archive"]) as data:
                    data.seek(row["header"] + 26)
                    names = sum(struct.unpack("<HH", data.read(4)))
                    begin = row["header"] + 30 + names
                    data.seek(begin)
                    found = (row["store"], row["archive"], begin, row["size"]) if row["method"] == zipfile.ZIP_STORED else spooled(row, data, row["size"])
                yield _batch([out | dict(zip(("store", "path", "offset", "size"), found, strict=True)) | {"problem": None}], schema)
            except Exception as e:  # the other members go on
                yield _batch([out | {"problem": f"{type(e).__name__}: {e}"}], schema)

    return run


def _scanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(SCANNED)
    for row in _rows(batches):
        data = _read(row["store"], row["path"], row["offset"] + row["begin"], row["offset"] + row["until"])
        found = scans(data)
        yield _batch([row | {"sum": zlib.crc32(data), "until": row["begin"] + len(data), "ends": [e for e, _ in found],
                             "firsts": [row["begin"] + f if f >= 0 else -1 for _, f in found]}], schema)


def combine(ranges: pd.DataFrame) -> pd.DataFrame:
    """Ranges from record to record of one member; one row with a problem if its bytes aren't what they should be."""
    ranges = ranges.sort_values("nth", ignore_index=True)
    state, total, cuts = START, 0, []
    for r in ranges.itertuples():
        total = combined_crc(total, int(r.sum), int(r.until - r.begin))
        if r.firsts[state] >= 0:
            cuts.append(int(r.firsts[state]))
        state = int(r.ends[state])
    source = ranges.iloc[:1].drop(columns=["nth", "begin", "until", "sum", "ends", "firsts"])
    size = int(ranges["until"].iloc[-1])
    header = cuts[0] if cuts else size
    if size != int(source["size"].iloc[0]) or total != int(source["crc"].iloc[0]):
        return source.assign(problem="BadZipFile: bad checksum", unit=0, header=0, begin=0, until=0)
    begins = [header, *cuts[1:]]
    units = source.loc[source.index.repeat(len(begins))]
    return units.assign(unit=range(len(begins)), header=header, begin=begins, until=[*cuts[1:], size])


def _parsing(parse: Callable[[dict, io.BytesIO], Iterator[pa.RecordBatch]]) -> Callable:
    """The rows of each range under its member's header, with their unit; the first row keeps the cells' number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        header_of = lru_cache(maxsize=64)(_read)
        for row in _rows(batches):
            if row["problem"]:
                rows = parse(row, None)
            else:
                a = row["offset"]
                header = header_of(row["store"], row["path"], a, a + row["header"])
                rows = parse(row, io.BytesIO(header + _read(row["store"], row["path"], a + row["begin"], a + row["until"])))
            for batch in rows:
                yield batch.append_column("unit", pa.array([row["unit"] or 0] * batch.num_rows, pa.int64()))

    return run


def split_rows(spark: SparkSession, store: str, members: Sequence[Member], parse: Callable, schema: str,
               range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows of ``members``, each parsed by many tasks; ``line`` counts a member's rows as one pass would.

    ``parse`` makes batches of ``schema`` from a member's row and a file of its header and some of its records.
    """
    tasks = -(-sum(m.whole for m in members) // TASK_BYTES) or 1  # the rows that are dealt out are small, the bytes they stand for aren't
    given = [(m.archive, m.entry, m.member, m.kind, store, m.header, m.size, m.method, m.crc) for m in members]
    listed = spark.createDataFrame(given, f"{MEMBER}, store string, header bigint, size bigint, method int, crc bigint")
    placed = stored(listed.repartition(max(1, min(len(given), tasks)), "archive", "entry").mapInArrow(_located(new_folder(spark, "members")), SOURCE))
    good = placed.filter("problem IS NULL")
    nth = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), F.floor((F.col("size") - 1) / range_bytes))))
    ranges = good.withColumn("nth", nth).withColumn("begin", F.col("nth") * range_bytes).withColumn(
        "until", F.least(F.col("begin") + range_bytes, "size"))
    scanned = ranges.repartition(tasks, "archive", "entry", "nth").mapInArrow(_scanning, SCANNED)
    units = stored(scanned.groupBy("archive", "entry").applyInPandas(combine, UNIT))
    bad = placed.filter("problem IS NOT NULL").select("*", *[F.lit(0).cast("bigint").alias(c) for c in ("unit", "header", "begin", "until")])
    dealt = units.unionByName(bad).repartition(tasks, "archive", "entry", "unit")
    rows = stored(dealt.mapInArrow(_parsing(parse), f"{schema}, unit bigint"))
    counts = rows.groupBy("archive", "entry", "unit").agg(F.max("line").alias("n"))
    before = Window.partitionBy("archive", "entry").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("archive", "entry", "unit", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = rows.join(offsets, ["archive", "entry", "unit"])
    return numbered.withColumn("line", F.col("line") + F.col("before")).select(*[c.split()[0] for c in _columns(schema)])


def _columns(ddl: str) -> list[str]:
    """The columns of a schema without the commas of nested types."""
    parts, depth, out = "", 0, []
    for c in ddl + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(parts.strip())
            parts = ""
        else:
            parts += c
    return out
