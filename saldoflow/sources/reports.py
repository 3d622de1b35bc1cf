"""Settlement reports: ZIP archives of CSV members to typed tables.

Nothing is lost in silence: an archive, a member or a value that can't be read is reported.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain, groupby, product
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import column_name, decimal_point
from .archives import PIECE_BYTES, list_members, read_members
from .archives import SCHEMA as PIECES_SCHEMA
from .schemas import SKIPPED_KINDS, report_kind
from .split_csv import RANGE_BYTES, split_rows
from .storage import land_csv, publish, stored, temporary

ROWS_SCHEMA = ("archive string, entry int, member string, kind string, line bigint, values map<string,string>, "
               "problem string")
CHUNK_ROWS = 20_000
INFLATED_BYTES = 1 << 18  # of a member, held at a time
SPLIT_BYTES = 256 * 1024 * 1024  # from here on a member is parsed by many tasks

# Day-first patterns accepted in date columns, and ISO dates.
DATE_PATTERNS = (
    "d/M/yyyy", "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d-M-yyyy", "d-M-yyyy H:mm:ss", "d-M-yyyy H:mm", "d.M.yyyy",
    "yyyy-M-d", "yyyy-M-d H:mm:ss", "yyyy-M-d H:mm", "yyyy-M-d'T'H:mm:ss", "yyyy/M/d",
)
# The same with years of two digits, of which 69 to 99 lie in the last century.
SHORT_DATE_PATTERNS = ("d/M/yy", "d/M/yy H:mm:ss", "d/M/yy H:mm", "d-M-yy", "d.M.yy")
LAST_SHORT_YEAR = 2068


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The report members of the ZIP files of a folder, as compressed pieces read by ranges; no archive is held whole."""
    return read_members(spark, path, recursive=False)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed pieces of the members of each archive; what can't be read has a problem instead."""
    names = ["archive", "entry", "member", "kind", "piece", "data", "method", "crc", "problem"]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.string()]

    def row(*values: object) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            archive, content = path.as_py(), content.as_py()
            try:
                infos = zipfile.ZipFile(io.BytesIO(content)).infolist()
            except Exception as e:  # the other archives go on
                yield row(archive, None, None, None, 0, None, None, None, f"{type(e).__name__}: {e}")
                continue
            for entry, info in enumerate(infos):
                member = info.filename.rsplit("/", 1)[-1]
                prefix, dash, _ = member.partition("-")
                if not dash or not prefix or not member.endswith((".csv", ".xlsx")):
                    continue
                known = (archive, entry, member, prefix.lower())
                name_size, extra_size = struct.unpack_from("<HH", content, info.header_offset + 26)
                start = info.header_offset + 30 + name_size + extra_size
                problem = (
                    "workbooks are not read" if member.endswith(".xlsx") else
                    "encrypted" if info.flag_bits & 1 else
                    None if info.compress_type in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) else
                    f"compression method {info.compress_type}")
                if problem:
                    yield row(*known, 0, None, None, None, problem)
                    continue
                for piece, at in enumerate(range(0, max(info.compress_size, 1), PIECE_BYTES)):
                    data = content[start + at:start + min(at + PIECE_BYTES, info.compress_size)]
                    yield row(*known, piece, data, info.compress_type, info.CRC, None)


class _Member(io.RawIOBase):
    """A member's bytes, inflated a little at a time and checked at the end."""

    def __init__(self, pieces: Iterator[dict], first: dict):
        self.crc, self.sum, self.rest = first["crc"], 0, memoryview(b"")
        self.plain = self._plain(chain([first], pieces), first["method"] == zipfile.ZIP_DEFLATED)

    @staticmethod
    def _plain(pieces: Iterator[dict], deflated: bool) -> Iterator[bytes]:
        inflate = zlib.decompressobj(-15)
        for piece in pieces:
            data = piece["data"]
            while deflated and data:
                yield inflate.decompress(data, INFLATED_BYTES)
                data = inflate.unconsumed_tail
            yield data
        if deflated:
            yield inflate.flush()

    def readable(self) -> bool:
        return True

    def readinto(self, buffer: memoryview) -> int:
        while not self.rest and (some := next(self.plain, None)) is not None:
            self.rest = memoryview(some)
        size = min(len(buffer), len(self.rest))
        buffer[:size], self.rest = self.rest[:size], self.rest[size:]
        self.sum = zlib.crc32(buffer[:size], self.sum)
        if not size and self.sum != self.crc:
            raise zipfile.BadZipFile("bad checksum")
        return size


def _batch(first: dict, line: int, frame: pd.DataFrame | None, problem: str | None) -> pa.RecordBatch:
    """Rows of a chunk; the cells become one map per row, built column-wise."""
    if frame is None:
        n, lines, maps = 1, [None], pa.array([None], pa.map_(pa.string(), pa.string()))
    else:
        n, width = frame.shape
        cells = pa.array(frame.to_numpy(dtype=object).ravel(), pa.string(), from_pandas=True)
        keys = pa.array(np.tile(np.array(frame.columns, dtype=object), n), pa.string())
        maps = pa.MapArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), keys, cells)
        lines = range(line, line + n)
    return pa.RecordBatch.from_arrays(
        [pa.array([first["archive"]] * n, pa.string()), pa.array([first["entry"]] * n, pa.int32()),
         pa.array([first["member"]] * n, pa.string()), pa.array([first["kind"]] * n, pa.string()),
         pa.array(lines, pa.int64()), maps, pa.array([problem] * n, pa.string())],
        names=["archive", "entry", "member", "kind", "line", "values", "problem"],
    )


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of each member, in one pass; a problem row ends a member that can't be read to its end."""
    pieces = (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows))
    for _, rows in groupby(pieces, key=lambda r: (r["archive"], r["entry"])):
        first = next(rows)
        if first["problem"]:
            yield _batch(first, 0, None, first["problem"])
            continue
        line = 1
        try:
            text = io.TextIOWrapper(io.BufferedReader(_Member(rows, first)), encoding="utf-8", newline="")
            for frame in pd.read_csv(text, dtype=str, sep=";", chunksize=CHUNK_ROWS):
                frame = normalise_columns(frame)
                if len(frame):
                    yield _batch(first, line, frame, None)
                line += len(frame)
        except Exception as e:  # the other members go on
            yield _batch(first, 0, None, f"{type(e).__name__}: {e}")


def normalise_columns(frame: pd.DataFrame) -> pd.DataFrame:
    """Headings as column names; two headings with one name are an error of the file."""
    names = [column_name(str(c)) for c in frame.columns]
    alike = sorted({n for n in names if names.count(n) > 1})
    if alike:
        raise ValueError(f"several headings become {', '.join(alike)}")
    return frame.set_axis(names, axis="columns")


def report_rows(archives: DataFrame) -> DataFrame:
    """One row per line of every member, cells as a map from normalised column name to text.

    ``archives`` is of ``read_archives``, or has the column ``content`` with whole archives beside ``path``. ``kind`` is the file name up to the first "-", in lower case; members without one, or neither CSV
    nor XLSX, are left out. An archive or member that cannot be read gives a row with ``problem``;
    ``whole_lines`` drops the lines that came before it. The compressed members are dealt out before
    they are read, so the members of an archive are read by many tasks, each in one pass.
    """
    whole = "content" in archives.columns
    pieces = archives.select("path", "content").mapInArrow(_pieces, PIECES_SCHEMA) if whole else archives
    dealt = pieces.repartition("archive", "entry").sortWithinPartitions("archive", "entry", "piece")
    return dealt.mapInArrow(_lines, ROWS_SCHEMA)


def _unit_lines(member: dict, data: io.BytesIO | None) -> Iterator[pa.RecordBatch]:
    """Lines of some records of a large member, below its header; a problem row if they can't be read."""
    line = 1
    try:
        if data is None:
            yield _batch(member, 0, None, member["problem"])
            return
        text = io.TextIOWrapper(data, encoding="utf-8", newline="")
        for frame in pd.read_csv(text, dtype=str, sep=";", chunksize=CHUNK_ROWS):
            if not isinstance(frame.index, pd.RangeIndex):  # pandas would take the first cells for names of rows
                raise ValueError("a line has more cells than the heading")
            frame = normalise_columns(frame)
            if len(frame):
                yield _batch(member, line, frame, None)
            line += len(frame)
    except Exception as e:  # the other members go on
        yield _batch(member, 0, None, f"{type(e).__name__}: {e}")


def member_rows(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``report_rows`` of all archives below ``path``, of any size: each task reads its members' bytes alone.

    A member that is inflated to ``split_bytes`` or more is parsed by many tasks (``split_csv``), by ranges of
    ``range_bytes``; in such a member a line with more cells than the heading is always a problem.
    """
    small = read_members(spark, path, below=split_bytes).mapInArrow(_lines, ROWS_SCHEMA)
    large = [m for m in list_members(path) if m.whole >= split_bytes and not m.problem]
    return small.unionByName(split_rows(spark, path, large, _unit_lines, ROWS_SCHEMA, range_bytes)) if large else small


def report_problems(rows: DataFrame) -> DataFrame:
    """Archives and members that could not be read, and why."""
    return rows.filter(F.col("problem").isNotNull()).select("archive", "member", "kind", "problem")


def whole_lines(rows: DataFrame) -> DataFrame:
    """Lines of the members that could be read to their end: a member counts as a whole or not at all."""
    failed = rows.filter(F.col("problem").isNotNull() & F.col("entry").isNotNull()).select("archive", "entry")
    return rows.filter(F.col("line").isNotNull()).join(failed, ["archive", "entry"], "left_anti")


def report_columns(rows: DataFrame, kind: str) -> list[str]:
    """Columns of a kind: in file order if all members have the same ones, else all that
    occur, sorted.

    Every line of a member has the same names, so the first lines suffice; what reaches
    the driver are distinct header lines.
    """
    first_lines = whole_lines(rows).filter((F.col("kind") == kind) & (F.col("line") == 1))
    headers = [r["header"] for r in first_lines.select(F.map_keys("values").alias("header")).distinct().collect()]
    if len(headers) == 1:
        return list(headers[0])
    return sorted({name for header in headers for name in header})


def report_table(rows: DataFrame, kind: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All lines of a kind as text columns; a column missing from a file is NULL there."""
    columns = report_columns(rows, kind) if columns is None else columns
    return whole_lines(rows).filter(F.col("kind") == kind).select(*[F.col("values")[c].alias(c) for c in columns])


def normalise_decimals(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Decimal points instead of commas, in all text columns or the given ones.

    Every point of a text goes, so identifiers and dotted dates change too unless
    ``columns`` leaves them out.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    wanted = texts if columns is None else [c for c in texts if c in columns]
    return df.withColumns({c: decimal_point(F.col(c)) for c in wanted}) if wanted else df


def outer_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; columns in alphabetical order if they differ, else as they are."""
    names = [f.columns for f in frames]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return together if all(n == names[0] for n in names) else together.select(*sorted(together.columns))


def shapes(pattern: str) -> list[str]:
    """Texts that a pattern fits, with 9 for each digit: one digit or two for a single letter."""
    runs = re.findall(r"'T'|([A-Za-z])(\1*)|([^A-Za-z'])", pattern)
    parts = ["T" if not letter and not sign else sign or (["9", "99"] if not more and letter in "dMH" else "9" * (1 + len(more)))
             for letter, more, sign in runs]
    return ["".join(p) for p in product(*[p if isinstance(p, list) else [p] for p in parts])]


def date_shape(text: Column) -> Column:
    """The text with 9 for each digit."""
    return F.translate(text, "012345678", "9" * 9)


#: Shapes of texts that no pattern's shapes have but a pattern may still fit: more digits, signs.
_ODD_SHAPE = r"^[+-]?9+([/.-])[+-]?9+\1[+-]?9+([ T][+-]?9+:99(:99)?)?$"


def parse_by_shape(text: Column, patterns: Sequence[str], shape: Column) -> Column:
    """Date by the one pattern whose shapes have the text's; NULL if none has, or if it doesn't fit."""
    chosen = F.lit(None).cast("date")
    for p in reversed(patterns):
        chosen = F.when(shape.isin(shapes(p)), F.try_to_date(text, p)).otherwise(chosen)
    return F.when(shape.isin([s for p in patterns for s in shapes(p)]), chosen)


def parse_day_first(text: Column, shape: Column | None = None) -> Column:
    """Date of a day-first (or ISO) text, NULL if it is none.

    The shape of a text says which pattern can fit it, so each text is parsed once and one without
    a known shape isn't parsed at all. A column that has ``date_shape`` already saves finding it again.
    """
    shape = date_shape(text) if shape is None else shape

    def in_turn(patterns: Sequence[str]) -> Column:
        return F.coalesce(*[F.try_to_date(text, p) for p in patterns])

    def in_century(short: Column) -> Column:
        return F.when(F.year(short) > LAST_SHORT_YEAR, F.add_months(short, -1200)).otherwise(short)

    odd = F.when(shape.rlike(_ODD_SHAPE), F.coalesce(in_turn(DATE_PATTERNS), in_century(in_turn(SHORT_DATE_PATTERNS))))
    return F.coalesce(parse_by_shape(text, DATE_PATTERNS, shape), in_century(parse_by_shape(text, SHORT_DATE_PATTERNS, shape)), odd)


def typed_dates(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns that the schema calls dates, parsed."""
    dates = [f.name for f in schema if isinstance(f.dataType, T.DateType) and f.name in df.columns]
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    wanted = [c for c in dates if c in texts]
    shaped = df.withColumns({f"_shape_{c}": date_shape(F.col(c)) for c in wanted}) if wanted else df
    return shaped.select(*[parse_day_first(F.col(c), F.col(f"_shape_{c}")).alias(c) if c in wanted else F.col(f"`{c}`") for c in df.columns])


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns known to the schema with its types, bad values NULL; others stay text."""
    numbers = [f for f in schema if isinstance(f.dataType, T.DoubleType | T.LongType) and f.name in df.columns]
    df = typed_dates(df, schema)
    return df.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in numbers}) if numbers else df


def stamp(df: DataFrame, run_date: dt.date) -> DataFrame:
    """``updated_on`` as the first column."""
    return df.select(F.lit(run_date).alias("updated_on"), *[c for c in df.columns if c != "updated_on"])


def lost_values(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """``column`` and ``lost``: texts that ``apply_schema`` turns into NULL, for each column it types."""
    typed = [f.name for f in schema if f.name in texts.columns and not isinstance(f.dataType, T.StringType)]
    if not typed:
        return texts.sparkSession.createDataFrame([], "column string, lost bigint")
    both = apply_schema(texts.withColumns({f"_text_{c}": F.col(c) for c in typed}), schema)
    counts = both.agg(*[F.count_if(F.col(f"_text_{c}").isNotNull() & F.col(c).isNull()).alias(c) for c in typed])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("lost")) for c in typed])
    return counts.select(F.inline(pairs))


def clean_report(rows: DataFrame, kind: str, run_date: dt.date, columns: Sequence[str] | None = None) -> DataFrame:
    """One report kind from lines to typed, stamped rows; an unknown kind stays text."""
    known = report_kind(kind)
    table = normalise_decimals(report_table(rows, kind, columns))
    return stamp(apply_schema(table, known.schema) if known else table, run_date)


class Landing(NamedTuple):
    """What ``land_reports`` wrote, read back with ``storage.read_table``."""

    paths: dict[str, str]  # by kind
    problems: str  # archive, member, kind, problem
    lost_values: str  # kind, column, lost


def land_reports(archives: DataFrame, out: str, run_date: dt.date, fmt: str = "parquet", strict: bool = False) -> Landing:
    """Write every kind of the archives below ``out``, replacing what is there.

    A registered kind goes to a folder with its table's name, partitioned by its business date
    when written as parquet; any other kind to one with its own. Members that can't be read and
    values that no type takes are written beside them; ``strict`` makes such a member an error
    before anything is replaced. The loop is over kinds, a handful of file prefixes.
    """
    spark = archives.sparkSession
    with temporary(spark):
        rows = stored(report_rows(archives))  # archives are opened once, not once per kind
        publish(report_problems(rows), f"{out}/problems")
        if strict and not rows.filter("problem IS NOT NULL").isEmpty():
            raise ValueError(f"some members can't be read, see {out}/problems")
        kinds = [r["kind"] for r in whole_lines(rows).filter("line = 1").select("kind").distinct().collect()]
        written, lost = {}, spark.createDataFrame([], "kind string, column string, lost bigint")
        for kind in sorted(set(kinds) - set(SKIPPED_KINDS)):
            known, columns = report_kind(kind), report_columns(rows, kind)
            df, path = clean_report(rows, kind, run_date, columns), f"{out}/{known.table if known else kind}"
            if known:
                texts = normalise_decimals(report_table(rows, kind, columns))
                lost = lost.unionByName(lost_values(texts, known.schema).filter("lost > 0").select(
                    F.lit(kind).alias("kind"), "column", "lost"))
            if fmt == "csv":
                land_csv(df, path)
            else:
                publish(df, path, known.partition_by if known and known.partition_by in df.columns else None)
            written[kind] = path
        publish(lost, f"{out}/lost_values")
    return Landing(written, f"{out}/problems", f"{out}/lost_values")
