"""ZIP archives as a data source: members are planned from the archives' directories and read by ranges.

The planner reads the end of each archive, where its directory lies, and nothing else; a task reads the
bytes of its members alone, a piece at a time. So an archive may have any size, and neither its size nor
that of a member shows in a task's memory.
"""

from __future__ import annotations

import struct
import zipfile
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "zip_members"
#: Compressed bytes of a row, and of the members that share a task.
PIECE_BYTES, TASK_BYTES = 4 * 1024 * 1024, 16 * 1024 * 1024
LISTED_AT_ONCE = 16  # archives whose directories are read at a time
SCHEMA = ("archive string, entry int, member string, kind string, piece int, data binary, method int, "
          "crc bigint, problem string")
SUFFIXES = (".csv", ".xlsx")


def store_of(path: str):  # noqa: ANN202
    """The file system of a path, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass(frozen=True)
class Member:
    archive: str
    entry: int | None
    member: str | None
    kind: str | None
    header: int = 0
    size: int = 0
    whole: int = 0  # bytes when inflated
    method: int | None = None
    crc: int | None = None
    problem: str | None = None


class Members(InputPartition):
    """Members that one task reads."""

    def __init__(self, members: list[Member]):
        self.members = members


def _problem(info: zipfile.ZipInfo) -> str | None:
    if info.filename.endswith(".xlsx"):
        return "workbooks are not read"
    if info.flag_bits & 1:
        return "encrypted"
    return None if info.compress_type in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) else f"compression method {info.compress_type}"


def members_of(store, archive: str, path: str) -> Iterator[Member]:  # noqa: ANN001
    """The report members of an archive by its directory; an archive without a readable one is a member with a problem."""
    try:
        with store.open_input_file(path) as data:
            infos = zipfile.ZipFile(data).infolist()
    except Exception as e:  # the other archives go on
        yield Member(archive, None, None, None, problem=f"{type(e).__name__}: {e}")
        return
    for entry, info in enumerate(infos):
        name = info.filename.rsplit("/", 1)[-1]
        prefix, dash, _ = name.partition("-")
        if dash and prefix and name.endswith(SUFFIXES):
            yield Member(archive, entry, name, prefix.lower(), info.header_offset, info.compress_size, info.file_size,
                         info.compress_type, info.CRC, _problem(info))


def list_members(folder: str, recursive: bool = True) -> list[Member]:
    """The report members of all archives below a folder, or of those right in it, by their directories."""
    from pyarrow import fs

    store, path = store_of(folder)
    files = store.get_file_info(fs.FileSelector(path, recursive=recursive))
    names = sorted(f.path for f in files if f.type == fs.FileType.File and f.path.endswith(".zip"))
    with ThreadPoolExecutor(LISTED_AT_ONCE) as pool:
        return [m for some in pool.map(lambda n: list(members_of(store, n, n)), names) for m in some]


def shared_out(members: Sequence[Member], most: int = TASK_BYTES) -> list[Members]:
    """Members dealt to tasks, in order; a large one has a task of its own."""
    tasks, size = [], most
    for m in members:
        if size + m.size > most:
            tasks.append(Members([]))
            size = 0
        tasks[-1].members.append(m)
        size += m.size
    return tasks


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.most, self.below = options["path"], int(options["taskBytes"]), int(options["below"])
        self.recursive = options["recursive"] == "true"

    def partitions(self) -> Sequence[Members]:
        listed = list_members(self.path, self.recursive)
        return shared_out([m for m in listed if m.whole < self.below or m.problem], self.most) or [Members([])]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        names = ["archive", "entry", "member", "kind", "piece", "data", "method", "crc", "problem"]
        kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.string()]

        def row(m: Member, piece: int, data: bytes | None, problem: str | None = None) -> pa.RecordBatch:
            values = (m.archive, m.entry, m.member, m.kind, piece, data, m.method, m.crc, problem or m.problem)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

        store, _ = store_of(self.path)
        for m in partition.members:
            if m.problem:
                yield row(m, 0, None)
                continue
            with store.open_input_file(m.archive) as data:
                data.seek(m.header + 26)  # the lengths of the name and the extra field before the member's bytes
                name_size, extra_size = struct.unpack("<HH", data.read(4))
                data.seek(m.header + 30 + name_size + extra_size)
                left, piece = m.size, 0
                while left or not piece:
                    some = data.read(min(PIECE_BYTES, left))
                    yield row(m, piece, some, None if some or not left else "the archive ends within the member")
                    left, piece = (left - len(some) if some else 0), piece + 1


class ZipMembers(DataSource):
    """Compressed pieces of the report members of all ZIP files below a path."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> _Reader:
        return _Reader(self.options)


def read_members(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES, below: int = 1 << 62,
                 recursive: bool = True) -> DataFrame:
    """Pieces of the members of all archives below ``path``; the pieces of a member are one task's, in order.

    Members that are inflated to ``below`` bytes or more are left out; without ``recursive``, so are archives in folders of ``path``.
    """
    spark.dataSource.register(ZipMembers)
    reader = spark.read.format(FORMAT).option("taskBytes", task_bytes).option("below", below)
    return reader.option("recursive", str(recursive).lower()).load(path)
