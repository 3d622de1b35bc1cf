"""Stored results: intermediate, replaced and partitioned tables.

Everything is written and removed by Spark itself, so a path may lie in any store Spark reaches.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS = "sequence long, folder string, format string, schema string"
CSV_OPTIONS = {"sep": ";", "header": "true", "encoding": "UTF-8"}

#: What the job in hand has stored; jobs of other threads have lists of their own.
_job: ContextVar[list[tuple[str, T.StructType]] | None] = ContextVar("job", default=None)


@cache
def _local_dir() -> str:
    """Folder of a session in local mode that names none, as in a test; it goes with the process."""
    folder = tempfile.mkdtemp(prefix="saldoflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors reach, as named by ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_dir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name not used before, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, by: str | None = None) -> DataFrame:
    """The result computed once, as a table in the shared folder, for all later uses; ``by`` a column of few values.

    It survives lost executors, cuts the lineage and, unlike a checkpoint, has a known size
    and columns that are read only if needed. ``temporary`` removes it.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stored")
    (df.write if by is None else df.write.partitionBy(by)).parquet(path)
    mine = _job.get()
    if mine is not None:
        mine.append((path, df.schema))
    return spark.read.schema(df.schema).parquet(path)


def _emptied(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Removes the files of a folder by overwriting it with no rows."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Removes what was ``stored`` inside, by this thread; for jobs that have published their result by then."""
    mine: list[tuple[str, T.StructType]] = []
    outer = _job.set(mine)
    try:
        yield
    finally:
        _job.reset(outer)
        for path, schema in mine:
            _emptied(spark, path, schema)


def _versions(spark: SparkSession, path: str) -> list[Row]:
    """Versions of a published table, the current one last; of two of one number the larger name."""
    try:
        rows = spark.read.schema(VERSIONS).json(f"{path}/versions/*").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(rows, key=lambda r: (r.sequence, r.folder))


def _schema(version: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(version.schema))


def _switch(spark: SparkSession, path: str, row: tuple) -> None:
    """Makes a complete version the current one: one small file, which appears as a whole."""
    spark.createDataFrame([row], VERSIONS).coalesce(1).write.json(f"{path}/versions/{row[1]}")


def _publish(df: DataFrame, path: str, fmt: str, write: Callable[[str], None]) -> None:
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"version-{uuid.uuid4().hex}"
    write(f"{path}/{folder}")
    before = _versions(spark, path)
    number = before[-1].sequence + 1 if before else 0
    _switch(spark, path, (number, folder, fmt, df.schema.json()))
    # The version before stays for those who still read it.
    for old in before:
        if old.sequence == number - 2:
            _emptied(spark, f"{path}/{old.folder}", _schema(old))


def publish(df: DataFrame, path: str, by: str | None = None) -> None:
    """Replace the table at ``path``, optionally partitioned by a date column; ``read_table`` reads it.

    The rows go to a folder of their own below ``path``, which becomes the current version only
    when it is complete: ``df`` may read the table it replaces, a run that fails at any point
    leaves the old table, and of two runs at once one wins as a whole. Rebalancing by the date gives
    few files per date, and adaptive execution still splits a date too large for one task.
    """
    def write(target: str) -> None:
        if by is None:
            df.write.parquet(target)
        else:
            df.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(target)

    _publish(df, path, "parquet", write)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table; its columns as they were published."""
    versions = _versions(spark, path.rstrip("/"))
    if not versions:
        raise FileNotFoundError(f"nothing is published at {path}")
    current = versions[-1]
    schema = _schema(current)
    folder = f"{path.rstrip('/')}/{current.folder}"
    if current.format == "csv":
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
        return spark.read.schema(texts).options(**CSV_OPTIONS).csv(folder)
    return spark.read.schema(schema).parquet(folder)


def repartition_table(spark: SparkSession, path: str, by: str) -> None:
    """Rewrite the table at ``path`` partitioned by ``by``, a date column."""
    publish(read_table(spark, path), path, by)


def land_csv(df: DataFrame, path: str) -> None:
    """Replace a report with ``;`` separated UTF-8 text with a header per file, as ``publish`` does."""
    _publish(df, path, "csv", lambda target: df.write.options(**CSV_OPTIONS).csv(target))
