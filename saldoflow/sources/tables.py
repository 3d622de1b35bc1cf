"""Tables by name: replaced as a whole, or only where a new load differs.

A name is a catalog view over the tables that hold its current version, so ``spark.table(name)`` reads it
like any other. A load writes tables of its own first and then replaces the view, which is one step:
readers see the old version or the new one, and a load that fails at any point changes nothing. The
catalog is the only log. What the version before the current one still needs stays for those who read
it; tables older than that are dropped, which removes their folders.

A table that is loaded by ``load_changes`` may be spread over several layers. Each business date is served by
the newest layer that has it, and the view says for each layer which dates newer ones have taken over.
After ``MAX_LAYERS`` the next load writes a single one. The digests of a version are one table beside its layers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from threading import Lock
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_LAYERS = 8
#: Properties of a view, numbered, as a catalog may bound the length of one.
VERSION, VERSION_PART = "saldoflow.version", 3000
#: Stands for a row without a date among the dates of a layer.
NO_DATE = ""

_switching = Lock()


class Layer(NamedTuple):
    table: str
    gone: list[str]  # dates that newer layers have taken over


class Version(NamedTuple):
    number: int
    by: str | None
    keys: list[str]
    layers: list[Layer]
    digests: str | None  # of all rows, by key
    before: list[str]  # tables that only the version before this one needs


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def current_version(spark: SparkSession, name: str) -> Version | None:
    """What the view ``name`` stands for; None if there is none. A table of another kind is an error."""
    if not spark.catalog.tableExists(name):
        return None
    try:
        found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()}
    except AnalysisException as e:
        raise ValueError(f"{name} is no table of this library") from e
    parts = [found[f"{VERSION}.{i}"] for i in range(len(found)) if f"{VERSION}.{i}" in found]
    if not parts:
        raise ValueError(f"{name} is no table of this library")
    number, by, keys, layers, digests, before = json.loads("".join(parts))
    return Version(number, by, keys, [Layer(*x) for x in layers], digests, before)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def date_text(by: str) -> Column:
    return F.coalesce(F.col(by).cast("string"), F.lit(NO_DATE))


def _layer_sql(table: str, by: str | None, gone: Sequence[str], columns: Sequence[str]) -> str:
    chosen = ", ".join(f"`{c}`" for c in columns)
    sql = f"SELECT {chosen} FROM {_quoted(table)}"
    if gone:
        sql += f" WHERE coalesce(CAST(`{by}` AS STRING), '{NO_DATE}') NOT IN ({', '.join(map(_literal, gone))})"
    return sql


def _switch(spark: SparkSession, name: str, columns: Sequence[str], version: Version) -> None:
    """Makes a version current."""
    rows = " UNION ALL ".join(_layer_sql(x.table, version.by, x.gone, columns) for x in version.layers)
    said = json.dumps(version)
    parts = [said[i:i + VERSION_PART] for i in range(0, len(said), VERSION_PART)]
    properties = ", ".join(f"'{VERSION}.{i}' = {_literal(p)}" for i, p in enumerate(parts))
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} TBLPROPERTIES ({properties}) AS {rows}")


def _written(df: DataFrame, name: str, kind: str, by: str | None, rebalanced: bool = True) -> str:
    """``df`` as a new table; if ``rebalanced`` few files per date, and a date too large for one task is split."""
    table = f"{name}__{kind}_{uuid.uuid4().hex}"
    rows = df if by is None or not rebalanced else df.hint("rebalance", F.col(by))
    writer = rows.write.format("parquet")
    (writer if by is None else writer.partitionBy(by)).saveAsTable(table)
    return table


def _tables(layers: Sequence[Layer], digests: str | None) -> set[str]:
    return {*(x.table for x in layers), *([digests] if digests else [])}


def _dropped(spark: SparkSession, names: Iterable[str]) -> None:
    for table in names:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")


def _publish(spark: SparkSession, name: str, columns: Sequence[str], by: str | None, keys: Sequence[str], layers: list[Layer],
             digests: str | None = None, based_on: int | None = None) -> None:
    """Switches to ``layers`` and drops what neither they nor the version before them need.

    If the layers continue version ``based_on`` and another load came first, what was written goes and
    this load is an error. Loads of one driver switch in turn; with several drivers, the tables of one
    that switches at the very same time may stay behind.
    """
    mine = _tables(layers, digests)
    with _switching:
        old = current_version(spark, name)
        kept = _tables(old.layers, old.digests) if old else set()
        if based_on is not None and (old is None or old.number != based_on):
            _dropped(spark, mine - kept)
            raise RuntimeError(f"{name} was replaced while it was loaded")
        before = sorted(kept - mine)
        _switch(spark, name, columns, Version(old.number + 1 if old else 0, by, list(keys), layers, digests, before))
    _dropped(spark, set(old.before if old else []) - set(before) - mine)


def replace_table(df: DataFrame, name: str, by: str | None = None, partitioned: bool = True) -> None:
    """CREATE OR REPLACE TABLE ``name``, optionally partitioned by a date column; ``df`` may read the table.

    A small table whose dates are only to be replaced one by one (``replace_dates``) needn't be ``partitioned``.
    """
    spark = df.sparkSession
    current_version(spark, name)  # a table of another kind is left alone before anything is written
    _publish(spark, name, df.columns, by, [], [Layer(_written(df, name, "rows", by if partitioned else None), [])])


def drop_table(spark: SparkSession, name: str) -> None:
    """DROP TABLE IF EXISTS ``name``, with all tables behind it."""
    old = current_version(spark, name)
    if old is not None:
        spark.sql(f"DROP VIEW {_quoted(name)}")
        _dropped(spark, _tables(old.layers, old.digests) | set(old.before))


def repartition_named(spark: SparkSession, name: str, by: str) -> None:
    """Writes a table anew, partitioned by a date column."""
    replace_table(spark.table(name), name, by)


# --- change-comparing load -----------------------------------------------------------------

def row_digest(schema: T.StructType, leaving: Sequence[str] = ()) -> Column:
    """128 bits of a row, as hexadecimal text: of each column its length and its text, or that it is null."""
    parts = []
    for f in schema:
        if f.name in leaving:
            continue
        nested = isinstance(f.dataType, T.ArrayType | T.StructType | T.MapType)
        text = F.to_json(F.struct(f"`{f.name}`"), {"ignoreNullFields": "false"}) if nested else F.col(f"`{f.name}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat(*parts, F.lit("")))


def key_digests(df: DataFrame, keys: Sequence[str], by: str, ignoring: Sequence[str] = ()) -> DataFrame:
    """Per date and key: the number of rows and the sums of both halves of their digests.

    The sums don't depend on the order of rows, so a key with many rows is added up in parts.
    """
    digest = row_digest(df.schema, leaving=[by, *keys, *ignoring])
    halves = [F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint").cast("decimal(20,0)") for at in (1, 17)]
    return df.groupBy(by, *keys).agg(
        F.count("*").alias("_rows"), *[F.sum(h).cast("decimal(38,0)").alias(f"_sum{i}") for i, h in enumerate(halves)])


SUMS = ("_rows", "_sum0", "_sum1")


def compare_digests(old: DataFrame, new: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Keys by what happened to them: ``by``, ``inserted``, ``changed``, ``removed``, ``same`` (numbers of keys).

    A key that moved to another date is removed there and inserted here. Nulls equal each other.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.struct(by, *keys).alias("_key"), F.struct(*SUMS).alias(name))

    both = side(old, "_old").join(side(new, "_new"), "_key", "full")
    here, there = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    equal = F.col("_old") == F.col("_new")
    kinds = {"inserted": here & ~there, "changed": here & there & ~equal, "removed": ~here & there, "same": here & there & equal}
    return both.groupBy(F.col(f"_key.`{by}`").alias(by)).agg(*[F.count_if(c).alias(k) for k, c in kinds.items()])


class Changes(NamedTuple):
    counts: DataFrame  # by, inserted, changed, removed, same
    dates: list[str]  # business dates that were written


def load_changes(df: DataFrame, name: str, keys: Sequence[str], by: str, ignoring: Sequence[str] = ()) -> Changes:
    """Brings the table ``name`` to the rows of ``df``, writing only the business dates that differ.

    The rows' digests by key are kept beside the table, and only they are compared: of the stored table
    no other column is read, and of the dates without a difference nothing is written. ``by`` is a date column;
    rows without a date are a partition too. A key may have several rows. The first load, one with other
    columns, keys or dates' column, and every one after ``MAX_LAYERS`` layers writes all dates. Columns named in
    ``ignoring`` make no difference, as the day of the load; name the same ones in each load. ``df`` is read twice. Dates reach the driver, one text each.
    """
    spark = df.sparkSession
    old = current_version(spark, name)
    digests = _written(key_digests(df, keys, by, ignoring), name, "digests", None)
    new = spark.table(digests)
    known = old is not None and old.digests is not None and (old.by, old.keys) == (by, list(keys))
    whole = not known or len(old.layers) >= MAX_LAYERS or _columns(spark.table(name).schema) != _columns(df.schema)
    counts = compare_digests(spark.table(old.digests) if known else new.filter("false"), new, keys, by)
    counts = spark.createDataFrame(counts.collect(), counts.schema)  # one row a date
    stays = F.col("inserted") + F.col("changed") + F.col("same") > 0
    differs = F.lit(whole) | (F.col("inserted") + F.col("changed") + F.col("removed") > 0)
    taken = counts.filter(differs).select(date_text(by).alias("date"), stays.alias("stays")).collect()
    written = sorted(r.date for r in taken if r.stays)
    if not whole and not taken:
        _dropped(spark, [digests])
        return Changes(counts, [])
    layers = [] if whole else _without(spark, old.layers, [r.date for r in taken], by)
    if written or not layers:
        rows = df if whole else df.filter(date_text(by).isin(written))
        layers.append(Layer(_written(rows, name, "rows", by), []))
    _publish(spark, name, df.columns, by, keys, layers, digests, old.number if old and not whole else None)
    return Changes(counts, written)


def replace_dates(df: DataFrame, name: str, by: str, dates: Sequence[str], partitioned: bool = True) -> None:
    """Replaces the business dates ``dates`` of the table ``name`` by ``df``, which has rows of no others.

    Dates are ISO text, ``NO_DATE`` for rows without one. Nothing else is read or written; a date without
    rows in ``df`` is then empty. A table that doesn't exist yet begins with ``df``; after
    ``MAX_LAYERS`` layers the table is written anew as one.
    """
    spark = df.sparkSession
    old = current_version(spark, name)
    if old is not None and (old.by != by or _columns(spark.table(name).schema) != _columns(df.schema)):
        raise ValueError(f"{name} has other columns or isn't partitioned by {by}")
    if old is not None and not dates:
        return
    layers = [*(_without(spark, old.layers, dates, by) if old else []), Layer(_written(df, name, "rows", by if partitioned else None), [])]
    _publish(spark, name, df.columns, by, [], layers, None, old.number if old else None)
    if len(layers) > MAX_LAYERS:
        replace_table(spark.table(name), name, by, partitioned)


def append_table(df: DataFrame, name: str, merged: Callable[[DataFrame], DataFrame], by: str | None = None,
                 based_on: int | None = None, rebalanced: bool = True) -> None:
    """Adds rows to the table ``name``, which begins with them if there is none.

    Rows whose tasks have few values of ``by`` each needn't be shuffled by it (``rebalanced``).

    For tables whose rows are parts of states: after ``MAX_LAYERS`` layers the whole table is replaced by
    ``merged`` of it. If ``based_on`` is given and the table has another version by then, nothing changes and
    this is an error.
    """
    spark = df.sparkSession
    old = current_version(spark, name)
    if old is not None and _columns(spark.table(name).schema) != _columns(df.schema):
        raise ValueError(f"{name} has other columns")
    layers = [*(old.layers if old else []), Layer(_written(df, name, "rows", by, rebalanced), [])]
    _publish(spark, name, df.columns, by, [], layers, None, old.number if old and based_on is None else based_on)
    if len(layers) > MAX_LAYERS:
        replace_table(merged(spark.table(name)), name, by)


def _without(spark: SparkSession, layers: Sequence[Layer], dates: Sequence[str], by: str) -> list[Layer]:
    """The layers that still serve some date when newer ones take over ``dates``."""
    left = [Layer(x.table, sorted({*x.gone, *dates})) for x in layers]
    return [x for x in left if not spark.table(x.table).filter(~date_text(by).isin(x.gone)).isEmpty()]


def _columns(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in schema]
