"""Registered queries of the stores: tables by name, loads by comparison, archives read by their members."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import landing, reports, storage, tables
from . import fixtures as fx

RUN_DATE = dt.date(2024, 1, 31)
#: Orders that share an archive, so that their number grows with the orders.
ARCHIVE_ORDERS = 8192
#: Lines of a CSV member at most, whatever its archive has.
MEMBER_LINES = 16_384


def _name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex}"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date(F.trunc(F.to_date("l_shipdate"), "month")).alias("month"), "l_partkey", "l_linestatus",
        F.col("l_quantity").cast("double").alias("l_quantity"))


def _two_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All lines, and an earlier state of them: in every third month other quantities and other orders."""
    lines, third = _lines(spark, sf), F.month("month") % 3 == 0
    order = F.col("l_orderkey")
    before = lines.filter(~(third & (order % 17 == 0))).withColumn(
        "l_quantity", F.when(third & (order % 13 == 0), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return before, lines.filter(~(third & (order % 19 == 0)))


KEYS = ["l_orderkey", "l_linenumber"]


def landing_changes(spark: SparkSession, sf: str) -> DataFrame:
    """What the second of two loads inserted, changed, removed and left, by business date."""
    name = _name("landing_changes")
    before, after = _two_loads(spark, sf)
    tables.load_changes(before, name, KEYS, "month")
    counts = tables.load_changes(after, name, KEYS, "month").counts
    tables.drop_table(spark, name)  # the counts are in hand
    return counts


def table_after_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The table by its name after both loads."""
    name = _name("table_after_changes")
    for load in _two_loads(spark, sf):
        tables.load_changes(load, name, KEYS, "month")
    found = storage.stored(spark.table(name))
    tables.drop_table(spark, name)
    return found


def table_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced by rows made of itself, then partitioned anew."""
    name = _name("table_by_name")
    tables.replace_table(_lines(spark, sf), name)
    own = spark.table(name)
    tables.replace_table(own.filter("l_linestatus <> 'O'").withColumn("l_quantity", F.col("l_quantity") * 2), name)
    tables.repartition_named(spark, name, "month")
    found = storage.stored(spark.table(name))
    tables.drop_table(spark, name)
    return found


def _zip_folder(spark: SparkSession, lines: DataFrame, order: str, kind: str) -> str:
    """The lines as CSV members of one archive per range of orders, written as they come, in the shared folder."""
    import zipfile

    folder = storage.new_folder(spark, "archives")

    def written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        store.create_dir(path)
        parts = (part for frame in frames for part in frame.groupby("_archive", sort=False))
        for name, some in groupby(parts, key=lambda part: part[0]):  # rows come sorted by archive
            with store.open_output_stream(f"{path}/{name}.zip") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as data:
                chunks = (rows[at:at + MEMBER_LINES] for _, rows in some for at in range(0, len(rows), MEMBER_LINES))
                for part, rows in enumerate(chunks):
                    data.writestr(f"in/{kind}-{name}-{part}.csv", rows.drop(columns="_archive").to_csv(index=False, sep=";"))
            yield pd.DataFrame({"path": [f"{name}.zip"]})

    # as texts, since numbers beside nulls would get a fraction in pandas
    texts = lines.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in lines.columns],
                         F.coalesce(F.floor(F.col(order) / ARCHIVE_ORDERS).cast("string"), F.lit("None")).alias("_archive"))
    dealt = texts.repartition("_archive").sortWithinPartitions("_archive")
    dealt.mapInPandas(written, "path string").write.format("noop").mode("overwrite").save()
    return folder


def _other_report(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as text of a kind without a schema."""
    lines = fx.table(spark, sf, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("pedido"), F.col("l_linenumber").cast("string").alias("parcela"),
        fx.brazilian(F.col("l_extendedprice")).alias("valor bruto"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("data da venda"),
        F.when(F.col("l_linenumber") == 2, "s/n").otherwise(F.col("l_suppkey").cast("string")).alias("loja"),
        F.concat(F.lit("00"), F.col("l_partkey").cast("string")).alias("código"),
        F.when(F.col("l_tax") > 0, F.col("l_partkey").cast("string")).alias("terminal"))


def land_unknown_kind(spark: SparkSession, sf: str) -> DataFrame:
    """Archives read by their members, a kind without a schema landed by name with the types of its values."""
    folder = _zip_folder(spark, _other_report(spark, sf), "pedido", "Outros")
    prefix = _name("landing") + "_"
    landed = landing.land_tables(reports.member_rows(spark, folder), prefix, RUN_DATE)
    table = spark.table(landed.tables["outros"])
    types = F.lit(",".join(f"{f.name}:{f.dataType.simpleString()}" for f in table.schema))
    found = storage.stored(table.withColumn("types", types))
    for name in (*landed.tables.values(), landed.problems, landed.lost_values):
        tables.drop_table(spark, name)
    return found


def read_split_members(spark: SparkSession, sf: str) -> DataFrame:
    """Members with quoted line breaks, each parsed by several tasks."""
    lines = fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("pedido"), F.col("l_linenumber").cast("string").alias("parcela"),
        F.concat(F.lit('linha 1\n"linha" 2; '), F.col("l_partkey").cast("string")).alias("nota"))
    folder = _zip_folder(spark, lines, "pedido", "Outros")
    rows = reports.member_rows(spark, folder, split_bytes=1 << 16, range_bytes=1 << 16)
    return reports.whole_lines(rows).select(*[F.col("values")[c].alias(c) for c in ("pedido", "parcela", "nota")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "landing_changes": landing_changes,
    "table_after_changes": table_after_changes,
    "table_by_name": table_by_name,
    "land_unknown_kind": land_unknown_kind,
    "read_split_members": read_split_members,
}
