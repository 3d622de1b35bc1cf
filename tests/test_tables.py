"""Tables by name and loads by comparison."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from saldoflow.sources import storage, tables

D = dt.date
ROWS = [(i, f"k{i % 3}", D(2024, 1 + i % 3, 1) if i % 7 else None, float(i), [i, None]) for i in range(30)]
SCHEMA = "id long, k string, day date, x double, a array<int>"


@pytest.fixture()
def name(spark, request):
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    yield name
    tables.drop_table(spark, name)
    assert [r for r in spark.sql(f"SHOW TABLES LIKE '{name}*'").collect()] == []


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def load(spark, rows, name, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    found = tables.load_changes(df, name, ["id"], "day", **options)
    assert rows_of(spark.table(name)) == rows_of(df)
    return {r.day: (r.inserted, r.changed, r.removed, r.same) for r in found.counts.collect()}, found.dates


def files(df):
    return {r[0]: os.stat(r[0].removeprefix("file://")).st_mtime_ns for r in df.select(F.input_file_name()).distinct().collect()}


def test_only_dates_with_a_difference_are_written(spark, name):
    counts, dates = load(spark, ROWS, name)
    assert counts[None] == (5, 0, 0, 0) and dates == ["", "2024-01-01", "2024-02-01", "2024-03-01"]
    before = files(spark.table(name).filter("day IS NULL OR day <> '2024-02-01'"))
    changed = [r if r[0] != 4 else (*r[:3], 99.0, r[4]) for r in ROWS] + [(100, "n", D(2024, 2, 1), 1.0, None)]
    counts, dates = load(spark, changed, name)
    assert counts == {None: (0, 0, 0, 5), D(2024, 1, 1): (0, 0, 0, 8), D(2024, 2, 1): (1, 1, 0, 7), D(2024, 3, 1): (0, 0, 0, 9)}
    assert dates == ["2024-02-01"]
    assert files(spark.table(name).filter("day IS NULL OR day <> '2024-02-01'")) == before
    number = tables.current_version(spark, name).number
    assert load(spark, changed, name)[1] == [] and tables.current_version(spark, name).number == number
    moved = [r for r in changed if r[2] is not None and r[0] != 4] + [(4, "k1", D(2024, 1, 1), 99.0, [4, None])]
    counts, dates = load(spark, moved, name)
    assert counts[None] == (0, 0, 5, 0) and counts[D(2024, 1, 1)][0] == 1 and counts[D(2024, 2, 1)][2] == 1
    assert dates == ["2024-01-01", "2024-02-01"]


def test_layers_stay_few_and_dropped_tables_go(spark, name, monkeypatch):
    monkeypatch.setattr(tables, "MAX_LAYERS", 3)
    rows, most = ROWS, 0
    for n in range(5):
        rows = [*rows[1:], (500 + n, "z", D(2025, 1, n + 1), 0.0, [])]
        load(spark, rows, name)
        most = max(most, len(tables.current_version(spark, name).layers))
        assert len(spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect()) <= 2 * tables.MAX_LAYERS + 4
    assert 1 < most <= tables.MAX_LAYERS
    folder = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    known = {r.tableName.lower() for r in spark.sql("SHOW TABLES").collect()}
    assert {f for f in os.listdir(folder) if f.startswith(name.lower())} <= known
    assert load(spark, [], name)[1] == []


def test_digests_alone_are_compared(spark, name):
    load(spark, ROWS, name)
    version = tables.current_version(spark, name)
    old = spark.table(version.digests)
    plan = tables.compare_digests(old, old, ["id"], "day")._jdf.queryExecution().toString()
    assert version.digests in plan and version.layers[0].table not in plan


def test_keys_with_many_rows_and_ignored_columns(spark, name):
    rows = [(1, "a", D(2024, 1, 1), float(i % 3), None) for i in range(300)] + [(None, None, None, None, None)] * 2
    load(spark, rows, name)
    assert load(spark, rows[::-1], name)[0] == {D(2024, 1, 1): (0, 0, 0, 1), None: (0, 0, 0, 1)}
    assert load(spark, rows[:-1], name)[0][None] == (0, 1, 0, 0)
    tables.load_changes(spark.createDataFrame(rows[:-1], SCHEMA), name, ["id"], "day", ignoring=["x"])
    df = spark.createDataFrame([(*r[:3], 9.0, r[4]) for r in rows[:-1]], SCHEMA)
    assert tables.load_changes(df, name, ["id"], "day", ignoring=["x"]).counts.agg(F.sum("changed")).first()[0] == 0


@pytest.mark.parametrize("column", ["a", "b"])
def test_null_and_text_differ(spark, column):
    df = spark.createDataFrame([(None, "1:x"), ("1:x", None), ("-", "1:x"), (None, None), ("", None), (None, "")], "a string, b string")
    digests = df.select(tables.row_digest(df.schema).alias("d"))
    assert digests.distinct().count() == 6


def test_other_columns_write_everything(spark, name):
    load(spark, ROWS, name)
    df = spark.createDataFrame([(1, D(2024, 1, 1), 5)], "id long, day date, n int")
    tables.load_changes(df, name, ["id"], "day")
    assert rows_of(spark.table(name)) == [(1, D(2024, 1, 1), 5)]
    tables.replace_table(df.withColumn("n", F.lit(7)), name, "day")
    assert tables.load_changes(df, name, ["id"], "day").dates == ["2024-01-01"]


def test_a_name_reads_before_during_and_after_a_replace(spark, name):
    tables.replace_table(spark.range(5).toDF("a"), name)
    reader = spark.table(name)
    tables.replace_table(spark.table(name).withColumn("a", F.col("a") * 10), name)
    assert rows_of(reader) == [(i,) for i in range(5)]  # a plan made before still reads the old version
    assert rows_of(spark.table(name)) == [(10 * i,) for i in range(5)]

    def replaced(i):
        tables.replace_table(spark.range(1000).select(F.lit(i).alias("a")), name)
        return spark.table(name).distinct().count()

    with ThreadPoolExecutor(2) as pool:
        assert set(pool.map(replaced, range(4))) == {1}
    with pytest.raises(Exception, match="no_such"):
        tables.replace_table(spark.table(name).select(F.expr("no_such")), name)
    assert spark.table(name).count() == 1000


def test_a_load_that_comes_too_late_changes_nothing(spark, name, monkeypatch):
    load(spark, ROWS, name)
    written, df = tables._written, spark.createDataFrame(ROWS[1:], SCHEMA)

    def overtaken(rows, *args):
        if args[1] == "rows":
            monkeypatch.setattr(tables, "_written", written)
            tables.replace_table(df.limit(3), name, "day")
        return written(rows, *args)

    monkeypatch.setattr(tables, "_written", overtaken)
    with pytest.raises(RuntimeError, match="was replaced"):
        tables.load_changes(df, name, ["id"], "day")
    assert spark.table(name).count() == 3


@pytest.mark.parametrize("partitioned", [True, False])
def test_dates_are_replaced_one_by_one(spark, name, monkeypatch, partitioned):
    monkeypatch.setattr(tables, "MAX_LAYERS", 2)
    now = ROWS
    tables.replace_dates(spark.createDataFrame(now, SCHEMA), name, "day", [], partitioned)
    for n, dates in enumerate([["2024-02-01"], ["", "2024-02-01"], ["2024-01-01"], ["2024-07-01"], []]):
        new = [(1000 + n, "new", D.fromisoformat(d) if d else None, 0.5, None) for d in dates if d != "2024-01-01"]
        now = [r for r in now if ("" if r[2] is None else r[2].isoformat()) not in dates] + new
        tables.replace_dates(spark.createDataFrame(new, SCHEMA), name, "day", dates, partitioned)
        assert rows_of(spark.table(name)) == rows_of(spark.createDataFrame(now, SCHEMA))
        assert len(tables.current_version(spark, name).layers) <= 2
    with pytest.raises(ValueError, match="other columns"):
        tables.replace_dates(spark.range(1), name, "day", ["2024-01-01"])


def test_a_foreign_table_is_left_alone(spark):
    spark.range(3).write.saveAsTable("foreign_table")
    try:
        with pytest.raises(ValueError, match="no table of this library"):
            tables.replace_table(spark.range(1), "foreign_table")
        with pytest.raises(ValueError, match="no table of this library"):
            tables.drop_table(spark, "foreign_table")
        assert spark.table("foreign_table").count() == 3
    finally:
        spark.sql("DROP TABLE foreign_table")


def test_jobs_of_two_threads_keep_what_they_stored(spark):
    def job(i):
        with storage.temporary(spark):
            mine = storage.stored(spark.range(100 + i))
            counts = [mine.count() for _ in range(5)]
        return set(counts)

    with ThreadPoolExecutor(4) as pool:
        outside = storage.stored(spark.range(7))
        assert list(pool.map(job, range(8))) == [{100 + i} for i in range(8)]
    assert outside.count() == 7
