import datetime as dt

import pytest
from pyspark.sql import functions as F

from saldoflow.functions.text import parse_day_label, parse_money
from saldoflow.operators import snapshots
from saldoflow.plans import jobs
from saldoflow.sources import storage

D, T = dt.date, dt.datetime
ROWS = "updated_on timestamp_ntz, data date, tipo string, valor long"


@pytest.mark.parametrize("text,cents,rounded", [
    ("R$ 19,99", 1998, 1999), ("-5,00", 500, 500), ("", 0, 0), ("R$ 1.234,56", 123456, 123456), ("R$", 0, 0), (None, None, None),
])
def test_money(spark, text, cents, rounded):
    df = spark.createDataFrame([(text,)], "t string")
    assert tuple(df.select(parse_money(F.col("t")), parse_money(F.col("t"), "round")).collect()[0]) == (cents, rounded)


@pytest.mark.parametrize("label,as_of,date", [
    ("Hoje, 05/Jan", D(2024, 12, 20), D(2025, 1, 5)), ("31/dez", D(2025, 1, 3), D(2024, 12, 31)),
    ("5/mai", D(2024, 6, 1), D(2024, 5, 5)), ("31/fev", D(2024, 6, 1), None), ("05/xyz", D(2024, 6, 1), None),
    ("no date", D(2024, 6, 1), None), (None, D(2024, 6, 1), None),
])
def test_day_label(spark, label, as_of, date):
    df = spark.createDataFrame([(label,)], "t string").select(parse_day_label(F.col("t"), as_of))
    assert df.collect()[0][0] == date


def test_statements_and_unreadable_labels(spark):
    captured = spark.createDataFrame(
        [(T(2024, 6, 1), "realised", "01/jun", "R$ 2,50"), (T(2024, 6, 1), "forecast", "soon", "R$ 1,00")],
        "updated_on timestamp_ntz, kind string, label string, value string")
    rows = snapshots.collect_statements(captured, D(2024, 6, 1)).orderBy("valor").collect()
    assert [(r["data"], r["tipo"], r["valor"]) for r in rows] == [(None, "previsto", 100), (D(2024, 6, 1), "realizado", 250)]
    assert [tuple(r) for r in snapshots.unreadable_labels(captured, D(2024, 6, 1)).collect()] == [("soon", 1)]


@pytest.fixture()
def snapshot(spark):
    history = [(T(2024, 1, 1), D(2024, 1, 5), "previsto", 1), (T(2024, 1, 2), D(2024, 1, 5), "previsto", 2),
               (T(2024, 1, 1), D(2024, 1, 10), "realizado", 3), (T(2024, 1, 1), None, "previsto", 4)]
    new = [(T(2024, 1, 9), D(2024, 1, 10), "previsto", 5), (T(2024, 1, 9), D(2024, 1, 11), "previsto", 6),
           (T(2024, 1, 8), D(2024, 1, 11), "previsto", 7)]
    return spark.createDataFrame(history, ROWS), spark.createDataFrame(new, ROWS)


def test_merge(snapshot):
    got = sorted(r["valor"] for r in snapshots.snapshot_merge(*snapshot).collect())
    # before the first new date nothing is removed; realised beats a newer forecast; no date, no row
    assert got == [1, 2, 3, 6]


def test_merge_twice_changes_nothing(snapshot):
    once = snapshots.snapshot_merge(*snapshot)
    twice = snapshots.snapshot_merge(once, snapshot[1])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_replaced_snapshot(spark, snapshot, tmp_path):
    path = str(tmp_path / "snapshot")
    storage.publish(snapshot[0], path)
    storage.publish(snapshots.snapshot_merge(storage.read_table(spark, path), snapshot[1]), path)
    assert sorted(r["valor"] for r in storage.read_table(spark, path).collect()) == [1, 2, 3, 6]


def test_merge_without_a_new_date_keeps_the_history(snapshot):
    history, new = snapshot
    for nothing in (new.limit(0), new.withColumn("data", F.lit(None).cast("date"))):
        assert sorted(r["valor"] for r in snapshots.snapshot_merge(history, nothing).collect()) == [1, 2, 3, 4]


def test_update_never_loses_the_history(spark, snapshot, tmp_path):
    path, as_of = str(tmp_path / "snapshot"), D(2024, 1, 20)
    storage.publish(snapshot[0], path)
    columns = "updated_on timestamp_ntz, kind string, label string, value string"
    row = lambda label: (T(2024, 1, 9), "forecast", label, "R$ 0,06")
    kept = lambda: sorted(r["valor"] for r in storage.read_table(spark, path).collect())

    empty = jobs.update_snapshot(spark, spark.createDataFrame([], columns), path, as_of)
    assert kept() == [1, 2, 3, 4] and empty.unreadable.count() == 0
    with pytest.raises(ValueError, match="no captured label"):
        jobs.update_snapshot(spark, spark.createDataFrame([row("soon"), row("later")], columns), path, as_of)
    assert kept() == [1, 2, 3, 4]
    assert storage.read_table(spark, f"{path}/unreadable").count() == 2
    mixed = jobs.update_snapshot(spark, spark.createDataFrame([row("soon"), row("11/jan")], columns), path, as_of)
    assert sorted(r["valor"] for r in mixed.snapshot.collect()) == [1, 2, 3, 6]
    assert [tuple(r) for r in mixed.unreadable.collect()] == [("soon", 1)]
