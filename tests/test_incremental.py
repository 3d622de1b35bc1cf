"""Receive/pay from states by creation day, and filters of keys before a shuffle."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from saldoflow.operators import joins, receivables
from saldoflow.plans import fixtures as fx
from saldoflow.plans import jobs, queries
from saldoflow.sources import tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def name(spark):
    yield "states_of_days"
    tables.drop_table(spark, "states_of_days")


def test_changed_days_alone_are_made_anew(spark, name):
    now = queries._receivables_tables(spark, SF_DIR)
    before, changes = queries.earlier_receivables(now)
    first = rows_of(jobs.update_receive_pay(spark, before, fx.RECEIVABLES, name))
    assert first == rows_of(jobs.receive_pay(spark, before, fx.RECEIVABLES))
    days = jobs.changed_days(now, changes, fx.RECEIVABLES)
    old = {r[0] for r in spark.table(name).select(F.input_file_name()).distinct().collect()}
    second = rows_of(jobs.update_receive_pay(spark, now, fx.RECEIVABLES, name, changes))
    assert second == rows_of(jobs.receive_pay(spark, now, fx.RECEIVABLES)) and second != first
    new = spark.table(name).filter(~F.input_file_name().isin(*old)).select("createdDate").distinct()
    every = spark.table(name).select("createdDate").distinct().count()
    assert {r[0] for r in new.collect()} <= set(days) and 0 < len(days) < every
    # no change, no write
    number = tables.current_version(spark, name).number
    assert rows_of(jobs.update_receive_pay(spark, now, fx.RECEIVABLES, name, jobs.ReceivablesChanges())) == second
    assert tables.current_version(spark, name).number == number


def test_states_add_up_to_the_rollups(spark):
    fact = queries._fact(spark, SF_DIR)
    merged = receivables.merged_states(receivables.day_states(fact))
    plain = receivables.dated_rollup(fact)
    assert rows_of(merged.select(*plain.columns)) == rows_of(plain)
    average = merged.filter("side = 'created'").select(*receivables.DIMENSIONS, "isFactoring", "daysBetweenPaymentsAvgCreated")
    expected = receivables.created_rollup(fact).select(*average.columns)
    assert rows_of(average) == rows_of(expected)


def test_days_reach_the_scan_as_ranges(spark):
    days = [dt.date(1996, 3, d) for d in (1, 2, 3, 9)]
    rows = fx.installments(spark, SF_DIR)
    some = rows.filter(receivables.created_on(days, "America/Sao_Paulo"))
    plan = some._jdf.queryExecution().toString()
    assert "Or(And(GreaterThanOrEqual(l_shipdate" in plan  # among the scan's pushed filters
    local = F.to_date(F.from_utc_timestamp("created", "America/Sao_Paulo"))
    assert rows_of(some.select("__key__")) == rows_of(rows.filter(local.isin(days)).select("__key__"))
    assert rows.filter(receivables.created_on([], "America/Sao_Paulo")).isEmpty()


@pytest.mark.parametrize("n", [0, 1, 1000, 50_000])
def test_a_key_filter_loses_nothing_and_lets_little_else_pass(spark, n):
    keys = spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k")).unionByName(
        spark.createDataFrame([(None,)], "k string"))
    df = spark.range(200_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), "id", F.lit("x").alias("_byte_of"))
    some = joins.perhaps_in(df, "k", joins.key_filter(keys, "k"))
    assert some.columns == df.columns
    assert some.filter(F.col("id") < n).count() == n
    assert some.count() - n <= 0.08 * (200_000 - n)
    assert "Exchange hash" not in some.select("id")._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]


def test_a_full_filter_still_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(joins, "MOST_BITS", joins.PIECE_BITS)
    df = spark.range(100_000).select("id")
    filter_ = joins.key_filter(df.filter("id % 2 = 0"), "id")
    assert filter_[1] == joins.PIECE_BITS and joins.perhaps_in(df, "id", filter_).filter("id % 2 = 0").count() == 50_000


def test_the_filtered_tables_give_the_same_fact(spark):
    now = queries._receivables_tables(spark, SF_DIR)
    log, purchases, settled = receivables.only_needed(
        now.installments, now.installment_log, now.merchant_purchases, now.acquiring_purchases, fx.RECEIVABLES)
    window = receivables.installment_fact(
        now.installments, log, purchases, settled, now.acquiring_installments, now.workspaces,
        queries.calendars.next_business_day(queries.calendars.holiday_calendar(spark, now.holidays)), fx.RECEIVABLES)
    assert rows_of(window) == rows_of(queries._fact(spark, SF_DIR))
    share = now.installments.filter(receivables.local_date_between(
        "created", fx.RECEIVABLES.start, fx.RECEIVABLES.end, fx.RECEIVABLES.tz)).count() / now.installments.count()
    assert log.count() <= (share + 0.08) * now.installment_log.count()


def small_tables(spark, fee):
    """Four installments of one day, two workspaces and two purchases; ``fee`` is the acquirer's of purchase 1."""
    at, due = dt.datetime(2001, 3, 5, 15), dt.datetime(2001, 4, 4, 15)
    rows = [(i, str(1 + i % 2), "AB"[i % 2]) for i in range(4)]
    stamp = "timestamp_ntz"
    return jobs.ReceivablesTables(
        spark.createDataFrame([((f"i{i}",), p, at, due, "visa", w, "open", 100 + i, 1, None) for i, p, w in rows],
                              f"__key__ struct<id: string>, purchaseId string, created {stamp}, due {stamp}, network string, "
                              "workspaceId string, status string, amount long, fee long, tags array<string>"),
        spark.createDataFrame([(f"i{i}", "created", (due, at)) for i, _, _ in rows],
                              f"installmentId string, type string, installment struct<due: {stamp}, created: {stamp}>"),
        spark.createDataFrame([((n,), f"e{n}", "credit", "confirmed") for n in (1, 2)],
                              "__key__ struct<id: long>, endToEndId string, fundingType string, status string"),
        spark.createDataFrame([(n, f"e{n}", 500, "confirmed") for n in (1, 2)],
                              "id long, endToEndId string, amount long, status string"),
        spark.createDataFrame([("1", due, fee), ("2", due, 5)], f"purchaseId string, due {stamp}, externalFee long"),
        spark.createDataFrame([(w, f"tax{w}", w, at) for w in "AB"],
                              f"workspaceId string, companyTaxId string, companyName string, workspaceCreated {stamp}"),
        spark.createDataFrame([(dt.date(2001, 1, 1), "new year"), (dt.date(2001, 12, 25), "christmas")], "holidayDate date, holidayName string"))


def test_only_the_workspaces_that_changed_are_made_anew(spark, name, monkeypatch):
    before, now = small_tables(spark, 3), small_tables(spark, 4)
    jobs.update_receive_pay(spark, before, fx.RECEIVABLES, name)
    asked, fact = [], jobs.receivables_fact
    monkeypatch.setattr(jobs, "receivables_fact", lambda spark, tables, params: (
        asked.append(sorted(r.workspaceId for r in tables.installments.collect())), fact(spark, tables, params))[1])
    changes = jobs.ReceivablesChanges(acquiring_installments=now.acquiring_installments.filter("purchaseId = '1'"))
    second = rows_of(jobs.update_receive_pay(spark, now, fx.RECEIVABLES, name, changes))
    assert asked == [["A", "A"]]
    monkeypatch.undo()
    assert second == rows_of(jobs.receive_pay(spark, now, fx.RECEIVABLES))
    assert second != rows_of(jobs.receive_pay(spark, before, fx.RECEIVABLES))


def test_an_installment_has_one_state_not_one_per_side(spark):
    states = receivables.day_states(jobs.receivables_fact(spark, small_tables(spark, 3), fx.RECEIVABLES))
    assert states.agg(F.sum("gaps")).first()[0] == 4 and states.count() == 2  # one per workspace


def test_a_key_filter_goes_below_an_aggregation(spark):
    rows = spark.range(1000).select((F.col("id") % 100).cast("string").alias("k"), F.lit(1).alias("n"))
    sums = rows.groupBy("k").agg(F.sum("n").alias("n"))
    keys = spark.range(7).select(F.col("id").cast("string").alias("k"))
    some = joins.perhaps_in(sums, "k", joins.key_filter(keys, "k"), below=True)
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [k") < plan.index("Join LeftSemi")
    assert {(r.k, r.n) for r in some.collect()} >= {(str(i), 10) for i in range(7)} and some.count() < 20


def test_rows_of_a_key_are_paired_whatever_their_flags(spark):
    """All flags on all sides of one key, and a key that is in part null and matches nothing."""
    at = dt.date(2001, 3, 5)
    flags = {"created": [None, True], "acquirer": [False, True], "merchant": [None, False, True]}
    amounts = [*receivables.ACQUIRER_COLUMNS, *receivables.MERCHANT_COLUMNS]
    rows = [(side, at, network, "open", "A", flag, *[None if flag else 10 * n + i for i in range(8)])
            for network in ("visa", None) for side, some in flags.items() for n, flag in enumerate(some)]
    rollup = spark.createDataFrame(rows, "side string, referenceDate date, network string, installmentStatus string, "
                                         "workspaceId string, isFactoring boolean, " + ", ".join(f"{c} long" for c in amounts))
    workspaces = spark.createDataFrame([("A", "tax", "A", dt.datetime(2001, 1, 1))],
                                       "workspaceId string, companyTaxId string, companyName string, workspaceCreated timestamp_ntz")
    got = receivables.daily_receive_pay(rollup, workspaces).select("network", "isFactoring", *amounts)
    nothing, side = (None,) * 4, lambda first, n, flag: (None,) * 4 if flag else tuple(10 * n + first + i for i in range(4))
    acquirer = [side(0, n, f) for n, f in enumerate(flags["acquirer"])]
    merchant = [side(4, n, f) for n, f in enumerate(flags["merchant"])]
    paired = [("visa", c, *a, *m) for c in flags["created"] for a in acquirer for m in merchant]
    alone = [(None, c, *nothing, *nothing) for c in flags["created"]] + [(None, None, *a, *nothing) for a in acquirer] + [
        (None, None, *nothing, *m) for m in merchant]
    assert rows_of(got) == sorted(paired + alone, key=repr)
