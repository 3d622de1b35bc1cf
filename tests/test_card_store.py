"""Active holders from states against the whole log."""

import datetime as dt
import random

import pytest

from saldoflow.operators import cards
from saldoflow.plans import card_store
from saldoflow.plans.card_store import CardStore
from saldoflow.sources import tables

END = dt.date(2025, 3, 31)
SCHEMA = ("issuingCardId string, cardType string, type string, logCreated timestamp_ntz, created timestamp_ntz, expiration date, "
          "issuingHolderId string, subIssuerTaxId string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def log_rows(seed, n):
    rnd = random.Random(seed)
    day = lambda: dt.datetime(2023, 1, 1) + dt.timedelta(days=rnd.randrange(800))
    return [(rnd.choice([None, *(f"c{i}" for i in range(25))]), rnd.choice(["virtual", "physical"]),
             rnd.choice([*cards.EVENT_TYPES, "blocked"]), day(), day(), rnd.choice([None, day().date()]),
             rnd.choice([None, "h1", "h2", "h3", "h4", "hot", "hot", "hot"]), rnd.choice([None, "i1", "i2"])) for _ in range(n)]


@pytest.fixture()
def store(spark):
    yield CardStore(spark, "card_store_test", END)
    tables.drop_table(spark, "card_store_test")


@pytest.mark.parametrize("seed", [1, 2])
def test_parts_of_a_log_add_up_to_the_whole(spark, store, seed, monkeypatch):
    monkeypatch.setattr(tables, "MAX_LAYERS", 2)
    issuers = spark.createDataFrame([("i1", "one"), ("i2", "two")], "subIssuerTaxId string, subIssuerName string")
    rows, seen = log_rows(seed, 120), []
    for part in (rows[:40], rows[40:41], rows[20:110] + rows[:5] * 3, rows):  # late, repeated, and all again
        seen += part
        store.update(spark.createDataFrame(part, SCHEMA))
        whole = spark.createDataFrame(seen, SCHEMA)
        activity = cards.holder_activity(cards.activity_delta(cards.card_events(whole, END)))
        assert rows_of(store.activity().select(*activity.columns)) == rows_of(activity)
        for empty in (False, True):
            assert rows_of(store.report(issuers, empty)) == rows_of(cards.active_holders_report(whole, issuers, END, empty))
    assert len(tables.current_version(spark, store.name).layers) <= 2


def test_an_update_shuffles_neither_the_stored_activity_nor_what_it_writes(spark, store, monkeypatch):
    store.update(spark.createDataFrame(log_rows(5, 60), SCHEMA))
    plans, kept, appended = [], card_store.stored, card_store.append_table
    plan = lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString())
    monkeypatch.setattr(card_store, "stored", lambda df: plan(df) or kept(df))
    monkeypatch.setattr(card_store, "append_table", lambda df, *a, **k: plans.append(k["rebalanced"]) or appended(df, *a, **k))
    store.update(spark.createDataFrame(log_rows(6, 60), SCHEMA))
    assert len(plans) > 3 and not any("LeftSemi" in p for p in plans[:-1]) and plans[-1] is False


def test_rows_that_came_before_write_nothing(spark, store):
    log = spark.createDataFrame(log_rows(3, 60), SCHEMA)
    store.update(log)
    number = tables.current_version(spark, store.name).number
    store.update(log.limit(30))
    store.update(log.filter("false"))
    assert tables.current_version(spark, store.name).number == number


def test_an_empty_log_makes_an_empty_store(spark, store):
    store.update(spark.createDataFrame([], SCHEMA))
    assert store.activity().count() == 0
    store.update(spark.createDataFrame(log_rows(4, 5), SCHEMA))
    assert store.activity().count() > 0
