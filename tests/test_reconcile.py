import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from saldoflow.operators import ordered, reconcile
from saldoflow.operators.ordered import running, running_sliced

D, T = dt.date, dt.datetime


@pytest.fixture()
def lists(spark):
    balances = spark.createDataFrame(
        [("both", 1, "virtual"), ("idle", 0, "physical"), ("own", 2, "virtual"), ("gone", -1, "virtual")],
        "issuingCardId string, balance long, cardType string").withColumn("subIssuerName", F.lit("n"))
    partner = spark.createDataFrame([(c,) for c in ("both", "both", "idle", "unknown")], "issuingCardId string")
    status = spark.createDataFrame([("both", "active"), ("idle", "blocked")], "issuingCardId string, status string")
    return balances, partner, status


def outcomes(df):
    return {r["issuingCardId"]: (r["outcome"], r["origin"], r["balance"], r["status"]) for r in df.collect()}


def test_compare(lists):
    got = outcomes(reconcile.compare(*lists))
    assert got == {"both": ("matched", "partner", 1, "active"), "idle": ("only_partner", "partner", 0, "blocked"),
                   "own": ("only_own", None, 2, None)}


def test_unknown_cards_can_be_flagged(lists):
    got = outcomes(reconcile.compare(*lists, unknown="flag"))
    assert got["unknown"] == ("only_partner", "partner", -1000, None)
    listed = {r["issuingCardId"] for r in lists[1].collect()}
    assert {c for c, o in got.items() if o[0] != "only_own"} == listed  # the parts cover the list


def test_peak_balance_puts_gains_first(spark):
    rows = [("c", "n", "virtual", D(2024, 1, 1), 1, 1), ("c", "n", "virtual", D(2024, 4, 1), -1, 2),
            ("c", "n", "virtual", D(2024, 4, 1), 1, 3), ("c", "n", "virtual", D(2025, 4, 1), 1, 4)]
    deltas = spark.createDataFrame(rows, "issuingCardId string, subIssuerName string, cardType string, quarter date, delta long, eventNumber int")
    peaks = {r["quarter"]: r["balance"] for r in reconcile.peak_balance(deltas, D(2025, 1, 1)).collect()}
    assert peaks == {D(2024, 1, 1): 1, D(2024, 4, 1): 2}
    assert reconcile.balance_at_quarter(deltas, D(2025, 1, 1)).collect()[0]["balance"] == 2
    with pytest.raises(ValueError):
        reconcile.balance_at_quarter(deltas, D(2025, 2, 1))


@pytest.fixture()
def divergent(spark):
    rows = [("own", None, 1, "virtual", None), ("bare", None, 1, "virtual", None), ("idle", "partner", 0, "physical", "x")]
    return spark.createDataFrame(rows, "issuingCardId string, origin string, balance long, cardType string, status string")


@pytest.fixture()
def log(spark):
    rows = [("own", T(2024, 1, 9), "canceled"), ("own", T(2024, 1, 1), "created"), ("own", T(2024, 1, 5), "unblocked"),
            ("idle", T(2024, 2, 1), "created")]
    return spark.createDataFrame(rows, "issuingCardId string, logCreated timestamp_ntz, type string")


def test_event_history(divergent, log):
    rows = reconcile.event_history(divergent, log, "own")
    assert sorted((r["issuingCardId"], r["position"], r["event"], r["copies"]) for r in rows.collect()) == [
        ("bare", 0, "NULL", 1), ("own", 0, "created", 1), ("own", 1, "unblocked", 1), ("own", 2, "canceled", 1)]
    got = {r["issuingCardId"]: (r["eventDates"], r["events"]) for r in reconcile.history_arrays(rows).collect()}
    assert got == {"own": ([D(2024, 1, 1), D(2024, 1, 5), D(2024, 1, 9)], ["created", "unblocked", "canceled"]),
                   "bare": ([D(1900, 1, 1)], ["NULL"])}
    partner = reconcile.event_history(divergent, log, "partner").collect()
    assert [(r["issuingCardId"], r["event"]) for r in partner] == [("idle", "created")]


def test_long_history_goes_on_in_pages(divergent, log):
    paged = reconcile.history_arrays(reconcile.event_history(divergent, log, "own"), page_size=2)
    pages = {(r["issuingCardId"], r["page"]): r["events"] for r in paged.collect()}
    assert pages == {("own", 0): ["created", "unblocked"], ("own", 1): ["canceled"], ("bare", 0): ["NULL"]}


def test_history_has_one_shape_for_any_size(spark, divergent):
    """One card holds a third of the log, most of it at one instant."""
    n = F.col("id")
    log = spark.range(30_000).select(
        F.when(n % 3 == 0, "own").otherwise(F.concat(F.lit("x"), n % 5000)).alias("issuingCardId"),
        (F.lit(T(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.when(n % 30 == 0, n % 7200).otherwise(0))).alias("logCreated"),
        F.when(n % 2 == 0, "created").otherwise("canceled").alias("type"))
    history = reconcile.event_history(divergent, log, "own").filter("issuingCardId = 'own'")
    rows = sorted(history.collect(), key=lambda r: r["position"])
    ends = [r["position"] + r["copies"] for r in rows]
    assert ends[-1] == 10_000 and [r["position"] for r in rows] == [0, *ends[:-1]]
    whole = reconcile.history_arrays(history).collect()
    assert len(whole) == 1 and len(whole[0]["events"]) == 10_000


def test_copies_of_an_event_are_spread_over_pages(spark, divergent):
    rows = [("own", T(2024, 1, 2), "created")] * 5 + [("own", T(2024, 1, 1), "created"), ("own", T(2024, 1, 2), "unblocked")]
    log = spark.createDataFrame(rows, "issuingCardId string, logCreated timestamp_ntz, type string")
    pages = {r["page"]: (r["eventDates"], r["events"]) for r in reconcile.history_arrays(reconcile.event_history(divergent, log, "own"), 3).collect()
             if r["issuingCardId"] == "own"}
    one, two = D(2024, 1, 1), D(2024, 1, 2)
    assert pages == {0: ([one, two, two], ["created"] * 3), 1: ([two] * 3, ["created"] * 3), 2: ([two], ["unblocked"])}


def test_pairing_of_dates_and_events(divergent, log):
    history = reconcile.event_history(divergent, log, "own")
    date = lambda pairing: [r["eventDate"] for r in reconcile.explode_history(history, pairing).collect()]
    assert date("cross") == [D(2024, 1, 1)] and date("zip") == [D(2024, 1, 9)]
    both = reconcile.explode_history(history, "zip", ("created", "unblocked", "canceled")).collect()
    assert sorted(r["event"] for r in both) == ["canceled", "created"]  # a virtual card is not unblocked


@pytest.mark.parametrize("ranges,seconds", [(False, 7200), (True, 7200), (True, 3)])
def test_running_equals_a_plain_window(spark, ranges, seconds):
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot", "hot", None, "a", "b"]), T(2024, 1, 1) + dt.timedelta(seconds=37 * rnd.randrange(seconds)), i,
             rnd.choice([None, i])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, i int, v int")
    got = running(df, ["k"], "t", ["t", "i"], last={"lastValue": F.col("v")}, total={"n": F.col("v").isNotNull().cast("long")},
                  ranges={"r": F.floor(F.col("i") / 7)} if ranges else None)
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("lastValue", F.last("v", True).over(w)).withColumn("n", F.count("v").over(w))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


@pytest.mark.parametrize("seconds", [7200, 3, 1])
def test_slices_give_what_a_plain_window_does(spark, seconds):
    rnd = random.Random(2)
    rows = [(rnd.choice(["hot", "hot", None, "a", "b"]), T(2024, 1, 1) + dt.timedelta(seconds=37 * rnd.randrange(seconds)), i,
             rnd.choice([None, None, i])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, i int, v int")
    got = running_sliced(df, ["k"], ["t", "i"], last={"lastValue": F.col("v")}, total={"n": F.col("v").isNotNull().cast("long")})
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("lastValue", F.last("v", True).over(w)).withColumn("n", F.count("v").over(w))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    assert running_sliced(df.filter("false"), ["k"], ["t", "i"], total={"n": F.lit(1)}).count() == 0


def test_rows_of_one_instant_with_sequential_ids_are_sliced_evenly(spark, monkeypatch):
    cut, stored = [], ordered.stored
    monkeypatch.setattr(ordered, "stored", lambda df: cut.append(stored(df)) or cut[0])
    rows = spark.range(200_000).select(F.lit("hot").alias("k"), F.lit(T(2024, 1, 1)).alias("t"), F.format_string("%012d", "id").alias("i"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = running_sliced(rows, ["k"], ["t", "i"], total={"n": F.lit(1)})
        assert found.agg(F.max("n"), F.count_distinct("n")).first()[:] == (200_000, 200_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in cut[0].groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 200_000 / 8
