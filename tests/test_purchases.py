import datetime as dt
import random

from pyspark.sql import functions as F

from saldoflow.operators import purchases
from saldoflow.params import RemunerationParams

D, T = dt.date, dt.datetime
PARAMS = RemunerationParams(start=D(2025, 1, 1), end=D(2025, 3, 31), as_of=D(2025, 3, 31))
LOG = "endToEndId string, issuingPurchaseLogId string, logTime timestamp_ntz, type string, logAmount long, " \
      "purchaseConfirmed date, subIssuerTaxId string"


def log(spark, rows):
    """rows: id, log id, time, type, amount."""
    full = [(i, n, t, k, a, t.date() if k == "confirmed" else None, "x") for i, n, t, k, a in rows]
    return spark.createDataFrame(full, LOG).withColumn("logDate", F.to_date("logTime")).withColumn(
        "confirmedTime", F.when(F.col("type") == "confirmed", F.col("logTime")))


def returns(spark, key="settlementDate"):
    start = D(2024, 12, 1)
    rows = [(start + dt.timedelta(days=i), 1.1, 1.0, False) for i in range(300)]
    return spark.createDataFrame(rows, "referenceDate date, accumulatedReturn double, indexValue double, isForecast boolean")


def test_reversal_before_confirmation_on_the_same_day(spark):
    day = D(2025, 1, 10)
    rows = [("p", "1", T(2025, 1, 10, 9), "reversed", 5), ("p", "2", T(2025, 1, 10, 10), "confirmed", 100),
            ("p", "3", T(2025, 1, 10, 11), "reversed", 7)]
    got = {r["issuingPurchaseLogId"]: r["cycleDate"] for r in purchases.attribute_cycle(log(spark, rows), PARAMS).collect()}
    assert got == {"1": None, "2": day, "3": day}
    amounts = purchases.cycle_amounts(log(spark, rows), PARAMS).collect()
    assert [(a["confirmedAmount"], a["reversedBeforeSettlement"], a["reversedAfterSettlement"]) for a in amounts] == [(100, 7, None)]


def test_settlement_date_counts_as_after(spark):
    rows = [("p", "1", T(2025, 1, 1, 9), "confirmed", 1000), ("p", "2", T(2025, 1, 27, 9), "reversed", 1),
            ("p", "3", T(2025, 1, 28, 9), "reversed", 2)]
    paid = purchases.with_remuneration(purchases.cycle_amounts(log(spark, rows), PARAMS), returns(spark), PARAMS).collect()[0]
    assert (paid["reversedBeforeSettlement"], paid["reversedAfterSettlement"]) == (1, 2)
    assert paid["remuneration"] == round(999 * 0.1 * 0.6)


def test_daily_report_counts_settlement_date_as_before(spark):
    rows = [("p", "1", T(2025, 1, 1, 9), "confirmed", 1000), ("p", "2", T(2025, 1, 28, 9), "reversed", 2),
            ("p", "3", T(2025, 1, 29, 9), "reversed", 4)]
    names = spark.createDataFrame([("x", "X"), ("y", "Y")], "subIssuerTaxId string, subIssuerName string")
    for inclusive, before, after in ((True, 2, 0), (False, 0, 2)):
        report = purchases.issuer_daily_remuneration(log(spark, rows), returns(spark), names, PARAMS, inclusive)
        days = {r["referenceDate"]: r for r in report.collect()}
        assert len(days) == 90  # every day of the range, for the one issuer in the log
        assert days[D(2025, 1, 26)]["confirmed"] == 1000
        assert days[D(2025, 1, 26)]["reversedBeforeSettlement"] == before
        assert days[D(2025, 1, 28)]["reversedAfterSettlement"] == after
        assert days[D(2025, 1, 29)]["reversedAfterSettlement"] == 4


def test_reversals_are_compared_as_instants_or_as_days(spark):
    rows = [("p", "1", T(2025, 1, 1, 9), "confirmed", 1000), ("p", "2", T(2025, 1, 1, 8), "reversed", 1),
            ("p", "3", T(2025, 1, 28, 8), "reversed", 2), ("p", "4", T(2025, 1, 28, 18), "reversed", 4)]
    names = spark.createDataFrame([("x", "X")], "subIssuerTaxId string, subIssuerName string")
    for compare, before, after in (("instant", 2, 4), ("day", 7, 0)):
        report = purchases.issuer_daily_remuneration(log(spark, rows), returns(spark), names, PARAMS, compare=compare)
        days = {r["referenceDate"]: r for r in report.collect()}
        assert days[D(2025, 1, 26)]["reversedBeforeSettlement"] == before
        assert days[D(2025, 1, 28)]["reversedAfterSettlement"] == after


def test_previous_event_of_rows_of_one_instant(spark):
    at = T(2025, 1, 1, 9)
    rows = [("p", f"{i:03}", at, "confirmed" if i % 2 else "reversed", i) for i in range(100)]
    got = purchases.previous_event_lookup(log(spark, rows)).collect()
    assert {r["previousLogId"] for r in got} == {"099"} and {r["previousTime"] for r in got} == {at}
    assert sorted(r["rowNumber"] for r in got) == list(range(1, 51))


def test_remuneration_rounds_half_away_and_floors_at_zero(spark):
    rows = [("a", "1", T(2025, 1, 1, 9), "confirmed", 0), ("a", "2", T(2025, 1, 2, 9), "reversed", 25),
            ("b", "3", T(2025, 1, 1, 9), "confirmed", 25)]
    paid = {r["endToEndId"]: r for r in purchases.with_remuneration(
        purchases.cycle_amounts(log(spark, rows), PARAMS), returns(spark), PARAMS).collect()}
    assert paid["a"]["remuneration"] == -2 and paid["a"]["nonNegativeRemuneration"] == 0
    assert paid["b"]["remuneration"] == 2


def brute_force(rows):
    """Cycle of each log row, the latest confirmation at or before it."""
    result = {}
    for i, n, t, kind, _ in rows:
        known = [u for j, _, u, k, _ in rows if j == i and k == "confirmed" and u <= t]
        result[n] = max(known).date() if known else None
    return result


def random_rows(n, seed=3):
    rnd = random.Random(seed)
    # one purchase holds a third of the rows
    return [("hot" if rnd.random() < 0.33 else f"p{rnd.randrange(20)}", str(i),
             T(2025, 1, 1) + dt.timedelta(seconds=rnd.randrange(0, 40 * 86400, 600)),
             rnd.choice(["confirmed", "reversed"]), rnd.randrange(1, 1000)) for i in range(n)]


def test_attribution_equals_brute_force(spark):
    rows = random_rows(400)
    got = {r["issuingPurchaseLogId"]: r["cycleDate"] for r in purchases.attribute_cycle(log(spark, rows), PARAMS).collect()}
    assert got == brute_force(rows)


def test_cycle_sums_equal_attributed_rows(spark):
    rows = random_rows(400, seed=4)
    cycles = brute_force(rows)
    amounts = purchases.cycle_amounts(log(spark, rows), PARAMS).collect()
    assert sum(a["confirmedAmount"] for a in amounts) == sum(r[4] for r in rows if r[3] == "confirmed")
    returned = sum((a["reversedBeforeSettlement"] or 0) + (a["reversedAfterSettlement"] or 0) for a in amounts)
    assert returned == sum(r[4] for r in rows if r[3] == "reversed" and cycles[r[1]])


def test_previous_event_equals_brute_force(spark):
    rows = random_rows(300, seed=5)
    got = {r["issuingPurchaseLogId"]: (r["previousLogId"], r["rowNumber"])
           for r in purchases.previous_event_lookup(log(spark, rows)).collect()}
    expected = {}
    for i, n, t, kind, _ in rows:
        if kind == "reversed":
            before = [(u, m) for j, m, u, k, _ in rows if j == i and k == "confirmed" and u <= t]
            number = sum(1 for j, m, u, k, _ in rows if j == i and k == "reversed" and (u, m) <= (t, n))
            expected[n] = (max(before)[1] if before else None, number)
    assert got == expected


def test_previous_row_attribution(spark):
    rows = [("p", "1", T(2025, 1, 1, 9), "confirmed", 100), ("p", "2", T(2025, 1, 5, 9), "reversed", 10),
            ("p", "3", T(2025, 1, 5, 10), "reversed", 20), ("p", "4", T(2025, 2, 20, 9), "reversed", 40)]
    got = {r["cycleDate"]: r for r in purchases.previous_row_amounts(log(spark, rows), PARAMS).collect()}
    # the first reversal of a day belongs to the day before it in the log, the next ones to their own
    assert got[D(2025, 1, 1)]["reversedBeforeSettlement"] == 10
    assert got[D(2025, 1, 5)]["reversedBeforeSettlement"] == 60
    assert got[D(2025, 2, 20)]["reversedBeforeSettlement"] is None
    assert got[D(2025, 1, 1)]["confirmedAmount"] == 100 and got[D(2025, 1, 5)]["confirmedAmount"] is None
    assert got[D(2025, 1, 1)]["dueDate"] == D(2025, 1, 26) and got[D(2025, 1, 5)]["dueDate"] is None


def test_log_filter_and_issuer(spark):
    rows = [("p", "1", "c1", T(2025, 1, 1), "confirmed", 1, "purchase", "BRL", T(2025, 1, 1)),
            ("p", "2", "c2", T(2025, 1, 1), "confirmed", 1, "purchase", "BRL", T(2025, 1, 1)),
            ("p", "3", "c3", T(2025, 1, 1), "confirmed", 1, "purchase", "BRL", T(2025, 1, 1)),
            ("p", "4", "c1", T(2025, 1, 1), "denied", 1, "purchase", "BRL", None),
            ("p", "5", "c1", T(2024, 12, 4), "confirmed", 1, "purchase", "BRL", None),
            ("p", "6", "c1", T(2025, 3, 31, 23, 59), "confirmed", 1, "purchase", "BRL", None),
            ("p", "7", "c1", T(2025, 4, 1), "confirmed", 1, "purchase", "BRL", None),
            ("p", "8", "c1", T(2025, 1, 1), "confirmed", 1, "withdrawal", "BRL", None),
            ("p", "9", "c1", T(2025, 1, 1), "confirmed", 1, "purchase", "USD", None)]
    events = spark.createDataFrame(rows, "endToEndId string, issuingPurchaseLogId string, issuingCardId string, "
                                   "logCreated timestamp_ntz, type string, logAmount long, purpose string, "
                                   "merchantCurrencyCode string, purchaseConfirmed timestamp_ntz")
    cards = spark.createDataFrame([("c1", "i1"), ("c2", "i2"), ("c3", None)], "issuingCardId string, subIssuerTaxId string")

    def ids(**kw):
        p = RemunerationParams(start=D(2025, 1, 1), end=D(2025, 3, 31), as_of=D(2025, 3, 31), **kw)
        return sorted(r["issuingPurchaseLogId"] for r in purchases.purchase_log(events, cards, p).collect())

    assert ids() == ["1", "2", "3", "6"]
    assert ids(issuer="i1") == ["1", "6"]
    assert ids(exclude_issuer="i1") == ["2"]
