import datetime as dt

from saldoflow.operators import cards

D, T = dt.date, dt.datetime
SCHEMA = "issuingCardId string, cardType string, type string, logCreated timestamp_ntz, created timestamp_ntz, " \
         "expiration date, issuingHolderId string, subIssuerTaxId string"
END = D(2030, 1, 1)


def log(spark, rows):
    """rows: card, card type, event type, date, expiration, holder."""
    full = [(c, k, t, dt.datetime.combine(d, dt.time()), T(2024, 1, 1), x, h, "i") for c, k, t, d, x, h in rows]
    return spark.createDataFrame(full, SCHEMA)


def deltas(spark, rows, **kw):
    got = cards.activity_delta(cards.card_events(log(spark, rows), END), **kw).orderBy("eventNumber").collect()
    return [(r["type"], r["delta"], r["quarter"]) for r in got]


def test_virtual_card_loses_twice(spark):
    rows = [("v", "virtual", t, d, D(2025, 6, 1), "h") for t, d in
            (("created", D(2024, 1, 5)), ("canceled", D(2024, 12, 31)))]
    assert deltas(spark, rows) == [("created", 1, D(2024, 1, 1)), ("canceled", -1, D(2025, 1, 1)),
                                   ("expiration", -1, D(2025, 7, 1))]
    assert [d for _, d, _ in deltas(spark, rows, clamp=True)] == [1, -1, 0]


def test_physical_card_loses_only_right_after_unblocking(spark):
    rows = [("f", "physical", t, d, D(2025, 6, 1), "h") for t, d in
            (("created", D(2024, 1, 1)), ("unblocked", D(2024, 4, 5)), ("canceled", D(2024, 5, 1)))]
    assert [d for _, d, _ in deltas(spark, rows)] == [0, 1, -1, 0]


def test_events_of_one_instant_follow_the_card_life(spark):
    rows = [("f", "physical", t, D(2024, 1, 1), None, "h") for t in ("canceled", "unblocked", "created", "unblocked")]
    assert [(t, d) for t, d, _ in deltas(spark, rows)] == [("created", 0), ("unblocked", 1), ("canceled", -1)]


def test_expiration_after_the_end_is_ignored(spark):
    rows = [("v", "virtual", "created", D(2024, 1, 5), D(2030, 1, 2), "h")]
    assert [t for t, _, _ in deltas(spark, rows)] == ["created"]


def report(spark, rows, **kw):
    names = spark.createDataFrame([("i", "Issuer"), ("j", "Other")], "subIssuerTaxId string, subIssuerName string")
    got = cards.active_holders_report(log(spark, rows), names, END, **kw).orderBy("quarter").collect()
    return {r["quarter"]: r["holders"] for r in got}


def test_quarter_without_holders_repeats_the_last_count(spark):
    rows = [("a", "virtual", "created", D(2024, 1, 5), None, "h1"), ("b", "virtual", "created", D(2024, 2, 5), None, "h2"),
            ("a", "virtual", "canceled", D(2024, 2, 6), None, "h1"), ("b", "virtual", "canceled", D(2024, 2, 7), None, "h2"),
            ("c", "virtual", "created", D(2024, 8, 1), None, "h3")]
    assert report(spark, rows) == {D(2024, 1, 1): 2, D(2024, 4, 1): 2, D(2024, 7, 1): 1}
    assert report(spark, rows, zero_when_empty=True) == {D(2024, 1, 1): 2, D(2024, 4, 1): 0, D(2024, 7, 1): 1}


def test_holder_keeps_balance_between_events(spark):
    rows = [("a", "virtual", "created", D(2024, 1, 5), None, "h1"), ("b", "virtual", "created", D(2024, 8, 5), None, "h1")]
    balance = cards.holder_balance(cards.holder_activity(cards.activity_delta(cards.card_events(log(spark, rows), END))))
    counts = {r["quarter"]: r["holders"] for r in cards.active_holders(balance).collect()}
    assert counts == {D(2024, 1, 1): 1, D(2024, 4, 1): 1, D(2024, 7, 1): 1}


def test_of_issuer_keeps_the_named_issuer(spark):
    names = spark.createDataFrame([("i", "Issuer"), ("j", "Other")], "subIssuerTaxId string, subIssuerName string")
    rows = log(spark, [("a", "virtual", "created", D(2024, 1, 5), None, "h1")])
    assert cards.of_issuer(rows, names, "Issuer").count() == 1
    assert cards.of_issuer(rows, names, "Other").count() == 0
