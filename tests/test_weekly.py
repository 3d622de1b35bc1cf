import datetime as dt

from saldoflow.operators import weekly

D = dt.date
FACT = "purchaseCreated date, subIssuerId string, subIssuerName string, networkCurrencyCode string, purpose string, " \
       "cardType string, amount long, issuingPurchaseId string"


def report(spark, rows, **kw):
    """rows: date, issuer, currency, cents."""
    full = [(d, i, "n", c, "p", "physical", a, str(n)) for n, (d, i, c, a) in enumerate(rows)]
    return weekly.weekly_tpv(spark.createDataFrame(full, FACT), D(2025, 1, 8), "skip", **kw).collect()


def test_week_starts_on_sunday(spark):
    row = report(spark, [(D(2025, 1, 1), "a", "BRL", 100)])[0]
    assert row["week"] == D(2024, 12, 29)
    assert row["weeksAgo"] == 1
    assert row["weekLabel"] == "1. 29/Dec to 04/Jan"


def test_fixed_fee_counts_once_per_group(spark):
    rows = [(D(2025, 1, 1), "a", "BRL", 10000)] * 3
    row = report(spark, rows)[0]
    assert row["totalRevenue"] == 1.75 and row["nationalTRX"] == 3 and row["internationalTPV"] is None
    assert report(spark, rows, fee_per_trx=True)[0]["totalRevenue"] == 2.25


def test_currency_and_issuer(spark):
    rows = [(D(2025, 1, 1), "a", None, 100), (D(2025, 1, 1), None, "BRL", 100), (D(2025, 1, 1), "skip", "BRL", 100),
            (D(2025, 1, 1), "a", "USD", 10000)]
    got = {r["networkCurrencyCode"]: r for r in report(spark, rows)}
    assert set(got) == {None, "USD"}
    assert got[None]["totalRevenue"] is None and got[None]["totalTPV"] == 1.0
    assert got["USD"]["internationalRevenue"] == 1.9


def test_conversion(spark):
    df = spark.createDataFrame(
        [(500, 0, 10, 1, 1, D(2022, 2, 28), "USD"), (500, 300, 10, 1, 0, D(2022, 3, 1), "USD"), (500, 300, 10, 1, 0, None, "BRL")],
        "issuerAmount long, networkAmount long, fee long, merchantFee long, cycle long, purchaseConfirmed date, merchantCurrencyCode string")
    rows = weekly.conversion_columns(df).collect()
    assert [r["conversionRate"] for r in rows] == [0.0, 1.6667, 1.6667]
    assert [r["spread"] for r in rows] == [0.04, 0.02, 0.0]
    assert [r["purchaseConciliated"] for r in rows] == [D(2022, 2, 27), D(2022, 3, 1), None]
    assert rows[1]["feeBRL"] == 16.67 and rows[1]["conversionRateIssuer"] == 1.7
    assert "cycle" not in rows[0] and "merchantFeeBRL" in rows[0]
