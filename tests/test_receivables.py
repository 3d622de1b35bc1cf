import datetime as dt

import pytest
from pyspark.sql import functions as F

from saldoflow.functions.dates import local_date, local_date_between
from saldoflow.operators import calendars, receivables
from saldoflow.params import ReceivablesParams

D, T = dt.date, dt.datetime
PARAMS = ReceivablesParams(start=D(2024, 1, 1), end=D(2024, 12, 31), excluded_companies=("own",))


def key(spark_value):
    return (spark_value,)


@pytest.fixture()
def entities(spark):
    """Two installments of one purchase, one of a denied and one of an excluded company's purchase."""
    noon = lambda *d: T(*d, 12)
    inst = [(key(1), "10", noon(2024, 1, 2), noon(2024, 2, 1), "visa", "w", "paid", 1000, 30, None),
            (key(2), "10", noon(2024, 1, 2), noon(2024, 3, 4), "visa", "w", "paid", 500, None, ["a", "contract-chunk-7"]),
            (key(3), "11", noon(2024, 1, 2), noon(2024, 2, 1), "visa", "w", "paid", 700, 10, None),
            (key(4), "10", noon(2024, 1, 2), noon(2024, 2, 1), "visa", "x", "paid", 900, 10, None),
            (key(5), "10", T(2025, 1, 1, 3), noon(2024, 2, 1), "visa", "w", "paid", 900, 10, None)]
    installments = spark.createDataFrame(inst, "`__key__` struct<id: long>, purchaseId string, created timestamp_ntz, "
                                         "due timestamp_ntz, network string, workspaceId string, status string, "
                                         "amount long, fee long, tags array<string>")
    log = installments.select(F.col("__key__.id").cast("string").alias("installmentId"), F.lit("created").alias("type"),
                              F.struct("due", "created").alias("installment"))
    purchases = spark.createDataFrame([(key(10), "e10", "debit", "confirmed"), (key(11), "e11", "credit", "confirmed")],
                                      "`__key__` struct<id: long>, endToEndId string, fundingType string, status string")
    acquiring = spark.createDataFrame([(100, "e10", 1, "confirmed"), (110, "e11", 1, "denied")],
                                      "id long, endToEndId string, amount long, status string")
    fees = spark.createDataFrame([("100", noon(2024, 2, 1), 20)], "purchaseId string, due timestamp_ntz, externalFee long")
    workspaces = spark.createDataFrame([("w", "c", "Old", T(2020, 1, 1)), ("w", "c", "Company", T(2021, 1, 1)),
                                        ("x", "own", "Self", T(2020, 1, 1))],
                                       "workspaceId string, companyTaxId string, companyName string, workspaceCreated timestamp_ntz")
    closed = spark.createDataFrame([(D(2024, 1, 1), "a"), (D(2024, 1, 4), "b"), (D(2024, 12, 25), "c")],
                                   "holidayDate date, holidayName string")
    next_days = calendars.next_business_day(calendars.holiday_calendar(spark, closed))
    return installments, log, purchases, acquiring, fees, workspaces, next_days


def test_fact(entities):
    rows = {r["installmentId"]: r for r in receivables.installment_fact(*entities, PARAMS).collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"]["dueFromAcquirer"] == D(2024, 1, 5)  # the 4th is a holiday
    assert (rows["1"]["externalFee"], rows["2"]["externalFee"]) == (20, None)
    assert (rows["1"]["isFactoring"], rows["2"]["isFactoring"]) == (False, True)


def test_missing_fee_drops_out_of_the_net_amount(entities):
    fact = receivables.installment_fact(*entities, PARAMS)
    merchant = {r["referenceDate"]: r for r in receivables.merchant_due_rollup(fact).collect()}
    assert merchant[D(2024, 2, 1)]["amountToMerchant"] == 970
    assert merchant[D(2024, 3, 4)]["amountToMerchant"] is None
    assert merchant[D(2024, 3, 4)]["amountWithoutFeeAndExternalFeeToMerchant"] == 500


def test_factored_installment_is_received_on_its_own_date(entities):
    fact = receivables.installment_fact(*entities, PARAMS)
    dates = {r["isFactoring"]: r["referenceDate"] for r in receivables.acquirer_due_rollup(fact).collect()}
    assert dates == {False: D(2024, 1, 5), True: D(2024, 3, 4)}


FACT = "createdDate date, merchantDue date, dueFromAcquirer date, nominalDue date, network string, " \
       "installmentStatus string, workspaceId string, isFactoring boolean, amount long, fee long, " \
       "externalFee long, purchaseStatus string"


def fact(spark, rows):
    """rows: created, merchant due, acquirer due, network, factoring."""
    return spark.createDataFrame(
        [(c, m, a, m, n, "paid", "w", f, 100, 1, 2, "confirmed") for c, m, a, n, f in rows], FACT)


@pytest.fixture()
def company(spark):
    return spark.createDataFrame([("w", "c", "Company", T(2020, 1, 1))],
                                 "workspaceId string, companyTaxId string, companyName string, workspaceCreated timestamp_ntz")


def test_rows_of_both_flags_are_paired_with_the_other_side(spark, company):
    one = D(2024, 1, 2)
    rows = [(one, D(2024, 1, 4), one, "visa", False), (one, one, D(2024, 1, 9), "visa", True)]
    got = receivables.daily_receive_pay(receivables.dated_rollup(fact(spark, rows)), company).collect()
    that_day = [(r["isFactoring"], r["amountFromAcquirer"], r["amountToMerchant"]) for r in got if r["referenceDate"] == one]
    assert sorted(that_day) == [(False, 98, 99)] * 2 + [(True, 98, 99)] * 2
    # day 3 has no creation but lies between the first creation and the last due date
    assert [(r["network"], r["companyName"]) for r in got if r["referenceDate"] == D(2024, 1, 3)] == [(None, None)]
    matched = receivables.daily_receive_pay(receivables.dated_rollup(fact(spark, rows)), company, match_factoring=True).collect()
    that_day = [(r["isFactoring"], r["amountFromAcquirer"], r["amountToMerchant"]) for r in matched if r["referenceDate"] == one]
    assert sorted(that_day, key=repr) == [(False, 98, None), (True, 98, 99)]


def test_unknown_network_matches_nothing(spark, company):
    one = D(2024, 1, 2)
    got = receivables.daily_receive_pay(receivables.dated_rollup(fact(spark, [(one, one, one, None, False)])), company).collect()
    sides = sorted([(r["isFactoring"], r["amountFromAcquirer"], r["amountToMerchant"]) for r in got], key=repr)
    assert sides == sorted([(False, None, None), (None, 98, None), (None, None, 99)], key=repr)


def test_tag_flag(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [None, "a"]), (4, [None, "xcontract-chunk9"])], "id int, tags array<string>")
    got = {r[0]: r[1] for r in rows.select("id", receivables.tag_flag(F.col("tags"), "contract-chunk")).collect()}
    assert got == {1: False, 2: False, 3: False, 4: True}


def test_local_date_range_equals_the_conversion(spark):
    start, end = D(2018, 11, 4), D(2019, 2, 16)  # both are days on which the clocks changed
    times = [T(2018, 11, 3) + dt.timedelta(minutes=30 * i) for i in range(150)]
    times += [T(2019, 2, 15) + dt.timedelta(minutes=30 * i) for i in range(150)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = df.select(local_date_between("t", start, end).alias("a"),
                    local_date("t").between(F.lit(start), F.lit(end)).alias("b"))
    assert got.filter("a <> b").count() == 0 and got.filter("a").count() > 0 and got.filter("not a").count() > 0
