import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from saldoflow.operators import calendars, index_returns

D = dt.date


def holidays(spark, *dates):
    return spark.createDataFrame([(d, "h") for d in dates], "holidayDate date, holidayName string")


def dates(df, column="referenceDate"):
    return [r[column] for r in df.orderBy(column).collect()]


def test_spine_bounds(spark):
    assert dates(calendars.date_spine(spark, D(2025, 1, 30), D(2025, 2, 1))) == [D(2025, 1, 30), D(2025, 1, 31), D(2025, 2, 1)]
    assert dates(calendars.date_spine(spark, D(2025, 2, 1), D(2025, 1, 1))) == []
    quarters = calendars.date_spine(spark, "2024-07-01", "2025-01-01", "3 month")
    assert dates(quarters) == [D(2024, 7, 1), D(2024, 10, 1), D(2025, 1, 1)]


def test_spine_of_missing_bound_is_empty(spark):
    nothing = holidays(spark).agg(F.min("holidayDate")).scalar()
    assert dates(calendars.date_spine(spark, nothing, D(2025, 1, 1))) == []


def test_working_days_and_duplicate_holidays(spark):
    days = calendars.working_days(calendars.date_spine(spark, D(2025, 1, 1), D(2025, 1, 6)),
                                  holidays(spark, D(2025, 1, 1), D(2025, 1, 1)))
    rows = {r["referenceDate"].day: r["isWorkingDay"] for r in days.collect()}
    assert rows == {1: False, 2: True, 3: True, 4: False, 5: False, 6: True}
    assert days.count() == 6


def test_next_business_day_equals_range_join(spark):
    closed = [D(2025, 1, 1), D(2025, 1, 31), D(2025, 1, 20), D(2025, 2, 2)]
    calendar = calendars.holiday_calendar(spark, holidays(spark, *closed))
    days = {r["referenceDate"]: r["isWorkingDay"] for r in calendar.collect()}
    expected = {d: min((e for e, w in days.items() if e >= d and w), default=None) for d in days}
    got = {r[0]: r[1] for r in calendars.next_business_day(calendar).collect()}
    assert got == {d: e for d, e in expected.items() if e}
    assert D(2025, 1, 31) not in got and D(2025, 2, 2) not in got  # after the last working day


def test_business_day_adjust_outside_calendar(spark):
    calendar = calendars.holiday_calendar(spark, holidays(spark, D(2025, 1, 1), D(2025, 1, 10)))
    rows = spark.createDataFrame([(1, D(2025, 1, 4)), (2, D(2026, 1, 1)), (3, None)], "id int, due date")
    moved = calendars.business_day_adjust(rows, "due", calendars.next_business_day(calendar))
    assert {r["id"]: r["due"] for r in moved.collect()} == {1: D(2025, 1, 6), 2: None, 3: None}


def index(spark, rows):
    return spark.createDataFrame(rows, "referenceDate timestamp, value double")


def test_latest_index_uses_local_date(spark):
    rows = [(dt.datetime(2025, 1, 1, 1), 1.01), (dt.datetime(2024, 12, 30, 12), 1.02), (dt.datetime(2025, 1, 2, 12), 1.0)]
    latest = index_returns.latest_index(index(spark, rows), D(2025, 1, 5)).collect()[0]
    assert (latest["latestValue"], latest["latestDate"]) == (1.01, D(2024, 12, 31))
    assert [r["referenceDate"] for r in index_returns.daily_factors(index(spark, rows)).orderBy("referenceDate").collect()] \
        == [D(2024, 12, 30), D(2025, 1, 1), D(2025, 1, 2)]


@pytest.mark.parametrize("rows", [
    [(dt.datetime(2025, 1, 2), 1.01), (dt.datetime(2025, 1, 2, 5), 1.02)],
    [(dt.datetime(2025, 1, 2), 0.0)],
])
def test_bad_index_is_an_error(spark, rows):
    with pytest.raises(Exception, match="index value"):
        index_returns.daily_factors(index(spark, rows)).collect()


def test_compound_return_is_the_product(spark):
    factors = [1 + i / 1000 for i in range(40)]
    rows = [(D(2025, 1, 1) + dt.timedelta(days=i), f) for i, f in enumerate(factors)]
    df = spark.createDataFrame(rows, "referenceDate date, indexValue double")
    by_settlement = {r[0]: r["accumulatedReturn"] for r in index_returns.compound_return(df, 25, 27).collect()}
    by_due = {r[0]: r["accumulatedReturn"] for r in index_returns.compound_return(df, 25, 27, "due").collect()}
    confirmation = 5
    expected = math.prod(factors[confirmation:confirmation + 25])
    assert by_settlement[rows[confirmation + 27][0]] == pytest.approx(expected)
    assert by_due[rows[confirmation + 25][0]] == pytest.approx(expected)
