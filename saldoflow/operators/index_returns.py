"""Daily index: last published factor, forecast and compounded return."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import SAO_PAULO, date_col, local_date
from ..params import RemunerationParams
from .calendars import date_spine, working_days


def latest_index(index: DataFrame, as_of: dt.date, tz: str = SAO_PAULO) -> DataFrame:
    """One row: last published factor other than 1 not after ``as_of``, and its local date."""
    published = index.filter((local_date("referenceDate", tz) <= date_col(as_of)) & (F.col("value") != 1))
    return published.agg(
        F.max_by("value", "referenceDate").alias("latestValue"),
        F.max(local_date("referenceDate", tz)).alias("latestDate"),
    )


def daily_factors(index: DataFrame) -> DataFrame:
    """Factor per UTC date; a second factor for a date, or one <= 0, is an error.

    Either would silently change the compounded return: the first shifts the row frame,
    the second has no logarithm.
    """
    day = F.col("referenceDate").cast("string")
    value = (
        F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("more than one index value on "), day)))
        .when(F.col("value") <= 0, F.raise_error(F.concat(F.lit("index value not positive on "), day)))
        .otherwise(F.col("value"))
    )
    return (
        index.groupBy(F.to_date("referenceDate").alias("referenceDate"))
        .agg(F.max("value").alias("value"), F.count("value").alias("_n"))
        .select("referenceDate", value.cast("double").alias("value"))
    )


def index_with_forecast(calendar: DataFrame, index: DataFrame, latest: DataFrame) -> DataFrame:
    """Factor per calendar day. After the last publication the last factor is repeated on
    working days; a day without publication has factor 1."""
    last_date = latest.select("latestDate").scalar()
    last_value = latest.select("latestValue").scalar()
    forecast = F.coalesce(F.col("referenceDate") > last_date, F.lit(False))
    repeated = F.when(F.col("isWorkingDay"), last_value).otherwise(F.lit(1.0))
    return (
        # one row per day on either side
        calendar.join(F.broadcast(daily_factors(index)), "referenceDate", "left")
        .select(
            "referenceDate",
            "isWorkingDay",
            F.when(forecast, repeated).otherwise(F.coalesce("value", F.lit(1.0))).alias("indexValue"),
            forecast.alias("isForecast"),
        )
    )


def compound_return(factors: DataFrame, due_days: int, settlement_days: int, key: str = "settlement") -> DataFrame:
    """Product of the ``due_days`` factors from confirmation to the day before the due date.

    ``key`` names what ``referenceDate`` is in the result: the settlement date (frame of
    rows settlement_days .. settlement_days - due_days + 1 before it) or the due date
    (rows due_days .. 1 before it). One row per calendar day, so one task is enough.
    """
    back = settlement_days if key == "settlement" else due_days
    frame = Window.orderBy("referenceDate").rowsBetween(-back, due_days - back - 1)
    return factors.withColumn("accumulatedReturn", F.exp(F.sum(F.log("indexValue")).over(frame)))


def return_series(spark: SparkSession, holidays: DataFrame, index: DataFrame, params: RemunerationParams,
                  key: str = "settlement", tz: str = SAO_PAULO) -> DataFrame:
    """Compounded return for every date from the start of the range on."""
    margin = dt.timedelta(days=params.settlement_days)
    calendar = working_days(date_spine(spark, params.start - margin, params.end + margin), holidays)
    factors = index_with_forecast(calendar, index, latest_index(index, params.as_of, tz))
    returns = compound_return(factors, params.due_days, params.settlement_days, key)
    return returns.filter(F.col("referenceDate") >= F.lit(params.start))
