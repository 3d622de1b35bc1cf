"""Date spines, working days and the next business day.

A calendar holds one row per day, so it is bounded by the length of the date range
(a century is 36,525 rows); that bound is what the broadcasts below rely on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import date_col

Bound = dt.date | str | Column


def date_range(start: Column, end: Column, step: str = "1 day") -> Column:
    """Array of dates, both ends included; NULL (so no rows once exploded) if start > end."""
    return F.when(start <= end, F.sequence(start, end, F.expr(f"interval {step}")))


def date_spine(spark: SparkSession, start: Bound, end: Bound, step: str = "1 day",
               name: str = "referenceDate") -> DataFrame:
    """One row per date; a bound may be a scalar sub-query column (``df.scalar()``)."""
    return (
        spark.range(0, 1, 1, 1)
        .select(date_col(start).alias("lo"), date_col(end).alias("hi"))
        .select(F.explode(date_range(F.col("lo"), F.col("hi"), step)).alias(name))
    )


def holiday_dates(holidays: DataFrame, name: str = "referenceDate") -> DataFrame:
    """Distinct holiday dates: a date listed twice must not double a calendar day."""
    return holidays.select(F.col("holidayDate").cast("date").alias(name)).filter(F.col(name).isNotNull()).distinct()


def working_days(spine: DataFrame, holidays: DataFrame, name: str = "referenceDate") -> DataFrame:
    """The spine with ``isWorkingDay``: neither Saturday, Sunday nor a holiday."""
    marked = holiday_dates(holidays, name).withColumn("_holiday", F.lit(True))
    weekend = F.dayofweek(name).isin(1, 7)
    return (
        spine.join(F.broadcast(marked), name, "left")
        .withColumn("isWorkingDay", ~weekend & F.col("_holiday").isNull())
        .drop("_holiday")
    )


def holiday_calendar(spark: SparkSession, holidays: DataFrame, name: str = "referenceDate") -> DataFrame:
    """Working-day calendar from the first to the last known holiday."""
    days = holiday_dates(holidays, name)
    first = days.agg(F.min(name)).scalar()
    last = days.agg(F.max(name)).scalar()
    return working_days(date_spine(spark, first, last, name=name), holidays, name)


def next_business_day(calendar: DataFrame, name: str = "referenceDate") -> DataFrame:
    """For each calendar day the first working day at or after it.

    Days after the last working day are left out. Reading the days backwards makes the
    frame a running one, so a single pass over the calendar is enough.
    """
    backwards = Window.orderBy(F.desc(name)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upcoming = F.min(F.when(F.col("isWorkingDay"), F.col(name))).over(backwards)
    return calendar.select(name, upcoming.alias("nextBusinessDay")).filter("nextBusinessDay is not null")


def business_day_adjust(df: DataFrame, column: str, next_days: DataFrame,
                        name: str = "referenceDate") -> DataFrame:
    """``column`` moved to its next business day; NULL outside the calendar."""
    lookup = next_days.select(F.col(name).alias(column), F.col("nextBusinessDay").alias("_moved"))
    moved = df.join(F.broadcast(lookup), column, "left")
    return moved.withColumn(column, F.col("_moved")).drop("_moved")
