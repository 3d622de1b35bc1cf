"""Receivables statements: captured text to rows, and the merge with earlier snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_day_label, parse_money
from .dims import first_per_key

REALISED, FORECAST = "realizado", "previsto"


def collect_statements(captured: DataFrame, as_of: dt.date, rounding: str = "truncate") -> DataFrame:
    """Rows (updated_on, data, tipo, valor in cents) from captured kind, label and value.

    ``captured`` has updated_on, kind ("realised" or "forecast"), label and value. A label
    that is no day gives a NULL date, see ``unreadable_labels``.
    """
    kind = F.when(F.col("kind") == "realised", REALISED).when(F.col("kind") == "forecast", FORECAST)
    return captured.select(
        "updated_on",
        parse_day_label(F.col("label"), as_of).alias("data"),
        kind.alias("tipo"),
        parse_money(F.col("value"), rounding).alias("valor"),
    )


def unreadable_labels(captured: DataFrame, as_of: dt.date) -> DataFrame:
    """Labels without a known day and month, with their number of rows."""
    return captured.filter(parse_day_label(F.col("label"), as_of).isNull()).groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"))


def snapshot_merge(history: DataFrame, new: DataFrame) -> DataFrame:
    """History before the first new date as it is; from there on one row per date.

    A realised amount beats a forecast, then the newest ``updated_on`` wins, then the
    smallest amount. Rows without date are left out; without any new date the history stays as it
    is. ``new`` is read twice and should be a stored result.
    """
    first_new = new.agg(F.min("data")).scalar()
    columns = ["updated_on", "data", "tipo", "valor"]
    history = history.select(*columns)
    later = history.filter(F.col("data") >= first_new).unionByName(new.select(*columns).filter("data is not null"))
    best = first_per_key(later, ["data"], [
        F.when(F.col("tipo") == REALISED, 0).otherwise(1), F.desc("updated_on"), F.col("tipo"), F.col("valor"),
    ])
    earlier = F.when(first_new.isNull(), True).otherwise(F.col("data") < first_new)
    return history.filter(earlier).unionByName(best)
