"""Helpers used by every job: picking one row per key and reading shared settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key: the first in ``order``, which should end in a unique column.

    The ``rn == 1`` filter becomes a group limit below the shuffle, so a task sends one
    row per key however many rows the key has.
    """
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).filter("_rn = 1").drop("_rn")


def dedupe_dim(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Dimension with one row per non-null key."""
    return first_per_key(df.filter(F.col(key).isNotNull()), [key], order)
