"""Running values that do not put a whole key into one task.

A window over a key sorts all rows of that key in one task, which fails once a key holds a
large share of the table. Here the key is cut into minutes, and where many rows may share an
instant, a minute into instants and ranges of what orders the rows of an instant. The window
runs over such a part; one summary row per part carries the state within its minute, one per
minute across minutes, and a join brings it to the rows. No task sorts more than a part's rows, a
minute's parts or a key's minutes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.storage import stored


def _summary(rows: DataFrame, by: str, at: Column, last: Sequence[str], total: Sequence[str]) -> DataFrame:
    """State that the rows of a part leave: last values with where they stood, and totals."""
    aggregates = [F.sum(f"_in_{n}").alias(f"_in_{n}") for n in total]
    for n in last:
        known = F.when(F.col(f"_in_{n}").isNotNull(), at)
        aggregates += [F.max_by(f"_in_{n}", known).alias(f"_in_{n}"), F.max(known).alias(f"_at_{n}")]
    return rows.groupBy(by).agg(*aggregates)


def _carried(within: Window, last: Sequence[str], total: Sequence[str], name: str) -> list[Column]:
    """State before each summary row."""
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    return [F.last(f"_in_{n}", ignorenulls=True).over(before).alias(f"{name}{n}") for n in last] + [
        F.coalesce(F.sum(f"_in_{n}").over(before), F.lit(0)).alias(f"{name}{n}") for n in total]


def running(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str],
            last: Mapping[str, Column] | None = None, total: Mapping[str, Column] | None = None,
            ranges: Mapping[str, Column] | None = None) -> DataFrame:
    """Adds, for each row, values over the rows of its key up to and including it.

    ``last`` names the last non-null value of a column, ``total`` the sum of a whole number,
    NULL counting as 0. ``order`` starts with ``ts`` and is unique within a key; NULL
    keys form a key of their own. ``ranges`` names coarser values of the other columns of ``order``,
    which never fall along it, for keys of which many rows may share an instant.
    """
    last, total, ranges = last or {}, total or {}, ranges or {}
    # One value for key and minute: as columns they would pass for partitioned once the
    # rows are partitioned by the key, and a key would stay in one task.
    minute = F.struct(*keys, F.date_trunc("minute", F.col(ts)).alias("_minute"))
    fine = F.struct(*keys, F.col(ts).alias("_instant"), *[v.alias(n) for n, v in ranges.items()])
    rows = df.withColumn("_part", fine if ranges else minute).withColumn("_bucket", minute)
    for name, value in last.items():
        rows = rows.withColumn(f"_in_{name}", value)
    for name, value in total.items():
        rows = rows.withColumn(f"_in_{name}", F.coalesce(value, F.lit(0)).cast("long"))

    names = (list(last), list(total))
    across = Window.partitionBy(*[f"_bucket.{k}" for k in keys]).orderBy("_bucket._minute")
    if ranges:
        parts = _summary(rows.withColumn("_part", F.struct("_part", "_bucket")), "_part", F.struct(*order), *names).select(
            F.col("_part._bucket").alias("_bucket"), F.col("_part._part").alias("_part"),
            *[c for n in last for c in (f"_in_{n}", f"_at_{n}")], *[f"_in_{n}" for n in total])
        inside = Window.partitionBy("_bucket").orderBy("_part._instant", *[f"_part.{r}" for r in ranges])
        minutes = parts
        for n in last:  # where the last value of a minute stands
            minutes = minutes.withColumn(f"_in_{n}", F.struct(F.col(f"_at_{n}").alias("at"), F.col(f"_in_{n}").alias("value")))
        minutes = minutes.groupBy("_bucket").agg(
            *[F.max(F.when(F.col(f"_at_{n}").isNotNull(), F.col(f"_in_{n}")))["value"].alias(f"_in_{n}") for n in last],
            *[F.sum(f"_in_{n}").alias(f"_in_{n}") for n in total])
        summary = parts.select("_part", "_bucket", *_carried(inside, *names, "_near_")).join(
            minutes.select("_bucket", *_carried(across, *names, "_far_")), "_bucket").select(
            "_part", *[F.coalesce(f"_near_{n}", f"_far_{n}").alias(f"_carry_{n}") for n in last],
            *[(F.col(f"_near_{n}") + F.col(f"_far_{n}")).alias(f"_carry_{n}") for n in total])
    else:
        summary = _summary(rows, "_part", F.struct(*order), *names).withColumn("_bucket", F.col("_part")).select(
            "_part", *_carried(across, *names, "_carry_"))

    up_to = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select(
        *df.columns, "_part",
        *[F.last(f"_in_{n}", ignorenulls=True).over(up_to).alias(f"_local_{n}") for n in last],
        *[F.sum(f"_in_{n}").over(up_to).alias(f"_local_{n}") for n in total],
    )
    return local.join(summary, "_part").select(
        *df.columns,
        *[F.coalesce(f"_local_{n}", f"_carry_{n}").alias(n) for n in last],
        *[(F.col(f"_carry_{n}") + F.col(f"_local_{n}")).alias(n) for n in total],
    )


def running_sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   last: Mapping[str, Column] | None = None, total: Mapping[str, Column] | None = None) -> DataFrame:
    """``running`` for tables in which many rows of a key may share an instant.

    Spark cuts the table, ordered by key and ``order``, at quantiles that it samples, so a slice is as large as
    any other whatever the keys, instants and ids are: a hot key has many slices and many small keys share one.
    The state passes from slice to slice by one row per key and slice. The slices are stored, as both the
    rows and that state have to meet the same ones; ``order`` is unique within a key.
    """
    last, total = last or {}, total or {}
    rows = df
    for name, value in last.items():
        rows = rows.withColumn(f"_in_{name}", value)
    for name, value in total.items():
        rows = rows.withColumn(f"_in_{name}", F.coalesce(value, F.lit(0)).cast("long"))
    cut = stored(rows.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()))
    # One value, so that a partitioning by the key alone doesn't pass for one by its slices.
    cut = cut.withColumn("_part", F.struct(*keys, "_slice"))
    names = (list(last), list(total))
    across = Window.partitionBy(*[f"_part.{k}" for k in keys]).orderBy("_part._slice")
    summary = _summary(cut, "_part", F.struct(*order), *names).select("_part", *_carried(across, *names, "_carry_"))
    up_to = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.select(
        *df.columns, "_part",
        *[F.last(f"_in_{n}", ignorenulls=True).over(up_to).alias(f"_local_{n}") for n in last],
        *[F.sum(f"_in_{n}").over(up_to).alias(f"_local_{n}") for n in total],
    )
    return local.join(summary, "_part").select(
        *df.columns,
        *[F.coalesce(f"_local_{n}", f"_carry_{n}").alias(n) for n in last],
        *[(F.col(f"_carry_{n}") + F.col(f"_local_{n}")).alias(n) for n in total],
    )
