"""Active cards and card holders per quarter, from the card event log.

A card contributes at most four events (first created, unblocked, canceled, and its
expiration), so the log is reduced to one row per card by a single aggregation with
map-side combining; every window after it runs over a handful of rows per card, or over
(holder, quarter) sums. Among equal timestamps the smallest values win.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import quarter_start
from .calendars import date_range
from .dims import dedupe_dim
from .joins import join_splittable

# The events that change a card, in the order in which they follow each
# other when they carry the same time.
EVENT_TYPES = ("created", "unblocked", "canceled")
EXPIRATION = "expiration"
EVENT_ORDER = (*EVENT_TYPES, EXPIRATION)


def issuer_names(sub_issuers: DataFrame) -> DataFrame:
    """One name per issuer."""
    return dedupe_dim(sub_issuers.select("subIssuerTaxId", "subIssuerName"), "subIssuerTaxId", [F.col("subIssuerName")])


def of_issuer(log: DataFrame, sub_issuers: DataFrame, name: str) -> DataFrame:
    """Card log rows of the issuers called ``name``."""
    wanted = issuer_names(sub_issuers).filter(F.col("subIssuerName") == name).select("subIssuerTaxId")
    return join_splittable(log, wanted, ["subIssuerTaxId"], "left_semi")


def _first_row(order: str) -> Column:
    """Expiration, holder and issuer as stated by the earliest log row of the card."""
    return F.min(F.struct(
        F.col(order).alias("at"),
        F.col("expiration").cast("date").alias("expiration"),
        "cardType", "issuingHolderId", "subIssuerTaxId",
    ))


def _first_event(event: str) -> Column:
    return F.min(F.when(F.col("type") == event, F.struct(F.col("logCreated").cast("timestamp_ntz").alias("at"), "cardType")))


def card_expirations(log: DataFrame, order: str = "created") -> DataFrame:
    """One expiration per card with its holder and issuer."""
    return log.groupBy("issuingCardId").agg(_first_row(order).alias("_first")).select(
        "issuingCardId",
        F.col("_first.cardType").alias("cardType"),
        F.lit(EXPIRATION).alias("type"),
        F.col("_first.expiration").alias("logCreated"),
        F.col("_first.issuingHolderId").alias("issuingHolderId"),
        F.col("_first.subIssuerTaxId").alias("subIssuerTaxId"),
    )


def card_states(log: DataFrame, order: str = "created", types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """All that counts of a card: its earliest row as ``_first`` and its first event of each type.

    Each is a minimum, so the states of two logs are merged by the smaller of both (``merged_card_states``).
    """
    wanted = log.select("issuingCardId", "cardType", "type", "logCreated", "created", "expiration",
                        "issuingHolderId", "subIssuerTaxId")
    return wanted.groupBy("issuingCardId").agg(
        _first_row(order).alias("_first"),
        *[_first_event(t).alias(f"_{t}") for t in types],
    )


def merged_card_states(states: DataFrame) -> DataFrame:
    """One state per card from several."""
    return states.groupBy("issuingCardId").agg(*[F.min(c).alias(c) for c in states.columns if c != "issuingCardId"])


def events_of(states: DataFrame, end: dt.date | None, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """The events of ``card_events`` from the cards' states."""
    entries = [
        F.when(F.col(f"_{t}").isNotNull(), F.struct(
            F.col(f"_{t}.cardType").alias("cardType"), F.lit(t).alias("type"), F.col(f"_{t}.at").alias("logCreated")))
        for t in types
    ]
    if end is not None:
        entries.append(F.when(F.col("_first.expiration") <= F.lit(end), F.struct(
            F.col("_first.cardType").alias("cardType"), F.lit(EXPIRATION).alias("type"),
            F.col("_first.expiration").cast("timestamp_ntz").alias("logCreated"))))
    return states.select(
        "issuingCardId",
        F.col("_first.issuingHolderId").alias("issuingHolderId"),
        F.col("_first.subIssuerTaxId").alias("subIssuerTaxId"),
        F.explode(F.array_compact(F.array(*entries))).alias("_event"),
    ).select("issuingCardId", "_event.*", "issuingHolderId", "subIssuerTaxId")


def card_events(log: DataFrame, end: dt.date | None, order: str = "created",
                types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """First event of each type per card, and expirations up to ``end`` (none if ``end`` is None).

    Columns issuingCardId, cardType, type, logCreated, issuingHolderId, subIssuerTaxId.
    """
    return events_of(card_states(log, order, types), end, types)


def first_card_events(log: DataFrame, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """Earliest row per card and event type."""
    return card_events(log, None, types=types).select("issuingCardId", "cardType", "type", "logCreated")


def activity_delta(events: DataFrame, clamp: bool = False) -> DataFrame:
    """Change of the active count per event, and the quarter from which it holds.

    A virtual card is active from creation, a physical one from unblocking. Cancellation
    and expiration count from the following quarter; a physical card loses one only if the
    event right before was the unblocking, while a virtual one loses one for each of the
    two. ``clamp`` lets a card lose at most one.
    """
    rank = F.array_position(F.array(*[F.lit(t) for t in EVENT_ORDER]), F.col("type"))
    by_time = Window.partitionBy("issuingCardId").orderBy("logCreated", "_rank")
    ends = F.col("type").isin("canceled", EXPIRATION)
    virtual, physical = F.col("cardType") == "virtual", F.col("cardType") == "physical"
    loses = ends & (virtual | (physical & (F.col("_previous") == "unblocked")))
    if clamp:
        loses = loses & (F.col("_ends_before") == 0)
    delta = (
        F.when((F.col("type") == "created") & virtual, 1)
        .when((F.col("type") == "unblocked") & physical, 1)
        .when(loses, -1)
        .otherwise(0)
    )
    start = quarter_start(F.to_date("logCreated"))
    return (
        events.withColumn("_rank", rank)
        .withColumn("_previous", F.lag("type").over(by_time))
        .withColumn("_ends_before", F.coalesce(
            F.sum(ends.cast("int")).over(by_time.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(
            "issuingCardId", "cardType", "type", "issuingHolderId", "subIssuerTaxId",
            F.when(ends, F.add_months(start, 3)).otherwise(start).alias("quarter"),
            delta.cast("long").alias("delta"),
            F.row_number().over(by_time).alias("eventNumber"),
        )
    )


def with_issuer_name(deltas: DataFrame, sub_issuers: DataFrame) -> DataFrame:
    return join_splittable(deltas, issuer_names(sub_issuers), ["subIssuerTaxId"])


def holder_activity(deltas: DataFrame) -> DataFrame:
    """Sum of the deltas per holder, issuer and quarter."""
    return deltas.groupBy("issuingHolderId", "subIssuerTaxId", "quarter").agg(F.sum("delta").alias("delta"))


def holder_balance(activity: DataFrame) -> DataFrame:
    """Running number of active cards, one row per holder and quarter.

    A holder with several issuers in a quarter keeps the row of the greatest issuer id,
    whose running sum covers the whole quarter.
    """
    ordered = Window.partitionBy("issuingHolderId").orderBy("quarter", "subIssuerTaxId")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.lead("quarter").over(ordered)
    return (
        activity.withColumn("balance", F.sum("delta").over(running))
        .withColumn("_following", following)
        .filter("_following is null or _following <> quarter")
        .select("issuingHolderId", "subIssuerTaxId", "quarter", "balance")
    )


def intervals(df: DataFrame, keys: Sequence[str], date: str, values: Sequence[str]) -> DataFrame:
    """Each row with the values carried forward over NULLs and the date of the next row."""
    ordered = Window.partitionBy(*keys).orderBy(date)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = [F.last(v, ignorenulls=True).over(running).alias(v) for v in values]
    return df.select(*keys, date, *filled, F.lead(date).over(ordered).alias("nextDate"))


def densify_fill(df: DataFrame, keys: Sequence[str], date: str, values: Sequence[str], last: Column) -> DataFrame:
    """One row per key and quarter up to ``last``, the values carried forward.

    ``df`` has one row per key and quarter. Every row is repeated up to the quarter before
    the next one, so there is no grid to join: a key starts at its first quarter.
    """
    until = F.coalesce(F.add_months("nextDate", -3), last)
    return (
        intervals(df, keys, date, values)
        .withColumn(date, F.explode(date_range(F.col(date), until, "3 month")))
        .drop("nextDate")
    )


def holder_steps(balance: DataFrame) -> DataFrame:
    """Starts (1) and ends (-1) of holders' activity by issuer and quarter, 0 for rows that change nothing.

    A holder counts from the quarter of a positive balance to its next row.
    """
    counted = (F.col("balance") > 0) & F.col("issuingHolderId").isNotNull()
    return (
        intervals(balance, ["issuingHolderId"], "quarter", ["subIssuerTaxId", "balance"])
        .withColumn("_on", F.coalesce(counted, F.lit(False)).cast("int"))
        .select("subIssuerTaxId", F.explode(F.array(
            F.struct(F.col("quarter").alias("quarter"), F.col("_on").alias("step")),
            F.struct(F.col("nextDate").alias("quarter"), (-F.col("_on")).alias("step")),
        )).alias("s"))
        .select("subIssuerTaxId", "s.*")
        .filter("quarter is not null")
    )


def counts_of(steps: DataFrame) -> DataFrame:
    """Active holders per issuer and quarter from the sums of their steps."""
    running = Window.partitionBy("subIssuerTaxId").orderBy("quarter").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    counts = steps.select("subIssuerTaxId", "quarter", F.sum("step").over(running).alias("holders"))
    # The step is taken along so that both readers of the steps need the same columns and
    # share one exchange.
    last = steps.agg(F.max(F.struct("quarter", "step"))["quarter"].alias("last")).scalar()
    return densify_fill(counts, ["subIssuerTaxId"], "quarter", ["holders"], last)


def holder_counts(balance: DataFrame) -> DataFrame:
    """Holders with at least one active card per issuer and quarter, zeros included.

    The starts and ends of activity are summed per issuer and quarter, and the running sum is the count,
    so the holders are never repeated for each quarter. Steps of 0 keep the quarters in which
    nobody starts, so that the last quarter of all is that of the small table of steps.
    """
    return counts_of(holder_steps(balance).groupBy("subIssuerTaxId", "quarter").agg(F.sum("step").alias("step")))


def active_holders(balance: DataFrame) -> DataFrame:
    """Issuers and quarters with active holders, and their number."""
    return holder_counts(balance).filter("holders > 0")


def active_holders_report(log: DataFrame, sub_issuers: DataFrame, end: dt.date,
                          zero_when_empty: bool = False) -> DataFrame:
    """Active holders per issuer and quarter from the first quarter an issuer has any.

    A quarter without active holders repeats the last count, or shows 0 with
    ``zero_when_empty``.
    """
    balance = holder_balance(holder_activity(activity_delta(card_events(log, end))))
    return report_of(holder_counts(balance), sub_issuers, zero_when_empty)


def report_of(counts: DataFrame, sub_issuers: DataFrame, zero_when_empty: bool = False) -> DataFrame:
    """The report of ``active_holders_report`` from the counts of holders."""
    so_far = Window.partitionBy("subIssuerTaxId").orderBy("quarter").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    last_count = F.last(F.when(F.col("holders") > 0, F.col("holders")), ignorenulls=True).over(so_far)
    shown = F.col("holders") if zero_when_empty else F.col("_last_count")
    return (
        counts
        .withColumn("_last_count", last_count)
        .filter("_last_count is not null")
        .withColumn("holders", shown)
        .join(issuer_names(sub_issuers), "subIssuerTaxId")
        .select("quarter", "subIssuerTaxId", "subIssuerName", "holders")
    )


def _running_delta() -> Column:
    running = Window.partitionBy("issuingCardId").orderBy("quarter", "eventNumber").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return F.sum("delta").over(running)


def card_balance_listing(deltas: DataFrame, issuer_name: str, since: dt.date) -> DataFrame:
    """Running balance per card of one issuer; rows other than 0 from ``since`` on."""
    return (
        deltas.filter(F.col("subIssuerName") == issuer_name)
        .withColumn("balance", _running_delta())
        .filter((F.col("balance") != 0) & (F.col("quarter") >= F.lit(since)))
        .select("issuingCardId", "subIssuerName", "quarter", "balance")
    )


def partner_list_check(deltas: DataFrame, partner: DataFrame, status: DataFrame,
                       issuer_name: str, quarter: dt.date, origin: str = "partner") -> DataFrame:
    """Cards of the partner list whose events of one quarter leave no positive balance."""
    own = (
        deltas.filter((F.col("subIssuerName") == issuer_name) & (F.col("quarter") == F.lit(quarter)))
        .withColumn("balance", _running_delta())
        .filter("balance <= 0")
        .select("issuingCardId", "subIssuerName", "quarter", "balance")
    )
    listed = join_splittable(partner.withColumn("origin", F.lit(origin)), own, ["issuingCardId"], "inner")
    return join_splittable(listed, status.select("issuingCardId", "status"), ["issuingCardId"])
