"""Reconciliation of the own card list with the list of a partner.

Everything about the own cards is reduced to one row per card before it meets the partner
list, and a list is made distinct before it is joined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.storage import stored
from . import digest_tree
from .dims import dedupe_dim, first_per_key
from .joins import join_splittable
from .ordered import running

UNKNOWN_BALANCE = -1000


def card_collection(deltas: DataFrame) -> DataFrame:
    """Distinct cards with issuer name and type."""
    return deltas.select("issuingCardId", "subIssuerName", "cardType").distinct()


def _with_peak(deltas: DataFrame, cutoff: dt.date) -> DataFrame:
    """Running sum per card, largest deltas first, over the quarters up to the cut-off."""
    counted = F.when(F.col("quarter") <= F.lit(cutoff), F.col("delta"))
    largest_first = Window.partitionBy("issuingCardId").orderBy(
        F.desc_nulls_last("_counted"), "quarter", "eventNumber"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return deltas.withColumn("_counted", counted).withColumn(
        "balance", F.when(F.col("_counted").isNotNull(), F.sum("_counted").over(largest_first)))


def peak_balance(deltas: DataFrame, cutoff: dt.date) -> DataFrame:
    """Highest running sum per card and quarter up to the cut-off."""
    return (
        _with_peak(deltas, cutoff).filter("balance is not null")
        .groupBy("issuingCardId", "quarter").agg(F.max("balance").alias("balance"))
    )


def balance_at_quarter(deltas: DataFrame, cutoff: dt.date) -> DataFrame:
    """Balance at the cut-off quarter of every card, type and issuer name.

    The value is that of the last quarter with an event; NULL if all events are later.
    """
    if cutoff.day != 1 or cutoff.month % 3 != 1:
        raise ValueError("cutoff must be the first day of a quarter")
    latest = F.when(F.col("balance").isNotNull(), F.struct("quarter", "balance"))
    return (
        _with_peak(deltas, cutoff)
        .groupBy("issuingCardId")
        .agg(
            # at most four events per card
            F.collect_set(F.struct("subIssuerName", "cardType")).alias("_kinds"),
            F.max(latest)["balance"].alias("balance"),
        )
        .select("issuingCardId", F.explode("_kinds").alias("_kind"), F.lit(cutoff).alias("quarter"), "balance")
        .select("issuingCardId", "_kind.*", "quarter", "balance")
    )


def card_status(cards: DataFrame) -> DataFrame:
    """Status per card from the raw card table, of its earliest row."""
    rows = cards.select(F.col("__key__.id").cast("string").alias("issuingCardId"), "status", "created")
    return dedupe_dim(rows, "issuingCardId", [F.col("created"), F.col("status")]).select("issuingCardId", "status")


def tag_source(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("origin", F.lit(name))


def compare(balances: DataFrame, partner: DataFrame, status: DataFrame, origin: str = "partner",
            unknown: str = "drop") -> DataFrame:
    """Own balances against the partner list, one row per card with its ``outcome``.

    ``matched``: in the list and active here; ``only_partner``: in the list and not active
    here; ``only_own``: active here and not in the list (no origin). A listed card unknown
    here is left out, or with ``unknown="flag"`` shown as ``only_partner`` with balance
    -1000. One full join answers all of them, so the balances are computed once.
    """
    return _outcomes(_own_cards(balances), partner, status, origin, unknown)


def _own_cards(balances: DataFrame) -> DataFrame:
    """One row per card with a balance."""
    return first_per_key(balances.filter("balance is not null"), ["issuingCardId"],
                         [F.col("cardType"), F.col("subIssuerName")]).select("issuingCardId", "balance", "cardType")


def _outcomes(own: DataFrame, partner: DataFrame, status: DataFrame, origin: str, unknown: str) -> DataFrame:
    listed = tag_source(partner.select("issuingCardId").filter("issuingCardId is not null").distinct(), origin)
    balance, is_listed = F.col("balance"), F.col("origin").isNotNull()
    outcome = (
        F.when(is_listed & (balance > 0), "matched")
        .when(is_listed & (balance <= 0), "only_partner")
        .when(~is_listed & (balance > 0), "only_own")
    )
    both = own.join(listed, "issuingCardId", "full")
    if unknown == "flag":
        both = both.withColumn("balance", F.coalesce("balance", F.lit(UNKNOWN_BALANCE)))
    return (
        both.withColumn("outcome", outcome).filter("outcome is not null")
        .join(status, "issuingCardId", "left")
        .select("issuingCardId", "origin", "balance", "cardType", "status", "outcome")
    )


def outcome(compared: DataFrame, *names: str) -> DataFrame:
    """Cards with one of the given outcomes."""
    return compared.filter(F.col("outcome").isin(*names)).drop("outcome")


def divergences(compared: DataFrame) -> DataFrame:
    """Cards that one side holds active and the other does not."""
    return outcome(compared, "only_partner", "only_own")


def divergences_by_tree(balances: DataFrame, partner: DataFrame, status: DataFrame, origin: str = "partner",
                        unknown: str = "drop", leaf_rows: int = digest_tree.LEAF_ROWS) -> DataFrame:
    """The same rows as ``divergences(compare(...))``, for lists that agree on most cards.

    Digest trees of the cards active here and of the list tell where they differ, and only cards
    of those leaves are joined. A card active here and listed diverges in nothing, so its leaf only
    counts if another card of it does. Where the lists agree on little, all cards are joined as ever.
    """
    own = stored(_own_cards(balances))
    suspect = digest_tree.suspects(own.filter("balance > 0"), partner, "issuingCardId", leaf_rows)
    near = [suspect.of(side, "issuingCardId") for side in (own, partner, status)]
    return divergences(_outcomes(*near, origin, unknown))


def event_history(divergent: DataFrame, log: DataFrame, side: str, origin: str = "partner") -> DataFrame:
    """Divergent cards of one side with all their log rows, in time order.

    ``side`` is "partner" (origin given, balance <= 0) or "own" (no origin). One row per card, instant
    and type: ``position`` counts the card's log rows before it, ``copies`` the equal ones it
    stands for, so no row grows with the log. A card without log gets one row, 1900-01-01 and
    "NULL". ``divergent`` is read more than once and should be a stored result.
    """
    wanted = (
        divergent.filter((F.col("balance") <= 0) & (F.col("origin") == origin)) if side == "partner"
        else divergent.filter(F.col("origin").isNull())
    )
    card = wanted.columns
    missing_date, missing_type = F.lit(dt.date(1900, 1, 1)), F.lit("NULL")
    events = log.select("issuingCardId", F.col("logCreated").cast("timestamp_ntz").alias("_at"), F.col("type").alias("_type"))
    # The card's columns travel with the events: a second join would meet the hot cards again.
    counted = (
        join_splittable(events, wanted, ["issuingCardId"], "inner")
        .groupBy(*card, "_at", "_type").agg(F.count(F.lit(1)).alias("copies"))
    )
    placed = running(counted, ["issuingCardId"], "_at", ["_at", "_type"], total={"_end": F.col("copies")})
    with_log = placed.select(
        *card, (F.col("_end") - F.col("copies")).alias("position"),
        F.coalesce(F.to_date("_at"), missing_date).alias("eventDate"),
        F.coalesce("_type", missing_type).alias("event"), "copies")
    # With the number in use the plan is the one above, so its shuffle is read again and not the log.
    seen = counted.groupBy("issuingCardId").agg(F.sum("copies").alias("_n")).filter("_n > 0")
    without_log = wanted.join(seen, "issuingCardId", "left_anti").select(
        *card, F.lit(0).cast("long").alias("position"), missing_date.alias("eventDate"),
        missing_type.alias("event"), F.lit(1).cast("long").alias("copies"))
    return with_log.unionByName(without_log)


def history_arrays(history: DataFrame, page_size: int | None = None) -> DataFrame:
    """The history as one row per card with arrays ``eventDates`` and ``events``, equal rows repeated.

    A card's arrays must fit a task. With ``page_size`` a card has a row for each ``page`` of so many
    entries instead, which bounds them.
    """
    card = [c for c in history.columns if c not in ("position", "eventDate", "event", "copies")]
    start, end = F.col("position"), F.col("position") + F.col("copies")
    keys, n = [*card], F.col("copies")
    if page_size is not None:
        history = history.withColumn("page", F.explode(F.sequence(
            F.floor(start / page_size), F.floor((end - 1) / page_size))))
        first = F.col("page") * page_size
        keys, n = [*card, "page"], F.least(end, first + page_size) - F.greatest(start, first)
    entry = F.struct("position", F.col("eventDate").alias("d"), F.col("event").alias("t"), n.cast("int").alias("n"))

    def repeated(field: str) -> Column:
        return F.flatten(F.transform("_entries", lambda e: F.array_repeat(e[field], e["n"])))

    return (
        history.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        .select(*keys, repeated("d").alias("eventDates"), repeated("t").alias("events"))
    )


def explode_history(history: DataFrame, pairing: str = "cross",
                    report: tuple[str, ...] = ("canceled",)) -> DataFrame:
    """First date of each reported event of the cards in ``event_history``.

    ``cross`` pairs every event with every date, so that the first date of an event is the
    first of the card; no pairs are made. ``zip`` takes the dates of the event itself. Creation says
    nothing about a physical card and unblocking nothing about a virtual one, so these are left out.
    """
    card = ["issuingCardId", "origin", "balance", "cardType", "status"]

    def first_date(event: str) -> Column:
        has = F.col("event") == event
        if pairing == "zip":
            return F.min(F.when(has, F.col("eventDate")))
        return F.when(F.max(has), F.min("eventDate"))

    reported = F.array(*[F.struct(F.lit(e).alias("event"), first_date(e).alias("eventDate")) for e in report])
    idle = ((F.col("cardType") == "physical") & (F.col("event") == "created")) | (
        (F.col("cardType") == "virtual") & (F.col("event") == "unblocked"))
    return (
        history.groupBy(*card).agg(reported.alias("_e")).select(*card, F.inline("_e"))
        .filter(F.col("eventDate").isNotNull() & ~F.coalesce(idle, F.lit(False)))
    )


def resolve_holder(cards: DataFrame, log: DataFrame) -> DataFrame:
    """Holder of each card of a list; of several, the smallest id."""
    holders = log.groupBy("issuingCardId").agg(F.min("issuingHolderId").alias("issuingHolderId"))
    return join_splittable(cards.select("issuingCardId"), holders, ["issuingCardId"])
