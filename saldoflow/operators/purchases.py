"""Purchase remuneration: reversals attributed to confirmation cycles.

A purchase id may hold any share of the log, so nothing here sorts the log rows of an id.
What is kept per id is one entry per day, and the date range bounds the number of days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..params import RemunerationParams
from .calendars import date_range
from .dims import dedupe_dim
from .joins import join_splittable
from .ordered import running_sliced


def confirmed() -> Column:
    return F.col("type") == "confirmed"


def reversed_() -> Column:
    return F.col("type") == "reversed"


def purchase_log(log: DataFrame, cards: DataFrame, params: RemunerationParams) -> DataFrame:
    """Confirmed and reversed rows of the wanted purpose, currency and issuer in the range.

    The log starts ``settlement_days`` early. Dates are compared on the bare timestamp so
    that the range reaches the scan. An issuer condition drops cards without issuer.
    """
    day = dt.timedelta(days=1)
    rows = log.filter(
        F.col("type").isin("confirmed", "reversed")
        & (F.col("purpose") == params.purpose)
        & (F.col("merchantCurrencyCode") == params.currency)
        & (F.col("logCreated") >= F.lit(params.log_start))
        & (F.col("logCreated") < F.lit(params.end + day))
    ).select(
        "endToEndId",
        "issuingPurchaseLogId",
        "issuingCardId",
        F.col("logCreated").alias("logTime"),
        F.to_date("logCreated").alias("logDate"),
        "type",
        "logAmount",
        F.to_date("purchaseConfirmed").alias("purchaseConfirmed"),
        F.col("purchaseConfirmed").alias("confirmedTime"),
    )
    owners = cards.select("issuingCardId", "subIssuerTaxId")
    how = "left"
    if params.issuer is not None:
        owners, how = owners.filter(F.col("subIssuerTaxId") == params.issuer), "inner"
    if params.exclude_issuer is not None:
        owners, how = owners.filter(F.col("subIssuerTaxId") != params.exclude_issuer), "inner"
    return rows.join(owners, "issuingCardId", how).drop("issuingCardId")


def cycle_id(purchase: str, date: str) -> Column:
    """Surrogate key of a cycle; NULL without a cycle date."""
    return F.concat(F.col(purchase), F.col(date).cast("string"))


def cycle_dates(log: DataFrame, params: RemunerationParams) -> DataFrame:
    """One row per cycle, that is per purchase and confirmation day, with its dates."""
    return (
        log.filter(confirmed() & F.col("endToEndId").isNotNull())
        .groupBy("endToEndId", F.col("logDate").alias("confirmationDate"))
        .agg(F.min("logTime").alias("firstConfirmed"), F.sum("logAmount").alias("confirmedAmount"))
        .withColumn("dueDate", F.date_add("confirmationDate", params.due_days))
        .withColumn("settlementDate", F.date_add("confirmationDate", params.settlement_days))
    )


def reversal_cycles(log: DataFrame, cycles: DataFrame) -> DataFrame:
    """Reversals with ``cycleDate``: the day of the last confirmation at or before them.

    The first confirmation of each day decides which days precede a reversal, so an id
    needs one entry per day. The entries hold all measures of ``cycles``, needed or not, so
    that a plan which also uses ``cycles`` itself aggregates the confirmations once and
    reuses that exchange.
    """
    entry = F.struct("firstConfirmed", "confirmedAmount")
    starts = (
        cycles.groupBy("endToEndId").agg(F.collect_list(entry).alias("_entries"))
        .select("endToEndId", F.col("_entries.firstConfirmed").alias("_starts"))
    )
    past = F.filter("_starts", lambda t: t <= F.col("logTime"))
    return (
        join_splittable(log.filter(reversed_()), starts, ["endToEndId"])
        .withColumn("cycleDate", F.to_date(F.array_max(past)))
        .drop("_starts")
    )


def attribute_cycle(log: DataFrame, params: RemunerationParams) -> DataFrame:
    """Every log row with the date and the id of its cycle (NULL before any confirmation)."""
    starts = log.filter(confirmed()).withColumn("cycleDate", F.col("logDate"))
    reversals = reversal_cycles(log, cycle_dates(log, params))
    return starts.unionByName(reversals).withColumn("internalId", cycle_id("endToEndId", "cycleDate"))


def classify_reversals(reversals: DataFrame, params: RemunerationParams) -> DataFrame:
    """``beforeSettlement``: reversed strictly before the settlement date of the cycle.

    A cycle date always has a confirmation, so the settlement date follows from it.
    """
    before = F.col("logDate") < F.date_add("cycleDate", params.settlement_days)
    return reversals.withColumn("beforeSettlement", F.coalesce(before, F.lit(False)))


def cycle_amounts(log: DataFrame, params: RemunerationParams) -> DataFrame:
    """Confirmed and reversed amounts per cycle; NULL where a cycle has no such row."""
    cycles = cycle_dates(log, params)
    before = F.col("beforeSettlement")
    sums = (
        classify_reversals(reversal_cycles(log, cycles), params)
        .filter("cycleDate is not null")
        .groupBy("endToEndId", F.col("cycleDate").alias("confirmationDate"))
        .agg(
            F.sum(F.when(before, F.col("logAmount"))).alias("reversedBeforeSettlement"),
            F.sum(F.when(~before, F.col("logAmount"))).alias("reversedAfterSettlement"),
        )
    )
    return cycles.join(sums, ["endToEndId", "confirmationDate"], "left").select(
        cycle_id("endToEndId", "confirmationDate").alias("internalId"),
        "endToEndId",
        "confirmationDate",
        "firstConfirmed",
        "dueDate",
        "settlementDate",
        "confirmedAmount",
        "reversedBeforeSettlement",
        "reversedAfterSettlement",
    )


def share_of_return(amount: Column, accumulated: Column, share: float) -> Column:
    """Part of the interest on ``amount``, not rounded; 0 when either is missing."""
    return F.coalesce(amount * accumulated - amount, F.lit(0.0)) * share


def whole_cents(value: Column) -> Column:
    """Half away from zero to an integer."""
    return F.round(value).cast("long")


def with_remuneration(amounts: DataFrame, returns: DataFrame, params: RemunerationParams) -> DataFrame:
    """Cycle amounts with the return at settlement and the remuneration."""
    net = F.col("confirmedAmount") - F.coalesce("reversedBeforeSettlement", F.lit(0))
    paid = whole_cents(share_of_return(F.col("netAmount"), F.col("accumulatedReturn"), params.share))
    series = returns.select(F.col("referenceDate").alias("settlementDate"), "accumulatedReturn")
    return (
        # one row per calendar day
        amounts.join(F.broadcast(series), "settlementDate", "left")
        .withColumn("netAmount", net)
        .withColumn("remuneration", paid)
        .withColumn("nonNegativeRemuneration", F.greatest("remuneration", F.lit(0)))
    )


def cycle_remuneration(log: DataFrame, cards: DataFrame, returns: DataFrame,
                       params: RemunerationParams, attribution: str = "last_confirmation") -> DataFrame:
    """Remuneration of every purchase cycle.

    ``attribution="previous_row"`` is the older rule, see ``previous_row_amounts``.
    """
    rows = purchase_log(log, cards, params)
    amounts = cycle_amounts(rows, params) if attribution == "last_confirmation" else previous_row_amounts(rows, params)
    return with_remuneration(amounts, returns, params)


def previous_row_amounts(log: DataFrame, params: RemunerationParams) -> DataFrame:
    """Amounts per (purchase, day) where a reversal belongs to the day of the row before it.

    The day is the purchase confirmation if given, else the log date. Rows of a day follow
    each other, so only the first row of a day can belong to an earlier one; the previous
    day then receives it through ``lead``. Whether it counts as before settlement depends
    on that day against the settlement of the first confirmation of the purchase.
    """
    amount = F.col("logAmount")
    entry = F.struct("logTime", "issuingPurchaseLogId", "type", "logAmount")
    first_confirmed = F.struct("logTime", "issuingPurchaseLogId", "cycleDate", "purchaseConfirmed")
    days = (
        log.filter(F.col("endToEndId").isNotNull())
        .withColumn("cycleDate", F.coalesce("purchaseConfirmed", "logDate"))
        .groupBy("endToEndId", "cycleDate")
        .agg(
            F.sum(F.when(confirmed(), amount)).alias("confirmedAmount"),
            F.sum(F.when(reversed_(), amount)).alias("_reversed"),
            F.count(F.when(reversed_(), amount)).alias("_n"),
            F.min(entry).alias("_first"),
            # the first confirmation of the purchase, by log time
            F.min(F.when(confirmed(), first_confirmed)).alias("_confirmed"),
        )
    )
    whole = Window.partitionBy("endToEndId")
    ordered = whole.orderBy("cycleDate")
    moved = F.when(F.col("_first.type") == "reversed", F.col("_first.logAmount"))
    stays = F.when(
        F.col("_n") > F.when(F.col("_moved").isNull(), 0).otherwise(1),
        F.col("_reversed") - F.coalesce("_moved", F.lit(0)),
    )
    received = F.lead("_moved").over(ordered)
    total = F.when(
        F.col("_stays").isNotNull() | F.col("_received").isNotNull(),
        F.coalesce("_stays", F.lit(0)) + F.coalesce("_received", F.lit(0)),
    )
    settlement = F.date_add("_confirmed.cycleDate", params.settlement_days)
    before = F.coalesce(F.col("cycleDate") < settlement, F.lit(False))
    is_first = F.col("cycleDate") == F.col("_confirmed.cycleDate")
    return (
        days.withColumn("_moved", moved)
        .withColumn("_stays", stays)
        .withColumn("_received", received)
        .withColumn("_total", total)
        .withColumn("_confirmed", F.min("_confirmed").over(whole))
        .select(
            "endToEndId",
            "cycleDate",
            F.when(is_first, F.col("_confirmed.purchaseConfirmed")).alias("confirmationDate"),
            F.when(is_first, F.date_add("cycleDate", params.due_days)).alias("dueDate"),
            F.when(is_first, settlement).alias("settlementDate"),
            "confirmedAmount",
            F.when(before, F.col("_total")).alias("reversedBeforeSettlement"),
            F.when(~before, F.col("_total")).alias("reversedAfterSettlement"),
        )
    )


def issuer_daily_remuneration(log: DataFrame, returns: DataFrame, sub_issuers: DataFrame,
                              params: RemunerationParams, settled_inclusive: bool = True,
                              compare: str = "instant") -> DataFrame:
    """Totals per date and issuer on a full date grid.

    Confirmed amounts and reversals up to settlement count on the due date of the first
    confirmation of the purchase, later reversals on their own date. ``returns`` is keyed
    by due date. A reversal is compared with the first confirmation, as its ``purchaseConfirmed``
    states it, and with its settlement: as an ``instant``, or as a ``day``. ``settled_inclusive`` says
    whether a reversal at the settlement itself is still before it.
    """
    if compare not in ("instant", "day"):
        raise ValueError(f"compare is instant or day, not {compare}")
    time, confirmed_time, when = (
        ("logTime", "confirmedTime", "logTime") if compare == "instant" else ("logDate", "purchaseConfirmed", "logDate"))
    first = log.filter(confirmed() & F.col("endToEndId").isNotNull()).groupBy("endToEndId").agg(
        F.min(F.struct("logTime", "issuingPurchaseLogId", "logDate", "purchaseConfirmed", "confirmedTime")).alias("_first"))
    known = join_splittable(log, first, ["endToEndId"])
    settled = F.date_add(f"_first.{when}", params.settlement_days) if compare == "day" else (
        F.col(f"_first.{when}") + F.make_dt_interval(days=F.lit(params.settlement_days)))
    due = F.date_add("_first.logDate", params.due_days)
    late = F.col(time) > settled if settled_inclusive else F.col(time) >= settled
    early = ~late & (F.col(time) >= F.col(f"_first.{confirmed_time}"))
    amount = F.col("logAmount")

    def flow(date: Column, confirmed: Column, early_: Column, late_: Column) -> Column:
        return F.struct(date.alias("referenceDate"), confirmed.alias("confirmed"),
                        early_.alias("reversedBefore"), late_.alias("reversedAfter"))

    none = F.lit(None).cast("long")
    flows = (
        known.select("subIssuerTaxId", F.explode(F.array(
            flow(due, F.when(confirmed(), amount), F.when(reversed_() & early, amount), none),
            flow(F.col("logDate"), none, none, F.when(reversed_() & late, amount)),
            # every issuer has a row on the first date
            flow(F.lit(params.start), none, none, none),
        )).alias("f"))
        .select("subIssuerTaxId", "f.*")
        .filter(F.col("referenceDate").between(F.lit(params.start), F.lit(params.end)))
        .groupBy("referenceDate", "subIssuerTaxId")
        .agg(F.sum("confirmed").alias("confirmed"), F.sum("reversedBefore").alias("reversedBefore"),
             F.sum("reversedAfter").alias("reversedAfter"))
    )
    # Each row is repeated up to the day before the next row of its issuer, without amounts.
    following = F.lead("referenceDate").over(Window.partitionBy("subIssuerTaxId").orderBy("referenceDate"))
    until = F.coalesce(F.date_sub(following, 1), F.lit(params.end))
    amounts = ["confirmed", "reversedBefore", "reversedAfter"]
    grid = (
        flows.withColumn("_until", until)
        .withColumn("_day", F.explode(date_range(F.col("referenceDate"), F.col("_until"))))
        .select("subIssuerTaxId", F.col("_day").alias("referenceDate"),
                *[F.when(F.col("_day") == F.col("referenceDate"), F.col(c)).alias(c) for c in amounts])
    )
    names = dedupe_dim(sub_issuers.select("subIssuerTaxId", "subIssuerName"), "subIssuerTaxId", [F.col("subIssuerName")])
    zero = F.lit(0)
    gain = F.col("accumulatedReturn")
    confirmed_share = share_of_return(F.col("confirmed"), gain, params.share)
    reversed_share = share_of_return(F.col("reversedBefore"), gain, params.share)
    both = (F.coalesce(F.col("confirmed") * gain - F.col("confirmed"), F.lit(0.0))
            - F.coalesce(F.col("reversedBefore") * gain - F.col("reversedBefore"), F.lit(0.0))) * params.share
    return (
        grid.join(names, "subIssuerTaxId")
        # one row per calendar day
        .join(F.broadcast(returns), "referenceDate", "left")
        .select(
            "referenceDate",
            "subIssuerTaxId",
            "subIssuerName",
            "accumulatedReturn",
            "indexValue",
            "isForecast",
            (F.coalesce("confirmed", zero) - F.coalesce("reversedBefore", zero)).alias("baseValue"),
            whole_cents(both).alias("remuneration"),
            F.coalesce("confirmed", zero).alias("confirmed"),
            F.coalesce("reversedBefore", zero).alias("reversedBeforeSettlement"),
            F.coalesce("reversedAfter", zero).alias("reversedAfterSettlement"),
            whole_cents(confirmed_share).alias("remunerationConfirmed"),
            whole_cents(reversed_share).alias("remunerationReversedBeforeSettlement"),
        )
    )


def previous_event_lookup(log: DataFrame) -> DataFrame:
    """Reversals with the id, type, date and time of the last non-reversal row at or before them.

    Rows of one instant: confirmations come first. ``rowNumber`` counts the reversals of
    the purchase. The log is cut into slices and stored when this is called.
    """
    ranked = log.withColumn("_rank", F.when(reversed_(), 1).otherwise(0))
    other = F.when(~reversed_(), F.struct("issuingPurchaseLogId", "type", "logDate", "logTime"))
    # a bulk load may give one instant to all rows of a purchase, and any ids
    looked_up = running_sliced(
        ranked, ["endToEndId"], ["logTime", "_rank", "issuingPurchaseLogId"],
        last={"_previous": other}, total={"rowNumber": reversed_().cast("long")},
    )
    return looked_up.filter(reversed_()).select(
        "endToEndId",
        "issuingPurchaseLogId",
        "rowNumber",
        "type",
        F.coalesce("purchaseConfirmed", "logDate").alias("logDate"),
        "purchaseConfirmed",
        F.col("_previous.issuingPurchaseLogId").alias("previousLogId"),
        F.col("_previous.type").alias("previousType"),
        F.col("_previous.logDate").alias("previousDate"),
        F.col("_previous.logTime").alias("previousTime"),
    )

