"""Daily positions to receive from the acquirer and to pay to merchants."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import SAO_PAULO, local_date, local_date_between
from ..params import ReceivablesParams
from .calendars import business_day_adjust, date_range
from .dims import dedupe_dim
from ..sources.storage import stored
from .joins import join_splittable, key_filter, perhaps_in

DIMENSIONS = ["referenceDate", "network", "installmentStatus", "workspaceId"]


def key_id() -> Column:
    return F.col("__key__.id").cast("string")


def nominal_due(log: DataFrame, tz: str = SAO_PAULO) -> DataFrame:
    """Local due and creation dates from the "created" rows of the installment log."""
    return log.filter(F.col("type") == "created").select(
        "installmentId",
        local_date(F.col("installment.due"), tz).alias("nominalDue"),
        local_date(F.col("installment.created"), tz).alias("installmentCreated"),
    )


def acquirer_days(funding: Column, params: ReceivablesParams) -> Column:
    """Days from creation until the acquirer pays, by funding type."""
    days = F.lit(params.default_acquirer_days)
    for name, n in params.acquirer_days:
        days = F.when(funding == name, n).otherwise(days)
    return days


def _purchases(purchases: DataFrame) -> DataFrame:
    return purchases.select(
        key_id().alias("purchaseId"), "endToEndId", "fundingType", F.col("status").alias("purchaseStatus"))


def with_acquirer_due(installments: DataFrame, dues: DataFrame, next_days: DataFrame,
                      params: ReceivablesParams) -> DataFrame:
    """Adds nominal due, creation and acquirer due (on a business day) to installments that
    carry ``installmentId`` and ``fundingType``."""
    due = F.date_add("installmentCreated", acquirer_days(F.col("fundingType"), params))
    dated = installments.join(dues, "installmentId", "left").withColumn("dueFromAcquirer", due)
    return business_day_adjust(dated, "dueFromAcquirer", next_days)


def acquirer_due(installments: DataFrame, purchases: DataFrame, dues: DataFrame, next_days: DataFrame,
                 params: ReceivablesParams) -> DataFrame:
    """Nominal due, creation and acquirer due per installment."""
    rows = installments.select(key_id().alias("installmentId"), "purchaseId").join(
        _purchases(purchases), "purchaseId", "left")
    return with_acquirer_due(rows, dues, next_days, params).select(
        "installmentId", "nominalDue", "installmentCreated", "dueFromAcquirer")


def workspace_dim(workspaces: DataFrame) -> DataFrame:
    """Latest row per workspace."""
    return dedupe_dim(workspaces, "workspaceId", [
        F.desc("workspaceCreated"), F.col("companyTaxId"), F.col("companyName"),
    ]).select("workspaceId", "companyTaxId", "companyName")


def tag_flag(tags: Column, marker: str) -> Column:
    """Whether any tag contains the marker; False for a missing list or tag."""
    return F.coalesce(F.exists(tags, lambda t: F.coalesce(t.contains(marker), F.lit(False))), F.lit(False))


def created_on(days: Sequence[dt.date], tz: str) -> Column:
    """``local_date(created)`` among ``days``, as ranges on the bare column, one per run of days."""
    ordered = sorted(days)
    runs: list[list[dt.date]] = []
    for day in ordered:
        if runs and day <= runs[-1][1] + dt.timedelta(days=1):
            runs[-1][1] = day
        else:
            runs.append([day, day])
    return reduce(lambda a, b: a | b, [local_date_between("created", a, b, tz) for a, b in runs], F.lit(False))


def of_units(installments: DataFrame, units: DataFrame, params: ReceivablesParams) -> DataFrame:
    """Installments of the creation days and workspaces of ``units`` (``createdDate``, ``workspaceId``)."""
    dated = installments.withColumn("createdDate", local_date("created", params.tz))
    return dated.join(units, ["createdDate", "workspaceId"], "left_semi").select(*installments.columns)


def only_needed(installments: DataFrame, installment_log: DataFrame, purchases: DataFrame, acquiring_purchases: DataFrame,
                params: ReceivablesParams) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The log and both purchase tables without most rows that the window's installments don't meet.

    Filters of the installments' keys are tried before the shuffles of the joins, which decide. Rows
    of the window are read once for their keys alone, and so are their purchases.
    """
    keys = stored(installments.filter(local_date_between("created", params.start, params.end, params.tz)).select(
        key_id().alias("installmentId"), "purchaseId"))
    log = perhaps_in(installment_log, "installmentId", key_filter(keys, "installmentId"))
    named = perhaps_in(purchases.withColumn("_id", key_id()), "_id", key_filter(keys.select("purchaseId").distinct(), "purchaseId")).drop("_id")
    ends = stored(named.select("endToEndId").distinct())
    return log, named, perhaps_in(acquiring_purchases, "endToEndId", key_filter(ends, "endToEndId"))


def needed_fees(acquiring_installments: DataFrame, acquiring_purchases: DataFrame) -> DataFrame:
    """The acquirer's installments without most of those that ``acquiring_purchases`` (of ``only_needed``) doesn't have."""
    ids = stored(acquiring_purchases.select(F.col("id").cast("string").alias("id")).distinct())
    return perhaps_in(acquiring_installments, "purchaseId", key_filter(ids, "id"), below=True)


def window_rows(installments: DataFrame, params: ReceivablesParams) -> DataFrame:
    """The window's installments with the columns of the fact, stored: their keys are read once more than they are."""
    return stored(installments.filter(local_date_between("created", params.start, params.end, params.tz)).select(
        "__key__", "purchaseId", "created", "due", "network", "workspaceId", "status", "amount", "fee", "tags"))


def installment_fact(installments: DataFrame, installment_log: DataFrame, purchases: DataFrame,
                     acquiring_purchases: DataFrame, acquiring_installments: DataFrame,
                     workspaces: DataFrame, next_days: DataFrame, params: ReceivablesParams) -> DataFrame:
    """One row per installment (and matching acquirer installment) created in the window,
    with every column the three rollups need."""
    rows = installments.filter(local_date_between("created", params.start, params.end, params.tz)).select(
        key_id().alias("installmentId"),
        "purchaseId",
        local_date("created", params.tz).alias("createdDate"),
        local_date("due", params.tz).alias("merchantDue"),
        "network",
        "workspaceId",
        F.col("status").alias("installmentStatus"),
        "amount",
        "fee",
        tag_flag(F.col("tags"), params.factoring_marker).alias("isFactoring"),
    )
    # The status of the acquiring purchase and the company must be known, so these joins
    # are inner ones, and the most selective of them comes first.
    companies = workspace_dim(workspaces).filter(~F.col("companyTaxId").isin(*params.excluded_companies)) \
        if params.excluded_companies else workspace_dim(workspaces).filter("companyTaxId is not null")
    settled = acquiring_purchases.filter(
        F.col("status").isin("confirmed", "voided") & ((F.col("amount") > 0) | (F.col("status") == "voided"))
    ).select(F.col("id").cast("string").alias("acquiringId"), "endToEndId")
    fees = acquiring_installments.select(
        F.col("purchaseId").alias("acquiringId"),
        local_date("due", params.tz).alias("nominalDue"),
        "externalFee",
    )
    return (
        with_acquirer_due(
            join_splittable(rows, companies.select("workspaceId"), ["workspaceId"], "left_semi")
            .join(_purchases(purchases), "purchaseId")
            .join(settled, "endToEndId"),
            nominal_due(installment_log, params.tz), next_days, params,
        )
        .join(fees, ["acquiringId", "nominalDue"], "left")
    )


def _unless_voided(amount: str) -> Column:
    return F.when(F.col("purchaseStatus") == "voided", 0).otherwise(F.col(amount))


def _missing_fees(suffix: str) -> list[Column]:
    """Amounts of installments whose own fee, the acquirer's fee, or both are unknown."""
    no_fee, no_external = F.col("fee").isNull(), F.col("externalFee").isNull()
    amount = F.col("amount")
    return [
        F.sum(F.when(no_fee & no_external, amount)).alias(f"amountWithoutFeeAndExternalFee{suffix}"),
        F.sum(F.when(no_fee & ~no_external, amount)).alias(f"amountWithoutFeeOnly{suffix}"),
        F.sum(F.when(~no_fee & no_external, amount)).alias(f"amountWithoutExternalFeeOnly{suffix}"),
    ]


def _created_measures() -> list[Column]:
    nothing = F.lit(None).cast("long")
    return [
        F.sum(_unless_voided("amount")).alias("amountCreated"),
        F.sum(_unless_voided("fee")).alias("feeCreated"),
        # not recorded anywhere yet, kept as columns of the result
        F.sum(nothing).alias("factoringFeeCreated"),
        F.sum(nothing).alias("externalFactoringFeeCreated"),
        F.sum(F.col("fee") - F.col("externalFee")).alias("netResultWithoutFactoringCreated"),
        F.sum("externalFee").alias("externalFeeCreated"),
        *_missing_fees("Created"),
        F.avg(F.datediff("nominalDue", "dueFromAcquirer")).alias("daysBetweenPaymentsAvgCreated"),
    ]


def _merchant_measures() -> list[Column]:
    return [
        F.sum(_unless_voided("amount") - _unless_voided("fee")).alias("amountToMerchant"),
        *_missing_fees("ToMerchant"),
    ]


def _acquirer_measures() -> list[Column]:
    return [
        F.sum(_unless_voided("amount") - _unless_voided("externalFee")).alias("amountFromAcquirer"),
        *_missing_fees("FromAcquirer"),
    ]


def _acquirer_date() -> Column:
    """Factored installments are paid on their own due date."""
    return F.when(F.col("isFactoring"), F.col("merchantDue")).otherwise(F.col("dueFromAcquirer"))


def _rollup(fact: DataFrame, date: Column, measures: Sequence[Column]) -> DataFrame:
    return fact.withColumn("referenceDate", date).groupBy(*DIMENSIONS, "isFactoring").agg(*measures)


def created_rollup(fact: DataFrame) -> DataFrame:
    """Amounts, fees and missing fees by creation date."""
    return _rollup(fact, F.col("createdDate"), _created_measures())


def merchant_due_rollup(fact: DataFrame) -> DataFrame:
    """Amounts to pay by merchant due date."""
    return _rollup(fact, F.col("merchantDue"), _merchant_measures())


def acquirer_due_rollup(fact: DataFrame) -> DataFrame:
    """Amounts to receive by acquirer due date."""
    return _rollup(fact, _acquirer_date(), _acquirer_measures())


def _on_sides(rows: DataFrame, acquirer_date: Column) -> DataFrame:
    """Every row on its creation, acquirer and merchant date, told apart by ``side``."""
    sides = F.array(*[
        F.struct(F.lit(side).alias("side"), date.alias("referenceDate"))
        for side, date in (("created", F.col("createdDate")), ("acquirer", acquirer_date),
                           ("merchant", F.col("merchantDue")))
    ])
    return rows.withColumn("_s", F.explode(sides)).select("*", "_s.*").drop("_s")


def dated_rollup(fact: DataFrame) -> DataFrame:
    """The three rollups in one pass: every installment counts on its creation, acquirer and
    merchant date, told apart by ``side``."""
    return _on_sides(fact, _acquirer_date()).groupBy("side", *DIMENSIONS, "isFactoring").agg(*_acquirer_measures(), *_merchant_measures())


# --- by creation day -----------------------------------------------------------------------

def day_states(fact: DataFrame) -> DataFrame:
    """Sums per creation day and both due dates, which add up over days to the whole rollup.

    An installment counts in one row, not in one per side: ``merged_states`` puts each row on its three dates. There
    is also the pair that the average of days between payments is made of.
    """
    gap = F.datediff("nominalDue", "dueFromAcquirer")
    return fact.withColumn("acquirerDate", _acquirer_date()).groupBy(
        "createdDate", "acquirerDate", "merchantDue", *DIMENSIONS[1:], "isFactoring").agg(
        *_acquirer_measures(), *_merchant_measures(), F.sum(gap).alias("gapDays"), F.count(gap).alias("gaps"))


def merged_states(states: DataFrame) -> DataFrame:
    """The rollup of all days of ``states``."""
    sums = [F.sum(c).alias(c) for c in (*ACQUIRER_COLUMNS, *MERCHANT_COLUMNS)]
    sums += [F.sum(F.when(F.col("side") == "created", F.col(c))).alias(c) for c in ("gapDays", "gaps")]
    return _on_sides(states, F.col("acquirerDate")).groupBy("side", *DIMENSIONS, "isFactoring").agg(*sums).withColumn(
        "daysBetweenPaymentsAvgCreated", F.try_divide("gapDays", "gaps")).drop("gapDays", "gaps")


ACQUIRER_COLUMNS = ["amountFromAcquirer", "amountWithoutFeeAndExternalFeeFromAcquirer",
                    "amountWithoutFeeOnlyFromAcquirer", "amountWithoutExternalFeeOnlyFromAcquirer"]
MERCHANT_COLUMNS = ["amountToMerchant", "amountWithoutFeeAndExternalFeeToMerchant",
                    "amountWithoutFeeOnlyToMerchant", "amountWithoutExternalFeeOnlyToMerchant"]


def daily_receive_pay(rollup: DataFrame, workspaces: DataFrame, match_factoring: bool = False) -> DataFrame:
    """Amounts to receive and to pay per day, network, status and company.

    The result is the full outer join of the three rollups on date, network, status and
    workspace, over every day from the first creation to the last merchant due date. The
    factoring flag is no key, so the rows of a key with both flags on one side are paired
    with all rows of the other sides; ``match_factoring`` makes it a key. A row with a NULL
    key matches nothing. ``isFactoring`` is that of the creation side.

    A key has at most one row per side and flag, so instead of joining three branches of
    the same fact the rows of a key are put side by side, by a sum each, and paired in place. The
    ``rollup`` (of ``dated_rollup``) is read three times and should be a stored result.
    """
    day = rollup.agg(
        F.min(F.when(F.col("side") == "created", F.col("referenceDate"))).alias("first"),
        F.max(F.when(F.col("side") == "merchant", F.col("referenceDate"))).alias("last"),
    )
    first, last = day.select("first").scalar(), day.select("last").scalar()

    keys = [*DIMENSIONS, "isFactoring"] if match_factoring else DIMENSIONS
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()

    # the flag as a number, and of each side the set of its flags as three bits
    flag = F.when(F.col("isFactoring"), 2).when(~F.col("isFactoring"), 1).otherwise(0)
    columns = {"acquirer": ACQUIRER_COLUMNS, "merchant": MERCHANT_COLUMNS}
    sums = [F.sum(F.when((F.col("side") == side) & (F.col("_flag") == i), F.col(c))).alias(f"_{i}_{c}")
            for side, of_side in columns.items() for i in range(3) for c in of_side]
    sums += [F.bit_or(F.when(F.col("side") == side, F.col("_bit"))).alias(f"_{side}")
             for side in ("created", *columns)]

    def rows_of(side: str) -> Column:
        flags = F.lit([[i for i in range(3) if bits >> i & 1] for bits in range(1, 8)])
        return F.explode_outer(F.get(flags, F.col(f"_{side}") - 1))

    def amount(at: str, column: str) -> Column:
        return F.coalesce(*[F.when(F.col(at) == i, F.col(f"_{i}_{column}")) for i in range(3)]).alias(column)

    in_range = (F.col("side") != "created") | F.col("referenceDate").between(first, last)
    paired = (
        rollup.filter(in_range)
        # rows with a NULL key stay with their own side
        .withColumn("_alone", F.when(~known, F.concat_ws("/", "side", F.col("isFactoring").cast("string"))))
        .withColumn("_flag", flag)
        .withColumn("_bit", F.element_at(F.lit([1, 2, 4]), F.col("_flag") + 1))
        .repartition(*keys, "_alone")  # hardly two rows have one key, so nothing is added up before the shuffle
        .groupBy(*keys, "_alone")
        .agg(*sums)
        .withColumn("_c", rows_of("created"))
        .withColumn("_a", rows_of("acquirer"))
        .withColumn("_m", rows_of("merchant"))
        .select("referenceDate", F.when(F.col("_c") > 0, F.col("_c") == 2).alias("isFactoring"), "network",
                "installmentStatus", "workspaceId",
                *[amount("_a", c) for c in ACQUIRER_COLUMNS], *[amount("_m", c) for c in MERCHANT_COLUMNS])
    )
    names = workspace_dim(workspaces).select("workspaceId", "companyName")
    named = join_splittable(paired, names, ["workspaceId"]).drop("workspaceId")
    return named.unionByName(_days_without_creation(rollup, first, last), allowMissingColumns=True)


def _days_without_creation(rollup: DataFrame, first: Column, last: Column) -> DataFrame:
    """Days of the spine on which nothing was created: rows with the date alone.

    Found as the gaps between the days that have creations, one row per day at most.
    """
    days = rollup.filter((F.col("side") == "created") & F.col("referenceDate").between(first, last)) \
        .select("referenceDate").distinct()
    following = F.lead("referenceDate").over(Window.orderBy("referenceDate"))
    return (
        days.withColumn("_until", F.coalesce(F.date_sub(following, 1), last))
        .select(F.explode(date_range(F.date_add("referenceDate", 1), F.col("_until"))).alias("referenceDate"))
    )
