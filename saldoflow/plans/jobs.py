"""Whole jobs: from source tables to the report they publish.

Each is a composition of operators; tables are passed in, so a caller reads them from a
catalog (``spark.table``) or from files.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import local_date, local_date_between
from ..operators import calendars, cards, index_returns, purchases, receivables, reconcile, snapshots, weekly
from ..params import ReceivablesParams, RemunerationParams
from ..sources.storage import publish, read_table, stored, temporary
from ..sources.tables import current_version, replace_dates, replace_table


# --- purchase remuneration -----------------------------------------------------------------

def cycle_remuneration(spark: SparkSession, log: DataFrame, card_owners: DataFrame, holidays: DataFrame,
                       index: DataFrame, params: RemunerationParams,
                       attribution: str = "last_confirmation") -> DataFrame:
    """Remuneration per purchase cycle of one issuer, or of all but one."""
    returns = index_returns.return_series(spark, holidays, index, params, "settlement")
    return purchases.cycle_remuneration(log, card_owners, returns, params, attribution)


def issuer_daily_remuneration(spark: SparkSession, log: DataFrame, card_owners: DataFrame, sub_issuers: DataFrame,
                              holidays: DataFrame, index: DataFrame, params: RemunerationParams) -> DataFrame:
    """Remuneration per due date and issuer."""
    returns = index_returns.return_series(spark, holidays, index, params, "due")
    rows = purchases.purchase_log(log, card_owners, params)
    return purchases.issuer_daily_remuneration(rows, returns, sub_issuers, params)


def reversal_probe(log: DataFrame, card_owners: DataFrame, params: RemunerationParams) -> DataFrame:
    """Reversals with the event they undo."""
    return purchases.previous_event_lookup(purchases.purchase_log(log, card_owners, params))


# --- cards ---------------------------------------------------------------------------------

def issuer_deltas(log: DataFrame, sub_issuers: DataFrame, issuer_name: str, end: dt.date) -> DataFrame:
    """Activity deltas of the cards of one issuer; expirations as of the earliest log row."""
    events = cards.card_events(cards.of_issuer(log, sub_issuers, issuer_name), end, order="logCreated")
    return cards.activity_delta(events).withColumn("subIssuerName", F.lit(issuer_name))


def card_comparison(log: DataFrame, sub_issuers: DataFrame, raw_cards: DataFrame, partner: DataFrame,
                    issuer_name: str, end: dt.date, cutoff: dt.date, unknown: str = "drop") -> DataFrame:
    """Cards of one issuer that are active at the cut-off quarter against the partner list."""
    balances = reconcile.balance_at_quarter(issuer_deltas(log, sub_issuers, issuer_name, end), cutoff)
    return reconcile.compare(balances, partner, reconcile.card_status(raw_cards), unknown=unknown)


def publish_divergences(compared: DataFrame, log: DataFrame, folder: str) -> dict[str, str]:
    """Writes the divergences and the histories of both sides below ``folder``."""
    paths = {name: f"{folder}/{name}" for name in ("matched", "divergences", "history_own", "history_partner", "canceled")}
    spark = compared.sparkSession
    publish(compared, f"{folder}/compared")
    whole = read_table(spark, f"{folder}/compared")
    publish(reconcile.outcome(whole, "matched"), paths["matched"])
    publish(reconcile.divergences(whole), paths["divergences"])
    divergent = read_table(spark, paths["divergences"])
    for side in ("own", "partner"):
        publish(reconcile.event_history(divergent, log, side), paths[f"history_{side}"])
    publish(reconcile.explode_history(read_table(spark, paths["history_own"])), paths["canceled"])
    return paths


# --- receivables ---------------------------------------------------------------------------

@dataclass(frozen=True)
class ReceivablesTables:
    installments: DataFrame
    installment_log: DataFrame
    merchant_purchases: DataFrame
    acquiring_purchases: DataFrame
    acquiring_installments: DataFrame
    workspaces: DataFrame
    holidays: DataFrame


def receivables_fact(spark: SparkSession, tables: ReceivablesTables, params: ReceivablesParams) -> DataFrame:
    next_days = calendars.next_business_day(calendars.holiday_calendar(spark, tables.holidays))
    return receivables.installment_fact(
        tables.installments, tables.installment_log, tables.merchant_purchases, tables.acquiring_purchases,
        tables.acquiring_installments, tables.workspaces, next_days, params)


def narrowed(tables: ReceivablesTables, params: ReceivablesParams) -> ReceivablesTables:
    """The window's installments, stored, and the other tables without most rows that none of these meets."""
    window = receivables.window_rows(tables.installments, params)
    log, purchases, settled = receivables.only_needed(
        window, tables.installment_log, tables.merchant_purchases, tables.acquiring_purchases, params)
    fees = receivables.needed_fees(tables.acquiring_installments, settled)
    return replace(tables, installments=window, installment_log=log, merchant_purchases=purchases,
                   acquiring_purchases=settled, acquiring_installments=fees)


def receive_pay(spark: SparkSession, tables: ReceivablesTables, params: ReceivablesParams,
                path: str | None = None, key_filters: bool = True) -> DataFrame:
    """Daily amounts to receive and to pay, published by date if a path is given.

    The rollup is stored here, so the join of the fact runs once, when this is called. ``key_filters`` takes out of
    the log and the purchases, before their shuffles, most of what the window doesn't need, for one more read of
    the window's keys; without it the result is the same, sooner only where the window is all there is.
    """
    def rollup() -> DataFrame:
        needed = narrowed(tables, params) if key_filters else tables
        return stored(receivables.dated_rollup(receivables_fact(spark, needed, params)))

    if path is None:
        return receivables.daily_receive_pay(rollup(), tables.workspaces)
    with temporary(spark):
        publish(receivables.daily_receive_pay(rollup(), tables.workspaces), path, "referenceDate")
    return read_table(spark, path)


@dataclass(frozen=True)
class ReceivablesChanges:
    """Rows that changed since the last run, old and new versions alike; None where nothing did.

    Of ``installments`` ``created`` and ``workspaceId`` are needed, of the others their keys: ``installmentId``, ``__key__``,
    ``endToEndId``, ``purchaseId`` and ``workspaceId``. Changed holidays can move every day: run anew.
    """

    installments: DataFrame | None = None
    installment_log: DataFrame | None = None
    merchant_purchases: DataFrame | None = None
    acquiring_purchases: DataFrame | None = None
    acquiring_installments: DataFrame | None = None
    workspaces: DataFrame | None = None


def changed_units(tables: ReceivablesTables, changes: ReceivablesChanges, params: ReceivablesParams) -> DataFrame:
    """Creation days and workspaces (``createdDate``, ``workspaceId``) of the window whose rows of the fact may have changed.

    A few changed purchases in a thousand touch every day, but few workspaces of each.
    """
    tz, unit = params.tz, ["createdDate", "workspaceId"]
    window = tables.installments.filter(local_date_between("created", params.start, params.end, tz)).select(
        receivables.key_id().alias("installmentId"), "purchaseId", "workspaceId", local_date("created", tz).alias("createdDate"))
    purchases = tables.merchant_purchases.select(receivables.key_id().alias("purchaseId"), "endToEndId")
    found = []
    if changes.installments is not None:
        found.append(changes.installments.filter(local_date_between("created", params.start, params.end, tz)).select(
            local_date("created", tz).alias("createdDate"), "workspaceId"))
    if changes.installment_log is not None:
        found.append(window.join(changes.installment_log.select("installmentId"), "installmentId", "left_semi").select(*unit))
    ends, ids = [], []
    if changes.acquiring_installments is not None:
        fees = changes.acquiring_installments.select(F.col("purchaseId").alias("acquiringId"))
        settled = tables.acquiring_purchases.select(F.col("id").cast("string").alias("acquiringId"), "endToEndId")
        ends.append(settled.join(fees, "acquiringId", "left_semi").select("endToEndId"))
    if changes.acquiring_purchases is not None:
        ends.append(changes.acquiring_purchases.select("endToEndId"))
    if ends:
        ids.append(purchases.join(reduce(DataFrame.union, ends), "endToEndId", "left_semi").select("purchaseId"))
    if changes.merchant_purchases is not None:
        ids.append(changes.merchant_purchases.select(receivables.key_id().alias("purchaseId")))
    if ids:
        found.append(window.join(reduce(DataFrame.union, ids), "purchaseId", "left_semi").select(*unit))
    if changes.workspaces is not None:
        found.append(window.join(changes.workspaces.select("workspaceId"), "workspaceId", "left_semi").select(*unit))
    none = window.select(*unit).filter("false")
    return reduce(DataFrame.union, found, none).filter("workspaceId IS NOT NULL").distinct()


def _days(units: DataFrame) -> list[dt.date]:
    return sorted(r.createdDate for r in units.select("createdDate").distinct().collect())


def changed_days(tables: ReceivablesTables, changes: ReceivablesChanges, params: ReceivablesParams) -> list[dt.date]:
    """Creation days of ``changed_units``; at most one date a day reaches the driver."""
    return _days(changed_units(tables, changes, params))


def update_receive_pay(spark: SparkSession, tables: ReceivablesTables, params: ReceivablesParams, name: str,
                       changes: ReceivablesChanges | None = None) -> DataFrame:
    """``receive_pay`` from states by creation day that are kept in the table ``name``.

    Without ``changes``, or if there are no states yet (or only ones by side, as earlier versions kept them), those of the
    whole window are made. Else only the days that the changes touch are written again, and of these only the workspaces
    that they touch are computed again: their installments alone go into the joins, and of the installment log and the
    purchases little else is shuffled. The states of the other workspaces of such days are copied. The result adds up
    the states of the window.
    """
    whole = changes is None or current_version(spark, name) is None or "acquirerDate" not in spark.table(name).columns
    with temporary(spark):
        if whole:
            states = receivables.day_states(receivables_fact(spark, narrowed(tables, params), params))
            replace_table(states, name, "createdDate", partitioned=False)
        else:
            units = stored(changed_units(tables, changes, params))
            days = _days(units)
            if days:
                touched = receivables.of_units(tables.installments.filter(receivables.created_on(days, params.tz)), units, params)
                some = narrowed(replace(tables, installments=touched), params)
                made = receivables.day_states(receivables_fact(spark, some, params))
                others = spark.table(name).filter(F.col("createdDate").isin(days)).join(units, units.columns, "left_anti")
                replace_dates(made.unionByName(others), name, "createdDate", [d.isoformat() for d in days], partitioned=False)
    states = spark.table(name).filter(F.col("createdDate").between(F.lit(params.start), F.lit(params.end)))
    return receivables.daily_receive_pay(stored(receivables.merged_states(states)), tables.workspaces)


# --- weekly report and snapshots -----------------------------------------------------------

def purchase_base(log: DataFrame, holders: DataFrame, workspaces: DataFrame, raw_cards: DataFrame,
                  sub_issuers: DataFrame, categories: DataFrame,
                  spread_change: dt.date = weekly.SPREAD_CHANGE) -> DataFrame:
    """Signed, converted and enriched purchases, the base of the weekly report."""
    converted = weekly.conversion_columns(weekly.signed_purchases(log), spread_change)
    return weekly.enrich(converted, holders, workspaces, raw_cards, sub_issuers, categories)


class SnapshotUpdate(NamedTuple):
    snapshot: DataFrame
    unreadable: DataFrame  # label, rows: captured labels that are no day


def update_snapshot(spark: SparkSession, captured: DataFrame, path: str, as_of: dt.date) -> SnapshotUpdate:
    """Merges newly captured statements into the stored snapshot at ``path``.

    A capture without rows leaves the snapshot as it is. One in which no label is a day is an error,
    as the page has changed then, and leaves it too. Labels that are no day are published
    at ``path``/unreadable.
    """
    with temporary(spark):
        captured = stored(captured)
        publish(snapshots.unreadable_labels(captured, as_of), f"{path}/unreadable")
        unreadable = read_table(spark, f"{path}/unreadable")
        new = stored(snapshots.collect_statements(captured, as_of))
        if new.filter("data IS NOT NULL").isEmpty():
            if not new.isEmpty():
                raise ValueError(f"no captured label is a day, see {path}/unreadable")
        else:
            publish(snapshots.snapshot_merge(read_table(spark, path), new), path)
    return SnapshotUpdate(read_table(spark, path), unreadable)
