"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import datetime as dt
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import replace
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import parse_day_label, parse_money
from ..operators import calendars, cards, index_returns, purchases, receivables, reconcile, snapshots, weekly
from ..sources import reports, storage, tables
from ..sources.schemas import report_kind
from . import fixtures as fx
from . import card_store, jobs, store_queries

RUN_DATE = dt.date(2024, 1, 31)


def plain(df: DataFrame) -> DataFrame:
    """Columns in types that every engine prints alike: dates as ISO text, whole numbers as
    bigint, doubles with six places, arrays of text as one text."""

    def shown(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            return c.cast("string")
        if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        if isinstance(f.dataType, T.IntegerType | T.ShortType | T.ByteType):
            return c.cast("long")
        if isinstance(f.dataType, T.DoubleType | T.FloatType):
            return F.round(c, 6)
        if isinstance(f.dataType, T.ArrayType):
            return F.array_join(c.cast("array<string>"), ",")
        return c

    return df.select(*[shown(f).alias(f.name) for f in df.schema])


# --- calendar and index --------------------------------------------------------------------

def working_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Days from the first to the last event with the working flag and the number of events."""
    per_day = fx.table(spark, sf, "events").groupBy(F.to_date("ts").alias("referenceDate")).agg(
        F.count(F.lit(1)).alias("events"))
    first = per_day.agg(F.min("referenceDate")).scalar()
    last = per_day.agg(F.max("referenceDate")).scalar()
    days = calendars.working_days(calendars.date_spine(spark, first, last), fx.holidays(spark, sf))
    return days.join(per_day, "referenceDate", "left").withColumn("events", F.coalesce("events", F.lit(0)))


def next_business_day(spark: SparkSession, sf: str) -> DataFrame:
    """Line items per business day on or after their shipping date."""
    next_days = calendars.next_business_day(calendars.holiday_calendar(spark, fx.acquiring_holidays(spark, sf)))
    shipped = fx.table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("businessDay"), fx.cents(F.col("l_extendedprice")).alias("amount"))
    return calendars.business_day_adjust(shipped, "businessDay", next_days).groupBy("businessDay").agg(
        F.count(F.lit(1)).alias("items"), F.sum("amount").alias("amount"))


def _index_calendar(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.REMUNERATION
    margin = dt.timedelta(days=p.settlement_days)
    spine = calendars.date_spine(spark, p.start - margin, p.end + margin)
    return calendars.working_days(spine, fx.holidays(spark, sf))


def latest_index(spark: SparkSession, sf: str) -> DataFrame:
    return index_returns.latest_index(fx.daily_index(spark, sf), fx.REMUNERATION.as_of)


def index_with_forecast(spark: SparkSession, sf: str) -> DataFrame:
    index = fx.daily_index(spark, sf)
    latest = index_returns.latest_index(index, fx.REMUNERATION.as_of)
    return index_returns.index_with_forecast(_index_calendar(spark, sf), index, latest)


def _returns(spark: SparkSession, sf: str, key: str = "settlement") -> DataFrame:
    return index_returns.return_series(
        spark, fx.holidays(spark, sf), fx.daily_index(spark, sf), fx.REMUNERATION, key)


def compound_return(spark: SparkSession, sf: str) -> DataFrame:
    due = _returns(spark, sf, "due").select("referenceDate", F.col("accumulatedReturn").alias("returnByDueDate"))
    return _returns(spark, sf).join(due, "referenceDate")


# --- purchases -----------------------------------------------------------------------------

def _log(spark: SparkSession, sf: str) -> DataFrame:
    return purchases.purchase_log(fx.purchase_events(spark, sf), fx.purchase_cards(spark, sf), fx.REMUNERATION)


def purchase_log(spark: SparkSession, sf: str) -> DataFrame:
    return _log(spark, sf)


def cycle_attribution(spark: SparkSession, sf: str) -> DataFrame:
    return purchases.attribute_cycle(_log(spark, sf), fx.REMUNERATION).select(
        "endToEndId", "issuingPurchaseLogId", "type", "logDate", "logAmount", "cycleDate", "internalId")


def classify_reversals(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf)
    attributed = purchases.reversal_cycles(log, purchases.cycle_dates(log, fx.REMUNERATION))
    return purchases.classify_reversals(attributed, fx.REMUNERATION).select(
        "issuingPurchaseLogId", "endToEndId", "cycleDate", "logDate", "logAmount", "beforeSettlement")


def cycle_amounts(spark: SparkSession, sf: str) -> DataFrame:
    return purchases.cycle_amounts(_log(spark, sf), fx.REMUNERATION)


def cycle_remuneration(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.cycle_remuneration(
        spark, fx.purchase_events(spark, sf), fx.purchase_cards(spark, sf), fx.holidays(spark, sf),
        fx.daily_index(spark, sf), fx.REMUNERATION)


def prior_row_cycle(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.cycle_remuneration(
        spark, fx.purchase_events(spark, sf), fx.purchase_cards(spark, sf), fx.holidays(spark, sf),
        fx.daily_index(spark, sf), fx.REMUNERATION, attribution="previous_row")


def issuer_daily_remuneration(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.issuer_daily_remuneration(
        spark, fx.purchase_events(spark, sf), fx.purchase_cards(spark, sf), fx.sub_issuers(spark, sf),
        fx.holidays(spark, sf), fx.daily_index(spark, sf), fx.REMUNERATION)


def issuer_daily_remuneration_by_day(spark: SparkSession, sf: str) -> DataFrame:
    log = purchases.purchase_log(fx.purchase_events(spark, sf), fx.purchase_cards(spark, sf), fx.REMUNERATION)
    return purchases.issuer_daily_remuneration(
        log, _returns(spark, sf, "due"), fx.sub_issuers(spark, sf), fx.REMUNERATION, compare="day")


def previous_event_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return purchases.previous_event_lookup(_log(spark, sf))


# --- cards ---------------------------------------------------------------------------------

def sub_issuer_dim(spark: SparkSession, sf: str) -> DataFrame:
    """One name per issuer among the names its customers give: their market segments."""
    named = fx.table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("subIssuerTaxId"), F.col("c_mktsegment").alias("subIssuerName"))
    return cards.issuer_names(named)


def card_expirations(spark: SparkSession, sf: str) -> DataFrame:
    return cards.card_expirations(fx.card_log(spark, sf))


def first_card_events(spark: SparkSession, sf: str) -> DataFrame:
    return cards.first_card_events(fx.card_log(spark, sf))


def card_events(spark: SparkSession, sf: str) -> DataFrame:
    return cards.card_events(fx.card_log(spark, sf), fx.CARDS_END)


def _deltas(spark: SparkSession, sf: str) -> DataFrame:
    return cards.activity_delta(cards.card_events(fx.card_log(spark, sf), fx.CARDS_END))


def activity_delta(spark: SparkSession, sf: str) -> DataFrame:
    return _deltas(spark, sf)


def holder_activity(spark: SparkSession, sf: str) -> DataFrame:
    return cards.holder_activity(_deltas(spark, sf))


def _balance(spark: SparkSession, sf: str) -> DataFrame:
    return cards.holder_balance(cards.holder_activity(_deltas(spark, sf)))


def holder_balance(spark: SparkSession, sf: str) -> DataFrame:
    return _balance(spark, sf)


def densify_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Balance of every holder in every quarter up to the cut-off."""
    until = _balance(spark, sf).filter(F.col("quarter") <= F.lit(fx.CARDS_CUTOFF))
    return cards.densify_fill(until, ["issuingHolderId"], "quarter", ["subIssuerTaxId", "balance"],
                              F.lit(fx.CARDS_CUTOFF))


def active_holders(spark: SparkSession, sf: str) -> DataFrame:
    return cards.active_holders(_balance(spark, sf))


def active_holders_report(spark: SparkSession, sf: str) -> DataFrame:
    return cards.active_holders_report(fx.card_log(spark, sf), fx.sub_issuers(spark, sf), fx.CARDS_END)


def active_holders_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The report from states: the log comes in two parts, neither in order, and some rows of the first come again."""
    log, name = fx.card_log(spark, sf), f"card_store_{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64("issuingCardId", "type", "logCreated"), F.lit(10))
    store = card_store.CardStore(spark, name, fx.CARDS_END)
    store.update(log.filter(part < 7))
    store.update(log.filter(part > 4))
    report = storage.stored(store.report(fx.sub_issuers(spark, sf)))
    tables.drop_table(spark, name)
    return report


def _named_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return cards.with_issuer_name(_deltas(spark, sf), fx.sub_issuers(spark, sf))


def card_balance_listing(spark: SparkSession, sf: str) -> DataFrame:
    return cards.card_balance_listing(_named_deltas(spark, sf), fx.CARDS_ISSUER, dt.date(1998, 1, 1))


def _status(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.card_status(fx.raw_cards(spark, sf))


def partner_list_check(spark: SparkSession, sf: str) -> DataFrame:
    return cards.partner_list_check(_named_deltas(spark, sf), fx.partner_cards(spark, sf), _status(spark, sf),
                                    fx.CARDS_ISSUER, fx.CARDS_CUTOFF)


# --- reconciliation ------------------------------------------------------------------------

def card_collection(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.card_collection(_named_deltas(spark, sf))


def peak_balance(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.peak_balance(_deltas(spark, sf), fx.CARDS_CUTOFF)


def balance_at_quarter(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.balance_at_quarter(_named_deltas(spark, sf), fx.CARDS_CUTOFF)


def card_status(spark: SparkSession, sf: str) -> DataFrame:
    return _status(spark, sf)


def _compared(spark: SparkSession, sf: str, unknown: str = "drop") -> DataFrame:
    return reconcile.compare(balance_at_quarter(spark, sf), fx.partner_cards(spark, sf), _status(spark, sf),
                             unknown=unknown)


def reconcile_matched(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.outcome(_compared(spark, sf), "matched")


def reconcile_only_partner(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.outcome(_compared(spark, sf), "only_partner")


def reconcile_flag_unknown(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.outcome(_compared(spark, sf, unknown="flag"), "only_partner")


def reconcile_only_own(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.outcome(_compared(spark, sf), "only_own")


def divergence_report(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.divergences(_compared(spark, sf))


def divergences_by_tree(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.divergences_by_tree(balance_at_quarter(spark, sf), fx.partner_cards(spark, sf), _status(spark, sf))


def issuer_divergences(spark: SparkSession, sf: str) -> DataFrame:
    """Divergences of the cards of one issuer; the partner also lists cards of other issuers."""
    return reconcile.divergences(jobs.card_comparison(
        fx.card_log(spark, sf), fx.sub_issuers(spark, sf), fx.raw_cards(spark, sf), fx.partner_cards(spark, sf),
        fx.CARDS_ISSUER, fx.CARDS_END, fx.CARDS_CUTOFF))


def _history(spark: SparkSession, sf: str, side: str) -> DataFrame:
    divergent = storage.stored(divergence_report(spark, sf))
    return reconcile.event_history(divergent, fx.card_log(spark, sf), side)


def event_history(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf, "own")


def event_history_arrays(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.history_arrays(_history(spark, sf, "own"))


def event_history_partner(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf, "partner")


def explode_history(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.explode_history(_history(spark, sf, "own"))


def explode_history_zip(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.explode_history(_history(spark, sf, "own"), "zip", ("created", "unblocked", "canceled"))


def resolve_holder(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.resolve_holder(fx.partner_cards(spark, sf), fx.card_log(spark, sf))


# --- receivables ---------------------------------------------------------------------------

def _next_days(spark: SparkSession, sf: str) -> DataFrame:
    return calendars.next_business_day(calendars.holiday_calendar(spark, fx.acquiring_holidays(spark, sf)))


def nominal_due(spark: SparkSession, sf: str) -> DataFrame:
    return receivables.nominal_due(fx.installment_log(spark, sf))


def acquirer_due(spark: SparkSession, sf: str) -> DataFrame:
    return receivables.acquirer_due(
        fx.installments(spark, sf), fx.merchant_purchases(spark, sf),
        receivables.nominal_due(fx.installment_log(spark, sf)), _next_days(spark, sf), fx.RECEIVABLES)


def workspace_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Latest company per workspace; every order of a customer restates the customer's."""
    stated = fx.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("workspaceId"),
        F.col("o_orderstatus").alias("companyTaxId"),
        F.col("o_orderpriority").alias("companyName"),
        F.col("o_orderdate").alias("workspaceCreated"),
    )
    return receivables.workspace_dim(stated)


def factoring_flag(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.installments(spark, sf)
    return rows.select(receivables.key_id().alias("installmentId"),
                       receivables.tag_flag(F.col("tags"), fx.RECEIVABLES.factoring_marker).alias("isFactoring"))


def _receivables_tables(spark: SparkSession, sf: str) -> jobs.ReceivablesTables:
    return jobs.ReceivablesTables(
        fx.installments(spark, sf), fx.installment_log(spark, sf), fx.merchant_purchases(spark, sf),
        fx.acquiring_purchases(spark, sf), fx.acquiring_installments(spark, sf), fx.workspaces(spark, sf),
        fx.acquiring_holidays(spark, sf))


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.receivables_fact(spark, _receivables_tables(spark, sf), fx.RECEIVABLES)


def installment_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf)


def created_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return receivables.created_rollup(_fact(spark, sf))


def merchant_due_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return receivables.merchant_due_rollup(_fact(spark, sf))


def acquirer_due_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return receivables.acquirer_due_rollup(_fact(spark, sf))


def daily_receive_pay(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.receive_pay(spark, _receivables_tables(spark, sf), fx.RECEIVABLES)


def earlier_receivables(now: jobs.ReceivablesTables) -> tuple[jobs.ReceivablesTables, jobs.ReceivablesChanges]:
    """The tables as they were: some installments of a month missing, some purchases denied and some fees other."""
    order = F.substring_index("purchaseId", "-", 1).cast("long")
    missing = (order % 5 == 0) & (F.month("created") == 3)
    denied, other = F.col("id").cast("long") % 500 == 0, F.col("purchaseId").cast("long") % 700 == 0
    late = F.substring_index("installmentId", "-", 1).cast("long") % 900 == 0
    due = F.struct((F.col("installment.due") + F.expr("INTERVAL 2 DAYS")).alias("due"), F.col("installment.created").alias("created"))
    before = replace(
        now, installments=now.installments.filter(~missing),
        installment_log=now.installment_log.withColumn("installment", F.when(late, due).otherwise(F.col("installment"))),
        acquiring_purchases=now.acquiring_purchases.withColumn("status", F.when(denied, "denied").otherwise(F.col("status"))),
        acquiring_installments=now.acquiring_installments.withColumn(
            "externalFee", F.when(other, F.col("externalFee") + 7).otherwise(F.col("externalFee"))))
    changes = jobs.ReceivablesChanges(
        installments=now.installments.filter(missing), installment_log=now.installment_log.filter(late),
        acquiring_purchases=now.acquiring_purchases.filter(denied), acquiring_installments=now.acquiring_installments.filter(other))
    return before, changes


def receive_pay_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The daily amounts after a first run over an earlier state and a second one over the changed days alone."""
    name, now = f"day_states_{uuid.uuid4().hex}", _receivables_tables(spark, sf)
    before, changes = earlier_receivables(now)
    jobs.update_receive_pay(spark, before, fx.RECEIVABLES, name)
    found = storage.stored(jobs.update_receive_pay(spark, now, fx.RECEIVABLES, name, changes))
    tables.drop_table(spark, name)
    return found


def publish_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Line items published by shipping month and read back, then repartitioned by status."""
    path = storage.new_folder(spark, "published")
    rows = fx.table(spark, sf, "lineitem").select(
        F.to_date(F.trunc("l_shipdate", "month")).alias("month"), "l_orderkey", "l_linestatus",
        fx.cents(F.col("l_extendedprice")).alias("amount"))
    storage.publish(rows, path, "month")
    storage.repartition_table(spark, path, "l_linestatus")
    return storage.read_table(spark, path).select("month", "l_orderkey", "l_linestatus", "amount")


# --- weekly report -------------------------------------------------------------------------

def signed_purchases(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.signed_purchases(fx.purchase_records(spark, sf)).drop("walletId")


def _converted(spark: SparkSession, sf: str) -> DataFrame:
    signed = weekly.signed_purchases(fx.purchase_records(spark, sf))
    return weekly.conversion_columns(signed, dt.date(1998, 1, 1))


def conversion_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _converted(spark, sf).select(
        "endToEndId", "conversionRate", "spread", "purchaseConciliated", "merchantFeeBRL", "feeBRL",
        "conversionRateIssuer")


def enrich(spark: SparkSession, sf: str) -> DataFrame:
    base = jobs.purchase_base(
        fx.purchase_records(spark, sf), fx.corporate_holders(spark, sf), fx.nation_workspaces(spark, sf),
        fx.raw_cards(spark, sf), fx.raw_sub_issuers(spark, sf), fx.merchant_categories(spark, sf),
        dt.date(1998, 1, 1))
    return base.select(
        "endToEndId", "logAmount", "holderName", "workspaceId", "centerId", "companyName", "companyTaxId",
        "binId", "cardType", "subIssuerWorkspaceId", "subIssuerName", "merchantCategoryNumber")


def weekly_tpv(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.weekly_tpv(fx.purchase_conciliation(spark, sf), fx.WEEKLY_AS_OF, exclude_issuer="5")


# --- settlement reports --------------------------------------------------------------------

def normalise_decimals(spark: SparkSession, sf: str) -> DataFrame:
    return reports.normalise_decimals(fx.report_sales(spark, sf))


def typed_dates(spark: SparkSession, sf: str) -> DataFrame:
    return reports.typed_dates(fx.report_sales(spark, sf), report_kind("pagamentos").schema)


def apply_schema(spark: SparkSession, sf: str) -> DataFrame:
    text = reports.normalise_decimals(fx.report_sales(spark, sf))
    return reports.apply_schema(text, report_kind("pagamentos").schema)


def outer_union(spark: SparkSession, sf: str) -> DataFrame:
    return reports.outer_union([fx.report_sales(spark, sf), fx.report_receipts(spark, sf)])


def stamp(spark: SparkSession, sf: str) -> DataFrame:
    return reports.stamp(fx.report_receipts(spark, sf), RUN_DATE)


#: Lines of a CSV member, so that an archive of any size has members of one.
MEMBER_LINES = 100_000


class _Archive:
    """A ZIP archive written as its lines come, in CSV members beside ones that are skipped, odd or unreadable."""

    def __init__(self, out: io.IOBase, name: str):
        self.name, self.data, self.members, self.left, self.member = name, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED), 0, 0, None

    def write(self, lines: pd.DataFrame) -> None:
        while len(lines):
            if not self.left:
                self._end()
                self.member, self.left = self.data.open(f"Pagamentos-{self.name}-{self.members}.csv", "w"), MEMBER_LINES
                self.members += 1
                self.member.write(lines[:0].to_csv(index=False, sep=";").encode())
            some, lines = lines[:self.left], lines[self.left:]
            self.member.write(some.to_csv(index=False, header=False, sep=";").encode())
            self.left -= len(some)

    def _end(self) -> None:
        if self.member:
            self.member.close()

    def close(self) -> None:
        self._end()
        self.data.writestr("capa-1.csv", "Título;Número\nx;1\n")
        self.data.writestr("recebidos-1.csv", "")
        self.data.writestr("outros-1.csv", "Código/A;Taxa %\n1.5;2,5\n")
        self.data.writestr("outros-2.csv", "Código/A;Codigo-A\n1;2\n")
        self.data.writestr("ajustes-1.xlsx", b"a workbook")
        self.data.writestr("leiame.txt", "no report")
        self.data.close()


def _sales(spark: SparkSession, sf: str, odd_dates: bool = False) -> DataFrame:
    """The sales report with headings, dealt to sixteen archives by order; with ``odd_dates`` each order's
    first line has a date that no pattern fits."""
    lines = fx.report_sales(spark, sf).withColumn("archive", F.split("NSU_CV", "-")[0].cast("long") % 16)
    if odd_dates:
        lines = lines.withColumn("data_original_da_venda", F.when(F.col("parcela") == "1", "1 fev").otherwise(
            F.col("data_original_da_venda")))
    headings = {"data_original_da_venda": "data original da venda",
                "valor_bruto_da_parcela_original": "valor bruto da parcela original"}
    for name, heading in headings.items():
        lines = lines.withColumnRenamed(name, heading)
    return lines


def _archive_folder(spark: SparkSession, sf: str, odd_dates: bool = False) -> str:
    """The sales report as sixteen ZIP archives in the shared folder, beside a broken one."""
    folder = storage.new_folder(spark, "archives")

    def written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        store.create_dir(path)
        parts = (part for frame in frames for part in frame.groupby("archive", sort=False))
        for name, some in groupby(parts, key=lambda part: part[0]):  # rows come sorted by archive
            with store.open_output_stream(f"{path}/{name}.zip") as out:
                archive = _Archive(out, name)
                for _, lines in some:
                    archive.write(lines.drop(columns="archive"))
                archive.close()
            if name == "0":
                with store.open_output_stream(f"{path}/broken.zip") as out:
                    out.write(b"no archive")
            yield pd.DataFrame({"path": [f"{name}.zip"]})

    lines = _sales(spark, sf, odd_dates).withColumn("archive", F.coalesce(F.col("archive").cast("string"), F.lit("None")))
    dealt = lines.repartition("archive").sortWithinPartitions("archive")
    dealt.mapInPandas(written, "path string").write.format("noop").mode("overwrite").save()
    return folder


def _landed(spark: SparkSession, folder: str, fmt: str) -> reports.Landing:
    return reports.land_reports(reports.read_archives(spark, folder), storage.new_folder(spark, "landed"), RUN_DATE, fmt)


def land_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Archives written to the shared folder, landed in both formats, and the sales table read back."""
    columns = ["updated_on", "NSU_CV", "parcela", "data_original_da_venda", "valor_bruto_da_parcela_original", "status"]
    number = F.col("valor_bruto_da_parcela_original").cast("double")
    folder, frames = _archive_folder(spark, sf), []
    for fmt in ("csv", "parquet"):
        table = storage.read_table(spark, _landed(spark, folder, fmt).paths["pagamentos"])
        texts = table.withColumn("valor_bruto_da_parcela_original", number).select(
            *[F.col(c) if c.startswith("valor") else F.col(c).cast("string").alias(c) for c in columns])
        frames.append(texts.withColumn("fmt", F.lit(fmt)))
    return frames[0].unionByName(frames[1])


def landing_problems(spark: SparkSession, sf: str) -> DataFrame:
    """What the landing could not read, by member."""
    problems = storage.read_table(spark, _landed(spark, _archive_folder(spark, sf), "parquet").problems)
    return problems.groupBy("member", "kind").agg(F.count(F.lit(1)).alias("archives"))


def landing_lost_values(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that became NULL because no type takes them, by column."""
    return storage.read_table(spark, _landed(spark, _archive_folder(spark, sf, odd_dates=True), "parquet").lost_values)


def read_zipped_reports(spark: SparkSession, sf: str) -> DataFrame:
    rows = reports.report_rows(reports.read_archives(spark, _archive_folder(spark, sf)))
    names = ["NSU_CV", "data_original_da_venda", "parcela", "status", "valor_bruto_da_parcela_original"]
    return reports.clean_report(rows, "pagamentos", RUN_DATE, names)


# --- snapshots -----------------------------------------------------------------------------

def parse_day_labels(spark: SparkSession, sf: str) -> DataFrame:
    return fx.captured_text(spark, sf).select(
        "event_id", "label", parse_day_label(F.col("label"), fx.SNAPSHOT_AS_OF).alias("data"))


def parse_money_texts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.captured_text(spark, sf).select(
        "event_id", "value", parse_money(F.col("value")).alias("valor"),
        parse_money(F.col("value"), "round").alias("rounded"))


def collect_statements(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.collect_statements(fx.captured_text(spark, sf), fx.SNAPSHOT_AS_OF)


def _snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = fx.snapshot_rows(spark, sf)
    split = F.lit(fx.SNAPSHOT_SPLIT)
    return rows.filter(F.col("updated_on") < split), rows.filter(F.col("updated_on") >= split)


def snapshot_merge(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.snapshot_merge(*_snapshots(spark, sf))


def snapshot_update(spark: SparkSession, sf: str) -> DataFrame:
    """The history stored, then replaced by its merge with the captured statements."""
    path = storage.new_folder(spark, "snapshot")
    history, _ = _snapshots(spark, sf)
    storage.publish(history.select("updated_on", "data", "tipo", "valor"), path)
    captured = fx.captured_text(spark, sf).filter(F.col("updated_on") >= F.lit(fx.SNAPSHOT_SPLIT))
    return jobs.update_snapshot(spark, captured, path, fx.SNAPSHOT_AS_OF).snapshot


def _stored_snapshot(spark: SparkSession, sf: str) -> str:
    path = storage.new_folder(spark, "snapshot")
    storage.publish(fx.snapshot_rows(spark, sf).select("updated_on", "data", "tipo", "valor"), path)
    return path


def snapshot_empty_update(spark: SparkSession, sf: str) -> DataFrame:
    """The whole history, updated by a capture without rows: as it was."""
    none = fx.captured_text(spark, sf).filter("event_id IS NULL")
    return jobs.update_snapshot(spark, none, _stored_snapshot(spark, sf), fx.SNAPSHOT_AS_OF).snapshot


def snapshot_unreadable(spark: SparkSession, sf: str) -> DataFrame:
    """Labels that are no day: those captured in the first ten minutes of an hour tell the hour."""
    hour = F.concat(F.lit("since "), F.date_format("updated_on", "HH"), F.lit("h"))
    captured = fx.captured_text(spark, sf).withColumn(
        "label", F.when(F.minute("updated_on") < 10, hour).otherwise(F.col("label")))
    return jobs.update_snapshot(spark, captured, _stored_snapshot(spark, sf), fx.SNAPSHOT_AS_OF).unreadable


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "working_calendar": working_calendar,
    "next_business_day": next_business_day,
    "latest_index": latest_index,
    "index_with_forecast": index_with_forecast,
    "compound_return": compound_return,
    "purchase_log": purchase_log,
    "cycle_attribution": cycle_attribution,
    "classify_reversals": classify_reversals,
    "cycle_amounts": cycle_amounts,
    "cycle_remuneration": cycle_remuneration,
    "prior_row_cycle": prior_row_cycle,
    "issuer_daily_remuneration": issuer_daily_remuneration,
    "issuer_daily_remuneration_by_day": issuer_daily_remuneration_by_day,
    "previous_event_lookup": previous_event_lookup,
    "sub_issuer_dim": sub_issuer_dim,
    "card_expirations": card_expirations,
    "first_card_events": first_card_events,
    "card_events": card_events,
    "activity_delta": activity_delta,
    "holder_activity": holder_activity,
    "holder_balance": holder_balance,
    "densify_fill": densify_fill,
    "active_holders": active_holders,
    "active_holders_report": active_holders_report,
    "active_holders_incremental": active_holders_incremental,
    "card_balance_listing": card_balance_listing,
    "partner_list_check": partner_list_check,
    "card_collection": card_collection,
    "peak_balance": peak_balance,
    "balance_at_quarter": balance_at_quarter,
    "card_status": card_status,
    "reconcile_matched": reconcile_matched,
    "reconcile_only_partner": reconcile_only_partner,
    "reconcile_flag_unknown": reconcile_flag_unknown,
    "reconcile_only_own": reconcile_only_own,
    "divergence_report": divergence_report,
    "divergences_by_tree": divergences_by_tree,
    "issuer_divergences": issuer_divergences,
    "event_history": event_history,
    "event_history_partner": event_history_partner,
    "event_history_arrays": event_history_arrays,
    "explode_history": explode_history,
    "explode_history_zip": explode_history_zip,
    "resolve_holder": resolve_holder,
    "nominal_due": nominal_due,
    "acquirer_due": acquirer_due,
    "workspace_dim": workspace_dim,
    "factoring_flag": factoring_flag,
    "installment_fact": installment_fact,
    "created_rollup": created_rollup,
    "merchant_due_rollup": merchant_due_rollup,
    "acquirer_due_rollup": acquirer_due_rollup,
    "daily_receive_pay": daily_receive_pay,
    "receive_pay_incremental": receive_pay_incremental,
    "publish_roundtrip": publish_roundtrip,
    "signed_purchases": signed_purchases,
    "conversion_columns": conversion_columns,
    "enrich": enrich,
    "weekly_tpv": weekly_tpv,
    "normalise_decimals": normalise_decimals,
    "typed_dates": typed_dates,
    "apply_schema": apply_schema,
    "outer_union": outer_union,
    "stamp": stamp,
    "read_zipped_reports": read_zipped_reports,
    "parse_day_label": parse_day_labels,
    "parse_money": parse_money_texts,
    "collect_statements": collect_statements,
    "snapshot_merge": snapshot_merge,
    "snapshot_update": snapshot_update,
    "snapshot_empty_update": snapshot_empty_update,
    "snapshot_unreadable": snapshot_unreadable,
    "land_reports": land_reports,
    "landing_problems": landing_problems,
    "landing_lost_values": landing_lost_values,
} | store_queries.QUERIES


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries with their columns shown plainly."""

    def shown(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plain(query(spark, sf_dir))

    return {name: shown(query) for name, query in QUERIES.items()}
