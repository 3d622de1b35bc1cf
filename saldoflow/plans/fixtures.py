"""The test tables seen as the entities of the jobs.

Every mapping is a projection of whole tables; ``oracles`` states the same in SQL.
"""

from __future__ import annotations

import datetime as dt
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import ReceivablesParams, RemunerationParams

D = dt.date

# Terms used on the test tables, whose events cover January 2024.
REMUNERATION = RemunerationParams(
    start=D(2024, 1, 8), end=D(2024, 1, 30), as_of=D(2024, 1, 20),
    exclude_issuer="0", due_days=5, settlement_days=7,
)
CARDS_END = D(2001, 8, 1)
CARDS_CUTOFF = D(2000, 1, 1)
CARDS_ISSUER = "NATION_3"
RECEIVABLES = ReceivablesParams(start=D(2000, 9, 4), end=D(2001, 11, 4), excluded_companies=("0", "1"))
WEEKLY_AS_OF = D(2001, 8, 1)
SNAPSHOT_SPLIT = D(2024, 1, 16)
SNAPSHOT_AS_OF = D(2024, 1, 31)


@cache
def _table_schema(path: str) -> T.StructType:
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is inferred once per process, a query may read it often."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_table_schema(path)).parquet(path)


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("long")


# --- purchases -----------------------------------------------------------------------------

def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A holiday per nation, every fifth day from 2024 on."""
    return table(spark, sf_dir, "nation").select(
        F.date_add(F.lit(D(2024, 1, 1)), 5 * F.col("n_nationkey").cast("int")).alias("holidayDate"),
        F.col("n_name").alias("holidayName"))


def daily_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factor per weekday that is no holiday, up to 2024-01-20, from the number of views.

    The days after it have no factor on purpose: they are forecast.
    """
    views = table(spark, sf_dir, "events").filter(
        (F.col("event_type") == "view") & (F.col("ts") < F.lit(D(2024, 1, 21)))
    ).groupBy(F.date_trunc("day", "ts").alias("referenceDate")).agg(
        (1 + F.count(F.lit(1)) / F.lit(100000.0)).alias("value"))
    closed = holidays(spark, sf_dir).select("holidayDate")
    open_days = views.filter(~F.dayofweek("referenceDate").isin(1, 7))
    return open_days.join(closed, F.to_date("referenceDate") == F.col("holidayDate"), "left_anti")


def purchase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    confirmed = F.col("event_type") == "purchase"
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("endToEndId"),
        F.col("event_id").cast("string").alias("issuingPurchaseLogId"),
        F.col("user_id").cast("string").alias("issuingCardId"),
        F.col("ts").alias("logCreated"),
        F.when(confirmed, "confirmed").when(F.col("event_type") == "error", "reversed")
        .otherwise(F.col("event_type")).alias("type"),
        cents(F.col("value")).alias("logAmount"),
        F.when(F.col("value") < 5, "withdrawal").otherwise("purchase").alias("purpose"),
        F.when(F.col("value") > 200, "USD").otherwise("BRL").alias("merchantCurrencyCode"),
        F.when(confirmed, F.col("ts")).alias("purchaseConfirmed"),
    )


def purchase_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("issuingCardId"),
        F.col("c_nationkey").cast("string").alias("subIssuerTaxId"),
    )


def sub_issuers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("subIssuerTaxId"),
        F.col("n_name").alias("subIssuerName"),
    )


# --- cards ---------------------------------------------------------------------------------

def card_type(priority: str = "o_orderpriority") -> Column:
    return F.when(F.col(priority).isin("1-URGENT", "3-MEDIUM", "5-LOW"), "physical").otherwise("virtual")


def card_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as card events: an order is a card, its customer the holder."""
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("issuingCardId"),
        card_type().alias("cardType"),
        F.when(F.col("l_returnflag") == "N", "created").when(F.col("l_returnflag") == "R", "unblocked")
        .otherwise("canceled").alias("type"),
        F.col("l_shipdate").alias("logCreated"),
        F.col("o_orderdate").alias("created"),
        F.add_months(F.to_date("o_orderdate"), 36).alias("expiration"),
        F.col("o_custkey").cast("string").alias("issuingHolderId"),
        F.col("c_nationkey").cast("string").alias("subIssuerTaxId"),
    )


def partner_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards the partner lists: those of all orders but the ones of low priority."""
    return table(spark, sf_dir, "orders").filter("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").cast("string").alias("issuingCardId"))


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.struct(F.col("o_orderkey").alias("id")).alias("__key__"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created"),
        F.col("o_orderpriority").alias("binId"),
        card_type().alias("type"),
    )


# --- receivables ---------------------------------------------------------------------------

def acquiring_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One holiday per nation and year, 1995 to 2003."""
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").withColumn(
        "year", F.explode(F.sequence(F.lit(1995), F.lit(2003)))
    ).select(F.make_date("year", 1 + n % 12, 1 + n).alias("holidayDate"), F.col("n_name").alias("holidayName"))


def _line_id() -> Column:
    """Unique per line item; order and line number alone are not."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       F.to_date("l_shipdate").cast("string"))


def _line_due() -> Column:
    return F.col("l_shipdate") + F.make_dt_interval(30 * F.col("l_linenumber"))


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    price = F.col("l_extendedprice")
    fee = cents(price * F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.struct(_line_id().alias("id")).alias("__key__"),
        F.col("l_orderkey").cast("string").alias("purchaseId"),
        F.col("l_shipdate").alias("created"),
        _line_due().alias("due"),
        F.col("o_orderpriority").alias("network"),
        F.col("l_suppkey").cast("string").alias("workspaceId"),
        F.col("l_linestatus").alias("status"),
        cents(price).alias("amount"),
        F.when(fee != 0, fee).alias("fee"),
        F.when(F.col("l_quantity") >= 46, F.array(F.lit("x"), F.lit("contract-chunk-1")))
        .when(F.col("l_quantity") <= 5, F.array().cast("array<string>")).alias("tags"),
    )


def installment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A "created" row per line item, and a "settled" one for those of status F."""
    types = F.when(F.col("l_linestatus") == "F", F.array(F.lit("created"), F.lit("settled"))).otherwise(
        F.array(F.lit("created")))
    return table(spark, sf_dir, "lineitem").withColumn("due", _line_due()).select(
        _line_id().alias("installmentId"),
        F.explode(types).alias("type"),
        F.struct("due", F.col("l_shipdate").alias("created")).alias("installment"),
    )


def merchant_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    funding = F.when(F.col("o_orderpriority") == "1-URGENT", "credit").when(
        F.col("o_orderpriority") == "2-HIGH", "debit").when(F.col("o_orderpriority") == "3-MEDIUM", "prepaid")
    return table(spark, sf_dir, "orders").select(
        F.struct(F.col("o_orderkey").alias("id")).alias("__key__"),
        F.concat(F.lit("e"), F.col("o_orderkey").cast("string")).alias("endToEndId"),
        funding.otherwise("other").alias("fundingType"),
        F.when(F.col("o_orderstatus") == "P", "voided").otherwise("confirmed").alias("status"),
    )


def acquiring_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    denied = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("e"), F.col("o_orderkey").cast("string")).alias("endToEndId"),
        cents(F.col("o_totalprice")).alias("amount"),
        F.when(F.col("o_orderstatus") == "P", "voided").when(denied, "denied").otherwise("confirmed").alias("status"),
    )


def acquiring_installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").filter("l_returnflag <> 'R'").groupBy(
        F.col("l_orderkey").cast("string").alias("purchaseId"), _line_due().alias("due")
    ).agg(F.sum(cents(F.col("l_extendedprice") * F.col("l_tax"))).alias("externalFee"))


def workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("workspaceId"),
        F.col("s_nationkey").cast("string").alias("companyTaxId"),
        F.col("s_name").alias("companyName"),
        F.lit(dt.datetime(1995, 1, 1)).cast("timestamp_ntz").alias("workspaceCreated"),
    )


# --- weekly report -------------------------------------------------------------------------

def _orders_of_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def _currency() -> Column:
    return F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", None).when(
        F.col("n_regionkey").isin(0, 3), "USD").otherwise("BRL")


def purchase_conciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_of_nations(spark, sf_dir).select(
        F.to_date("o_orderdate").alias("purchaseCreated"),
        F.col("c_nationkey").cast("string").alias("subIssuerId"),
        F.col("n_name").alias("subIssuerName"),
        _currency().alias("networkCurrencyCode"),
        F.col("c_mktsegment").alias("purpose"),
        F.when(F.col("o_orderstatus") == "F", "physical").when(F.col("o_orderstatus") == "O", "virtual")
        .otherwise("combo").alias("cardType"),
        cents(F.col("o_totalprice")).alias("amount"),
        F.col("o_orderkey").cast("string").alias("issuingPurchaseId"),
    )


def purchase_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase log with the nested record."""
    price = cents(F.col("o_totalprice"))
    return _orders_of_nations(spark, sf_dir).select(
        F.when(F.col("o_orderstatus") == "O", "confirmed").when(F.col("o_orderstatus") == "P", "reversed")
        .otherwise("approved").alias("type"),
        F.col("o_orderkey").cast("string").alias("endToEndId"),
        F.lit(None).cast("string").alias("walletId"),
        F.col("o_orderdate").alias("logCreated"),
        F.struct(
            F.col("c_nationkey").cast("string").alias("subIssuerId"),
            F.col("o_custkey").cast("string").alias("holderId"),
            F.col("o_orderkey").cast("string").alias("cardId"),
            F.col("o_orderdate").alias("created"),
            _currency().alias("merchantCurrencyCode"),
            price.alias("logAmount"),
            F.col("c_mktsegment").alias("purpose"),
            F.col("o_orderpriority").alias("methodCode"),
        ).alias("purchase"),
        _currency().alias("networkCurrencyCode"),
        price.alias("issuerAmount"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", 0).otherwise(F.floor(price / 5)).cast("long").alias("networkAmount"),
        F.floor(price / 100).cast("long").alias("fee"),
        F.floor(price / 200).cast("long").alias("merchantFee"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).cast("long").alias("cycle"),
        F.date_add(F.to_date("o_orderdate"), 1).alias("purchaseConfirmed"),
        F.col("c_mktsegment").alias("merchantCategoryCode"),
    )


def corporate_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("issuingHolderId"),
        F.col("c_nationkey").cast("string").alias("workspaceId"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("centerId"),
    )


def nation_workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("workspaceId"),
        F.col("n_name").alias("companyName"),
        F.col("n_regionkey").cast("string").alias("companyTaxId"),
    )


def raw_sub_issuers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.struct(F.col("n_nationkey").alias("id")).alias("__key__"),
        F.col("n_nationkey").cast("string").alias("workspaceId"),
    )


def merchant_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("code")).agg(
        F.min("c_custkey").cast("string").alias("number"))


# --- settlement reports --------------------------------------------------------------------

def brazilian(amount: Column) -> Column:
    """1.234,56 as in the reports."""
    return F.translate(F.format_number(amount, 2), ",.", ".,")


def _report_date() -> Column:
    return F.when(F.col("l_tax") == 0, "xx").otherwise(F.date_format("l_shipdate", "dd/MM/yyyy"))


def report_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as text of one report file."""
    return table(spark, sf_dir, "lineitem").select(
        _line_id().alias("NSU_CV"),
        F.col("l_linenumber").cast("string").alias("parcela"),
        _report_date().alias("data_original_da_venda"),
        brazilian(F.col("l_extendedprice")).alias("valor_bruto_da_parcela_original"),
        F.col("l_linestatus").alias("status"),
    )


def report_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as text of a file of the same kind with other columns."""
    net = cents(F.col("l_extendedprice") * (1 - F.col("l_discount"))) / 100
    return table(spark, sf_dir, "lineitem").select(
        _line_id().alias("NSU_CV"),
        _report_date().alias("data_do_recebimento"),
        brazilian(net).alias("valor_liquido_da_parcela"),
        F.col("l_returnflag").alias("bandeira"),
    )


# --- snapshots -----------------------------------------------------------------------------

def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases are realised amounts and all other events forecasts, due up to three days later."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("updated_on"),
        F.date_add(F.to_date("ts"), F.floor(F.hour("ts") / 6).cast("int")).alias("data"),
        F.when(F.col("event_type") == "purchase", "realizado").otherwise("previsto").alias("tipo"),
        cents(F.col("value")).alias("valor"),
        F.col("event_id"),
    )


def captured_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot rows as page text, their dates 20 days earlier."""
    from ..functions.text import MONTHS

    day = F.date_sub("data", 20)
    name = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(day))
    return snapshot_rows(spark, sf_dir).select(
        "event_id",
        "updated_on",
        F.when(F.col("tipo") == "realizado", "realised").otherwise("forecast").alias("kind"),
        F.concat(F.lit("dia "), F.date_format(day, "dd"), F.lit("/"), F.initcap(name)).alias("label"),
        F.concat(F.lit("R$ "), brazilian(F.col("valor") / 100)).alias("value"),
    )
