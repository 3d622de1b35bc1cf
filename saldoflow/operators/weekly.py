"""Weekly purchase volume and its source rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import SAO_PAULO, local_date, week_start, weeks_between
from ..params import WeeklyRates

# Exchange spread for foreign purchases, before and from the date of change.
SPREAD_CHANGE = dt.date(2022, 3, 1)
SPREAD_BEFORE, SPREAD_SINCE = 0.04, 0.02

PASSED_ON = ["networkCurrencyCode", "issuerAmount", "networkAmount", "fee", "merchantFee", "cycle",
             "purchaseConfirmed", "merchantCategoryCode"]


def signed_purchases(log: DataFrame, tz: str = SAO_PAULO) -> DataFrame:
    """Purchase records of confirmed and reversed rows, reversals with negative amount."""
    sign = F.when(F.col("type") == "reversed", -1).otherwise(1)
    purchase = [F.col(f"purchase.{c}").alias(c) for c in
                ("subIssuerId", "holderId", "cardId", "merchantCurrencyCode", "purpose", "methodCode")]
    present = [c for c in PASSED_ON if c in log.columns]
    return log.filter(F.col("type").isin("confirmed", "reversed")).select(
        "type", "endToEndId", "walletId", "logCreated", *purchase,
        local_date(F.col("purchase.created"), tz).alias("purchaseCreated"),
        (sign * F.col("purchase.logAmount")).alias("logAmount"),
        *present,
    )


def conversion_columns(df: DataFrame, spread_change: dt.date = SPREAD_CHANGE) -> DataFrame:
    """Conversion rate, spread, fee in local currency and conciliation date."""
    rate = F.when(F.col("networkAmount") == 0, F.lit(0.0)).otherwise(
        F.round(F.col("issuerAmount") / F.col("networkAmount"), 4))
    spread = F.when(F.col("merchantCurrencyCode") == "BRL", F.lit(0.0)).when(
        F.to_date("purchaseConfirmed") < F.lit(spread_change), F.lit(SPREAD_BEFORE)).otherwise(F.lit(SPREAD_SINCE))
    conciliated = F.when(F.col("cycle") == 1, F.date_sub("purchaseConfirmed", 1)).otherwise(F.col("purchaseConfirmed"))
    return (
        df.withColumn("conversionRate", rate)
        .withColumn("spread", spread)
        .withColumn("purchaseConciliated", conciliated)
        .withColumn("feeBRL", F.round(F.col("fee") * F.col("conversionRate"), 2))
        .withColumn("conversionRateIssuer", F.round(F.col("conversionRate") * (1 + F.col("spread")), 4))
        .withColumnRenamed("merchantFee", "merchantFeeBRL")
        .drop("cycle")
    )


def enrich(df: DataFrame, holders: DataFrame, workspaces: DataFrame, cards: DataFrame,
           sub_issuers: DataFrame, categories: DataFrame) -> DataFrame:
    """Holder, workspace, card, sub-issuer and merchant category of each purchase.

    The purchases stay on the left of every join. Which dimension is broadcast is left to
    Spark, which knows their sizes: holders and cards grow with the business.
    """
    company = workspaces.select("workspaceId", "companyName", "companyTaxId")
    holder = holders.select(F.col("issuingHolderId").alias("holderId"), "workspaceId",
                            F.col("name").alias("holderName"), "centerId")
    card = cards.select(F.col("__key__.id").cast("string").alias("cardId"), "binId", F.col("type").alias("cardType"))
    sub_issuer = (
        sub_issuers.select(F.col("__key__.id").cast("string").alias("subIssuerId"), "workspaceId")
        .join(company.select("workspaceId", F.col("companyName").alias("subIssuerName")), "workspaceId", "left")
        .withColumnRenamed("workspaceId", "subIssuerWorkspaceId")
    )
    category = categories.select(F.col("code").alias("merchantCategoryCode"),
                                 F.col("number").alias("merchantCategoryNumber"))
    return (
        df.join(holder.join(company, "workspaceId", "left"), "holderId", "left")
        .join(card, "cardId", "left")
        .join(sub_issuer, "subIssuerId", "left")
        .join(category, "merchantCategoryCode", "left")
    )


def weekly_tpv(fact: DataFrame, as_of: dt.date, exclude_issuer: str, rates: WeeklyRates = WeeklyRates(),
               fee_per_trx: bool = False) -> DataFrame:
    """Volume, revenue and number of purchases per week, issuer, currency, purpose and card type.

    Weeks start on Sunday. The fixed fee counts once per row of the result, or once per
    purchase with ``fee_per_trx``. A purchase without currency is neither national nor
    international; one without issuer is left out.
    """
    week = week_start(F.col("purchaseCreated"))
    card_type = F.when(F.col("cardType") == "physical", "Physical").when(F.col("cardType") == "virtual", "Virtual")
    grouped = (
        fact.filter(F.col("subIssuerId") != exclude_issuer)
        .groupBy(week.alias("week"), "subIssuerName", "networkCurrencyCode", "purpose", card_type.alias("cardType"))
        .agg(F.sum("amount").alias("_cents"), F.count("issuingPurchaseId").alias("totalTRX"))
    )
    day = F.date_format("week", "dd/MMM")
    text = F.concat(day, F.lit(" to "), F.date_format(F.date_add("week", 6), "dd/MMM"))
    national = F.col("networkCurrencyCode") == "BRL"
    international = F.col("networkCurrencyCode") != "BRL"
    volume = F.col("_cents") / 100
    fees = F.col("totalTRX") if fee_per_trx else F.lit(1)
    local = F.col("_cents") * rates.national_rate / 100 + fees * rates.national_fee
    foreign = F.col("_cents") * rates.international_rate / 100 + fees * rates.international_fee
    return grouped.select(
        F.col("week"),
        weeks_between(F.lit(as_of), F.col("week")).alias("weeksAgo"),
        text.alias("weekText"),
        F.concat(weeks_between(F.lit(as_of), F.col("week")).cast("string"), F.lit(". "), text).alias("weekLabel"),
        "subIssuerName",
        "networkCurrencyCode",
        "purpose",
        "cardType",
        F.when(national, volume).alias("nationalTPV"),
        F.when(international, volume).alias("internationalTPV"),
        F.when(national, local).alias("nationalRevenue"),
        F.when(international, foreign).alias("internationalRevenue"),
        F.when(national, F.col("totalTRX")).alias("nationalTRX"),
        F.when(international, F.col("totalTRX")).alias("internationalTRX"),
        volume.alias("totalTPV"),
        F.when(national, local).when(international, foreign).alias("totalRevenue"),
        "totalTRX",
    )
