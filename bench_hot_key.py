"""Times the jobs that may meet a hot key, on generated logs; prints one JSON line.

BENCH_ROWS rows (20 million by default), a third of them of one purchase, or of one card and one
holder; BENCH_CPUS local cores. Broadcasts are limited to 1 MB, as if all tables were large.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldoflow.operators import cards, purchases, reconcile
from saldoflow.plans import fixtures as fx


def purchase_log(spark: SparkSession, rows: int) -> DataFrame:
    """A third of the rows is one purchase; every tenth row stands at one instant."""
    n = F.col("id")
    start = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    seconds = F.when(n % 10 == 0, 3600).otherwise((n * 17) % (29 * 86400))
    log = spark.range(0, rows, 1, 32).select(
        F.when(n % 3 == 0, "hot").otherwise(F.md5((n % (rows // 20 + 1)).cast("string"))).alias("endToEndId"),
        F.md5(n.cast("string")).alias("issuingPurchaseLogId"),
        (start + F.make_dt_interval(secs=seconds)).alias("logTime"),
        F.when(F.xxhash64(n) % 2 == 0, "confirmed").otherwise("reversed").alias("type"),
        (n % 1000).alias("logAmount"), F.lit("x").alias("subIssuerTaxId"))
    confirmed = F.when(F.col("type") == "confirmed", F.col("logTime"))
    return log.withColumns({"logDate": F.to_date("logTime"), "confirmedTime": confirmed, "purchaseConfirmed": F.to_date(confirmed)})


def card_log(spark: SparkSession, rows: int) -> DataFrame:
    """A third of the rows is one card of one holder."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(0)).otherwise(n % (rows // 10 + 1))
    at = F.to_timestamp_ntz(F.lit("1995-01-01 00:00:00")) + F.make_dt_interval(secs=(n * 31) % (6 * 365 * 86400))
    return spark.range(0, rows, 1, 32).select(
        key.cast("string").alias("issuingCardId"), F.when(key % 2 == 0, "physical").otherwise("virtual").alias("cardType"),
        F.element_at(F.array(*[F.lit(x) for x in cards.EVENT_TYPES]), (n % 3 + 1).cast("int")).alias("type"),
        at.alias("logCreated"), at.alias("created"), F.to_date(at).alias("expiration"),
        (key % 1000).cast("string").alias("issuingHolderId"), (key % 25).cast("string").alias("subIssuerTaxId"))


def main(scratch: str) -> None:
    rows, cpus = int(os.environ.get("BENCH_ROWS", "20000000")), os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench hot key")
        .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.autoBroadcastJoinThreshold", "1m").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{scratch}/shared").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    purchase_log(spark, rows).write.parquet(f"{scratch}/purchases")
    card_log(spark, rows // 2).write.parquet(f"{scratch}/cards")
    log, events = spark.read.parquet(f"{scratch}/purchases"), spark.read.parquet(f"{scratch}/cards")
    divergent = events.select("issuingCardId").distinct().select(
        "issuingCardId", F.lit(None).cast("string").alias("origin"), F.lit(1).cast("long").alias("balance"),
        F.lit("physical").alias("cardType"), F.lit("active").alias("status"))
    jobs = {
        "cycle_amounts": purchases.cycle_amounts(log, fx.REMUNERATION),
        "previous_event_lookup": purchases.previous_event_lookup(log),
        "previous_row_amounts": purchases.previous_row_amounts(log, fx.REMUNERATION),
        "holder_activity": cards.holder_activity(cards.activity_delta(cards.card_events(events, fx.CARDS_END))),
        "event_history": reconcile.event_history(divergent, events, "own"),
    }
    seconds = {}
    for name, df in jobs.items():
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 2)
    spark.stop()
    print(json.dumps({"metric": "hot_key_seconds", "rows": rows, "cpus": int(cpus), "queries": seconds}))


if __name__ == "__main__":
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        main(folder)
