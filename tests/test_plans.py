"""Properties of the plans that matter once the tables are large."""

import re

import pytest
from pyspark.sql import functions as F

from saldoflow.operators import cards, dims, purchases, receivables, reconcile
from saldoflow.operators.joins import join_splittable
from saldoflow.plans import fixtures as fx
from saldoflow.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture()
def large_table_settings(spark):
    """No broadcasts, and small thresholds, so that small data is treated like large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    assert not re.search("CartesianProduct|NestedLoopJoin", plan(QUERIES[name](spark, SF_DIR)))


def hot_log(spark, rows=150_000):
    """A purchase log in which one purchase holds a third of the rows."""
    start = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    n = F.col("id")
    return spark.range(0, rows, 1, 8).select(
        F.when(F.rand(1) < 0.33, F.lit("hot")).otherwise(F.md5((n % 5000).cast("string"))).alias("endToEndId"),
        F.md5(n.cast("string")).alias("issuingPurchaseLogId"),
        (start + F.make_dt_interval(secs=(n * 17) % (29 * 86400))).alias("logTime"),
        F.when(F.rand(2) < 0.5, "confirmed").otherwise("reversed").alias("type"),
        (n % 1000).alias("logAmount"),
        F.lit(None).cast("date").alias("purchaseConfirmed"),
        F.lit("x").alias("subIssuerTaxId"),
    ).withColumn("logDate", F.to_date("logTime"))


def test_hot_purchase_is_split(spark, large_table_settings):
    log = hot_log(spark)
    amounts = purchases.cycle_amounts(log, fx.REMUNERATION)
    assert "skew=true" in final_plan(amounts)
    known = log.filter("type = 'confirmed'").agg(F.sum("logAmount")).collect()[0][0]
    assert amounts.agg(F.sum("confirmedAmount")).collect()[0][0] == known


def test_hot_key_is_split_against_an_aggregated_side(spark, large_table_settings):
    log = hot_log(spark)
    totals = log.groupBy("endToEndId").agg(F.count(F.lit(1)).alias("n"))
    joined = join_splittable(log, totals, ["endToEndId"]).groupBy("endToEndId").agg(
        F.max("n").alias("n"), F.max("issuingPurchaseLogId").alias("x"))
    assert "skew=true" in final_plan(joined)
    assert joined.agg(F.sum("n")).collect()[0][0] == log.count()


def test_rows_of_one_instant_are_split(spark, large_table_settings):
    """A third of the log is one purchase at one instant, as a bulk load may write it."""
    log = hot_log(spark).withColumn("logTime", F.when(
        F.col("endToEndId") == "hot", F.to_timestamp_ntz(F.lit("2024-01-05 10:00:00"))).otherwise(F.col("logTime")))
    log = log.withColumn("logDate", F.to_date("logTime"))
    found = purchases.previous_event_lookup(log)
    window = re.findall(r"Window \[.*?\], \[(_part)#", final_plan(found))
    assert window  # rows are windowed by part, never by purchase
    hot = found.filter("endToEndId = 'hot'")
    n = log.filter("endToEndId = 'hot' and type = 'reversed'").count()
    last = log.filter("endToEndId = 'hot' and type = 'confirmed'").agg(F.max("issuingPurchaseLogId")).collect()[0][0]
    assert hot.agg(F.max("rowNumber")).collect()[0][0] == n
    assert [r[0] for r in hot.select("previousLogId").distinct().collect()] == [last]


def test_issuer_rows_are_split(spark, large_table_settings):
    log = hot_log(spark).withColumn("subIssuerTaxId", F.when(F.col("endToEndId") == "hot", "x").otherwise(F.col("endToEndId")))
    names = log.select("subIssuerTaxId", F.lit("X").alias("subIssuerName")).distinct()
    assert "skew=true" in final_plan(cards.of_issuer(log, names, "X"))


def test_history_reads_the_log_once(spark, large_table_settings, tmp_path):
    fx.card_log(spark, SF_DIR).write.parquet(f"{tmp_path}/log")
    QUERIES["divergence_report"](spark, SF_DIR).write.parquet(f"{tmp_path}/divergent")
    log, divergent = spark.read.parquet(f"{tmp_path}/log"), spark.read.parquet(f"{tmp_path}/divergent")
    text = final_plan(reconcile.event_history(divergent, log, "own"))
    assert len(re.findall(r"FileScan parquet [^\n]*/log\]", text)) == 1


def test_plans_are_built_without_running_jobs(spark):
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        fact = QUERIES["installment_fact"](spark, SF_DIR)
        rollup = receivables.dated_rollup(fact)
        receivables.daily_receive_pay(rollup, fx.workspaces(spark, SF_DIR))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_join_splittable_ignores_missing_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert sorted(tuple(r) for r in join_splittable(left, right, ["k"], "inner").collect()) == [("a", 2, 20)]
    assert {r["v"]: r["w"] for r in join_splittable(left, right, ["k"]).collect()} == {1: None, 2: 20}


def test_confirmations_are_aggregated_once(spark):
    amounts = QUERIES["cycle_amounts"](spark, SF_DIR)
    assert "ReusedExchange" in final_plan(amounts)


def test_dimension_rows_are_limited_below_the_shuffle(spark):
    rows = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    text = plan(dims.dedupe_dim(rows, "k", [F.col("v")]))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


def test_card_log_is_shuffled_once(spark, large_table_settings):
    log = fx.card_log(spark, SF_DIR).select("*")  # its own joins are no part of the operators
    log.write.mode("overwrite").format("noop").save()
    fixture = plan(log).split("== Initial Plan ==")[-1].count("Exchange hashpartitioning")
    deltas = plan(QUERIES["activity_delta"](spark, SF_DIR)).split("== Initial Plan ==")[-1]
    assert deltas.count("Exchange hashpartitioning") == fixture + 1


def test_ranges_reach_the_scan(spark):
    events = fx.table(spark, SF_DIR, "events").select(
        F.col("ts").alias("logCreated"), F.lit("confirmed").alias("type"), F.lit("purchase").alias("purpose"),
        F.lit("BRL").alias("merchantCurrencyCode"), F.col("user_id").alias("endToEndId"),
        F.col("event_id").alias("issuingPurchaseLogId"), F.col("user_id").alias("issuingCardId"),
        F.col("event_id").alias("logAmount"), F.col("ts").alias("purchaseConfirmed"))
    text = plan(purchases.purchase_log(events, fx.purchase_cards(spark, SF_DIR), fx.REMUNERATION))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2024-01-01T00:00\), LessThan\(ts,2024-01-31T00:00\)", text)
    fact = QUERIES["installment_fact"](spark, SF_DIR)
    assert re.search(r"GreaterThanOrEqual\(l_shipdate,2000-09-04T03:00", fact._jdf.queryExecution().toString())
