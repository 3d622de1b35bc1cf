import pytest
from pyspark.sql import functions as F

from saldoflow.operators import digest_tree, reconcile


def cards(spark, ids):
    return spark.createDataFrame([(None if i is None else f"card{i}",) for i in ids], "issuingCardId string")


def inputs(spark, own, listed):
    balances = spark.createDataFrame([(f"card{i}", b, k) for i, b, k in own], "issuingCardId string, balance long, cardType string")
    status = spark.createDataFrame([(f"card{i}", "active") for i, _, _ in own if i % 3], "issuingCardId string, status string")
    return balances.withColumn("subIssuerName", F.lit("n")), cards(spark, listed), status


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("leaf_rows", [1, 4, 10**9])
@pytest.mark.parametrize("unknown", ["drop", "flag"])
def test_equal_to_the_join(spark, leaf_rows, unknown):
    own = [(i, [1, 0, -1, 2, None][i % 5] if i % 50 < 5 else 1, k) for i in range(600) for k in ("virtual", "physical")[:1 + i % 2]]
    listed = [*range(0, 560), *range(0, 560, 7), 9001, 9002, None, None]  # repeats, unknown cards, no card
    args = inputs(spark, own, listed)
    want = rows(reconcile.divergences(reconcile.compare(*args, unknown=unknown)))
    assert len(want) > 40
    assert rows(reconcile.divergences_by_tree(*args, unknown=unknown, leaf_rows=leaf_rows)) == want


@pytest.mark.parametrize("own, listed", [([], []), ([], [1, 2]), ([(1, 1, "virtual"), (2, 0, "virtual")], []),
                                         ([(1, 1, "virtual"), (2, 1, "virtual")], [2, 1])])
def test_empty_and_equal_lists(spark, own, listed):
    args = inputs(spark, own, listed)
    assert rows(reconcile.divergences_by_tree(*args)) == rows(reconcile.divergences(reconcile.compare(*args)))


def test_few_differences_leave_few_rows(spark):
    n = 60_000  # 0.1 % are missing from the list
    own = spark.range(n).select(F.concat(F.lit("card"), "id").alias("issuingCardId"))
    listed = spark.range(n).filter("id % 1000 <> 7").select(F.concat(F.lit("card"), "id").alias("issuingCardId"))
    found = digest_tree.suspects(own, listed, "issuingCardId")
    left = found.of(own, "issuingCardId")
    assert n // 1000 <= left.count() < n / 10
    missing = left.join(found.of(listed, "issuingCardId"), "issuingCardId", "left_anti")
    assert sorted(r[0] for r in missing.collect()) == sorted(f"card{i}" for i in range(7, n, 1000))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(issuingCardId" not in plan  # rows of equal leaves are never shuffled
