"""Whole jobs that write what they compute."""

from pyspark.sql import functions as F

from saldoflow.operators import reconcile
from saldoflow.plans import fixtures as fx
from saldoflow.plans import jobs
from saldoflow.plans.queries import QUERIES, _receivables_tables
from saldoflow.sources.storage import read_table

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_receive_pay_is_published_by_date(spark, tmp_path):
    tables = _receivables_tables(spark, SF_DIR)
    workspaces = tables.workspaces.filter("workspaceId = '3'")
    tables = jobs.ReceivablesTables(**{**tables.__dict__, "workspaces": workspaces})
    path = str(tmp_path / "receive_pay")
    published = jobs.receive_pay(spark, tables, fx.RECEIVABLES, path)
    assert rows(published) == rows(jobs.receive_pay(spark, tables, fx.RECEIVABLES))
    assert any(p.name.startswith("referenceDate=") for p in (tmp_path / "receive_pay").glob("version-*/*"))


def test_divergences_are_published_with_histories(spark, tmp_path):
    log, partner = fx.card_log(spark, SF_DIR), fx.partner_cards(spark, SF_DIR)
    compared = jobs.card_comparison(log, fx.sub_issuers(spark, SF_DIR), fx.raw_cards(spark, SF_DIR), partner,
                                    fx.CARDS_ISSUER, fx.CARDS_END, fx.CARDS_CUTOFF)
    paths = jobs.publish_divergences(compared, log, str(tmp_path))
    read = {name: read_table(spark, path) for name, path in paths.items()}
    assert rows(read["divergences"]) == rows(QUERIES["issuer_divergences"](spark, SF_DIR))
    assert read["matched"].count() > 0
    sides = read["history_own"].unionByName(read["history_partner"]).select("issuingCardId").distinct().count()
    assert sides == read["divergences"].count()
    canceled = reconcile.explode_history(read["history_own"])
    assert rows(read["canceled"]) == rows(canceled)


def test_matched_and_divergent_cards_cover_the_known_list(spark):
    known = QUERIES["balance_at_quarter"](spark, SF_DIR).filter(F.col("balance").isNotNull()).select("issuingCardId")
    listed = fx.partner_cards(spark, SF_DIR).join(known, "issuingCardId")
    matched = QUERIES["reconcile_matched"](spark, SF_DIR).select("issuingCardId")
    inactive = QUERIES["reconcile_only_partner"](spark, SF_DIR).select("issuingCardId")
    assert matched.intersect(inactive).count() == 0
    assert rows(matched.union(inactive)) == rows(listed.distinct())
