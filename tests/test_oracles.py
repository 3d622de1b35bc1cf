"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import oracle
from __spark_entry__ import entry
from saldoflow.plans.oracles import ORACLES
from saldoflow.plans.queries import registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registered()) == set(ORACLES)


def test_entry_is_the_flagship(spark):
    assert "remuneration" in entry(spark).columns
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, con, name):
    assert oracle.difference(registered()[name](spark, SF_DIR), con, ORACLES[name]) is None
