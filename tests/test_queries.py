"""Every registered query against its SQL check, on whole tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from pairloom.plans.registry import CHECKS, PLANS


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_every_query_has_a_check():
    assert set(PLANS) == set(CHECKS)
    assert set(PLANS) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query(spark, folder, connection, name):
    assert difference(PLANS[name](spark, folder), connection, CHECKS[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "id", "freq"] and df.count() > 0
