"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from ledgerloom.plans.registry import OPERATORS
from oracles.sql import oracle_texts
from tests.compare import differences, duck

QUERIES, ORACLES = entry.queries(), oracle_texts()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert {*OPERATORS, "price_metrics_stream", "price_sheet_import"} == set(ORACLES)
    assert set(ORACLES) <= set(QUERIES) and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_comparison_sees_differences(spark, sf_dir, con):
    changed = ORACLES["credit_limit"].replace("sum(credit_limit)", "max(credit_limit)")
    assert differences(QUERIES["credit_limit"](spark, sf_dir), con, changed)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
