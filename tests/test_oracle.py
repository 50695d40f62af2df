"""Registered queries against their SQL on the smallest tables.

A selection by default; REFISCOPE_ALL=1 runs every query.
"""

import os

import pytest
from conftest import SF

import __spark_entry__ as entry
from oracle_check import compare, connect

SELECTED = ["silver_loans", "market_rates_standardized", "loan_current_state", "maturity_wall", "quality_gate_raw_loans", "training_frame",
            "stress_summary", "survival_predictions", "overwrite_one_partition_twice", "streamed_snapshot_history"]
NAMES = list(entry.oracle_sql()) if os.environ.get("REFISCOPE_ALL") else SELECTED


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
