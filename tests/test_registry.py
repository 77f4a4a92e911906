"""Every registered query against its SQL on the smallest tables."""

import re
from pathlib import Path

import pytest
from compare import connect, difference
from helpers import executed_plan

import __spark_entry__ as entry
from salesmart.oracles import ORACLES
from salesmart.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
# What these return is a plain scan of what they wrote.
SLOW = {"stream_cdc_to_lake", "lake_lifecycle", "mart_incremental"}


@pytest.fixture(scope="module")
def connection():
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert difference(spark, connection, name, FOLDER) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_plans_hold_no_python_and_no_cross_join(spark, name):
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    text = executed_plan(QUERIES[name](spark, FOLDER))
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", text)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
