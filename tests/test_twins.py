"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(entry.ENTRIES)
# No project of the smallest tables has that many audits; every other query has rows there.
EMPTY = {"audited_projects"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, con, name):
    problem = compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])
    assert problem is None or (name in EMPTY and problem == "both results are empty"), problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0
