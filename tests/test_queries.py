"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
#: What looks up one order, which only larger tables have.
LOOKUPS = {"order_status": "/root/testdata/sf0.01"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    folder = LOOKUPS.get(name, FOLDER)
    assert compare(spark, con if folder == FOLDER else connect(folder), folder, name) is None


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_plans_push_filters_and_columns_down(spark, capsys):
    queries()["order_book_l2"](spark, FOLDER).explain("formatted")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "o_comment" not in plan and "PushedFilters" in plan
