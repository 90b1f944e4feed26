"""Every registered query against its oracle at the smallest scale."""

import pytest

from __spark_entry__ import entry, queries
from compare import connect, differences
from tabclean.catalog import load

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    own, oracles = load()
    assert set(own) <= set(queries())
    assert set(own) - set(oracles) == ROWS_ONLY


@pytest.mark.parametrize("key", sorted(load()[1]))
def test_query(spark, con, key):
    assert differences(queries()[key](spark, FOLDER), con, load()[1][key], loose=True) is None


def test_full_neighbour_plan_leaves_no_gap(spark):
    out = queries()["clean_sales_knn"](spark, FOLDER)
    assert out.where("Color IS NULL OR Interior IS NULL").count() == 0


def test_entry(spark):
    assert entry(spark).count() > 0
