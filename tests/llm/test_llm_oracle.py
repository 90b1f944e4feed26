"""Registered queries of the subpackage against their oracles, or against plain versions."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from brute import components
from compare import connect, differences
from tabclean.llm.registered import load

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_all_are_registered():
    assert set(load()[0]) | {"pipeline"} <= set(queries())
    assert set(load()[1]) <= set(oracle_sql())
    assert len(load()[0]) == 13


@pytest.mark.parametrize("key", sorted(load()[1]))
def test_query(spark, con, key):
    assert differences(queries()[key](spark, FOLDER), con, load()[1][key]) is None


def test_near_duplicates_against_brute_force(spark):
    docs = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())
    want = components(docs, 4)
    rows = queries()["op5_minhash"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_pipeline_keeps_what_it_should(spark):
    rows = queries()["pipeline"](spark, FOLDER).collect()
    assert 0 < len(rows) <= 200
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
