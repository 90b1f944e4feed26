"""The queries of the library load without the optional ones."""

import sys

import pytest

import __spark_entry__ as entry
from tabclean.catalog import load


@pytest.mark.parametrize("hidden", [["xxhash"], ["tabclean.llm.registered"], ["corpus_pipeline"]])
def test_hidden_modules(monkeypatch, hidden):
    for name in [n for n in sys.modules if n.startswith("tabclean.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    for name in hidden:
        monkeypatch.setitem(sys.modules, name, None)
    assert set(load()[0]) <= set(entry.queries()) and "pipeline" not in entry.queries()
    assert set(load()[1]) <= set(entry.oracle_sql())
