"""Joins and components in which one key holds most rows."""

import random

import pytest

from tabclean.llm import skew
from tabclean.llm.components import connected_components


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "LEAST_ROWS", 50)
    rows = [(i, None if i % 7 == 0 else 1 if i % 3 else i % 40) for i in range(2000)]
    fact = spark.createDataFrame(rows, "id long, k long")
    dim = spark.createDataFrame([(k, str(k)) for k in range(0, 40, 1) if k != 5], "k long, v string")
    assert skew.heavy_keys(fact, "k") == [1]
    got = sorted((r.id, r.v) for r in skew.spread_join(fact, dim, "k", how, spread_by="id").collect())
    want = sorted((r.id, r.v) for r in fact.join(dim, "k", how).collect())
    assert got == want


def test_components_of_stars_chains_and_loops(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_ROWS", 50)
    rng = random.Random(1)
    edges = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000), (299, 700)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    rng.shuffle(edges)
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {x: root(x) for x in parent}
