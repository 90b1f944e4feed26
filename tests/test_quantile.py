"""Exact quantiles against numpy."""

import numpy as np
import pytest

from tabclean.operators import quantile
from tabclean.operators.quantile import group_quantiles, quantile_values

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
NAMES = [f"p{i}" for i in range(len(PROBS))]


@pytest.fixture(params=[3, 100_000], ids=["grids", "buckets"])
def limit(request, monkeypatch):
    monkeypatch.setattr(quantile, "CELL_VALUES", request.param)


def groups():
    rng = np.random.default_rng(7)
    return {
        "normal": rng.normal(0, 1, 999),
        "wide": np.exp(rng.normal(0, 40, 500)),
        "hot value": np.array([5.0] * 700 + [6.0, 7.0, -1.0]),
        "single": np.array([3.25]),
        "pair": np.array([-2.0, 1e12]),
        "negative": -np.abs(rng.normal(1000, 1, 400)),
        "zeros": np.array([0.0, -0.0, 0.0]),
        "clustered": np.append(1e9 + np.arange(400) * 1e-7, 1.005e9),
        "close": 1e9 + np.arange(300) * 1e-6,
    }


def test_groups(spark, limit):
    rows = [(k, float(x)) for k, xs in groups().items() for x in xs]
    rows += [(None, 1.0), ("normal", None), ("normal", float("nan")), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    found = {r[0]: r[1:] for r in group_quantiles(df, ["k"], "x", PROBS, NAMES).collect()}
    assert set(found) == set(groups())
    for key, xs in groups().items():
        np.testing.assert_allclose(found[key], np.quantile(xs, PROBS), rtol=1e-12, err_msg=key)


def test_whole_column(spark, limit):
    df = spark.range(1, 1002).selectExpr("cast(id AS double) AS x")
    assert quantile_values(df, "x", [0.5, 0.01]) == [501.0, 11.0]
    assert quantile_values(df.where("x < 0"), "x", [0.5]) == [None]


def test_no_broadcast_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(quantile, "CELL_VALUES", 10)
    monkeypatch.setattr(quantile, "MAX_BROADCAST_BYTES", 1)
    df = spark.range(1000).selectExpr("id % 3 AS k", "cast(id AS double) AS x")
    found = dict(group_quantiles(df, ["k"], "x", [0.5], ["m"]).collect())
    assert found == {k: float(np.median(np.arange(k, 1000, 3))) for k in range(3)}
