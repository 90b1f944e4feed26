"""A bundle is seen whole or not at all."""

import pytest
from pyspark.sql import functions as F

from tabclean.sources import bundle


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_versions(spark, tmp_path, fmt):
    folder = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        bundle.read_bundle(spark, folder)
    a, b = spark.range(5).selectExpr("id", "'x,\"y' AS t"), spark.range(3).selectExpr("id * 2D AS d")
    assert bundle.publish({"a": a, "b": b}, folder, fmt) == 1
    assert bundle.publish({"a": a.limit(2), "b": b.limit(1)}, folder, fmt) == 2
    assert {n: df.count() for n, df in bundle.read_bundle(spark, folder).items()} == {"a": 2, "b": 1}
    first = bundle.read_bundle(spark, folder, 1)
    assert rows(first["a"]) == rows(a) and rows(first["b"]) == rows(b) and first["a"].dtypes == a.dtypes
    with pytest.raises(FileNotFoundError):
        bundle.read_bundle(spark, folder, 7)


def test_failure_between_tables(spark, tmp_path):
    folder = str(tmp_path / "out")
    good = spark.range(5)
    bundle.publish({"a": good, "b": good}, folder)
    broken = good.select(F.raise_error(F.lit("no such luck")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no such luck"):
        bundle.publish({"a": good.limit(1), "b": broken, "c": good}, folder)
    seen = bundle.read_bundle(spark, folder)
    assert bundle.versions(spark, folder) == [1] and {n: df.count() for n, df in seen.items()} == {"a": 5, "b": 5}
    assert bundle.publish({"a": good.limit(2)}, folder) == 2


def test_two_writers(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    monkeypatch.setattr(bundle, "versions", lambda spark, directory: [])
    bundle.publish({"a": spark.range(1)}, folder)
    with pytest.raises(FileExistsError):
        bundle.publish({"a": spark.range(2)}, folder)
    monkeypatch.undo()
    assert bundle.read_bundle(spark, folder)["a"].count() == 1
