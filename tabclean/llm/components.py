"""Connected components of a link table, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .skew import spread_join


def narrow(links: DataFrame) -> DataFrame:
    """A table of ids in an eighth of the shuffle's partitions, which are made for texts."""
    parts = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return links.coalesce(max(1, parts // 8))


def _written(edges: DataFrame) -> DataFrame:
    return stage(narrow(edges), "links")


def _smallest(edges: DataFrame, key: str, other: str) -> DataFrame:
    """Each pair with the smallest of `key` and all its partners."""
    least = edges.groupBy(key).agg(F.least(F.min(other), F.col(key)).alias("__m"))
    return spread_join(edges, least, key, spread_by=other)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Large-star and small-star steps in turn: every step ties nodes to the smallest
    partner of a neighbour, which shortens paths without making new links. Groups are
    only ever reduced to a minimum; nodes with very many links are dealt over tasks. Each
    step is written, so lost executors repeat one step. Links of a node to itself give a
    component of one.
    """
    alone = edges.where("a = b").select("a")
    now = _written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = _written(now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        large = _smallest(both, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("__m").alias("b"))
        large = _written(large.where("a <> b").distinct())
        small = _smallest(large, "a", "b")
        small = small.select(F.explode(F.array(
            F.struct(F.col("a"), F.col("__m").alias("b")), F.struct(F.col("b").alias("a"), F.col("__m").alias("b"))
        )).alias("e")).select("e.*")
        after = _written(small.where("a <> b").distinct())
        if _checked(after) == _checked(now):
            break
        now = after
    pairs = after.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = after.select(F.col("b").alias("node"), F.col("b").alias("component"))
    single = alone.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return pairs.union(roots).union(single).groupBy("node").agg(F.min("component").alias("component"))


def _checked(edges: DataFrame) -> tuple:
    folded = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(folded)).first())
