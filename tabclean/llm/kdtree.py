"""Exact largest inner products by KD-trees, one for each shard of the vectors.

A tree splits its points at the median of the widest dimension and keeps the tight bounding
box of every node. The inner product of a query with any point of a box is at most the sum
of the better of both box sides in each dimension. A search goes through the nodes best
bound first and ends when the bound falls below the k-th score found so far. Shards are
searched in two waves: the k-th scores of the first go with the queries to the second.

Vectors are dealt to shards by a hash of their id, queries are packed into blocks, and a
task meets one shard with one block; so memory is bounded by both, not by the tables.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.staging import stage

SHARD_VECTORS, BLOCK_QUERIES, LEAF = 8192, 1024, 128
#: Shards of the first wave: one in so many.
FIRST_WAVE = 8
_EXACT = 2.0**53


class Tree:
    """Points in leaf order with the boxes of all nodes; children of node i are given by index."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.arange(len(ids))
        self.low, self.high, self.spans, self.children = [], [], [], []
        self._split(points, order, 0, len(order))
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _split(self, points: np.ndarray, order: np.ndarray, start: int, stop: int) -> int:
        own, node = points[order[start:stop]], len(self.spans)
        low, high = own.min(axis=0), own.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.spans.append((start, stop))
        self.children.append(None)
        if stop - start > LEAF and (high > low).any():
            middle = (stop - start) // 2
            axis = int(np.argmax(high - low))
            order[start:stop] = order[start:stop][np.argpartition(own[:, axis], middle)]
            self.children[node] = (
                self._split(points, order, start, start + middle), self._split(points, order, start + middle, stop)
            )
        return node

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, least: np.ndarray) -> list[list[tuple]]:
        """For each query its k best (score, -id) in this tree, but for its own id and scores below `least`."""
        plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
        bounds = plus @ self.high.T + minus @ self.low.T
        # Sums of large products are rounded; the bound is raised by what that may cost.
        bounds += (np.abs(plus) @ np.abs(self.high.T) + np.abs(minus) @ np.abs(self.low.T)) * 1e-13
        whole = np.abs(queries).max(initial=0) * np.abs(self.points).max(initial=0) * max(1, queries.shape[1]) < _EXACT
        out = []
        for q, query in enumerate(queries):
            best: list[tuple] = []
            floor = least[q]
            todo = [(-bounds[q, 0], 0)]
            while todo:
                bound, node = heapq.heappop(todo)
                if -bound < floor:
                    break
                if self.children[node]:
                    for child in self.children[node]:
                        if bounds[q, child] >= floor:
                            heapq.heappush(todo, (-bounds[q, child], child))
                    continue
                start, stop = self.spans[node]
                if whole:
                    scores = self.points[start:stop] @ query
                    near = start + np.flatnonzero(scores >= floor)
                    found = [(int(scores[i - start]), -int(self.ids[i])) for i in near if self.ids[i] != own[q]]
                else:
                    exact = [int(x) for x in query]
                    found = [(sum(int(a) * b for a, b in zip(self.points[i], exact)), -int(self.ids[i]))
                             for i in range(start, stop) if self.ids[i] != own[q]]
                best = heapq.nlargest(k, best + found)
                if len(best) == k:
                    floor = max(floor, best[-1][0])
            out.append(best)
        return out


def _packed(vectors: DataFrame, group: str, size_name: str) -> DataFrame:
    """One row for each group and dimension: ids and values as bytes."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy().astype(np.int64)
        order = np.argsort(ids, kind="stable")
        lists = table.column("v").combine_chunks()
        dim = table.column("dim")[0].as_py()
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), dim)[order]
        return pa.table({
            group: table.column(group).slice(0, 1), "dim": table.column("dim").slice(0, 1),
            f"{size_name}_ids": pa.array([ids[order].tobytes()], pa.binary()), f"{size_name}_values": pa.array([values.tobytes()], pa.binary()),
        })

    schema = f"{group} long, dim long, {size_name}_ids binary, {size_name}_values binary"
    return stage(vectors.select(group, "dim", "id", "v").groupBy(group, "dim").applyInArrow(pack, schema), size_name)


def _read(ids: bytes, values: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, np.int64)
    return found, np.frombuffer(values, np.float64).reshape(len(found), dim)


def _wave(trees: DataFrame, blocks: DataFrame, shards: Column, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each shard for each query of each block."""

    def searched(table: pa.Table) -> pa.Table:
        rows = []
        for r in table.to_pylist():
            tree = Tree(*_read(r["p_ids"], r["p_values"], r["dim"]))
            own, queries = _read(r["q_ids"], r["q_values"], r["dim"])
            least = np.frombuffer(r["least"], np.float64) if r["least"] else np.full(len(own), -np.inf)
            for q, best in zip(own, tree.search(queries, own, k, least)):
                rows += [(int(q), -i, s) for s, i in best]
        columns = zip(*rows) if rows else ([], [], [])
        return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    met = blocks.withColumn("shard", F.explode(shards)).join(trees, ["shard", "dim"])
    return met.groupBy("shard", "block", "dim").applyInArrow(searched, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def all_finite(v: Column) -> Column:
    """Whether an array of doubles is there and each component is a finite number."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf)
    return v.isNotNull() & ~F.exists(v, odd)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of `vectors` and `queries`, both (id, v) with v an array of doubles.

    The score is the inner product as a whole number, so components must be whole numbers and
    scores fit into a long. The k highest scores of each query are returned (all, if there
    are fewer), ties to the smaller id; a query's own id is no candidate. Vectors that are
    null or hold null or non-finite components, and those without an id, take no part; a
    vector meets vectors of its own length only. Of rows that repeat an id, those with
    different components are different candidates; as queries their candidates are put
    together and the k best returned.
    Empty tables give an empty table.
    """
    usable = lambda df: df.where(F.col("id").isNotNull() & all_finite(F.col("v"))).withColumn("dim", F.size("v").cast("long"))
    vectors, queries = stage(usable(vectors), "vectors"), stage(usable(queries), "queries")
    count, asked = vectors.count(), queries.count()
    shards = max(1, math.ceil(count / SHARD_VECTORS))
    blocks = max(1, math.ceil(asked / BLOCK_QUERIES))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    trees = _packed(dealt, "shard", "p")
    packed = _packed(queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), "block", "q")
    first = max(1, shards // FIRST_WAVE)
    found = stage(_wave(trees, packed.withColumn("least", F.lit(None).cast("binary")), F.sequence(F.lit(0).cast("long"), F.lit(first - 1).cast("long")), k), "found")
    if first < shards:
        kth = _best(found, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
        kth = queries.select("id", "dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")).join(kth, "id", "left")

        def in_order(table: pa.Table) -> pa.Table:
            order = np.argsort(table.column("id").to_numpy(), kind="stable")
            least = table.column("least").to_numpy(zero_copy_only=False).astype(np.float64)[order]
            least = np.where(np.isnan(least), -np.inf, least)
            return pa.table({"block": table.column("block").slice(0, 1), "dim": table.column("dim").slice(0, 1), "least": pa.array([least.tobytes()], pa.binary())})

        floors = kth.groupBy("block", "dim").applyInArrow(in_order, "block long, dim long, least binary")
        rest = _wave(trees, packed.join(floors, ["block", "dim"]), F.sequence(F.lit(first).cast("long"), F.lit(shards - 1).cast("long")), k)
        found = found.unionByName(rest)
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2(spark: SparkSession, folder: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    given = F.col("embedding").cast("array<double>")
    # Floor gives a long, which has neither NaN nor infinity: they are looked for before.
    whole = F.when(all_finite(given), F.transform(given, lambda x: F.floor(x * 256).cast("double")))
    vectors = table.select(F.col("vec_id").cast("long").alias("id"), whole.alias("v"))
    return top_k(vectors, vectors.where("id % 50 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND list_count(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""
