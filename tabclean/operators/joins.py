"""Join of a large table with a lookup table of unknown size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

MAX_BROADCAST_BYTES = 32 << 20
SALTS = 32
# A key with more than this share of the large table is hot, so there are fewer than 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def keys_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def one_per_key(dim: DataFrame, keys: list[str]) -> DataFrame:
    """The dimension with one row per key: the smallest in order of its other columns. Null keys match nothing."""
    rest = [c for c in dim.columns if c not in keys]
    least = dim.where(keys_present(keys)).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__least"))
    return least.select(*keys, *[F.col("__least")[c].alias(c) for c in rest])


def prefix_rows(dim: DataFrame) -> DataFrame:
    """A prefix table (code, make, body) with upper-cased codes of three characters, one row each."""
    dim = dim.select(F.upper("code").alias("code"), "make", "body").where(F.length("code") == 3)
    return one_per_key(dim, ["code"])


def bounded(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the written dimension takes at most `max_bytes` as rows in memory."""
    wide = [c for c, kind in dim.dtypes if kind in ("string", "binary")]
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in wide), F.lit(16 * len(dim.columns) + 16))
    return (dim.agg(F.sum(text.cast("bigint"))).first()[0] or 0) <= max_bytes


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    extra: Column | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = SALTS,
    literal: bool = False,
    staged: bool = False,
) -> DataFrame:
    """Left join that adds the dimension's other columns to `fact`.

    The dimension is written once and the bytes of its rows are added up. Within the bound it is
    broadcast, so `fact` is never shuffled. Beyond it both sides are shuffled on the keys;
    keys that a count of `fact` shows to be hot, and null keys, are spread over `salts`
    partitions, and only the dimension's rows of hot keys are copied. `literal` is for
    tables that stand in the plan itself, `staged` for a dimension written already. `extra`
    may name columns of both sides.
    """
    renamed = dim.withColumnsRenamed({k: f"__dim_{k}" for k in on})
    if not (literal or staged):
        renamed = stage(renamed, "dim")
    left = fact
    tests = [F.col(k) == F.col(f"__dim_{k}") for k in on]
    if literal or bounded(renamed, max_broadcast_bytes):
        renamed = F.broadcast(renamed)
    else:
        # The counted columns decide; what else `fact` computes is pruned away here.
        counts = stage(fact.where(keys_present(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("__n")), "counts")
        least = (counts.agg(F.sum("__n")).first()[0] or 0) * HOT_SHARE
        hot = counts.where(F.col("__n") > least).select(*[F.col(k).alias(f"__hot_{k}") for k in on], F.lit(True).alias("__hot"))

        def marked(frame: DataFrame, prefix: str) -> DataFrame:
            same = reduce(lambda a, b: a & b, [F.col(f"{prefix}{k}") == F.col(f"__hot_{k}") for k in on])
            return frame.join(F.broadcast(hot), same, "left").drop(*[f"__hot_{k}" for k in on])

        plain = [c for c, kind in fact.dtypes if not kind.startswith(("map", "array", "struct", "variant"))][:8]
        spread = F.pmod(F.xxhash64(*plain), F.lit(salts))
        left = marked(fact, "").withColumn("__salt", F.when(F.col("__hot") | ~keys_present(on), spread).otherwise(0)).drop("__hot")
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
        copies = F.when(F.col("__hot"), every).otherwise(F.array(F.lit(0).cast("bigint")))
        renamed = marked(renamed, "__dim_").withColumn("__dim_salt", F.explode(copies)).drop("__hot")
        tests.append(F.col("__salt") == F.col("__dim_salt"))
    if extra is not None:
        tests.append(extra)
    joined = left.join(renamed, reduce(lambda a, b: a & b, tests), "left")
    return joined.drop(*[f"__dim_{k}" for k in on], "__salt", "__dim_salt")
