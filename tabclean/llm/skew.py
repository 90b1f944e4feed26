"""Joins in which one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import scratch_path

#: A key with more than this share of the rows is heavy, so there are fewer than 1 / SHARE of them.
SHARE = 0.001
SALTS = 32
#: So many rows of a key are no load for one task.
LEAST_ROWS = 20_000


def heavy_keys(fact: DataFrame, key: str, share: float = SHARE) -> list:
    """The keys with more than `share` of all rows and `LEAST_ROWS`: fewer than 1 / share values, by a grouped count."""
    rows = fact.count()
    least = max(share * rows, LEAST_ROWS)
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    # No key of a table with fewer rows can be heavy, so it isn't counted by key.
    top = counts.orderBy(F.desc("__n")).limit(int(1 / share)).collect() if least < rows else []
    return [r[key] for r in top if r["__n"] > least]


def spread_join(
    fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", spread_by: str | None = None,
    salts: int = SALTS, heavy: list | None = None,
) -> DataFrame:
    """Inner or left join on `key`, which is unique in `dim`; heavy and null keys are dealt over `salts` tasks.

    Only the `dim` rows of heavy keys are copied, `salts` times each; all other rows are
    joined as they are, so a bucketed `dim` is not shuffled for them. `fact` should be
    written already, since it is counted first, unless `heavy` is known. Rows are dealt by
    a hash of `spread_by` (all columns of `fact` if not given), so that a repeated task
    deals alike.
    """
    heavy = heavy_keys(fact, key) if heavy is None else heavy
    listed = F.coalesce(F.col(key).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    if how == "inner" and not heavy:
        return fact.join(dim, key)
    apart = listed if how == "inner" else listed | F.col(key).isNull()
    salt = F.pmod(F.xxhash64(*([spread_by] if spread_by else fact.columns)), F.lit(salts)).cast("int")
    every = F.explode(F.array(*[F.lit(i) for i in range(salts)]))
    hot = fact.where(apart).withColumn("__salt", salt).join(dim.where(listed).withColumn("__salt", every), [key, "__salt"], how)
    return fact.where(~apart).join(dim, key, how).unionByName(hot.drop("__salt"))


def stage_bucketed(df: DataFrame, key: str, name: str) -> str:
    """Writes `df` as a table bucketed and sorted by `key`, as many buckets as a shuffle has partitions; its name."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return table
