"""Tables written to a shared folder, so that lineage is cut and sizes are known."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: The open scopes of this thread or task; another one's folders are none of its business.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


#: Spark removes the shuffle files of a query as it ends; nothing reads them again once its result is written.
_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; where it is unset, the warehouse of the session."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str = "stage") -> str:
    path = f"{scratch_dir(spark)}/tabclean/{name}-{uuid.uuid4().hex}"
    if scopes := _SCOPES.get():
        scopes[-1].append(path)
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` once and read it back; in Zstandard, as what is staged is much of the disk a query needs.

    What follows no longer recomputes `df`, survives lost executors, and Catalyst
    plans with the true size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN_SHUFFLES, "false")
    spark.conf.set(_CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def staged_until_end(spark: SparkSession) -> Iterator[None]:
    """Removes the folders staged within the block; results must have been written before it ends."""
    paths: list[str] = []
    before = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(before)
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
