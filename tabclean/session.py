"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot key's partition at run time, also where that costs a later shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # The JVM never compiles methods over 8000 bytes; wide text projections would exceed that.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "tabclean", master: str | None = None, **conf: str) -> SparkSession:
    """A session with `CONF`; keyword names use `__` for dots (`spark__ui__enabled="false"`)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**CONF, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
