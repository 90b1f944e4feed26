"""Registered queries and their oracle texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import Views, with_steps

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(
    key: str, sql: str | None = None, steps: tuple[str, ...] = ("sales",), digits: dict[str, int] | None = None
):
    """Register a function of `Views` under a key.

    `digits` rounds measures alike on both sides, because the last digits of sums of
    doubles depend on the order of addition.
    """

    def register(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(Views(spark, folder))
            if digits:
                df = df.withColumns({c: F.round(F.col(c).cast("double"), d) for c, d in digits.items()})
            return df

        if key in QUERIES:
            raise ValueError(f"query {key} exists already")
        QUERIES[key] = run
        if sql:
            body = f"SELECT * FROM (\n{sql}\n)" if sql.lstrip().startswith("WITH") else sql
            if digits:
                rounded = ", ".join(f'round(cast("{c}" AS double), {d}) AS "{c}"' for c, d in digits.items())
                body = f"SELECT * REPLACE ({rounded}) FROM (\n{sql}\n)"
            ORACLES[key] = with_steps(steps, body)
        return fn

    return register
